"""Damage and repair of conversations against a search over all edits."""

import hashlib
import random
import zlib

import pytest

from wardlake.llm import queries, turn_automaton
from wardlake.llm.common import table

SCHEMA = "conv_id bigint, turn bigint, role string, text string, segment string, letters string, cost string"
SPACE = " \t\n\v\f\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        if h == 0:
            continue
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(h, text)
        kept.extend([(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1))
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def best_repair(rows, faults):
    """Cheapest audit by trying every edit from the front, least audit first among equals."""
    layer = {("", 0): (0, "", ())}
    for (_, role, text), fault in [*zip(rows, faults, strict=True), ((None, None, None), None)]:
        # Insertions before this row, at most four in a row are ever of use.
        for _ in range(4):
            for (at, k), (cost, audit, said) in list(layer.items()):
                for name in ("user", "assistant"):
                    new = NEXT.get((at, name[0]))
                    choice = (cost + 5, audit + "I", (*said, name + ":"))
                    if new and choice[:2] < layer.get((new, k), (1e9,))[:2]:
                        layer[new, k] = choice
        if role is None:
            break
        later = {}
        for (at, k), (cost, audit, said) in layer.items():
            choices = [(at, cost + 2, "D", said)]
            if fault in (None, "truncated"):
                extra = 5 * (fault == "truncated")
                if NEXT.get((at, role[:1])):
                    choices.append((NEXT[at, role[:1]], cost + extra, "K", (*said, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if NEXT.get((at, name[0])):
                        choices.append((NEXT[at, name[0]], cost + extra + 1, "R", (*said, f"{name}:{text}")))
            for new, price, edit, words in choices:
                choice = (price, audit + edit, words)
                if choice[:2] < later.get((new, k + 1), (1e9,))[:2]:
                    later[new, k + 1] = choice
        layer = later
    return min((v for (at, _), v in layer.items() if at in ("", "a")), key=lambda v: v[:2])


def plain(rows):
    out = {}
    for conv, kept in plain_damage(rows).items():
        seen, faults = set(), []
        for _, role, text in kept:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
            faults.append(fault)
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit, said = best_repair([(t, r, x) for t, r, x in kept], faults) if kept else (0, "", ())
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def result(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = turn_automaton.repaired_conversations(df).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def some_rows(convs=150, longest=9):
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "s"]
    texts = ["Yes.", "No!", "Why?", "and then", "", " \n", None, " ", "Fine. ", "é.\n", "漢字", "x" * 500 + "."]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.6:
                role, text = ("system", "user", "assistant")[0 if turn == 0 and rng.random() < 0.3 else 1 + turn % 2], f"Say {turn}."
            else:
                role, text = rng.choice(roles), rng.choice(texts)
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows + rows[:40]


def test_repairs_equal_the_search(spark):
    rows = some_rows()
    assert result(spark, rows) == plain(rows)


def test_segments_and_borders_change_nothing(spark, monkeypatch):
    rows = some_rows(12, 60) + [(99, t, "user" if t % 2 else "assistant", f"Line {t % 40}.") for t in range(700)]
    whole = plain(rows)
    monkeypatch.setattr(turn_automaton, "SEGMENT_ROWS", 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = result(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == whole


def test_costs_at_borders_are_few():
    assert len(turn_automaton.border_costs()) < 64


def test_empty_table_and_dropped_conversations(spark):
    assert result(spark, []) == {}
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert result(spark, [(dropped, 0, "user", "Hi.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_given_conversations(spark, small):
    rows = [tuple(r) for r in table(spark, small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_turn_automaton(spark, small).collect()}
    assert got == plain(rows)


@pytest.mark.parametrize("letters", ["A", "AEI", "EIEI", "IIDD", "MNOP"])
def test_shared_endings_give_the_same_nodes(letters):
    one, two = turn_automaton.Endings(), turn_automaton.Endings()
    one.move_to(0, "EI" + letters)
    kept = one.nodes[:3]
    one.move_to(0, "EI" + letters[::-1])
    two.move_to(0, "EI" + letters[::-1])
    assert one.nodes == two.nodes and all(a is b for a, b in zip(kept, one.nodes, strict=False))
