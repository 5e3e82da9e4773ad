"""Cheapest repair of the structure of conversations, over one automaton of all their endings.

A row of a conversation becomes one letter: the initial of its role with its first fault. Conversations that end alike
share those endings: sorted by their letters read from the end, each shares its longest common ending with the one
before it, so every node (a letter and the node that follows it) is made once. At a node stand, for each of the four
states of the grammar ``(s?(ua)+)?``, the cost to go and the first edit of the best audit, which goes on at the next
node: the audit of an ending is written once and shared by all that end so. Edits of equal cost at a node differ in
their initial, so the least initial gives the least audit and no two audits are ever compared.

Long conversations are cut into segments of bounded rows and bytes. Rows are sorted and cut by ranges of conversation
and turn, so one conversation may fill many tasks. The costs at a border, less the least of them, take few values
(``border_costs``), none depending on the data. A segment is solved for each, the answers are strung
together from the last segment to the first, and then each segment is written out for the one that holds. Only the
digest of a conversation's text, which is one sequence by its nature, reads the pieces of one conversation in order
in one task, piece by piece.

A null id, turn, role or text counts as one space where damage is drawn; a null id is a conversation of its own. Rows of one
turn are taken by role and text; nulls come first. Repeated rows count as duplicates. A conversation without rows after the
damage has zeros, an empty audit and the digest of nothing. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import staged

# Bounds of a segment.
SEGMENT_ROWS = 1024
SEGMENT_BYTES = 1 << 17
# Conversations with equal letters are dealt to this many parts when answers go back to them.
SALTS = 32

# The share of damaged rows, marks that end a text, white space, and costs of the edits.
DAMAGE = 20
END_MARKS = ".!?"
SPACE = " \t\n\v\f\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 40

# States of the grammar: nothing yet, after the system row, after a user row, after an assistant row.
INITIALS = "sua"
TAKES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# The role that may be put or made in a state, and the state after it.
PUTS = ("user", "user", "assistant", "user")
AFTER_PUT = (2, 2, 3, 2)
ACCEPTS = (True, False, False, True)
# Letters of rows: the place of the initial times four, plus the fault.
FINE, CUT_OFF, BLANK, DUPLICATE = range(4)
Costs = tuple[int, int, int, int]


def letter(initial: str, fault: int) -> str:
    place = INITIALS.find(initial) if initial else -1
    return chr(ord("A") + (place if place >= 0 else len(INITIALS)) * 4 + fault)


def initial_of(row: str) -> str:
    place = (ord(row) - ord("A")) // 4
    return INITIALS[place] if place < len(INITIALS) else "x"


def fault_of(row: str) -> int:
    return (ord(row) - ord("A")) % 4


def _with_inserts(cost: list[int], edit: list[str]) -> tuple[Costs, str]:
    """Let rows be put in before what a node does; the smaller initial goes where costs are equal."""
    best = list(cost)
    for _ in range(3):
        best = [min(best[q], INSERT + best[AFTER_PUT[q]]) for q in range(4)]
    first = []
    for q in range(4):
        choices = [(cost[q], edit[q]), (INSERT + best[AFTER_PUT[q]], "I")]
        first.append(min(choices)[1])
    return tuple(best), "".join(first)


@lru_cache(maxsize=None)
def ending() -> tuple[Costs, str]:
    return _with_inserts([0 if ok else NEVER for ok in ACCEPTS], ["." if ok else "~" for ok in ACCEPTS])


@lru_cache(maxsize=None)
def before(row: str, costs: Costs) -> tuple[Costs, str]:
    """Costs and first edits of a node from its letter and the costs behind it, which are less the least of them."""
    initial, fault = initial_of(row), fault_of(row)
    cost, edit = [], []
    for q in range(4):
        choices = [(DELETE + costs[q], "D")]
        if fault in (FINE, CUT_OFF):
            extra = TRUNCATED if fault == CUT_OFF else 0
            if initial in TAKES[q]:
                choices.append((extra + costs[TAKES[q][initial]], "K"))
            choices.append((REROLE + extra + costs[AFTER_PUT[q]], "R"))
        best = min(choices)
        cost.append(best[0])
        edit.append(best[1])
    return _with_inserts(cost, edit)


def levelled(costs: Costs) -> tuple[int, Costs]:
    least = min(costs)
    return least, tuple(c - least for c in costs)


@lru_cache(maxsize=None)
def border_costs() -> tuple[Costs, ...]:
    """Every value that levelled costs take in front of the rows of any conversation."""
    found = [levelled(ending()[0])[1]]
    for costs in found:
        for place in range(4 * (len(INITIALS) + 1)):
            later = levelled(before(chr(ord("A") + place), costs)[0])[1]
            if later not in found:
                found.append(later)
    return tuple(found)


class Endings:
    """Nodes of the current ending, the last row at the bottom; what the next ending shares is kept.

    An entry is what lies behind the rows: 0 the end of the conversation, k + 1 a border with the costs at place k.
    """

    def __init__(self):
        self.entry, self.letters = None, ""
        self.nodes: list[tuple[int, Costs, str]] = []

    def move_to(self, entry: int, letters_from_end: str) -> None:
        if entry != self.entry:
            self.entry, self.letters = entry, ""
            self.nodes = [(0, *ending()) if entry == 0 else (0, border_costs()[entry - 1], "....")]
        shared = 0
        for x, y in zip(self.letters, letters_from_end, strict=False):
            if x != y:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        total, costs, _ = self.nodes[-1]
        for row in letters_from_end[shared:]:
            later, edits = before(row, costs)
            least, costs = levelled(later)
            total += least
            self.nodes.append((total, costs, edits))
        self.letters = letters_from_end

    def leave(self) -> int:
        """The ending as an entry for the rows before it."""
        return border_costs().index(self.nodes[-1][1]) + 1

    def walk(self, state: int) -> tuple[str, int, int]:
        """Best audit from a state in front of the ending, the state behind it, and the cost in between."""
        edits, at, begin = [], len(self.nodes) - 1, state
        while True:
            edit = self.nodes[at][2][state]
            if edit == ".":
                break
            edits.append(edit)
            if edit in "IR":
                state = AFTER_PUT[state]
            elif edit == "K":
                state = TAKES[state][initial_of(self.letters[at - 1])]
            at -= edit != "I"
        total, costs, _ = self.nodes[-1]
        return "".join(edits), state, total + costs[begin] - self.nodes[0][1][state]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage: ``conv_id, turn, role, text, copies``."""
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(name.cast("binary")) % DAMAGE).alias("h"),
    ).where("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", END_MARKS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("h") == 3, 2).otherwise(1).alias("copies"),
    )


def _key(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


SEGMENTS = (
    "conv_id bigint, segment bigint, open boolean, letters string, keys array<binary>, last_turn bigint, least_turn bigint, "
    " turns bigint, roles array<string>, texts array<string>"
)


class _Segment:
    def __init__(self):
        self.letters, self.keys, self.roles, self.texts = [], [], [], []
        self.last = self.least = None
        self.turns = self.size = 0

    def add(self, turn, role: str, text: str, fault: int, key: bytes | None) -> None:
        if turn is not None and (turn != self.last or not self.turns):
            self.turns += 1
            self.least = turn if self.least is None else self.least
        self.last = turn
        self.letters.append(letter(role[:1], fault))
        self.keys.append(key)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(role) + len(text)


def segments(rows: DataFrame) -> DataFrame:
    """Sorted rows packed into segments with their letters; ``open`` where a conversation may go on elsewhere.

    Repeats inside a conversation are found as far as its part of the range goes; ``keys`` name the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, out = TaskContext.get().partitionId(), 0, []
        current, here, pieces, first, seen = None, None, 0, True, set()

        def close(is_open: bool) -> None:
            nonlocal made
            out.append(
                {
                    "conv_id": current[0], "segment": (part << 32) + made, "open": is_open, "letters": "".join(here.letters),
                    "keys": here.keys if is_open else None, "last_turn": here.last, "least_turn": here.least,
                    "turns": here.turns, "roles": here.roles, "texts": here.texts,
                }
            )
            made += 1

        schema = pa.schema(
            [("conv_id", pa.int64()), ("segment", pa.int64()), ("open", pa.bool_()), ("letters", pa.string())]
            + [("keys", pa.list_(pa.binary()))]
            + [(n, pa.int64()) for n in ("last_turn", "least_turn", "turns")]
            + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
        )
        for batch in batches:
            held = 0
            for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or conv != current[0]:
                    if current is not None:
                        close(first or pieces > 0)
                        first = False
                    current, here, pieces, seen = (conv,), _Segment(), 0, set()
                elif len(here.letters) >= SEGMENT_ROWS or here.size >= SEGMENT_BYTES:
                    close(True)
                    here, pieces = _Segment(), pieces + 1
                shown = text.rstrip(SPACE)
                key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "replace"), digest_size=16).digest()
                for _ in range(copies):
                    if not shown:
                        here.add(turn, role, text, BLANK, None)
                    elif key in seen:
                        here.add(turn, role, text, DUPLICATE, None)
                    else:
                        seen.add(key)
                        here.add(turn, role, text, FINE if shown[-1] in END_MARKS else CUT_OFF, key)
                held += len(text)
                if out and held > SEGMENT_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if current is not None:
            close(True)
            yield pa.RecordBatch.from_pylist(out, schema)

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    chosen = rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text", "copies")
    return chosen.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SEGMENTS)


def across_segments(opened: DataFrame) -> DataFrame:
    """``segment, again``: places of rows whose role and text an earlier segment of the conversation has."""
    rows = opened.select("conv_key", "segment", F.posexplode("keys").alias("at", "key")).where("key is not null")
    least = rows.groupBy("conv_key", "key").agg(F.min("segment").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = rows.join(least, ["conv_key", "key"]).where(F.col("segment") > F.col("first"))
    return later.groupBy("segment").agg(F.collect_list("at").alias("again"))  # at most the rows of a segment


def with_duplicates(slim: DataFrame, again: DataFrame) -> DataFrame:
    """``conv_key, segment, letters`` with the rows marked that an earlier segment has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = []
            for text, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                rows = list(text)
                for at in places or ():
                    rows[at] = chr(ord(rows[at]) - fault_of(rows[at]) + DUPLICATE)
                letters.append("".join(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(letters, pa.string())], ["conv_key", "segment", "letters"]
            )

    joined = slim.select("conv_key", "segment", "letters").join(again, "segment", "left")
    return joined.select("conv_key", "segment", "letters", "again").mapInArrow(run, "conv_key string, segment bigint, letters string")


ANSWERS = "entry int, start int, letters string, leave int, stops array<int>, audit string, cost bigint"


def solved(requests: DataFrame) -> DataFrame:
    """Answers to distinct ``entry, start, letters``: sorted from the end, so shared endings are solved once.

    With ``start`` -1 the states behind the segment for all four states in front of it, else the audit and its cost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for batch in batches:
            entries, starts, letters = (c.to_pylist() for c in batch.columns)
            leave, stops, audits, costs = [], [], [], []
            for entry, start, row in zip(entries, starts, letters, strict=True):
                endings.move_to(entry, row[::-1])
                leave.append(endings.leave())
                if start < 0:
                    stops.append([endings.walk(q)[1] for q in range(4)])
                    audits.append(None)
                    costs.append(None)
                else:
                    audit, _, cost = endings.walk(start)
                    stops.append(None)
                    audits.append(audit)
                    costs.append(cost)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leave, pa.int32()), pa.array(stops, pa.list_(pa.int32()))]
                + [pa.array(audits, pa.string()), pa.array(costs, pa.int64())],
                ["entry", "start", "letters", "leave", "stops", "audit", "cost"],
            )

    order = [F.col("entry"), F.reverse("letters"), F.col("start")]
    distinct = requests.select("entry", "start", "letters").distinct()
    return distinct.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, ANSWERS)


def strung(many: DataFrame) -> DataFrame:
    """``conv_key, segment, entry, start, letters`` of conversations in several segments.

    Each segment is solved for all border costs; from the last segment to the first these are chosen, and from the
    first to the last the states.
    """
    entries = F.explode(F.sequence(F.lit(0), F.lit(len(border_costs())))).alias("entry")
    asked = many.select("conv_key", "segment", "letters", entries).withColumn("start", F.lit(-1))
    answers = asked.join(solved(asked), ["entry", "start", "letters"]).select("conv_key", "segment", "entry", "leave", "stops")

    def choose(table: pa.Table) -> pa.Table:
        table = table.sort_by([("segment", "ascending"), ("entry", "ascending")])
        count = len(border_costs()) + 1
        leave = table.column("leave").to_numpy().reshape(-1, count)
        stops = np.array(table.column("stops").to_pylist()).reshape(-1, count, 4)
        entry, start = np.zeros(len(leave), np.int32), np.zeros(len(leave), np.int32)
        for k in range(len(leave) - 1, 0, -1):
            entry[k - 1] = leave[k, entry[k]]
        for k in range(len(leave) - 1):
            start[k + 1] = stops[k, entry[k], start[k]]
        return pa.table(
            {"segment": table.column("segment").to_numpy()[::count], "entry": pa.array(entry), "start": pa.array(start)}
        )

    chosen = answers.groupBy("conv_key").applyInArrow(choose, "segment bigint, entry int, start int")
    return many.join(chosen, "segment").select("conv_key", "segment", "entry", "start", "letters")


REPAIRED = (
    "conv_key string, conv_id bigint, segment bigint, last_turn bigint, least_turn bigint, turns bigint, "
    "letters string, cost bigint, audit string, digest string, piece string"
)


def repaired(rows: DataFrame) -> DataFrame:
    """Segments with their repaired text as a digest, or as a piece where the conversation has more of them."""
    names = [c.split()[0] for c in REPAIRED.split(", ")]

    def text_of(roles: list, texts: list, audit: str, state: int) -> list[str]:
        out, at = [], 0
        for edit in audit:
            if edit == "I":
                out.append(f"{PUTS[state]}:")
                state = AFTER_PUT[state]
                continue
            if edit == "R":
                out.append(f"{PUTS[state]}:{texts[at]}")
                state = AFTER_PUT[state]
            elif edit == "K":
                out.append(f"{roles[at]}:{texts[at]}")
                state = TAKES[state][roles[at][:1]]
            at += 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, pieces = [], []
            for roles, texts, audit, start, many in zip(*(batch.column(k).to_pylist() for k in range(9, 14)), strict=True):
                lines = text_of(roles, texts, audit, start)
                text = "\n".join(lines)
                digests.append(None if many else hashlib.sha256(text.encode("utf-8", "replace")).hexdigest())
                pieces.append(text if many and lines else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:9], pa.array(digests, pa.string()), pa.array(pieces, pa.string())], names
            )

    chosen = rows.select(*names[:9], "roles", "texts", "audit", "start", "many")
    return chosen.mapInArrow(run, REPAIRED)


RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


class _Conversation:
    """Counts of a conversation, added up segment by segment."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.faults, self.illegal, self.cost, self.turns = [0] * 4, 0, 0, 0
        self.least = self.last = None
        self.initial, self.audit = "", []
        self.digest, self.text, self.begun = None, hashlib.sha256(), False

    def add(self, row: dict) -> None:
        if row["least_turn"] is not None:
            self.turns += row["turns"] - (self.last is not None and row["least_turn"] == self.last)
            self.least = row["least_turn"] if self.least is None else self.least
            self.last = row["last_turn"]
        for mark in row["letters"]:
            self.faults[fault_of(mark)] += 1
            initial = initial_of(mark)
            self.illegal += bool(self.initial) and self.initial + initial not in ("su", "ua", "au")
            self.initial = initial
        self.cost += row["cost"]
        self.audit.append(row["audit"])
        if row["digest"] is not None:
            self.digest = row["digest"]
        if row["piece"] is not None:
            self.text.update((("\n" if self.begun else "") + row["piece"]).encode("utf-8", "replace"))
            self.begun = True

    def result(self) -> tuple:
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return (
            self.conv_id, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT_OFF], self.illegal, self.cost,
            "".join(self.audit), self.digest or self.text.hexdigest(),
        )


def summed(rows: DataFrame) -> DataFrame:
    """One row a conversation from its segments in order."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, current, done = None, None, []

        def give() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv_key"] != key:
                    if current is not None:
                        done.append(current.result())
                    key, current = row["conv_key"], _Conversation(row["conv_id"])
                if row["letters"] is not None:
                    current.add(row)
            if done:
                yield give()
                done = []
        if current is not None:
            done.append(current.result())
            yield give()

    return rows.repartition("conv_key").sortWithinPartitions("conv_key", "segment").mapInArrow(run, RESULT)


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table with its faults, least cost, audit and the digest of its repaired text."""
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    packed = staged(segments(damaged(rows)).withColumn("conv_key", _key("conv_id")), "segments")
    many = packed.where("open").groupBy("conv_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv_key")
    opened = staged(packed.where("open").join(many, "conv_key").select("conv_key", "segment", "letters", "keys"), "opened")
    long = staged(strung(staged(with_duplicates(opened, across_segments(opened)), "opened")), "strung")
    short = packed.select("conv_key", "segment", "letters").join(opened.select("segment"), "segment", "left_anti")
    slim = short.select("conv_key", "segment", F.lit(0).alias("entry"), F.lit(0).alias("start"), "letters", F.lit(False).alias("many"))
    slim = slim.unionByName(long.withColumn("many", F.lit(True)))

    # Very many conversations may have the same letters: their answer goes to each part once.
    asked = ["entry", "start", "letters"]
    salted = slim.withColumn("salt", F.pmod(F.xxhash64("segment"), F.lit(SALTS)))
    answers = salted.select(*asked, "salt").distinct().join(solved(slim).select(*asked, "audit", "cost"), asked)
    answered = salted.join(answers, [*asked, "salt"]).drop("conv_key", "salt")
    texts = packed.drop("letters", "keys", "open").join(answered, "segment")
    everyone = rows.select("conv_id").distinct().select(_key("conv_id").alias("conv_key"), "conv_id", F.lit(-1).cast("bigint").alias("segment"))
    return summed(repaired(texts).unionByName(everyone, allowMissingColumns=True))
