"""Near duplicates and linked groups against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import components, documents, shingles

from wardlake.llm import ngram_join, projection_passes
from wardlake.llm.common import linked_groups

VECTORS = "vec_id bigint, label int, embedding array<float>, id string, vector string, component string"


def near_texts(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts: list[str | None] = [None, "", " \n", "one", "One", "one two", "four words are short"]
    for _ in range(12):
        base = [word() for _ in range(rng.randint(20, 120))]
        if rng.random() < 0.5:
            base += passage
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            texts.append((" ".join(copy)).upper() if rng.random() < 0.3 else "\n".join(copy))
    texts += [" ".join(passage[k:] + [word() for _ in range(k)]) for k in range(0, 24, 2)]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    texts = near_texts(seed)
    sets = [shingles(t) for t in texts]
    near = lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    expected = components(list(range(len(texts))), near)
    got = ngram_join.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), expected[i]) for i in expected}
    assert sum(i != c for i, c in expected.items()) > 10


def test_what_minimum_hashes_miss_is_found(spark, monkeypatch):
    """Without any partner by minimum hash, the exact search alone finds every link."""
    texts = near_texts(5)
    sets = [shingles(t) for t in texts]
    near = lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    expected = components(list(range(len(texts))), near)
    none = lambda leads, sets, percent: (*[spark.createDataFrame([], f"{a} bigint, {b} bigint") for a, b in (("a", "b"), ("id", "component"), ("a", "b"))],)
    monkeypatch.setattr(ngram_join, "grouped_in_rounds", none)
    got = ngram_join.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


@pytest.mark.parametrize("tile", [1024, 4])
def test_documents_around_a_leader_are_counted_in_tiles(spark, monkeypatch, tile):
    """Variants of one text, most of them just below the threshold, in clusters small enough to be cut."""
    monkeypatch.setattr(ngram_join, "DENSE", 3)
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(base)]
    for _ in range(70):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([2, 3, 4, 5, 6])):
            words[at] = f"x{rng.randint(0, 30)}"
        texts.append(" ".join(words))
    sets = [shingles(t) for t in texts]
    expected = components(list(range(len(texts))), lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    got = ngram_join.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert 5 < len(set(expected.values())) < 60


def test_join_edges(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    docs = documents(spark, [long, long + " more", "a b c d e f", "a b c d e f", None], [7, 3, None, 9, 9])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()), key=str)
    assert got == [(3, 29_997, 3), (7, 29_996, 3), (9, 0, 9), (9, 2, 9), (None, 2, None)]
    assert ngram_join.near_duplicates(docs.where("false")).count() == 0


def test_shared_shingles_are_counted_across_batches(spark):
    texts = near_texts(3)
    sets = [shingles(t) for t in texts]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:

        def read(batch):
            yield batch.column(0).to_pylist(), ngram_join.shingle_sets(batch.column(1)), None

        got = ngram_join.shared_counts(documents(spark, texts).select("doc_id", "text").repartition(5), read, 7).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for row in got:
        others = set().union(*(s for k, s in enumerate(sets) if k != row.doc_id))
        assert (row.n, row.shared) == (len(sets[row.doc_id]), len(sets[row.doc_id] & others))


def test_kept_rows_of_batches_never_share_a_group():
    """Batches of equal number in different partitions stay apart, and what is kept does not grow with the fragments."""
    texts = pa.array([t or "" for t in near_texts(3)])
    sets = ngram_join.shingle_sets(texts)
    kept = {}
    for fragments in (7, 2000):
        for batch in (5, (1 << 32) + 5, (300 << 32) + 5):
            rows = ngram_join.cells(batch, list(range(len(sets))), sets, None, fragments).to_pylist()
            kept[fragments, batch] = next(r for r in rows if r["frag"] < 0)
    assert len({r["frag"] for r in kept.values()}) == 3
    size = lambda r: sum(len(v) for k, v in r.items() if isinstance(v, bytes) and k != "per_frag")
    assert size(kept[2000, 5]) == size(kept[7, 5])
    many = ngram_join.cells(5, list(range(len(sets))), sets, None, 1 << 31).to_pylist()
    assert len(next(r for r in many if r["frag"] < 0)["per_frag"]) <= 16 * sum(map(len, sets))


def test_linked_groups(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, 500 + k) for k in range(1, 80)] + [(9, 9), (None, 3)]
    edges += [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)]
    got = {r.id: r.component for r in linked_groups(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    ids = sorted({x for e in edges if None not in e and e[0] != e[1] for x in e})
    links = {frozenset(e) for e in edges if None not in e}
    assert got == components(ids, lambda a, b: frozenset((a, b)) in links)
    assert linked_groups(spark, spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECTORS)


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows: list[tuple] = []
    for label in (0, 1, None):
        for _ in range(40):
            base = rng.standard_normal(24)
            for _ in range(int(rng.integers(1, 5))):
                near = base + rng.standard_normal(24) * 0.08
                rows.append((len(rows), label, (near * rng.uniform(0.1, 9)).astype(np.float32).tolist()))
        dense = rng.standard_normal(24)
        rows += [(len(rows) + k, label, (dense + rng.standard_normal(24) * 0.05).astype(np.float32).tolist()) for k in range(90)]
    rows.append((len(rows), 0, rows[0][2]))
    got = {r.vec_id: r for r in projection_passes.near_vectors(vectors(spark, rows)).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, _, v in rows}
    label = {i: k for i, k, _ in rows}
    near = lambda a, b: label[a] is not None and label[a] == label[b] and unit[a] @ unit[b] >= 0.98
    ids = list(unit)
    expected = components(ids, near)
    for i in ids:
        assert got[i].n_links == sum(near(i, j) for j in ids if j != i)
        assert got[i].component_id == expected[i] and got[i].kept == (expected[i] == i)


def test_links_the_passes_miss_are_found(spark, monkeypatch):
    """Lone pairs in one dense label, with small blocks and a pass that finds little."""
    monkeypatch.setattr(projection_passes, "PASSES", 1)
    monkeypatch.setattr(projection_passes, "WINDOW", 1)
    monkeypatch.setattr(projection_passes, "BLOCK", 100, raising=False)
    rng = np.random.default_rng(6)
    centre = 3 * rng.standard_normal(32)
    base = centre + rng.standard_normal((300, 32))
    rows = [(k, 1, v.tolist()) for k, v in enumerate(np.concatenate([base, base[:150] + rng.standard_normal((150, 32)) * 0.3]))]
    unit = np.array([v for _, _, v in rows], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    expected = components(list(range(len(rows))), lambda a, b: bool(near[a, b]))
    got = {r.vec_id: r for r in projection_passes.near_vectors(vectors(spark, rows)).collect()}
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all(r.n_links == near[i].sum() - 1 for i, r in got.items())
    assert sum(i != c for i, c in expected.items()) > 100


def test_vectors_without_a_direction(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0]]
    rows = [(k, 1, v) for k, v in enumerate(bad * 2)] + [(90, 1, [1e-30, 0.0]), (91, 1, [3e30, 0.0]), (92, 2, [1.0, 0.0]), (93, 1, [1.0, 0.0, 0.0])]
    rows += [(None, 1, [1.0, 0.0]), (95, None, [1.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in projection_passes.near_vectors(vectors(spark, rows)).collect()}
    assert got.pop(90) == (1, 90, True) and got.pop(91) == (1, 90, False)
    assert got.pop(None) == (0, None, True)
    assert all(v == (0, k, True) for k, v in got.items())
    assert projection_passes.near_vectors(vectors(spark, rows).where("false")).count() == 0
