"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to the signs of random projections, written one after another, and orders the vectors of
a label by this key. Neighbours within a bounded window are compared exactly, and verified pairs are united over all
passes. Close vectors agree in most signs, so in some pass they mostly stand side by side. Equal vectors are one node.
What the passes miss in a hot or dense label is found after them: all vectors of a label are compared exactly, block
against block. That gives each vector its true count of links, and the links between groups that the passes left apart.
The products grow with the square of a label; only counts and one row for each group joined leave a pair of blocks.

Passes sort by range of (pass, label, key, id): a label or a key that very many vectors share is cut like any other
range, and the first rows of a range are compared from the range before as well.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without label or id, link with
nothing. Vectors of different length are never compared. Rows of equal id are one node; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import linked_groups, map_batches, staged

PASSES = 16
WINDOW = 24
# Signs in a key.
SIGNS = 62
# Vectors in a block of a label, and in a product at a time.
BLOCK, TILE = 8192, 512

KEYED = "pass int, label bigint, size int, key bigint, id bigint, vector binary"
PLACED = KEYED + ", part int, place bigint"


def unit_rows(vectors: list[bytes]) -> np.ndarray:
    """Rows of equal size as unit vectors in double precision; scaled first, so no square leaves the range."""
    rows = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def keyed(nodes: DataFrame) -> DataFrame:
    """A row for each vector and pass with the key of that pass."""

    def run(batch: pa.RecordBatch) -> dict:
        ids, labels, sizes, vectors = (c.to_pylist() for c in batch.columns)
        out: list[tuple] = []
        powers = 1 << np.arange(SIGNS, dtype=np.int64)[::-1]
        for size in sorted(set(sizes)):
            some = [i for i, s in enumerate(sizes) if s == size]
            rows = unit_rows([vectors[i] for i in some])
            for k in range(PASSES):
                planes = np.random.default_rng((k, size)).standard_normal((size, SIGNS))
                keys = ((rows @ planes) > 0) @ powers
                out += [(k, labels[i], size, key, ids[i], vectors[i]) for i, key in zip(some, keys.tolist(), strict=True)]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        names = [x.split()[0] for x in KEYED.split(",")]
        return {n: pa.array(c, t) for n, c, t in zip(names, zip(*out, strict=True), kinds, strict=True)}

    return map_batches(nodes.select("id", "label", "size", "vector"), run, KEYED)


def placed(rows: DataFrame) -> DataFrame:
    """The order of all passes: range by range, with the number of the range and the place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            names = [x.strip().split()[0] for x in PLACED.split(",")]
            extra = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names)
            place += n

    order = ["pass", "label", "size", "key", "id"]
    ranges = PASSES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4
    return rows.repartitionByRange(max(ranges, 1), *order).sortWithinPartitions(*order).mapInArrow(run, PLACED)


def united(table: pa.Table, least: float) -> pa.Table:
    """Verified pairs of neighbours in a range, united: each linked id with the smallest of its run."""
    table = table.sort_by([("part", "ascending"), ("place", "ascending")])
    kind = np.stack([table.column(c).to_numpy() for c in ("pass", "label", "size")])
    ids = table.column("id").to_numpy()
    vectors = table.column("vector").to_pylist()
    ends = np.append(np.flatnonzero((kind[:, 1:] != kind[:, :-1]).any(axis=0)) + 1, len(ids))
    begin, a, b = 0, [], []
    for end in ends.tolist():
        rows = unit_rows(vectors[begin:end])
        for step in range(1, min(WINDOW, end - begin - 1) + 1):
            hit = np.flatnonzero(np.einsum("ij,ij->i", rows[:-step], rows[step:]) >= least)
            a.append(hit + begin)
            b.append(hit + begin + step)
        begin = end
    left, right = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    low = ids.copy()
    while True:
        least_id = np.minimum(low[left], low[right])
        changed = (low[left] != least_id) | (low[right] != least_id)
        if not changed.any():
            break
        np.minimum.at(low, left, least_id)
        np.minimum.at(low, right, least_id)
    moved = low != ids
    return pa.table({"a": pa.array(ids[moved], pa.int64()), "b": pa.array(low[moved], pa.int64())})


def block_links(nodes: DataFrame, least: float) -> DataFrame:
    """Exact links of each node with all of its label, and what joins groups: id, links, a, b.

    ``nodes``: id, label, size, component, copies, vector. Rows have either id and links (weighted by the copies of the
    other node), or components a and b that a link joins. A label is dealt into blocks of about ``BLOCK`` nodes; each
    pair of blocks is worked off in tiles, wherever it runs.
    """
    size = nodes.groupBy("label", "size").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = nodes.join(size, ["label", "size"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "size", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "id", "component", "copies", "vector",
    )
    schema = "id bigint, links bigint, a bigint, b bigint"
    return dealt.groupBy("label", "size", "low", "high").applyInArrow(lambda key, table: compared(key, table, least), schema)


def compared(key: tuple, table: pa.Table, least: float) -> pa.Table:
    """Links inside a pair of blocks: their number for each node, and the groups they join."""
    low, high = key[2].as_py(), key[3].as_py()
    units = unit_rows(table.column("vector").to_pylist())
    ids, group, copies, owner = (table.column(c).to_numpy() for c in ("id", "component", "copies", "own"))
    one, two = np.flatnonzero(owner == low), np.flatnonzero(owner == high)
    links = np.zeros(len(ids), np.int64)
    joined: set[tuple[int, int]] = set()
    for i in range(0, len(one), TILE):
        left = one[i : i + TILE]
        for j in range(i if low == high else 0, len(two), TILE):
            right = two[j : j + TILE]
            near = units[left] @ units[right].T >= least
            same = low == high and i == j
            if same:
                np.fill_diagonal(near, False)
            if not near.any():
                continue
            links[left] += near @ copies[right]
            if not same:
                links[right] += copies[left] @ near
            x, y = np.nonzero(near & (group[left][:, None] != group[right][None, :]))
            if len(x):
                ends = np.sort(np.stack([group[left[x]], group[right[y]]]), axis=0)
                joined.update(map(tuple, np.unique(ends, axis=1).T.tolist()))
    some = np.flatnonzero(links)
    counted = pa.array(ids[some].tolist() + [None] * len(joined), pa.int64())
    number = pa.array(links[some].tolist() + [None] * len(joined), pa.int64())
    a, b = (pa.array([None] * len(some) + [pair[k] for pair in joined], pa.int64()) for k in (0, 1))
    return pa.table({"id": counted, "links": number, "a": a, "b": b})


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """One row for each row of ``vectors`` (vec_id, label, embedding): vec_id, n_links, component_id and kept."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    )

    def as_bytes(batch: pa.RecordBatch) -> dict:
        data = [np.array(v, "<f8") + 0.0 for v in batch.column(2).to_pylist()]
        return {
            "id": batch.column(0),
            "label": batch.column(1),
            "size": pa.array([len(d) for d in data], pa.int32()),
            "vector": pa.array([d.tobytes() for d in data], pa.binary()),
        }

    exact = map_batches(rows.where(usable), as_bytes, "id bigint, label bigint, size int, vector binary")
    exact = staged(exact, "vectors")
    nodes = exact.groupBy("label", "size", "vector").agg(F.min("id").alias("id"), F.countDistinct("id").alias("copies"))
    nodes = staged(nodes, "nodes")

    order = staged(placed(keyed(nodes)), "passes")
    over = order.where((F.col("place") < WINDOW) & (F.col("part") > 0)).withColumn("home", F.col("part") - 1)
    windows = order.withColumn("home", F.col("part")).unionByName(over)
    links = windows.groupBy("home").applyInArrow(lambda table: united(table, least), "a bigint, b bigint")
    links = staged(links, "neighbours")
    found = linked_groups(spark, links)

    # What the passes miss: every pair of a label, with the groups found so far as components.
    grouped = nodes.join(found, "id", "left").select(
        "id", "label", "size", F.coalesce("component", "id").alias("component"), "copies", "vector"
    )
    checked = staged(block_links(grouped, least), "blocks")
    counts = checked.where("id is not null").groupBy("id").agg(F.sum("links").alias("links"))
    more = checked.where("a is not null").select("a", "b")
    groups = staged(linked_groups(spark, links.union(more)), "groups")
    judged = (
        nodes.join(groups, "id", "left")
        .join(counts, "id", "left")
        .select(
            F.col("vector"),
            F.col("label"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = exact.select("id", "label", "vector").distinct().join(judged, ["label", "vector"]).groupBy("id").agg(
        F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    out = rows.select("vec_id").join(linked, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
