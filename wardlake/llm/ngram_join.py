"""Near duplicates by word shingles: an exact similarity join over vertical fragments of the shingle order.

The global order of shingles is the order of their 64-bit hashes, cut into fragments. Each fragment counts on its own,
and the parts are summed:

1. For each document, how many of its shingles occur in another text. A document that shares less than the threshold
   can't be similar to any other and leaves here; in most corpora few stay. A batch of documents sends each shingle to
   its fragment once, however many documents hold it, and gets one bit back for it, so a shingle that very many
   documents hold costs one entry a batch.
2. Of those that stay, one representative of each distinct set is paired with leaders: of the documents with one
   minimum hash, the one whose shingles are most wholly known from others, as an original is known from its copies. The
   overlap of a pair is counted fragment by fragment and summed; verified pairs join groups. A large group of copies
   comes together around its original in pairs that grow with its size, not with its square.
3. What that misses: the count of step 1 is repeated between groups, and only documents that share enough with
   other groups form candidates, over the rarest part of their shingles (prefix filters, what either shares with other
   groups at all, and the bound that the places of the shared ones leave); the same overlap verifies them.

A step only leaves out documents or pairs that can't reach the threshold, so no link between different texts is lost.
Equal hashes of different shingles would be counted as one; for the sets of a pair the odds are below 1 in 10 ** 12.

Texts without a word are empty sets and linked with nothing; a text with fewer words than a shingle is one shingle.
Rows with one id are one node; a null id is linked with nothing of its own. Texts of any length are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.common import linked_groups, map_batches, staged
from wardlake.llm.words import text_slices

WORDS = 5
# Similarity in hundredths.
PERCENT = 75
# Vertical parts in which the overlap of a pair is counted.
PARTS = 4
# Minimum hashes a document looks for partners with.
LEADERS = 6
# Parts in which the documents of one minimum hash meet their leader.
MET_PARTS = 32
# Documents around one leader are counted against each other in tiles from this many on, and so many to a tile.
DENSE = 32
TILE = 1024
# Bytes of text that a fragment counts the shingles of.
FRAGMENT_BYTES = 12_000_000
_SEPARATORS = r"[\x20\x09-\x0D]+"
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Well spread 64-bit values of 64-bit values."""
    x = (x ^ _MIX[salt % 4]) * _MIX[(salt + 1) % 4]
    x = (x ^ (x >> np.uint64(29))) * _MIX[(salt + 2) % 4]
    return x ^ (x >> np.uint64(32))


# Each factor gives another order of well spread values.
LEADER_FACTORS = mixed(np.arange(1, LEADERS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    from pandas.util import hash_array

    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    lists = pc.split_pattern_regex(lowered, _SEPARATORS)
    per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    counts = np.bincount(owner[real], minlength=len(per_text))
    coded = flat.dictionary_encode()
    hashes = hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    stream = mixed(hashes.astype(np.uint64))[coded.indices.to_numpy()][real]
    ends = np.cumsum(counts)
    rolled = np.zeros(max(len(stream) - words + 1, 0), np.uint64)
    for k in range(words):
        rolled = (rolled * _MIX[1]) ^ stream[k : k + len(rolled)]
        rolled = rolled * _MIX[0] + np.uint64(k)
    rolled = mixed(rolled)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        begin = end - n
        if n == 0:
            out.append(np.zeros(0, np.uint64))
        elif n < words:
            short = np.uint64(n)
            for value in stream[begin:end]:
                short = mixed(np.array([short ^ value], np.uint64), 1)[0]
            out.append(np.array([short], np.uint64))
        else:
            out.append(np.unique(rolled[begin : end - words + 1]))
    return out


# --- Step 1: how much of a document occurs elsewhere -----------------------------------------------------------------

CELLS = (
    "frag bigint, batch bigint, lows binary, labels binary, mixed binary, ids array<bigint>, sizes binary,"
    " signs binary, alone_doc binary, per_frag binary, extra_run binary, extra_doc binary, known binary"
)
CELL_NAMES = [part.split()[0] for part in CELLS.split(",")]
CELL_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())] + [pa.binary()] * 7


def cells(
    batch: int, ids: list, sets: list[np.ndarray], labels: np.ndarray | None, fragments: int
) -> pa.RecordBatch:
    """What a batch of documents sends: a row for each fragment, and a row (a negative fragment of its own) it keeps for the answers.

    ``labels``: shingles count as shared between different labels only; None if each document is its own.
    """
    size = np.array([len(s) for s in sets], np.int64)
    hashes, docs = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    start = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    run = np.cumsum(np.append(0, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    own = np.arange(len(sets)) if labels is None else labels
    low = np.minimum.reduceat(own[docs], start) if len(start) else start
    high = np.maximum.reduceat(own[docs], start) if len(start) else start
    shared = low != high
    known = np.bincount(docs[shared[run]], minlength=len(sets)).astype("<u4")
    frag = ((hashes[start] >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
    lows = (hashes[start] & np.uint64(0xFFFFFFFF)).astype("<u4")
    alone = np.flatnonzero(~shared)
    first = docs[start]
    alone = alone[np.argsort(frag[alone] * len(sets) + first[alone], kind="stable")]
    # Fragments with entries, and how many: as long as the entries, whatever the number of fragments.
    per_frag = np.stack(np.unique(frag[alone], return_counts=True)).astype("<u8")
    # Further documents of a run with a single label, by the place of the run in the order sent.
    place = np.full(len(start), -1, np.int64)
    place[alone] = np.arange(len(alone))
    again = np.ones(len(docs), bool)
    again[start] = False
    again &= ~shared[run] if len(run) else again
    rows = []
    both = np.flatnonzero(shared)  # hashes, so fragments, ascend
    used = np.union1d(frag[alone], frag[both])
    bounds = [np.searchsorted(frag[x], used, side) for x in (alone, both) for side in ("left", "right")]
    for f, a, b, c, d in zip(used.tolist(), *(x.tolist() for x in bounds), strict=True):
        part, twice = alone[a:b], both[c:d]
        label = low[part].astype("<i8").tobytes() if labels is not None else b""
        rows.append([f, batch, lows[part].tobytes(), label, lows[twice].tobytes()] + [None] * 8)
    signs = np.array(
        [(np.bitwise_xor.reduce(mixed(s)), mixed(s, 2).sum()) if len(s) else (0, 0) for s in sets], np.uint64
    )
    least = np.array([[(x * k).min() if len(x) else 0 for k in LEADER_FACTORS] for x in map(mixed, sets)], np.uint64)
    rows.append(
        [-1 - batch, batch, None, None, None, ids, size.astype("<i8").tobytes()]
        + [np.hstack([signs, least]).astype("<u8").tobytes(), first[alone].astype("<u4").tobytes(), per_frag.tobytes()]
        + [place[run[again]].astype("<u4").tobytes(), docs[again].astype("<u4").tobytes(), known.tobytes()]
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), CELL_TYPES, strict=True)], CELL_NAMES
    )


ANSWERS = CELLS + ", bits binary"


def answered(key: tuple, table: pa.Table) -> pa.Table:
    """A fragment's answers: for each row a batch sent, one bit for each of its shingles. Kept rows pass through."""
    if key[0].as_py() < 0:
        return table.append_column("bits", pa.nulls(len(table), pa.binary()))
    batch = table.column("batch").to_pylist()
    lows = [np.frombuffer(x, "<u4") for x in table.column("lows").to_pylist()]
    label = table.column("labels").to_pylist()
    both = [np.frombuffer(x, "<u4") for x in table.column("mixed").to_pylist()]
    # Without labels every batch is a label: inside a batch, the shingles sent have one document each.
    labels = [np.frombuffer(x, "<i8") if x else np.full(len(v), b) for x, v, b in zip(label, lows, batch, strict=True)]
    value = np.concatenate(lows + both)
    named = np.concatenate(labels + [np.full(len(v), -1) for v in both])
    order = np.argsort(value, kind="stable")
    start = np.flatnonzero(np.append(True, value[order][1:] != value[order][:-1]))
    spread = np.minimum.reduceat(named[order], start) != np.maximum.reduceat(named[order], start)
    shared = np.empty(len(value), bool)
    shared[order] = np.repeat(spread, np.diff(np.append(start, len(value))))
    ends = np.cumsum([len(v) for v in lows])
    bits = [np.packbits(shared[e - len(v) : e]).tobytes() for e, v in zip(ends.tolist(), lows, strict=True)]
    n = len(batch)
    columns = [table.column("frag"), table.column("batch")] + [pa.nulls(n, t) for t in CELL_TYPES[2:]]
    return pa.Table.from_arrays(
        [*columns, pa.array(bits, pa.binary())], schema=pa.schema(list(zip(CELL_NAMES, CELL_TYPES, strict=True)) + [("bits", pa.binary())])
    )


STATS = "doc_id bigint, n bigint, shared bigint, sign_a bigint, sign_b bigint, least array<bigint>"


def summed(key: tuple, table: pa.Table) -> pa.Table:
    """The answers of all fragments to one batch, summed for each of its documents."""
    rows = table.to_pylist()
    kept = next(r for r in rows if r["frag"] < 0)
    size = np.frombuffer(kept["sizes"], "<i8")
    n = len(size)
    per_frag = np.frombuffer(kept["per_frag"], "<u8").reshape(2, -1).tolist()
    answers = {r["frag"]: r["bits"] for r in rows if r["frag"] >= 0}
    parts = [
        np.unpackbits(np.frombuffer(answers[f], np.uint8), count=c).astype(bool)
        for f, c in zip(*per_frag, strict=True)
    ]
    bit = np.concatenate(parts) if parts else np.zeros(0, bool)
    doc = np.frombuffer(kept["alone_doc"], "<u4").astype(np.int64)
    shared = np.frombuffer(kept["known"], "<u4").astype(np.int64) + np.bincount(doc[bit], minlength=n)
    extra = np.frombuffer(kept["extra_doc"], "<u4")[bit[np.frombuffer(kept["extra_run"], "<u4").astype(np.int64)]]
    shared = shared + np.bincount(extra.astype(np.int64), minlength=n)
    signs = np.frombuffer(kept["signs"], "<u8").reshape(n, -1).view("<i8")
    return pa.table(
        {
            "doc_id": pa.array(kept["ids"], pa.int64()),
            "n": pa.array(size),
            "shared": pa.array(shared),
            "sign_a": pa.array(signs[:, 0]),
            "sign_b": pa.array(signs[:, 1]),
            "least": pa.array(signs[:, 2:].tolist(), pa.list_(pa.int64())),
        }
    )


def shared_counts(rows: DataFrame, read, fragments: int) -> DataFrame:
    """``read(batch)`` turns an Arrow batch of ``rows`` into parts (ids, sets, labels); gives STATS of each document."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, sets, labels in read(batch):
                yield cells(number, ids, sets, labels, fragments)
                number += 1

    sent = rows.mapInArrow(send, CELLS)
    return sent.groupBy("frag").applyInArrow(answered, ANSWERS).groupBy("batch").applyInArrow(summed, STATS)


# --- Steps 2 and 3: pairs and their overlap --------------------------------------------------------------------------

SETS = "doc_id bigint, n bigint, part int, hashes binary"


def set_parts(docs: DataFrame, words: int) -> DataFrame:
    """The vertical parts of each document's set: doc_id, n, part, sorted hashes."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        out: list[tuple] = []
        for a, b in text_slices(batch.column(1)):
            for name, own in zip(
                batch.column(0).slice(a, b - a).to_pylist(), shingle_sets(batch.column(1).slice(a, b - a), words), strict=True
            ):
                part = (own >> np.uint64(62)).astype(np.int64) if PARTS == 4 else (own % np.uint64(PARTS)).astype(np.int64)
                out += [(name, len(own), p, own[part == p].astype("<u8").tobytes()) for p in range(PARTS)]
        names = [x.split()[0] for x in SETS.split(",")]
        return dict(zip(names, map(list, zip(*out, strict=True)), strict=True))

    def typed(batch: pa.RecordBatch) -> dict:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return {k: pa.array(v, t) for (k, v), t in zip(run(batch).items(), kinds, strict=True)}

    return map_batches(docs.select("doc_id", "text"), typed, SETS)


def similar(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (n + m - overlap)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose overlap, counted in each vertical part and summed, reaches the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), "part", F.col("hashes").alias("ha"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), "part", F.col("hashes").alias("hb"))
    wide = pairs.select("a", "b").join(left, "a").join(right, ["b", "part"])

    def count(batch: pa.RecordBatch) -> dict:
        a, b, na, nb, ha, hb = (c.to_pylist() for c in batch.columns)
        same = [
            len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
            for x, y in zip(ha, hb, strict=True)
        ]
        return {k: pa.array(v, pa.int64()) for k, v in zip(("a", "b", "na", "nb", "same"), (a, b, na, nb, same), strict=True)}

    schema = "a bigint, b bigint, na bigint, nb bigint, same bigint"
    counted = map_batches(wide.select("a", "b", "na", "nb", "ha", "hb"), count, schema)
    total = counted.groupBy("a", "b", "na", "nb").agg(F.sum("same").alias("same"))
    return total.where(similar(F.col("same"), F.col("na"), F.col("nb"), percent)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles and component_id, the smallest linked id."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FRAGMENT_BYTES))

    def from_texts(batch: pa.RecordBatch):
        ids, texts = batch.column(0), batch.column(1)
        for a, b in text_slices(texts):
            yield ids.slice(a, b - a).to_pylist(), shingle_sets(texts.slice(a, b - a), words), None

    stats = staged(shared_counts(docs.select("doc_id", "text"), from_texts, fragments), "shared")

    # Documents that share enough with any other text; one for each distinct set.
    sign = ["n", "sign_a", "sign_b"]
    staying = stats.where("n > 0 and doc_id is not null").where(100 * F.col("shared") >= percent * F.col("n"))
    first = F.min(F.struct("doc_id", "shared", "least")).alias("first")
    classes = staying.groupBy(*sign).agg(first).select(*sign, F.col("first.doc_id").alias("head"), "first.shared", "first.least")
    classes = staged(classes, "classes")
    # A table of ids alone, by whose size Spark can tell whether the texts need a shuffle for it.
    heads = staged(classes.select(F.col("head").alias("doc_id")).distinct(), "heads")
    texts = docs.select("doc_id", "text").join(heads, "doc_id", "left_semi")
    sets = staged(set_parts(texts, words), "sets")

    known = (F.col("shared") / F.col("n")).alias("known")
    leads = staged(classes.select(F.col("head").alias("id"), "n", known, F.posexplode("least").alias("k", "value")), "leads")
    links, labels, best = grouped_in_rounds(leads, sets, percent)

    # What the rounds miss: documents that share enough with other groups.
    def from_sets(batch: pa.RecordBatch):
        ids, label, hashes = batch.columns
        label = label.to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in text_slices(hashes):
            own = [np.frombuffer(h, "<u8") for h in hashes.slice(a, b - a).to_pylist()]
            yield ids.slice(a, b - a).to_pylist(), own, label[a:b]

    labelled = sets.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n", "part", F.coalesce("component", "doc_id").alias("label"), "hashes"
    )
    ordered = labelled.sortWithinPartitions("label", "doc_id", "part").select("doc_id", "label", "hashes")
    between = shared_counts(ordered, from_sets, fragments).groupBy("doc_id").agg(
        F.sum("n").alias("n"), F.sum("shared").alias("shared")
    )
    open_ids = staged(between.where(100 * F.col("shared") >= percent * F.col("n")).select("doc_id", "shared"), "open")
    around = staged(clustered(open_ids, best), "around")
    left = staged(labelled.join(around, "doc_id"), "left")
    dense = dense_links(left.where("cluster >= 0"), percent)
    more = staged(verified(candidates(left, percent), sets, percent).union(dense), "links")
    found = linked_groups(spark, links.union(more)).select(F.col("id").alias("head"), "component")
    classes = classes.join(found, "head", "left").select(*sign, F.coalesce("component", "head").alias("component"))
    return stats.join(classes, sign, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def grouped_in_rounds(leads: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) and the groups they give (id, component), by partners of equal minimum hash.

    ``leads``: id, n, known, k, value. Each minimum hash names one leader: the document of which the largest part is
    known from others, as an original is wholly repeated by its copies while each copy has something of its own. Every
    document is compared with the leader that most of its hashes name; then those still apart from a leader with all
    the leaders they have. Only pairs that sizes allow are compared; the exact search has the rest.
    """
    spark = leads.sparkSession
    lead = F.struct("known", F.xxhash64("id").alias("tie"), F.col("id").alias("b"), F.col("n").alias("m"))
    named = leads.groupBy("k", "value").agg(F.max(lead).alias("lead"), F.count(F.lit(1)).alias("held")).where("held > 1")
    # A hash that very many documents share meets its leader in many parts.
    dealt = leads.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(MET_PARTS)))
    places = dealt.select("k", "value", "salt").distinct().join(named, ["k", "value"]).select("k", "value", "salt", "lead.*")
    fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    dealt = dealt.drop("known")
    met = dealt.join(places, ["k", "value", "salt"]).where(fits & (F.col("id") != F.col("b")))
    met = staged(met.groupBy(F.col("id").alias("a"), "b").agg(F.count(F.lit(1)).alias("times"), F.max("known").alias("known")), "met")

    best = staged(met.groupBy("a").agg(F.max(F.struct("times", "known", "b")).alias("best")).select("a", "best.b"), "best")
    links = staged(verified(best, sets, percent), "links")
    labels = staged(linked_groups(spark, links), "labels")
    side = lambda end: labels.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
    apart = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
    rest = met.join(best, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left").where(apart).select("a", "b")
    more = staged(verified(rest, sets, percent), "links")
    if not more.isEmpty():
        links = staged(links.union(more), "links")
        labels = staged(linked_groups(spark, links), "labels")
    return links, labels, best


def clustered(docs: DataFrame, best: DataFrame) -> DataFrame:
    """``doc_id, shared, cluster``: the leader of a document's leader where very many are around it, else below zero."""
    one = best.select(F.col("a").alias("doc_id"), F.col("b").alias("one"))
    two = best.select(F.col("a").alias("one"), F.col("b").alias("two"))
    led = docs.join(one, "doc_id", "left").withColumn("one", F.coalesce("one", "doc_id")).join(two, "one", "left")
    led = led.select("doc_id", "shared", F.coalesce("two", "one").alias("cluster"))
    many = led.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= DENSE)
    own = F.when(F.col("size").isNull(), -1 - F.abs("doc_id")).otherwise(F.abs("cluster"))
    return led.join(many, "cluster", "left").select("doc_id", "shared", own.alias("cluster"), F.coalesce("size", F.lit(1)).alias("size"))


def dense_links(docs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the similar documents of each cluster, counted tile by tile.

    Around a much copied text lie many documents just below the threshold: every pair of them must be counted, and as
    rows these would be the square of the group. A task counts two tiles against each other, part by part of the sets,
    as products of incidence matrices, and gives back no more than a link for each document.
    """
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    rows = docs.select("doc_id", "n", "label", "cluster", "hashes", tiles.alias("tiles"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("doc_id", "n", "label", "own", "hashes", "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def count(table: pa.Table) -> pa.Table:
        ids, at = np.unique(table.column("doc_id").to_numpy(), return_inverse=True)
        n, label, own = (np.zeros(len(ids), np.int64) for _ in range(3))
        for name, out in (("n", n), ("label", label), ("own", own)):
            out[at] = table.column(name).to_numpy()
        sets = [np.frombuffer(h, "<u8") for h in table.column("hashes").to_pylist()]
        value = np.unique(np.concatenate(sets), return_inverse=True)[1]
        doc = np.repeat(at, [len(s) for s in sets])
        held = np.bincount(value)
        common = np.cumsum(held > 1) - 1
        keep = held[value] > 1
        value, doc = common[value[keep]], doc[keep]
        order = np.argsort(value, kind="stable")
        value, doc = value[order], doc[order]
        left = np.flatnonzero(own == own.min())
        right = left if own.min() == own.max() else np.flatnonzero(own == own.max())
        overlap = np.zeros((len(left), len(right)), np.float32)
        width = 2048
        for low in range(0, int(value[-1]) + 1 if len(value) else 0, width):
            part = slice(*np.searchsorted(value, [low, low + width]))
            block = np.zeros((len(ids), width), np.float32)
            block[doc[part], value[part] - low] = 1
            overlap += block[left] @ block[right].T
        near = 100 * overlap >= percent * (n[left][:, None] + n[right][None, :] - overlap)
        near &= label[left][:, None] != label[right][None, :]
        a, b = np.nonzero(near)
        a, b = left[a], right[b]
        # The least document reached stands for all that hang together here.
        least = np.arange(len(ids))
        while True:
            low = least.copy()
            np.minimum.at(low, a, least[b])
            np.minimum.at(low, b, least[a])
            low = low[low]
            if (low == least).all():
                break
            least = low
        moved = np.flatnonzero(least != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[moved], pa.int64()), "b": pa.array(ids[least[moved]], pa.int64())})

    return rows.groupBy("cluster", "i", "j").applyInArrow(count, "a bigint, b bigint")


ENTRIES = "h bigint, doc_id bigint, n bigint, most bigint, label bigint, cluster bigint"


def candidates(docs: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents with different labels that may be similar.

    ``docs``: doc_id, n, shared, label, cluster, hashes, a row for each part of a set; ``shared`` is how many of its
    shingles other labels have, more than which no pair can share. Pairs of one cluster are counted elsewhere. With shingles ordered rarest first, of a similar
    pair the smaller set must share one of its first n - ceil(2t / (1 + t) n) + 1 shingles with the first
    m - ceil(t m) + 1 of the larger one. The shingles shared there, and how many can follow the last of them, bound the
    overlap; pairs whose bound is too low go.
    """

    def entries(batch: pa.RecordBatch) -> dict:
        ids, n, shared, label, cluster, data = (c.to_pylist() for c in batch.columns)
        sets = [np.frombuffer(d, "<i8") for d in data]
        times = [len(s) for s in sets]
        return {
            "h": pa.array(np.concatenate(sets), pa.int64()),
            "doc_id": pa.array(np.repeat(np.array(ids, np.int64), times)),
            "n": pa.array(np.repeat(np.array(n, np.int64), times)),
            "most": pa.array(np.repeat(np.array(shared, np.int64), times)),
            "label": pa.array(np.repeat(np.array(label, np.int64), times)),
            "cluster": pa.array(np.repeat(np.array(cluster, np.int64), times)),
        }

    rows = map_batches(docs.select("doc_id", "n", "shared", "label", "cluster", "hashes"), entries, ENTRIES)
    held = rows.groupBy("h").agg(F.count("*").alias("docs"), F.min("label").alias("low"), F.max("label").alias("high"))
    ranked = rows.join(held, "h").withColumn(
        "rank", F.row_number().over(Window.partitionBy("doc_id", "n").orderBy("docs", "h"))
    )
    n = F.col("n")
    shared = ranked.where(F.col("low") < F.col("high")).where(F.col("rank") <= n - F.ceil(percent * n / 100) + 1)
    larger = shared.select("h", F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("label").alias("label_b"), F.col("rank").alias("rank_b"), F.col("most").alias("most_b"), F.col("cluster").alias("cluster_b"))
    smaller = shared.where(F.col("rank") <= n - F.ceil(2 * percent * n / (100 + percent)) + 1)
    met = smaller.withColumnRenamed("doc_id", "a").join(larger, "h").where(
        "label <> label_b and cluster <> cluster_b and (n < m or (n = m and a < b))"
    ).where(100 * F.col("n") >= percent * F.col("m"))
    # Up to a shared shingle no more can be shared than its place in either set, after it no more than is left of either.
    most = F.least("rank", "rank_b") + F.least(F.col("n") - F.col("rank"), F.col("m") - F.col("rank_b"))
    most = F.least(most, "most", "most_b")
    met = met.where(similar(most, F.col("n"), F.col("m"), percent))
    pairs = met.groupBy("a", "b", "n", "m").agg(
        F.count("*").alias("same"), F.max("rank").alias("rank"), F.max("rank_b").alias("rank_b")
    )
    bound = F.col("same") + F.least(F.col("n") - F.col("rank"), F.col("m") - F.col("rank_b"))
    return pairs.where(similar(bound, F.col("n"), F.col("m"), percent)).select("a", "b").distinct()
