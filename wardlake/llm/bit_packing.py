"""Token ids in files of fixed-width bit fields.

Each id takes the fewest bits that hold every id of the vocabulary. A file is a Parquet table of blocks: a block holds
the ids of whole documents in a row, packed in groups of 64 ids (``bits`` 64-bit words a group), with the ids and
lengths of its documents and its place in its shard. Shards and blocks follow ascending document id, so the position of
any id is known from the block table alone: ``read_tokens`` opens one block and unpacks only the groups it needs.

Blocks are written by Spark's own committer, so a lost executor leaves no half file and no block twice. Null ids come
first, rows of equal id stay apart in the order of their texts, a null text has the end id only, and an empty table
gives an empty file with its schema. A text of any length is one document of one block; every other block is closed
at ``BLOCK_IDS`` ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.llm.common import crc32_of_ids, map_batches
from wardlake.llm.words import library_encoder, split_rows, vocabulary_size

# A block is closed once it holds this many ids.
BLOCK_IDS = 1 << 18
GROUP = 64

SCHEMA = (
    "shard int, block int, shard_offset bigint, n_ids bigint, bits int,"
    " doc_ids array<bigint>, lengths array<bigint>, words binary"
)


def bits_for(size: int) -> int:
    """Bits that hold the ids 0 to size - 1."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2 ** bits as bit fields, lowest bits first, filled up with zeros to a group of 64."""
    groups = -(-len(ids) // GROUP)
    lanes = np.zeros(groups * GROUP, np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(groups, GROUP)
    words = np.zeros((groups, bits), np.uint64)
    for lane in range(GROUP):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(packed: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids at positions start to stop - 1, reading only the groups that hold them."""
    low, high = start // GROUP, -(-stop // GROUP)
    if stop <= start:
        return np.zeros(0, np.uint32)
    words = np.frombuffer(packed, "<u8", (high - low) * bits, low * bits * 8).reshape(high - low, bits)
    lanes = np.empty((high - low, GROUP), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(GROUP):
        word, shift = divmod(lane * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, lane] = value & mask
    return lanes.reshape(-1)[start - low * GROUP : stop - low * GROUP].astype(np.uint32)


def write_packed(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``text`` of all ``docs``, append ``end_id`` to each, and write blocks in ascending ``doc_id``."""
    bits = bits_for(max(vocabulary_size(vocabulary), end_id + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = library_encoder(vocabulary), TaskContext.get().partitionId()
        block, offset, held = 0, 0, 0
        names: list[int | None] = []
        parts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            row = [shard, block, offset, len(ids), bits, names, [len(p) for p in parts], pack(ids, bits)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], titles)

        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        kinds += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        titles = [part.split()[0] for part in SCHEMA.split(",")]
        for batch in batches:
            rows = split_rows(*encoder.encode(batch.column(1)))
            for name, ids in zip(batch.column(0).to_pylist(), rows, strict=True):
                names.append(name)
                parts.append(np.append(ids, np.array(end_id, ids.dtype)))
                held += len(ids) + 1
                if held >= block_ids:
                    yield close()
                    block, offset, held, names, parts = block + 1, offset + held, 0, [], []
        if names:
            yield close()

    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def open_packed(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a file with ``first``, the number of ids in the whole file before each block.

    Only one total a shard is broadcast; shards are as many as the tasks that wrote the file.
    """
    blocks = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    starts = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return blocks.join(F.broadcast(starts), "shard").withColumn("first", F.col("_before") + F.col("shard_offset"))


def read_documents(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from unpacked ids."""

    def run(batch: pa.RecordBatch) -> dict:
        out: list[tuple] = []
        for names, lengths, words, bits, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = unpack(words, bits, 0, sum(lengths))
            at = 0
            for name, n in zip(names, lengths, strict=True):
                out.append((name, first + at, n, crc32_of_ids(ids[at : at + n])))
                at += n
        columns = zip(*out, strict=True)
        titles = ("doc_id", "start", "n_tokens", "ids_crc32")
        return {t: pa.array(c, pa.int64()) for t, c in zip(titles, columns, strict=True)}

    chosen = blocks.select("doc_ids", "lengths", "words", "bits", "first")
    return map_batches(chosen, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_tokens(blocks: DataFrame, start: int, stop: int) -> np.ndarray:
    """Ids at positions start to stop - 1 of the whole file; only the blocks that hold them are opened."""
    held = blocks.where((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    parts = []
    for row in held.select("first", "n_ids", "bits", "words").orderBy("first").toLocalIterator():
        low, high = max(start - row["first"], 0), row["n_ids"]
        parts.append(unpack(row["words"], row["bits"], low, min(stop - row["first"], high)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
