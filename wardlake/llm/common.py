"""Helpers shared by the operators: inputs, staged tables, Arrow batches and linked groups.

Every operator reads its columns by name and selects them first, so extra columns, clashing names included, never reach
its plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.session import fresh_path

# Characters that separate words; all else is part of a word.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the folder all executors share, and read again.

    Cuts the lineage, so a lost executor costs no earlier step, and gives later jobs one fixed set of rows.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files behind a staged table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """``fn`` on each Arrow batch; it returns columns in the order of ``schema``, or None for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (columns := fn(batch)) is not None:
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def linked_groups(spark: SparkSession, edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Smallest reachable id of each node that has a link: columns ``id``, ``component``.

    ``edges`` has bigint columns ``a`` and ``b``. Alternates large-star and small-star steps: each step hangs the
    neighbours of a node on the smallest of them, so long chains shrink by powers and a node with very many links costs
    one aggregate row. Each round is a written table; the loop ends when a round changes nothing. No link reaches the
    driver. Rows with a null end or equal ends are ignored; an empty table gives no rows.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = staged(pairs, "links")
    before = None
    for _ in range(rounds):
        mark = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            break
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        # Large star: every larger neighbour of a node moves to the smallest node around it.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        later = staged(small, "links")
        drop_staged(current)
        current, before = later, mark
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
