"""Contiguous surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlake.session import shared_folder

# monotonically_increasing_id keeps the partition above this bit and the row position below it.
PARTITION_BIT = 33


def with_contiguous_key(df: DataFrame, order: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """Add keys 1..n in the order of ``order``.

    The rows are range-partitioned and sorted once and checkpointed, which fixes their place even when an executor is
    lost. The rows per partition, at most one number per partition, then give the first key of each.
    """
    spark = df.sparkSession
    shared_folder(spark)
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_place", PARTITION_BIT))
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    # At most ``count`` rows, one per range partition.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_place").bitwiseAND((1 << PARTITION_BIT) - 1) + F.col("_offset") + 1)
        .drop("_part", "_place", "_offset")
    )
