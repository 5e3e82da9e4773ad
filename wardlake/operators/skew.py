"""Ordering inside groups when one group may hold a large share of the rows.

A window over a group runs in one task. The operators here look for groups that are too large for that, and cut only
those into slices of their own order. Slices are numbered or accumulated on their own, and the totals of the earlier
slices, one row per slice, are added afterwards. Groups of normal size keep the plain window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group below this many rows is left to one task.
GROUP_ROWS = 2_000_000
# Keys are counted together in so many lanes first.
LANES = 1 << 14


def hot_keys(df: DataFrame, key: str, group_rows: int = GROUP_ROWS) -> list:
    """Every key value held by more than ``group_rows`` rows.

    A lane of keys by hash holds at least the rows of each of its keys, so keys are counted one by one only in lanes
    above the bound: mostly in none, and nothing but a count a lane is shuffled. The list is exact; at most one value in
    ``group_rows`` rows comes back. Which keys are listed never changes a result, only how its work is split.
    """
    keys, many = df.where(F.col(key).isNotNull()).select(key), F.col("count") > group_rows
    lane = F.pmod(F.xxhash64(key), F.lit(LANES))
    full = [row[0] for row in keys.groupBy(lane.alias("lane")).count().where(many).select("lane").collect()]
    if not full:
        return []
    counted = keys.where(lane.isin(*full)).groupBy(key).count().where(many)
    return sorted(row[0] for row in counted.select(key).collect())


def slice_of(key: Column, hot: list, within: Column) -> Column:
    """The slice of a row: part of the order for a hot key, NULL for any other."""
    return F.when(key.isin(*hot), within) if hot else F.lit(None).cast("bigint")


def sequence_within(
    df: DataFrame,
    group: str,
    order: list[str],
    name: str,
    slice_by: Column,
    hot: list,
) -> DataFrame:
    """1-based position of each row in its group, by ``order``.

    ``slice_by`` must be a bigint that never decreases along ``order``; it cuts the groups listed in ``hot``.
    """
    position = F.row_number()
    if not hot:
        return df.withColumn(name, position.over(Window.partitionBy(group).orderBy(*order)))

    sliced = df.withColumn("_slice", slice_of(F.col(group), hot, slice_by))
    numbered = sliced.withColumn(name, position.over(Window.partitionBy(group, "_slice").orderBy(*order)))
    per_slice = sliced.where(F.col("_slice").isNotNull()).groupBy(group, "_slice").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select(
        F.col(group).alias("_group"), F.col("_slice").alias("_at"), F.sum("_rows").over(earlier).alias("_before")
    )
    return (
        numbered.join(before, (F.col(group) == F.col("_group")) & (F.col("_slice") == F.col("_at")), "left")
        .withColumn(name, (F.col(name) + F.coalesce("_before", F.lit(0))).cast("int"))
        .drop("_slice", "_group", "_at", "_before")
    )


def tally(columns: dict[str, Column]) -> list[Column]:
    """One ``count_if`` per named condition, for a single-pass aggregate."""
    return [F.count_if(condition).alias(name) for name, condition in columns.items()]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
