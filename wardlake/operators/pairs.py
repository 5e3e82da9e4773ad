"""Counting pairs of two child tables of one parent without forming every row pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def paired_counts(
    left: DataFrame, right: DataFrame, parent: str, left_code: str, right_code: str, hot: list
) -> DataFrame:
    """Row pairs and parents per (left code, right code): parent, left code, right code, pairs.

    Both sides are counted per parent and code before the join, so a parent with many rows shrinks to one row per code.
    Partitioning the rows by parent first lets count and join share one shuffle. With a parent listed in ``hot`` the
    rows are counted where they lie before anything is shuffled, at the price of a second shuffle.
    """

    def counted(rows: DataFrame, code: str, name: str) -> DataFrame:
        placed = rows.select(parent, code)
        if not hot:
            placed = placed.repartition(parent)
        return placed.groupBy(parent, code).agg(F.count("*").alias(name))

    joined = counted(left, left_code, "_left").join(counted(right, right_code, "_right"), parent)
    return joined.select(parent, left_code, right_code, (F.col("_left") * F.col("_right")).alias("pairs"))
