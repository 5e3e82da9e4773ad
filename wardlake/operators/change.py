"""Table changes as plans: insert-if-absent, update, upsert, replace, delete, move, added columns, staged writes.

A plain Parquet table has no in-place update. Each function returns the new content; ``overwrite_partitions`` writes
it through a staged copy, so that a table can be rebuilt from itself.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardlake.session import fresh_path


def _keyed(key: list[str]) -> Column:
    """True for rows whose key is whole; a key with a NULL part equals no other."""
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    return whole


def insert_if_absent(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """Table plus the rows whose key it lacks; of new rows with one key, one stays. Rows with a NULL key all stay."""
    fresh = rows.where(_keyed(key)).dropDuplicates(key).join(table.select(*key), key, "left_anti").select(*rows.columns)
    return table.unionByName(fresh.unionByName(rows.where(~_keyed(key))), allowMissingColumns=True)


def newest(rows: DataFrame, key: list[str], by: list[str] | None = None) -> DataFrame:
    """One row per whole key: the last by ``by``, or by all columns; combines before the shuffle. NULL keys all stay."""
    others = [c for c in rows.columns if c not in key]
    order = F.struct(*[F.col(c) for c in [*(by or []), *others]]) if others else F.lit(1)
    last = rows.where(_keyed(key)).groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in rows.columns]), order).alias("_last"))
    return last.select("_last.*").unionByName(rows.where(~_keyed(key)))


def update_from(
    table: DataFrame, changes: DataFrame, key: list[str], columns: list[str], by: list[str] | None = None
) -> DataFrame:
    """Table with ``columns`` taken from the change row of the same key, where there is one; of several, the newest."""
    marked = newest(changes.select(*dict.fromkeys([*key, *columns, *(by or [])])), key, by).select(*key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_changed"))
    joined = table.join(marked, key, "left")
    updated = {c: F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(updated).select(*table.columns)


def upsert(table: DataFrame, rows: DataFrame, key: list[str], by: list[str] | None = None) -> DataFrame:
    """Type-1 upsert: a new row replaces the old row of its key; of several new rows with one key, the newest.

    The keys of the new rows are the build side of an anti join, so a small change set is broadcast by its size and the
    table is not shuffled.
    """
    rows = newest(rows, key, by).select(*table.columns)
    return table.join(rows.select(*key), key, "left_anti").select(*table.columns).unionByName(rows)


def replace_children(children: DataFrame, changed_parents: DataFrame, rows: DataFrame, parent: str) -> DataFrame:
    """Delete all children of the changed parents and insert the given rows."""
    kept = children.join(changed_parents.select(parent), parent, "left_anti")
    return kept.select(*children.columns).unionByName(rows.select(*children.columns))


def split_by_age(table: DataFrame, moment: str, cutoff: dt.date | Column) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows older than the cutoff); a NULL moment is kept."""
    limit = F.lit(cutoff) if isinstance(cutoff, dt.date) else cutoff
    old = F.coalesce(F.col(moment) < limit, F.lit(False))
    return table.where(~old), table.where(old)


def ensure_columns(table: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add the columns that are missing, with their defaults."""
    return table.withColumns({c: v for c, v in defaults.items() if c not in table.columns})


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions present in ``df``, leaving the others; ``df`` may read from ``path``."""
    spark = df.sparkSession
    staged = fresh_path(spark, "staged")
    df.write.parquet(staged)
    writer = spark.read.schema(df.schema).parquet(staged).hint("rebalance", *partition_by).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    drop_folder(spark, staged)


def append_partitioned(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Append with few files per partition; a large partition is written by several tasks."""
    df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def move_partitions(
    spark: SparkSession, path: str, archive: str, partition: str, cutoff: dt.date, key: list[str]
) -> int:
    """Move the partitions before ``cutoff`` to the archive and return the rows moved.

    The archive is written first and the old partitions are removed last, so a failure in between leaves rows in both
    places, never in none. A second try adds only rows the archive lacks: by key, and as many equal rows as are missing
    where the key is NULL. Nothing is removed unless the archive holds at least the rows of each partition.
    """
    old = spark.read.parquet(path).where(F.col(partition) < F.lit(cutoff))
    values = [r[0] for r in old.select(partition).distinct().collect()]
    if not values:
        return 0
    staged = fresh_path(spark, "moved")
    seen = Observation()
    old.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
    moved = spark.read.schema(old.schema).parquet(staged)
    if path_exists(spark, archive):
        archived = spark.read.parquet(archive).where(F.col(partition).isin(*values)).select(*old.columns)
        keyed = moved.where(_keyed(key)).join(archived.select(*key), key, "left_anti").select(*old.columns)
        nameless = moved.where(~_keyed(key)).exceptAll(archived.where(~_keyed(key)))
        moved = archived.unionByName(keyed).unionByName(nameless)
    overwrite_partitions(moved, archive, [partition])
    kept = spark.read.parquet(archive).where(F.col(partition).isin(*values)).groupBy(partition).agg(F.count("*").alias("_kept"))
    staged_rows = spark.read.schema(old.schema).parquet(staged).groupBy(partition).agg(F.count("*").alias("_rows"))
    lost = staged_rows.join(kept, partition, "left").where(F.coalesce("_kept", F.lit(0)) < F.col("_rows"))
    if not lost.isEmpty():
        raise RuntimeError(f"the archive {archive} lacks rows; nothing was removed from {path}")
    drop_partitions(spark, path, partition, values)
    return seen.get["rows"]


def file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = file_system(spark, path)
    return system.exists(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    target, system = file_system(spark, path)
    system.delete(target, True)


def drop_partitions(spark: SparkSession, path: str, partition: str, values: list) -> None:
    """Remove whole partition folders of a table."""
    for value in values:
        drop_folder(spark, f"{path.rstrip('/')}/{partition}={value}")
