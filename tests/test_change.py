import datetime as dt

from pyspark.sql import functions as F

from wardlake.operators import change
from wardlake.plans import dims
from wardlake.session import fresh_path


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def frame(spark, data, schema="id bigint, v string"):
    return spark.createDataFrame(data, schema)


def test_insert_if_absent_is_repeatable(spark):
    old, new = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "x"), (3, "c"), (3, "d")])
    once = change.insert_if_absent(old, new, ["id"])
    twice = change.insert_if_absent(once, new, ["id"])
    assert [r[0] for r in rows(once, "id")] == [1, 2, 3]
    assert ("b" in [r[1] for r in rows(once, "id", "v")]) and rows(once, "id") == rows(twice, "id")


def test_upsert_overwrites_with_null_too(spark):
    merged = change.upsert(frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, None), (3, "c")]), ["id"])
    assert sorted(((r.id, r.v) for r in merged.collect()), key=str) == [(1, "a"), (2, None), (3, "c")]


def test_update_from_sets_null_and_keeps_others(spark):
    updated = change.update_from(frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, None)]), ["id"], ["v"])
    assert {r.id: r.v for r in updated.collect()} == {1: "a", 2: None}


def test_replace_children_and_split(spark):
    kids = frame(spark, [(1, "a"), (1, "b"), (2, "c")])
    new = change.replace_children(kids, frame(spark, [(1, "")]), frame(spark, [(1, "z")]), "id")
    assert rows(new, "id", "v") == [(1, "z"), (2, "c")]
    days = spark.createDataFrame([(1, dt.date(2000, 1, 1)), (2, dt.date(2001, 1, 1)), (3, None)], "id bigint, d date")
    kept, old = change.split_by_age(days, "d", dt.date(2000, 6, 1))
    assert rows(kept, "id") == [(2,), (3,)] and rows(old, "id") == [(1,)]


def test_ensure_columns(spark):
    df = change.ensure_columns(frame(spark, [(1, "a")]), {"v": F.lit("no"), "n": F.lit(0)})
    assert df.first().asDict() == {"id": 1, "v": "a", "n": 0}


def test_partitions_are_overwritten_from_the_table_itself(spark):
    path = fresh_path(spark, "t")
    frame(spark, [(1, "a"), (2, "a"), (3, "b")], "id bigint, p string").write.partitionBy("p").parquet(path)
    again = spark.read.parquet(path).where("p = 'a'").withColumn("id", F.col("id") + 10)
    change.overwrite_partitions(again, path, ["p"])
    assert rows(spark.read.parquet(path), "id", "p") == [(3, "b"), (11, "a"), (12, "a")]


def test_moving_partitions_repeats_without_copies(spark):
    path, archive = fresh_path(spark, "log"), fresh_path(spark, "archive")
    data = [("a1", dt.date(2000, 1, 1)), ("a2", dt.date(2000, 1, 2)), ("a3", dt.date(2010, 1, 1))]
    schema = "audit_id string, event_date date"
    spark.createDataFrame(data, schema).write.partitionBy("event_date").parquet(path)
    assert change.move_partitions(spark, path, archive, "event_date", dt.date(2005, 1, 1), ["audit_id"]) == 2
    assert rows(spark.read.parquet(path), "audit_id") == [("a3",)]
    # A late row of an archived day, and a row that is there already.
    late = spark.createDataFrame([("a1", dt.date(2000, 1, 1)), ("a4", dt.date(2000, 1, 1))], schema)
    late.write.mode("append").partitionBy("event_date").parquet(path)
    change.move_partitions(spark, path, archive, "event_date", dt.date(2005, 1, 1), ["audit_id"])
    assert rows(spark.read.parquet(archive), "audit_id") == [("a1",), ("a2",), ("a4",)]
    assert change.move_partitions(spark, path, archive, "event_date", dt.date(2005, 1, 1), ["audit_id"]) == 0


def test_rows_without_a_key_all_stay(spark):
    table = spark.createDataFrame([(1, "a")], "k int, v string")
    rows = spark.createDataFrame([(None, "b"), (None, "b"), (2, "c"), (2, "d"), (1, "e")], "k int, v string")
    got = change.insert_if_absent(table, rows, ["k"]).collect()
    assert sorted((r.k or 0) for r in got) == [0, 0, 1, 2]
    got = change.upsert(table, rows, ["k"]).collect()
    assert sorted(((r.k or 0), r.v) for r in got) == [(0, "b"), (0, "b"), (1, "e"), (2, "d")]


def test_the_newest_of_several_changes_counts(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(1, "x", 5), (1, "y", 9), (1, "z", 7)], "k int, v string, at int")
    got = change.update_from(table, changes, ["k"], ["v"], by=["at"]).collect()
    assert sorted((r.k, r.v) for r in got) == [(1, "y"), (2, "b")]


def test_archiving_twice_keeps_every_row(spark):
    path, archive = fresh_path(spark, "log"), fresh_path(spark, "archive")
    day = dt.date(2000, 1, 1)
    rows = spark.createDataFrame([(None, "p", day), (None, "p", day), ("1", "q", day), ("2", "r", dt.date(2020, 1, 1))], "id string, v string, d date")
    for _ in range(2):  # the second time, part of the rows is in the archive already
        change.append_partitioned(rows, path, ["d"])
        change.move_partitions(spark, path, archive, "d", dt.date(2010, 1, 1), ["id"])
    stored = sorted(((r.id or ""), r.v) for r in spark.read.parquet(archive).collect())
    assert stored == [("", "p"), ("", "p"), ("1", "q")]
    assert {r.v for r in spark.read.parquet(path).collect()} == {"r"}


def test_a_calendar_may_be_long_or_empty(spark):
    assert dims.dim_date(spark, dt.date(2000, 1, 1), dt.date(9999, 12, 31)).count() == 2_921_940
    assert dims.dim_date(spark, None, None).count() == 0


def test_equal_buckets_are_not_compared_row_by_row(spark):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from wardlake.plans import audit

    old = spark.range(20_000).select("id", (F.col("id") % 7).alias("value"), F.lit(None).cast("string").alias("note"))
    old = old.unionByName(spark.createDataFrame([(None, 1, "lost")], "id bigint, value bigint, note string"))
    new = old.where("id IS NULL OR id NOT IN (5, 19)").withColumn("value", F.when(F.col("id") == 77, 100).otherwise(F.col("value")))
    new = new.withColumn("note", F.when(F.col("id") == 300, "").otherwise(F.col("note")))
    new = new.unionByName(spark.createDataFrame([(50_000, 1, None), (None, 2, "found")], "id bigint, value bigint, note string"))
    changed = audit.differing_buckets(old, new, ["id"], 512)
    assert 1 <= len(changed) <= 7
    seen = Observation()
    kept = old.where(audit.bucket_of(["id"], 512).isin(changed)).observe(seen, F.count(F.lit(1)).alias("rows"))
    assert kept.count() < 20_000 * 8 / 512 + 200 and seen.get["rows"] == kept.count()
    rows = lambda df: sorted(map(str, df.collect()))
    found = audit.capture_changes_by_digest(old, new, ["id"], buckets=512)
    assert rows(found) == rows(audit.capture_changes(old, new, ["id"])) and found.count() >= 6
    assert audit.capture_changes_by_digest(old, old.where("id IS NOT NULL").union(old.where("id IS NULL")), ["id"]).count() == 0
