"""Streams whose state crosses batches and restarts: events taken once, sessions with a timer, totals of bills.

The state is a versioned store. A micro-batch reads the state it needs, writes what it changes and publishes both with
its own number as one version. A batch that comes again after a failure finds its number published and changes nothing,
so every row counts once, whatever the sink of the stream guarantees. Each class gives the function for
``foreachBatch``; ``jobs.run_each_batch`` drives it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.plans.store import Manifest, VersionedStore
from wardlake.session import fresh_path

HOUR = C.MICROS_PER_HOUR


class _Batches:
    """Takes each numbered batch once."""

    def __init__(self, store: VersionedStore):
        self.store, self.spark = store, store.spark

    def take(self, batch: DataFrame, batch_id: int) -> None:
        base = self.store.current()
        if base.marks.get("batch") is not None and batch_id <= int(base.marks["batch"]):
            return
        # The rows are fixed before anything is derived from them.
        path = fresh_path(self.spark, "batch")
        batch.write.parquet(path)
        rows = self.spark.read.schema(batch.schema).parquet(path)
        changes, marks = self.merge(rows, base, batch_id)
        self.store.publish(base, f"batch-{batch_id}", changes, {**marks, "batch": str(batch_id)})

    def merge(self, rows: DataFrame, base: Manifest, batch_id: int) -> tuple[dict, dict]:
        raise NotImplementedError


class EventLedger(_Batches):
    """Audit events of many files: taken in once, kept apart when late, and gathered into sessions.

    ``accepted`` holds the first row of each event id, by day. An event older than the watermark, the latest time of earlier
    batches less the lateness, goes to ``late``, as does one without an id or a time; ``repeated`` counts the further rows of
    an id within the watermark. Every input row is in one of the three. ``open_sessions`` is keyed by user; a session whose last
    event lies a gap behind the new watermark can't grow any more and moves to ``sessions``, which never changes.
    """

    def __init__(self, store: VersionedStore, lateness: int = HOUR, gap: int = HOUR):
        super().__init__(store)
        self.lateness, self.gap = lateness, gap

    def merge(self, rows: DataFrame, base: Manifest, batch_id: int) -> tuple[dict, dict]:
        old_mark = int(base.marks["watermark"]) if "watermark" in base.marks else None
        at = C.epoch_micros(F.col("ts"))
        reason = F.when(F.col("event_id").isNull(), "NO_ID").when(F.col("ts").isNull(), "NO_TIME")
        if old_mark is not None:
            reason = reason.when(at < old_mark, "LATE")
        judged = rows.withColumn("reason", reason)
        numbered = {"batch": F.lit(batch_id).cast("bigint")}
        late = judged.where("reason IS NOT NULL").withColumns(numbered)

        # First row of an id and the number of its rows, combined before the shuffle.
        first = F.min(F.struct("ts", *[c for c in rows.columns if c not in ("ts", "event_id")])).alias("first")
        by_id = judged.where("reason IS NULL").groupBy("event_id").agg(first, F.count(F.lit(1)).alias("copies"))
        known = self._ids_since(base, old_mark)
        by_id = by_id.join(known, "event_id", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
        path = fresh_path(self.spark, "ids")
        by_id.write.parquet(path)
        by_id = self.spark.read.schema(by_id.schema).parquet(path)
        fresh = by_id.where("NOT seen").select("event_id", "first.*").select(*rows.columns)
        further = F.col("copies") - (~F.col("seen")).cast("bigint")
        repeated = by_id.select("event_id", further.alias("copies")).where("copies > 0").withColumns(numbered)

        latest = judged.where("reason IS NULL").agg(F.max(at)).first()[0]
        marks = [m for m in (old_mark, None if latest is None else latest - self.lateness) if m is not None]
        changes = {
            "accepted": self.store.append("accepted", fresh.withColumn("day", self._day(at)), base, ["day"]),
            "late": self.store.append("late", late, base, ["batch"]),
            "repeated": self.store.append("repeated", repeated, base, ["batch"]),
        }
        changes |= self._sessions(fresh, base, max(marks, default=None))
        return changes, {"watermark": str(max(marks))} if marks else {}

    @staticmethod
    def _day(at: Column) -> Column:
        return F.floor(at / C.MICROS_PER_DAY).cast("bigint")

    def _ids_since(self, base: Manifest, mark: int | None) -> DataFrame:
        """Ids of accepted events that a row of this batch may repeat: days from the watermark on."""
        if "accepted" not in base.tables:
            return self.spark.createDataFrame([], "event_id bigint, seen boolean")
        parts = base.tables["accepted"]["parts"]
        days = [k for k, p in parts.items() if mark is None or p["values"]["day"] >= mark // C.MICROS_PER_DAY]
        return self.store.table("accepted", days, base).select("event_id", F.lit(True).alias("seen"))

    def _sessions(self, events: DataFrame, base: Manifest, mark: int | None) -> dict:
        """Open sessions and new events merged per user; those beyond the timer are closed."""
        at = C.epoch_micros(F.col("ts"))
        # Events of a user in one span of the length of the gap belong together, so a busy user costs a row a span.
        spans = events.select("user_id", at.alias("at")).groupBy("user_id", F.floor(F.col("at") / self.gap).alias("span")).agg(
            F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count(F.lit(1)).alias("events")
        ).drop("span")
        if "open_sessions" in base.tables:
            spans = spans.unionByName(self.store.table("open_sessions", manifest=base))
        in_time = Window.partitionBy("user_id").orderBy("first_at", "last_at")
        before = F.max("last_at").over(in_time.rowsBetween(Window.unboundedPreceding, -1))
        begins = F.when(F.col("first_at") - before < self.gap, 0).otherwise(1)
        numbered = spans.withColumn("begins", begins).withColumn("session", F.sum("begins").over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
        merged = numbered.groupBy("user_id", "session").agg(
            F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("events").alias("events")
        ).drop("session")
        path = fresh_path(self.spark, "sessions")
        merged.write.parquet(path)
        merged = self.spark.read.schema(merged.schema).parquet(path)
        over = F.lit(False) if mark is None else F.col("last_at") + self.gap <= mark
        closed = merged.where(over).select(
            "user_id", "events", C.micros_to_timestamp(F.col("first_at")).alias("first_at"),
            C.micros_to_timestamp(F.col("last_at")).alias("last_at"), self._day(F.col("last_at")).alias("day"),
        )
        return {
            "open_sessions": self.store.write("open_sessions", merged.where(~over)),
            "sessions": self.store.append("sessions", closed, base, ["day"]),
        }


class BillTotals(_Batches):
    """Totals of claims per encounter, kept up to date as bills arrive, however late.

    A batch is summed per encounter and added to the buckets of the table that hold these encounters; others stay as
    they are. ``since`` gives the encounters that the versions after a mark have touched.
    """

    MONEY = ("total_claim_amount", "total_allowed_amount")

    def __init__(self, store: VersionedStore, buckets: int = 64):
        super().__init__(store)
        self.buckets = buckets

    def merge(self, rows: DataFrame, base: Manifest, batch_id: int) -> tuple[dict, dict]:
        sums = rows.groupBy("encounter_id").agg(
            F.sum("claim_amount").cast("decimal(22,2)").alias(self.MONEY[0]),
            F.sum("allowed_amount").cast("decimal(22,2)").alias(self.MONEY[1]),
            F.count(F.lit(1)).alias("bills"),
        )
        bucket = F.pmod(F.xxhash64("encounter_id"), F.lit(self.buckets)).cast("int")
        news = sums.withColumns({"last_batch": F.lit(batch_id).cast("bigint"), "bucket": bucket})
        touched = [f"_bucket={r[0]}" for r in news.select("bucket").distinct().collect()]  # at most the buckets
        if "bill_totals" in base.tables:
            news = self.store.table("bill_totals", touched, base).unionByName(news)
        total = news.groupBy("encounter_id", "bucket").agg(
            *[F.sum(c).cast("decimal(22,2)").alias(c) for c in self.MONEY], F.sum("bills").alias("bills"), F.max("last_batch").alias("last_batch")
        )
        return {"bill_totals": self.store.write("bill_totals", total, ["bucket"], replaces=touched)}, {}

    def totals(self) -> DataFrame:
        return self.store.table("bill_totals").drop("bucket")

    def since(self, batch_id: int) -> DataFrame:
        return self.totals().where(F.col("last_batch") > batch_id)


def as_of_mark(mark: str) -> dt.datetime:
    """A stored watermark as a time without a zone."""
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(mark))
