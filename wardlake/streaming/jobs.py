"""Structured Streaming over the audit event feed and late billing.

Each job takes a streaming DataFrame and returns one; ``run_available`` drives it over all files present and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions import columns as C

# Fixed value: events may arrive this late.
LATENESS = "1 hour"
BILLING_LATENESS = "7 days"


def _instant(moment: Column) -> Column:
    """Event time as a watermark needs it: the zoneless time read as UTC, whatever the session zone."""
    return F.timestamp_micros(C.epoch_micros(moment))


def _zoneless(instant: Column) -> Column:
    return C.micros_to_timestamp(F.unix_micros(instant))


def event_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def deduplicated(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Events without repeats of an id inside the watermark, which bounds the state."""
    timed = events.withColumn("at", _instant(F.col("ts"))).withWatermark("at", lateness)
    return timed.dropDuplicatesWithinWatermark(["event_id"]).drop("at")


def alert_counts(events: DataFrame, window: str = "1 hour", slide: str | None = None, lateness: str = LATENESS) -> DataFrame:
    """Events and failures per user in tumbling or sliding windows."""
    span = F.window("at", window, slide) if slide else F.window("at", window)
    return (
        events.withColumn("at", _instant(F.col("ts")))
        .withWatermark("at", lateness)
        .groupBy(span.alias("w"), "user_id")
        .agg(F.count("*").alias("events"), F.count_if(F.col("event_type") == "error").alias("failures"))
        .select(
            _zoneless(F.col("w.start")).alias("window_start"),
            _zoneless(F.col("w.end")).alias("window_end"),
            "user_id",
            "events",
            "failures",
        )
    )


def access_sessions(events: DataFrame, gap: str = "1 hour", lateness: str = LATENESS) -> DataFrame:
    """Sessions of a user: events no further apart than the gap."""
    return (
        events.withColumn("at", _instant(F.col("ts")))
        .withWatermark("at", lateness)
        .groupBy(F.session_window("at", gap).alias("w"), "user_id")
        .agg(F.count("*").alias("events"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
        .select("user_id", "events", "first_at", "last_at")
    )


def late_bills(encounters: DataFrame, billing: DataFrame, lateness: str = BILLING_LATENESS) -> DataFrame:
    """Bills matched with their encounter when they arrive within the lateness after it: a stream-stream join.

    ``encounters`` has encounter_id and encounter_at, ``billing`` has encounter_id, billed_at and amounts.
    """
    e = encounters.withColumn("e_at", _instant(F.col("encounter_at"))).withWatermark("e_at", lateness).alias("e")
    b = billing.withColumn("b_at", _instant(F.col("billed_at"))).withWatermark("b_at", lateness).alias("b")
    in_time = F.expr(
        f"e.encounter_id = b.encounter_id AND b_at >= e_at - INTERVAL {lateness} AND b_at <= e_at + INTERVAL {lateness}"
    )
    return b.join(e, in_time).select(
        F.col("b.encounter_id").alias("encounter_id"), "claim_amount", "allowed_amount", "billed_at", "encounter_at"
    )


def run_available(stream: DataFrame, checkpoint: str, path: str, partition_by: list[str] | None = None) -> None:
    """Append the results for all data present to a Parquet folder, and stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def run_each_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Call ``handle`` with every micro-batch of the data present, and stop."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
