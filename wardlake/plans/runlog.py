"""Run logs: step events, run summaries, duration statistics and ratings."""

from __future__ import annotations

import contextlib
import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.functions import columns as C

STEP_EVENT_SCHEMA = (
    "log_id string, execution_id string, procedure_name string, step_name string, step_order int, event string, "
    "event_time timestamp_ntz, status string, rows_processed bigint, rows_inserted bigint, rows_updated bigint, "
    "rows_deleted bigint, error_message string"
)

# Upper bound in milliseconds of each rating.
RATINGS = [(100, "Excellent"), (500, "Good"), (1000, "Fair")]
SLOWEST_RATING = "Needs Optimization"


class RunLog:
    """Append-only log of the steps of one run.

    A step writes one row when it starts and one when it ends, apart from the data writes, so a failed step stays
    visible. Row counts come from an ``Observation`` on the written DataFrame, not from a second job.
    """

    def __init__(self, spark: SparkSession, path: str, execution_id: str, procedure_name: str):
        self.spark, self.path = spark, path
        self.execution_id, self.procedure_name = execution_id, procedure_name
        self.steps = 0

    def _append(self, log_id, step, order, event, status, rows=None, inserted=None, error=None):
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = (log_id, self.execution_id, self.procedure_name, step, order, event, now, status, rows, inserted, 0, 0, error)
        self.spark.createDataFrame([row], STEP_EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    @contextlib.contextmanager
    def step(self, name: str):
        self.steps += 1
        log_id, order, counted = uuid.uuid4().hex, self.steps, StepRows()
        self._append(log_id, name, order, "start", "RUNNING")
        try:
            yield counted
        except Exception as error:
            self._append(log_id, name, order, "end", "FAILED", error=str(error))
            raise
        self._append(log_id, name, order, "end", "COMPLETED", counted.rows, counted.rows)


class StepRows:
    """Counts the rows a step writes."""

    def __init__(self):
        self._seen: list[Observation] = []

    def watch(self, df: DataFrame) -> DataFrame:
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    @property
    def rows(self) -> int:
        return sum(o.get["rows"] for o in self._seen)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per step: the start merged with the end, where there is one."""
    events = spark.read.schema(STEP_EVENT_SCHEMA).parquet(path)
    ended = F.col("event") == "end"
    last = {c: F.max_by(c, F.struct("event_time", ended)).alias(c) for c in ("status", "error_message")}
    counts = [F.max(c).alias(c) for c in ("rows_processed", "rows_inserted", "rows_updated", "rows_deleted")]
    return (
        events.groupBy("log_id", "execution_id", "procedure_name", "step_name", "step_order")
        .agg(
            F.min("event_time").alias("start_time"),
            F.max(F.when(ended, F.col("event_time"))).alias("end_time"),
            *last.values(),
            *counts,
        )
        .withColumn(
            "duration_seconds", C.interval_micros(F.col("end_time") - F.col("start_time")) / F.lit(1_000_000.0)
        )
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Steps, outcomes, rows and seconds of each run."""
    seconds = F.sum(F.col("duration_seconds").cast("decimal(20,6)"))
    return log.groupBy("execution_id").agg(
        F.count("*").alias("total_steps"),
        F.count_if(F.col("status") == "COMPLETED").alias("successful_steps"),
        F.count_if(F.col("status") == "FAILED").alias("failed_steps"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows_processed"),
        F.coalesce(seconds.cast("double"), F.lit(0.0)).alias("total_duration_seconds"),
    )


def latest_run(log: DataFrame, procedure_name: str) -> DataFrame:
    """The run of a procedure that started last."""
    return (
        log.where(F.col("procedure_name") == procedure_name)
        .orderBy(F.desc("start_time"), "execution_id")
        .select("execution_id", "start_time")
        .limit(1)
    )


def rated_operations(metrics: DataFrame) -> DataFrame:
    """Mean duration of each operation of a run, ranked within the run and rated."""
    mean = C.rounded(C.mean(F.sum("duration_ms"), F.count("*")), 2)
    rating = F
    for limit, label in RATINGS:
        rating = rating.when(F.col("execution_time_ms") < limit, F.lit(label))
    # Pre-aggregated: a run has one row per operation before it is ranked.
    per_operation = metrics.groupBy("execution_id", "operation_type").agg(mean.alias("execution_time_ms"))
    ranks = Window.partitionBy("execution_id").orderBy("execution_time_ms", "operation_type")
    return per_operation.withColumn("performance_rank", F.row_number().over(ranks)).withColumn(
        "performance_rating", rating.otherwise(F.lit(SLOWEST_RATING))
    )


def duration_statistics(metrics: DataFrame) -> DataFrame:
    """Operations of each run with mean, shortest and longest duration."""
    return metrics.groupBy("execution_id").agg(
        F.count("*").alias("total_queries_analyzed"),
        C.rounded(C.mean(F.sum("duration_ms"), F.count("duration_ms")), 2).alias("avg_execution_time_ms"),
        F.min("duration_ms").alias("min_execution_time_ms"),
        F.max("duration_ms").alias("max_execution_time_ms"),
    )


def severity_rollup(issues: DataFrame) -> DataFrame:
    """Critical and high issues, warnings and the status line of each run."""
    counts = issues.groupBy("execution_id").agg(
        F.count_if(F.col("severity_level").isin("CRITICAL", "HIGH")).alias("critical_issues"),
        F.count_if(F.col("severity_level") == "MEDIUM").alias("warnings"),
    )
    # Status lines.
    banner = (
        F.when(F.col("critical_issues") > 0, "CRITICAL ISSUES DETECTED")
        .when(F.col("warnings") > 0, "WARNINGS DETECTED")
        .otherwise("ETL COMPLETED SUCCESSFULLY")
    )
    return counts.withColumn("status_banner", banner)


def timed(action) -> tuple[float, object]:
    """Seconds and result of a call."""
    begin = time.perf_counter()
    result = action()
    return time.perf_counter() - begin, result
