"""The full load: dimensions, fact, bridges and measures written step by step, then validated and exported."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.change import drop_folder, overwrite_partitions
from wardlake.plans import dims, fact
from wardlake.plans.audit import append_events, archive_records
from wardlake.plans.exports import export_run_logs
from wardlake.plans.incremental import changed_slice
from wardlake.plans.queries_star import refresh_pair_summary
from wardlake.plans.runlog import RunLog, latest_run, read_run_log
from wardlake.plans.validate import schema_comparison, validate, validation_report, verdict
from wardlake.plans.warehouse import derive_warehouse, open_warehouse
from wardlake.session import fresh_path
from wardlake.sources.tables import TableSet

# Steps of the load in their order.
DIMENSION_STEPS = [
    ("Populate date dimension", "dim_date"),
    ("Populate specialty dimension", "dim_specialty"),
    ("Populate department dimension", "dim_department"),
    ("Populate encounter type dimension", "dim_encounter_type"),
    ("Populate diagnosis dimension", "dim_diagnosis"),
    ("Populate procedure dimension", "dim_procedure"),
    ("Populate patient dimension", "dim_patient"),
    ("Populate provider dimension", "dim_provider"),
]


def write_fact(fact_rows: DataFrame, path: str) -> None:
    """Fact partitioned by year, rows in order of the day inside the files."""
    ordered = fact_rows.hint("rebalance", "encounter_year").sortWithinPartitions("encounter_year", "encounter_date_key")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("encounter_year").parquet(path)


def covering_calendar(src: TableSet, calendar: tuple[dt.date, dt.date] | None) -> tuple[dt.date | None, dt.date | None]:
    """The wanted calendar, widened to every day in use: queries join it, and a day outside it would lose its rows."""
    used = dims.calendar_bounds(src)
    if calendar is None or None in used:
        return calendar or used
    return min(calendar[0], used[0]), max(calendar[1], used[1])


def run_warehouse_load(
    spark: SparkSession,
    src: TableSet,
    folder: str,
    as_of: dt.date,
    run_id: str,
    calendar: tuple[dt.date, dt.date] | None = None,
    log_path: str | None = None,
) -> DataFrame:
    """Load all tables below ``folder`` and return the run's log.

    Each step reads what earlier steps have written, so no plan is evaluated twice, and a failed step is logged before
    the error goes on to the caller.
    """
    root = folder.rstrip("/")
    log_path = log_path or f"{root}/etl_logs"
    log = RunLog(spark, log_path, run_id, "run_warehouse_load")
    stored = open_warehouse(spark, root)
    planned = derive_warehouse(src, as_of, covering_calendar(src, calendar))

    for title, name in DIMENSION_STEPS:
        with log.step(title) as rows:
            table = dims.dim_provider(src, stored["dim_specialty"], stored["dim_department"]) if name == "dim_provider" else planned[name]
            rows.watch(table).write.mode("overwrite").parquet(f"{root}/{name}")

    stages = {n: fresh_path(spark, f"{run_id}-{n}") for n in ("fact", "readmission")}
    with log.step("Populate fact_encounters") as rows:
        resolved = fact.resolved_encounters(
            src["encounters"], stored["dim_patient"], stored["dim_provider"], stored["dim_encounter_type"]
        )
        measured = fact.with_measures(
            resolved, src["billing"], src["encounter_diagnoses"], src["encounter_procedures"], stored["dim_diagnosis"]
        )
        rows.watch(measured).write.parquet(stages["fact"])
    loaded = spark.read.parquet(stages["fact"])

    with log.step("Populate bridge tables") as rows:
        dx = fact.bridge_diagnoses(src["encounter_diagnoses"], loaded, stored["dim_diagnosis"])
        rows.watch(dx).write.mode("overwrite").parquet(f"{root}/bridge_encounter_diagnoses")
        hot = src.hot_keys("encounter_procedures", "encounter_id")
        px = fact.bridge_procedures(src["encounter_procedures"], loaded, stored["dim_procedure"], hot)
        rows.watch(px).write.mode("overwrite").parquet(f"{root}/bridge_encounter_procedures")

    with log.step("Calculate readmission metrics") as rows:
        measures = fact.readmission_measures(loaded, src.hot_keys("encounters", "patient_id"))
        rows.watch(measures).write.parquet(stages["readmission"])

    with log.step("Update primary diagnosis keys") as rows:
        # The primary diagnosis has been taken with the counts; the bridge isn't read for it again.
        final = fact.with_readmissions(loaded, spark.read.parquet(stages["readmission"]))
        write_fact(rows.watch(final), f"{root}/fact_encounters")

    for stage in stages.values():
        drop_folder(spark, stage)
    return read_run_log(spark, log_path).where(F.col("execution_id") == run_id)


def replace_run(rows: DataFrame, path: str) -> None:
    """Store the rows of a run in its own partition; a rerun of the same id replaces them."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("execution_id").parquet(path)


def run_load_and_checks(spark: SparkSession, src: TableSet, folder: str, as_of: dt.date, run_id: str, calendar=None) -> DataFrame:
    """Load, refresh the stored pair aggregate, validate the written tables, store the issues, return the verdict."""
    root = folder.rstrip("/")
    run_warehouse_load(spark, src, root, as_of, run_id, calendar)
    wh = open_warehouse(spark, root)
    refresh_pair_summary(wh, f"{root}/mv_diagnosis_procedure_pairs")
    log = RunLog(spark, f"{root}/etl_logs", run_id, "validate_warehouse")
    with log.step("Validate warehouse") as rows:
        found = validate(src, wh, as_of).withColumn("created_at", C.moment(_now()))
        issues = found.withColumn("execution_id", F.lit(run_id))
        replace_run(rows.watch(issues), f"{root}/data_quality_log")
        comparison = schema_comparison(src, wh).withColumn("execution_id", F.lit(run_id))
        replace_run(comparison, f"{root}/schema_validation_log")
    return verdict(spark.read.parquet(f"{root}/data_quality_log").where(F.col("execution_id") == run_id))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_logs(spark: SparkSession, folder: str, run_id: str) -> TableSet:
    """The stored logs of one run in the shape of the exports: its steps, issues, and steps as measurements."""
    root, mine = folder.rstrip("/"), F.col("execution_id") == run_id
    steps = read_run_log(spark, f"{root}/etl_logs").where(mine)
    issues = spark.read.parquet(f"{root}/data_quality_log").where(mine)
    name = F.concat_ws("|", "execution_id", "table_name", "column_name", "issue_type")
    return TableSet(
        spark,
        {
            "etl_execution_log": lambda: steps,
            "data_quality_log": lambda: issues.withColumns(
                {"quality_id": F.xxhash64(name), "sample_values": F.lit(None).cast("string")}
            ),
            "performance_metrics": lambda: steps.select(
                F.col("log_id").alias("metric_id"),
                "execution_id",
                F.col("procedure_name").alias("table_name"),
                F.col("step_name").alias("operation_type"),
                F.round(F.col("duration_seconds") * 1000).cast("bigint").alias("duration_ms"),
                F.col("rows_processed").alias("rows_affected"),
                "start_time",
                "end_time",
            ),
        },
    )


def stored_report(spark: SparkSession, folder: str, run_id: str | None = None) -> DataFrame:
    """The validation report of a stored run, of the one validated last if none is named; nothing is validated again."""
    root = folder.rstrip("/")
    if run_id is None:
        last = latest_run(read_run_log(spark, f"{root}/etl_logs"), "validate_warehouse").first()
        if last is None:
            raise ValueError(f"no validated run in {root}")
        run_id = last["execution_id"]
    logs, mine = run_logs(spark, root, run_id), F.col("execution_id") == run_id
    comparison = spark.read.parquet(f"{root}/schema_validation_log").where(mine)
    issues = logs["data_quality_log"]
    return validation_report(issues, comparison, verdict(issues), logs["performance_metrics"])


def run_everything(
    spark: SparkSession,
    src: TableSet,
    folder: str,
    as_of: dt.date,
    run_id: str,
    calendar: tuple[dt.date, dt.date] | None = None,
    trail: str | None = None,
) -> DataFrame:
    """Load and validate, export the run's logs, archive the old audit trail; returns the history of the exports.

    The outcome of the run is put on the audit trail below ``trail`` (``folder``/audit_log if not given). An error of
    any step is recorded there too, and goes on to the caller; what earlier steps have written stays.
    """
    root = folder.rstrip("/")
    trail = trail or f"{root}/audit_log"
    schema = (
        "audit_id string, event_timestamp timestamp_ntz, event_type_code string, table_name string, "
        "operation_type string, success boolean, error_message string, compliance_notes string"
    )

    def record(error: str | None) -> None:
        note = f"Load {run_id} " + ("failed" if error else "completed")
        row = (uuid.uuid4().hex, _now(), "ETL_EXECUTION", "star_schema", "EXECUTE", error is None, error, note)
        append_events(spark.createDataFrame([row], schema), trail)

    try:
        run_load_and_checks(spark, src, root, as_of, run_id, calendar)
        history = export_run_logs(run_logs(spark, root, run_id), f"{root}/exports")
    except Exception as failure:
        record(str(failure))
        raise
    record(None)
    archive_records(spark, trail, f"{root}/audit_archive", as_of, _now())
    return history


def measured_slice(src: TableSet, dim_diagnosis: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Attaches money, child counts and the primary diagnosis to a slice; only the slice's own children are summed."""

    def finish(own: DataFrame) -> DataFrame:
        part = changed_slice(src, own.select("encounter_id"))
        children = (part[n] for n in ("billing", "encounter_diagnoses", "encounter_procedures"))
        return fact.with_measures(own, *children, dim_diagnosis)

    return finish


def backfill_slices(
    spark: SparkSession,
    visits: DataFrame,
    slices: list[tuple[dt.date, dt.date]],
    path: str,
    hot: list,
    finish: Callable[[DataFrame], DataFrame] = lambda own: own,
    horizon_days: int = fact.READMISSION_DAYS,
) -> None:
    """Load history slice by slice into partitions of year and month, each slice with its readmission measures.

    ``visits`` are encounters with their keys (``resolved_encounters``); a slice is (first day, day after the last),
    both the first of a month. A return or an earlier discharge may lie outside the slice, so it is measured together
    with the visits that reach into the horizon around the stays it begins, however long these are: that is read, but
    only rows that begin in the slice are written. Slices need no order, can be repeated, and no other month is read
    back or rewritten. A slice without visits writes nothing, so months stored before stay as they are. A visit
    without a start belongs to no slice.
    """
    start, end = F.col("encounter_datetime"), F.col("discharge_datetime")
    horizon = dt.timedelta(days=horizon_days)
    # The visits are derived once, in order of their starts, so that a slice opens only the files around it.
    ordered = fresh_path(spark, "backfill-visits")
    visits.repartitionByRange("encounter_datetime").sortWithinPartitions("encounter_datetime").write.parquet(ordered)
    visits = spark.read.schema(visits.schema).parquet(ordered)
    for first, following in slices:
        if first.day != 1 or following.day != 1 or first >= following:
            raise ValueError(f"a slice is made of whole months: {first} to {following}")
        began = (start >= C.moment(dt.datetime(first.year, first.month, 1))) & (
            start < C.moment(dt.datetime(following.year, following.month, 1))
        )
        # Two values: the slice's first and last instants, stays that reach out of it and ends before starts included.
        low, high = visits.where(began).agg(F.min(F.least(start, end)), F.max(F.greatest(start, end))).first()
        if low is None:
            continue
        before, after = C.moment(low - horizon), C.moment(high + horizon)
        around = fresh_path(spark, f"backfill-{first}")
        visits.where((start <= after) & ((start >= before) | (end >= before))).write.parquet(around)
        near = spark.read.schema(visits.schema).parquet(around)
        rows = fact.with_readmissions(finish(near.where(began)), fact.readmission_measures(near, hot, horizon_days))
        overwrite_partitions(rows.withColumn("encounter_month", F.month(start)), path, ["encounter_year", "encounter_month"])
        drop_folder(spark, around)
    drop_folder(spark, ordered)
