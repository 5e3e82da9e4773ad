import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardlake.plans import audit, exports, incremental, runlog
from wardlake.plans.fact import billing_totals
from wardlake.session import fresh_path
from wardlake.sources.fixture import clinical_tables, event_tables
from wardlake.streaming import jobs

AUDIT = "audit_id string, event_timestamp timestamp_ntz, event_type_code string, user_id string, patient_id bigint, success boolean"


def test_run_log_keeps_failed_steps(spark):
    path = fresh_path(spark, "log")
    log = runlog.RunLog(spark, path, "run-1", "load")
    with log.step("first") as rows:
        rows.watch(spark.range(7)).write.parquet(fresh_path(spark, "out"))
    with pytest.raises(RuntimeError):
        with log.step("second"):
            raise RuntimeError('broken "step"')
    steps = {r.step_name: r for r in runlog.read_run_log(spark, path).collect()}
    assert (steps["first"].status, steps["first"].rows_processed) == ("COMPLETED", 7)
    assert (steps["second"].status, steps["second"].error_message) == ("FAILED", 'broken "step"')
    assert steps["first"].duration_seconds > 0
    summary = runlog.run_summary(runlog.read_run_log(spark, path)).first()
    assert (summary.total_steps, summary.successful_steps, summary.failed_steps, summary.total_rows_processed) == (2, 1, 1, 7)


def test_failed_export_is_recorded(spark, small, monkeypatch):
    logs = event_tables(spark, small)

    def refuse(*_, **__):
        raise OSError("no space")

    monkeypatch.setattr(exports, "write_csv", refuse)
    folder = fresh_path(spark, "exports")
    history = exports.export_run_logs(logs, folder, ("PERFORMANCE", "SUMMARY"))
    rows = history.collect()
    states = {(r.export_type, r.export_status, r.error_message) for r in rows}
    assert states == {("PERFORMANCE", "FAILED", "no space"), ("SUMMARY", "SUCCESS", None)}
    assert all((r.file_size_bytes is None) == (r.export_status == "FAILED") for r in rows)
    # The history keeps both runs of an export; the returned rows are those of the last call.
    again = exports.export_run_logs(logs, folder, ("SUMMARY",)).collect()
    stored = exports.read_export_history(spark, f"{folder}/export_history")
    assert stored.count() == len(rows) + len(again) == stored.select("export_id").distinct().count()
    listed = {r.execution_id: r.file_size_bytes for r in exports.export_sizes(spark, f"{folder}/summary_json").collect()}
    assert {r.execution_id: r.file_size_bytes for r in again} == listed and min(listed.values()) > 0


def test_runs_share_a_bounded_number_of_folders(spark):
    # More runs than folders, names that a number or a quoted field could be taken for, and rows without a run.
    names = [f"{n:03d}" for n in range(3 * exports.RUN_FOLDERS)] + ['say "run"', "{x}", None]
    rows = [(n, k, f"{k}, {n}") for n in names for k in (1, 2)]
    schema = "execution_id string, step_order int, step_name string"
    steps = spark.createDataFrame(rows, schema).selectExpr(
        "monotonically_increasing_id() AS log_id", "*", "'load' AS procedure_name", "TIMESTAMP_NTZ'2024-01-01 01:02:03' AS start_time",
        "CAST(NULL AS TIMESTAMP_NTZ) AS end_time", "'RUNNING' AS status", "CAST(NULL AS BIGINT) AS rows_processed", "1L AS rows_inserted",
        "0L AS rows_updated", "CAST(NULL AS BIGINT) AS rows_deleted", "0.5D AS duration_seconds", "CAST(NULL AS STRING) AS error_message",
    )
    steps = steps.select(*exports.LOG_EXTRACT)
    csv, json = fresh_path(spark, "csv"), fresh_path(spark, "json")

    def stored():
        read = {"csv": exports.read_csv(spark, csv, steps.schema), "json": spark.read.schema("execution_id string, n bigint").json(json)}
        return {k: sorted(map(str, df.drop(exports.FOLDER).collect())) for k, df in read.items()}

    def write(part):
        exports.write_run_csv(part, exports.LOG_EXTRACT, csv, ["step_order", "log_id"])
        exports.write_run_json(part.groupBy("execution_id").agg(F.count("*").alias("n")), json)

    write(steps)
    whole = stored()
    assert len(whole["csv"]) == len(rows) and len(whole["json"]) == len(names)
    for path in (csv, json):
        folders = [p for p in Path(path).iterdir() if p.is_dir()]
        assert len(folders) <= exports.RUN_FOLDERS
        sizes = {r.execution_id: r for r in exports.export_sizes(spark, path).collect()}
        assert set(sizes) == set(names) and all(r.files >= 1 for r in sizes.values())
        files = [f for d in folders for f in d.iterdir() if f.name.startswith("part")]
        heads = len(files) * (len(exports.HEADERS[0]) + 1) if path == csv else 0
        assert sum(r.file_size_bytes for r in sizes.values()) == sum(f.stat().st_size for f in files) - heads
    # A run that is written again replaces its own rows; runs that share its folder stay.
    write(steps.where("execution_id = '007'"))
    assert stored() == whole
    write(steps.where("execution_id = '007' AND step_order = 1"))
    assert len(stored()["csv"]) == len(rows) - 1 and len(stored()["json"]) == len(names)


def test_exports_of_no_runs(spark, small):
    empty = event_tables(spark, small)
    empty = empty.replacing(**{n: empty[n].where("false") for n in ("etl_execution_log", "data_quality_log", "performance_metrics")})
    assert exports.export_run_logs(empty, fresh_path(spark, "exports")).isEmpty()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gaps_match_brute_force(spark, seed):
    rng = random.Random(seed)
    start, moments = dt.datetime(2024, 1, 24), []
    for _ in range(60):
        start += dt.timedelta(microseconds=rng.choice([3_600_000_000, 3_600_000_001, 5, 1_800_000_000, 9_000_000_000]))
        moments.append(start)
    rows = [(str(i), m, "USER_LOGIN", "u", None, True) for i, m in enumerate(moments)]
    found = audit.audit_gaps(spark.createDataFrame(rows, AUDIT).repartition(5), dt.date(2024, 1, 24)).collect()
    expected = {(a, b) for a, b in zip(moments, moments[1:]) if b - a > dt.timedelta(hours=1)}
    assert {(r.prev_timestamp, r.event_timestamp) for r in found} == expected


def test_changes_between_snapshots(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "id bigint, v string, n int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", 2)], "id bigint, v string, n int")
    found = {r.record_id: r for r in audit.capture_changes(old, new, ["id"]).collect()}
    assert {k: r.operation_type for k, r in found.items()} == {"2": "UPDATE", "3": "DELETE", "4": "INSERT"}
    assert found["2"].affected_columns == ["n"] and found["2"].old_values["n"] == "1" and found["2"].new_values["n"] is None
    assert found["3"].new_values is None and found["4"].old_values is None


def test_digests_see_changed_lost_and_added_rows(spark):
    rows = [(f"a{i}", dt.datetime(2024, 1, 1 + i % 3), "USER_LOGIN", f"u{i}", None, True) for i in range(30)]
    columns = ["audit_id", "event_type_code", "user_id", "success"]
    digest = lambda data: audit.day_digests(audit.row_hashes(spark.createDataFrame(data, AUDIT), columns))
    stored = digest(rows)
    assert audit.tampered_days(stored, digest(list(reversed(rows)))).count() == 0
    changed = [(*r[:3], "other", *r[4:]) if r[0] == "a3" else r for r in rows]
    for data, day in [(changed, 1), (rows[:-1], 3), (rows + [("new", dt.datetime(2024, 1, 9), "USER_LOGIN", "u", None, True)], 9)]:
        assert [r.event_date.day for r in audit.tampered_days(stored, digest(data)).collect()] == [day]


def test_report_of_one_patient(spark, small):
    trail = event_tables(spark, small)["audit_log"]
    phi = audit.phi_access(trail, clinical_tables(spark, small)["patients"])
    rows = audit.hipaa_access_report(phi, trail, dt.date(2024, 1, 1), dt.date(2024, 1, 31), patient_id=42).collect()
    assert [r.patient_id for r in rows] == [42]
    assert rows[0].access_count == trail.where("patient_id = 42").count()
    assert rows[0].highest_risk_access in ("MEDIUM", "HIGH")


def test_late_bills_of_a_stream_update_the_totals_once(spark, small):
    """Micro-batches of bills name the encounters; their totals are recomputed, so a repeated batch changes nothing."""
    src = clinical_tables(spark, small)
    bills = src["billing"].select("encounter_id", "claim_amount", "allowed_amount", "claim_date")
    early = bills.where(F.col("claim_date") < F.lit(dt.date(2000, 1, 1)))
    state = {"path": fresh_path(spark, "totals")}
    everyone = src["encounters"].select("encounter_id")
    everyone.join(billing_totals(early), "encounter_id", "left").write.parquet(state["path"])
    feed = fresh_path(spark, "feed")
    bills.where(F.col("claim_date") >= F.lit(dt.date(2000, 1, 1))).repartition(3).write.parquet(feed)

    def merge(batch, batch_id):
        stored = batch.sparkSession.read.parquet(state["path"])
        merged = incremental.recompute_billing(stored, bills, batch.select("encounter_id").distinct())
        target = fresh_path(spark, f"totals-{batch_id}")
        merged.write.parquet(target)
        state["path"] = target

    jobs.run_each_batch(jobs.event_stream(spark, feed, bills.schema, files_per_trigger=1), fresh_path(spark, "progress"), merge)
    expected = everyone.join(billing_totals(bills), "encounter_id", "left")
    got = spark.read.parquet(state["path"]).select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
