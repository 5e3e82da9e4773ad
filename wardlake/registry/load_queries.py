"""Registered loads: sources and sinks, table changes, incremental loads, streaming."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators import change
from wardlake.operators.keys import with_contiguous_key
from wardlake.operators.skew import union_all
from wardlake.plans import dims, fact, incremental, load
from wardlake.plans.warehouse import derive_warehouse, open_warehouse
from wardlake.registry.check_queries import LATER_SQL, logs, snapshots
from wardlake.registry.oracle_base import AS_OF as AS_OF_SQL
from wardlake.registry.oracle_base import CTES, age_case
from wardlake.registry.warehouse_queries import AS_OF, money_as_double, plain, source, star
from wardlake.session import fresh_path
from wardlake.sources import catalogs, fixture
from wardlake.sources.tables import open_clinical_parquet, store_tables
from wardlake.streaming import jobs

CUTOFF = dt.date(2000, 1, 1)
PATIENT_MARK = dt.date(2001, 7, 1)
BILLED_TO = dt.date(2001, 11, 4)
ARCHIVE_AS_OF = dt.date(2005, 1, 1)


def _saved(spark, df, label):
    """The DataFrame written below the shared folder and opened again, as a stored table would be."""
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


# Sources, sinks, keys -------------------------------------------------------------------------------------------------


def _stored_scan(spark, sf_dir):
    folder = fresh_path(spark, "clinical")
    store_tables(source(spark, sf_dir), folder)
    stored = open_clinical_parquet(spark, folder)
    recent = stored["encounters"].where(F.col("encounter_date") >= F.lit(CUTOFF))
    return recent.join(stored["patients"], "patient_id").select("encounter_id", "encounter_type", "encounter_date", "mrn")


def _catalog_use(spark, sf_dir):
    events = logs(spark, sf_dir)["audit_log"].groupBy("event_type_code").agg(F.count("*").alias("events"))
    return catalogs.audit_event_types(spark).join(events, "event_type_code", "left").select(
        "event_type_code", "severity_level", "retention_days", F.coalesce("events", F.lit(0)).alias("events")
    )


def _insert_twice(spark, sf_dir):
    """Patients of the later snapshot inserted, twice, into the dimension of the earlier one."""
    old, new = snapshots(spark, sf_dir, "patients")
    make = lambda p: dims.dim_patient(source(spark, sf_dir).replacing(patients=p), AS_OF)
    once = change.insert_if_absent(make(old), make(new), ["patient_id"])
    return change.insert_if_absent(once, make(new), ["patient_id"])


def _contiguous(spark, sf_dir):
    encounters = source(spark, sf_dir)["encounters"].select("encounter_id", "patient_id")
    return with_contiguous_key(encounters, ["encounter_id"], "encounter_key")


def _table_as_select(spark, sf_dir):
    src = source(spark, sf_dir)
    by_type = src["encounters"].groupBy("encounter_type").agg(F.count("*").alias("encounters"))
    return _saved(spark, by_type, "result")


def _year_partitions(spark, sf_dir):
    path = fresh_path(spark, "fact")
    load.write_fact(star(spark, sf_dir)["fact_measured"], path)
    stored = spark.read.parquet(path).where(F.col("encounter_year") >= 1999)
    return stored.groupBy("encounter_year").agg(
        F.count("*").alias("encounters"), F.sum("total_claim_amount").cast("double").alias("claims")
    )


def _backfill(spark, sf_dir):
    """All history loaded by half-years, later ones first, one of them twice."""
    folder, path = fresh_path(spark, "clinical"), fresh_path(spark, "backfill")
    store_tables(source(spark, sf_dir), folder)
    src = open_clinical_parquet(spark, folder)
    wh = derive_warehouse(src, AS_OF, fixture.CALENDAR)
    first, last = dims.calendar_bounds(src)
    starts = [dt.date(y, m, 1) for y in range(first.year, last.year + 2) for m in (1, 7)]
    slices = list(zip(starts, starts[1:]))[::-1]
    slices.insert(3, slices[1])
    hot = src.hot_keys("encounters", "patient_id")
    load.backfill_slices(spark, wh["fact_resolved"], slices, path, hot, load.measured_slice(src, wh["dim_diagnosis"]))
    return plain(spark.read.parquet(path).drop("encounter_month"))


# Table changes and incremental loads ----------------------------------------------------------------------------------


def _updated(spark, sf_dir):
    src = source(spark, sf_dir)
    discharges = src["encounters"].where(F.col("discharge_date").isNull()).select(
        "encounter_id", (F.col("encounter_date") + F.expr("INTERVAL 6 HOURS")).alias("discharge_date"),
        F.lit("Closed").alias("encounter_type"),
    )
    return change.update_from(src["encounters"], discharges, ["encounter_id"], ["discharge_date", "encounter_type"]).select(
        "encounter_id", "encounter_type", "discharge_date"
    )


def _upserted(spark, sf_dir):
    old, new = snapshots(spark, sf_dir, "providers")
    return change.upsert(old, new, ["provider_id"])


def _children_replaced(spark, sf_dir):
    """Procedures of encounters from the cutoff on replaced by one visit row each."""
    src = source(spark, sf_dir)
    changed = src["encounters"].where(F.col("encounter_date") >= F.lit(CUTOFF))
    rows = changed.select(
        F.lit(0).cast("bigint").alias("encounter_procedure_id"), "encounter_id", F.lit(4001).cast("bigint").alias("procedure_id"),
        F.to_date("encounter_date").alias("procedure_date"),
    )
    return change.replace_children(src["encounter_procedures"], changed.select("encounter_id"), rows, "encounter_id")


def _kept_by_age(spark, sf_dir):
    kept, _ = change.split_by_age(source(spark, sf_dir)["billing"], "claim_date", CUTOFF)
    return plain(kept)


def _added_columns(spark, sf_dir):
    base = star(spark, sf_dir)["fact_resolved"]
    defaults = {
        "has_30day_readmission": F.lit(False),
        "readmission_count_30days": F.lit(0),
        "encounter_year": F.lit(0),
    }
    return change.ensure_columns(base, defaults).select(
        "encounter_id", "encounter_year", "has_30day_readmission", "readmission_count_30days"
    )


MODIFIED = "date_add(DATE'2001-01-01', cast(patient_id % 365 as int))"


def _patients_merged(spark, sf_dir):
    old, new = snapshots(spark, sf_dir, "patients")
    src = source(spark, sf_dir)
    stored = _saved(spark, dims.dim_patient(src.replacing(patients=old), AS_OF), "dim_patient")
    changed = incremental.changed_since(new, F.expr(MODIFIED), PATIENT_MARK)
    return incremental.merge_patients(stored, src, changed, AS_OF)


def _before_cutoff(spark, sf_dir):
    src = source(spark, sf_dir)
    early = src.replacing(encounters=src["encounters"].where(F.col("encounter_date") < F.lit(CUTOFF)))
    ids = incremental.changed_since(src["encounters"], "encounter_date", CUTOFF).select("encounter_id")
    return src, derive_warehouse(early, AS_OF, fixture.CALENDAR), derive_warehouse(src, AS_OF, fixture.CALENDAR), ids


def _bridge_merged(name):
    def run(spark, sf_dir):
        src, early, current, ids = _before_cutoff(spark, sf_dir)
        stored = {n: _saved(spark, early[n], n) for n in ("bridge_encounter_diagnoses", "bridge_encounter_procedures")}
        hot = src.hot_keys("encounter_procedures", "encounter_id")
        return incremental.merge_bridges(stored, src, current, ids, hot)[name]

    return run


def _late_billing(spark, sf_dir):
    src = source(spark, sf_dir)
    early = src["billing"].where(F.col("claim_date") < F.lit(BILLED_TO - dt.timedelta(days=incremental.LATE_BILLING_DAYS)))
    base = star(spark, sf_dir)["fact_resolved"].select("encounter_id")
    stored = _saved(spark, base.join(fact.billing_totals(early), "encounter_id", "left"), "fact")
    return plain(incremental.apply_late_billing(stored, src["billing"], BILLED_TO))


def _marks(spark, sf_dir):
    src = source(spark, sf_dir)
    return incremental.high_water_marks(
        {
            "encounters": (src["encounters"], "encounter_date"),
            "billing": (src["billing"], "claim_date"),
            "encounter_procedures": (src["encounter_procedures"], "procedure_date"),
        }
    )


def _small_refreshed(spark, sf_dir):
    folder = fresh_path(spark, "dims")
    incremental.refresh_small_dimensions(source(spark, sf_dir), folder, AS_OF)
    stored = open_warehouse(spark, folder)
    shown = [
        ("dim_specialty", "specialty_key", "specialty_category"),
        ("dim_department", "department_key", "department_type"),
        ("dim_encounter_type", "encounter_type_key", "type_description"),
        ("dim_diagnosis", "diagnosis_key", "diagnosis_category"),
        ("dim_procedure", "procedure_key", "procedure_category"),
    ]
    return union_all(
        [stored[t].select(F.lit(t).alias("table_name"), F.col(k).alias("row_key"), F.col(c).alias("label")) for t, k, c in shown]
    )


def _quarantine(spark, sf_dir):
    wh = star(spark, sf_dir)
    known = wh.replacing(
        dim_provider=wh["dim_provider"].where("credential = 'MD'"), dim_patient=wh["dim_patient"].where("gender <> 'O'")
    )
    return incremental.quarantined(source(spark, sf_dir), known)


def _archive_split(spark, sf_dir):
    kept, old = incremental.split_archive(star(spark, sf_dir)["fact_measured"], ARCHIVE_AS_OF)
    count = lambda df, side: df.groupBy("encounter_year").agg(F.count("*").alias("encounters")).withColumn("side", F.lit(side))
    return count(kept, "kept").unionByName(count(old, "archived"))


def _loaded(spark, sf_dir):
    """The source of a load, with the diagnoses stored, as several steps read their numbers."""
    return fixture.kept(source(spark, sf_dir), "encounter_diagnoses")


def _full_load(spark, sf_dir):
    log = load.run_warehouse_load(spark, _loaded(spark, sf_dir), fresh_path(spark, "warehouse"), AS_OF, "run-1", fixture.CALENDAR)
    return log.select("step_order", "step_name", "status", "rows_processed")


def _load_verdict(spark, sf_dir):
    return load.run_load_and_checks(spark, _loaded(spark, sf_dir), fresh_path(spark, "warehouse"), AS_OF, "run-1", fixture.CALENDAR)


def _everything(spark, sf_dir):
    """The full run: its exports as the stored history has them, beside the outcome on the audit trail."""
    folder = fresh_path(spark, "warehouse")
    history = load.run_everything(spark, _loaded(spark, sf_dir), folder, AS_OF, "run-1", fixture.CALENDAR)
    ended = spark.read.parquet(f"{folder}/audit_log").where("event_type_code = 'ETL_EXECUTION'").select("success")
    return history.join(F.broadcast(ended)).select(
        "export_type", "output_format", "export_status", "record_count", (F.col("file_size_bytes") > 0).alias("has_size"), "success"
    )


LOAD_STEPS = [
    ("Populate date dimension", "dim_date"), ("Populate specialty dimension", "dim_specialty"),
    ("Populate department dimension", "dim_department"), ("Populate encounter type dimension", "dim_encounter_type"),
    ("Populate diagnosis dimension", "dim_diagnosis"), ("Populate procedure dimension", "dim_procedure"),
    ("Populate patient dimension", "dim_patient"), ("Populate provider dimension", "dim_provider"),
    ("Populate fact_encounters", "resolved"), ("Populate bridge tables", None),
    ("Calculate readmission metrics", "readmission"), ("Update primary diagnosis keys", "resolved"),
]
LOAD_SQL = " UNION ALL ".join(
    f"SELECT {i} AS step_order, '{title}' AS step_name, 'COMPLETED' AS status, "
    + (f"(SELECT count(*) FROM {t})" if t else "(SELECT count(*) FROM bridge_encounter_diagnoses) + (SELECT count(*) FROM bridge_encounter_procedures)")
    + " AS rows_processed"
    for i, (title, t) in enumerate(LOAD_STEPS, 1)
)

CTES["later_patients"] = LATER_SQL["patients"].format(patients="patients")
CTES["later_patient_rows"] = f"""
SELECT patient_id, patient_id AS patient_key, first_name, last_name, first_name || ' ' || last_name AS full_name, gender, date_of_birth,
       age AS current_age, {age_case('age')} AS age_group, mrn
FROM (SELECT *, CAST(date_sub('year', date_of_birth, {AS_OF_SQL}) AS INT) AS age FROM later_patients) t"""
CTES["fresh_patient_rows"] = "SELECT * FROM later_patient_rows WHERE DATE '2001-01-01' + CAST(patient_id % 365 AS INT) >= DATE '2001-07-01'"

LOADS = {
    "a01_stored_scan": (
        _stored_scan,
        """SELECT encounter_id, encounter_type, encounter_date, mrn FROM encounters JOIN patients USING (patient_id)
           WHERE encounter_date >= DATE '2000-01-01'""",
    ),
    "a03_catalog_rows": (
        _catalog_use,
        """SELECT event_type_code, severity_level, retention_days, coalesce(n, 0) AS events
           FROM event_types LEFT JOIN (SELECT event_type_code, count(*) AS n FROM audit_log GROUP BY 1) a USING (event_type_code)""",
    ),
    "a04_insert_if_absent": (
        _insert_twice,
        """SELECT * FROM dim_patient UNION ALL BY NAME SELECT * FROM later_patient_rows
           WHERE patient_id NOT IN (SELECT patient_id FROM patients)""",
    ),
    "a10_table_as_select": (
        _table_as_select,
        "SELECT encounter_type, count(*) AS encounters FROM encounters GROUP BY 1",
    ),
    "a11_contiguous_key": (
        _contiguous,
        "SELECT encounter_id, patient_id, row_number() OVER (ORDER BY encounter_id) AS encounter_key FROM encounters",
    ),
    "a12_year_partitions": (
        _year_partitions,
        """SELECT encounter_year, count(*) AS encounters, CAST(sum(total_claim_amount) AS DOUBLE) AS claims
           FROM fact_encounters WHERE encounter_year >= 1999 GROUP BY 1""",
    ),
    "a12_monthly_backfill": (
        _backfill,
        money_as_double("fact_encounters"),
    ),
    "i01_update_from": (
        _updated,
        """SELECT encounter_id, CASE WHEN discharge_date IS NULL THEN 'Closed' ELSE encounter_type END AS encounter_type,
                  coalesce(discharge_date, encounter_date + INTERVAL 6 HOUR) AS discharge_date FROM encounters""",
    ),
    "i02_upsert": (_upserted, LATER_SQL["providers"].format(providers="providers")),
    "i03_replace_children": (
        _children_replaced,
        """SELECT ep.* FROM encounter_procedures ep ANTI JOIN (SELECT * FROM encounters WHERE encounter_date >= DATE '2000-01-01') c
             USING (encounter_id)
           UNION ALL SELECT 0, encounter_id, 4001, CAST(encounter_date AS DATE) FROM encounters WHERE encounter_date >= DATE '2000-01-01'""",
    ),
    "i04_delete_by_age": (
        _kept_by_age,
        """SELECT * REPLACE (CAST(claim_amount AS DOUBLE) AS claim_amount, CAST(allowed_amount AS DOUBLE) AS allowed_amount)
           FROM billing WHERE claim_date >= DATE '2000-01-01'""",
    ),
    "i05_ensure_columns": (
        _added_columns,
        """SELECT encounter_id, encounter_year, FALSE AS has_30day_readmission, 0 AS readmission_count_30days FROM resolved""",
    ),
    "j17_incremental_patients": (
        _patients_merged,
        """SELECT * FROM fresh_patient_rows UNION ALL BY NAME
           SELECT * FROM dim_patient WHERE patient_id NOT IN (SELECT patient_id FROM fresh_patient_rows)""",
    ),
    "j19_incremental_diagnosis_bridge": (
        _bridge_merged("bridge_encounter_diagnoses"), "SELECT * FROM bridge_encounter_diagnoses"),
    "j19_incremental_procedure_bridge": (
        _bridge_merged("bridge_encounter_procedures"), "SELECT * FROM bridge_encounter_procedures"),
    "j20_late_billing": (
        _late_billing,
        """SELECT encounter_id, CAST(sum(claim_amount) FILTER (keep) AS DOUBLE) AS total_claim_amount,
                  CAST(sum(allowed_amount) FILTER (keep) AS DOUBLE) AS total_allowed_amount
           FROM resolved LEFT JOIN (SELECT *, TRUE AS keep FROM billing) b USING (encounter_id) GROUP BY 1""",
    ),
    "j21_high_water_marks": (
        _marks,
        """SELECT 'encounters' AS table_name, max(encounter_date) AS last_modified FROM encounters
           UNION ALL SELECT 'billing', CAST(max(claim_date) AS TIMESTAMP) FROM billing
           UNION ALL SELECT 'encounter_procedures', CAST(max(procedure_date) AS TIMESTAMP) FROM encounter_procedures""",
    ),
    "j22_small_dimension_refresh": (
        _small_refreshed,
        """SELECT 'dim_specialty' AS table_name, specialty_key AS row_key, specialty_category AS label FROM dim_specialty
           UNION ALL SELECT 'dim_department', department_key, department_type FROM dim_department
           UNION ALL SELECT 'dim_encounter_type', encounter_type_key, type_description FROM dim_encounter_type
           UNION ALL SELECT 'dim_diagnosis', diagnosis_key, diagnosis_category FROM dim_diagnosis
           UNION ALL SELECT 'dim_procedure', procedure_key, procedure_category FROM dim_procedure""",
    ),
    "j23_quarantine": (
        _quarantine,
        """SELECT encounter_id, 'UNKNOWN_PATIENT' AS reason, CAST(patient_id AS VARCHAR) AS bad_value FROM encounters
             WHERE patient_id NOT IN (SELECT patient_id FROM patients WHERE gender <> 'O')
           UNION ALL SELECT encounter_id, 'UNKNOWN_PROVIDER', CAST(provider_id AS VARCHAR) FROM encounters
             WHERE provider_id NOT IN (SELECT provider_id FROM providers WHERE credential = 'MD')
           UNION ALL SELECT encounter_id, 'UNKNOWN_ENCOUNTER_TYPE', NULL FROM encounters WHERE encounter_type IS NULL""",
    ),
    "j24_archive_encounters": (
        _archive_split,
        """SELECT CASE WHEN encounter_datetime < DATE '1998-01-01' THEN 'archived' ELSE 'kept' END AS side, encounter_year,
                  count(*) AS encounters FROM resolved GROUP BY 1, 2""",
    ),
    "p02_warehouse_load": (_full_load, LOAD_SQL),
    "p02_full_run": (
        _everything,
        f"""SELECT export_type, output_format, 'SUCCESS' AS export_status, record_count, TRUE AS has_size, TRUE AS success FROM (
              VALUES ('LOGS', 'CSV', {len(LOAD_STEPS) + 1}), ('LOGS', 'JSON', {len(LOAD_STEPS) + 1}),
                     ('PERFORMANCE', 'CSV', {len(LOAD_STEPS) + 1}), ('SUMMARY', 'JSON', 1)) t(export_type, output_format, record_count)
            UNION ALL SELECT 'QUALITY_REPORT', 'CSV', 'SUCCESS', count(*), TRUE, TRUE FROM found_issues HAVING count(*) > 0""",
    ),
    "p02_load_and_checks": (_load_verdict, "SELECT * FROM verdict_row"),
}

# Streaming ------------------------------------------------------------------------------------------------------------


def _feed(spark, sf_dir, copies: int = 1):
    """The event file as a stream, or several copies of it, one file each."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    if copies == 1:
        return jobs.event_stream(spark, sf_dir, schema, "events.parquet")
    folder = fresh_path(spark, "feed")
    for _ in range(copies):
        spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").write.mode("append").parquet(folder)
    return jobs.event_stream(spark, folder, schema)


def _ran(spark, stream):
    path = fresh_path(spark, "stream")
    jobs.run_available(stream, fresh_path(spark, "progress"), path)
    return spark.read.parquet(path)


def _late_bill_rows(spark, sf_dir):
    """Encounters and bills written as two feeds and joined as streams."""
    src = source(spark, sf_dir)
    encounters = src["encounters"].select("encounter_id", F.col("encounter_date").alias("encounter_at"))
    bills = src["billing"].select(
        "encounter_id", F.col("claim_date").cast("timestamp_ntz").alias("billed_at"), "claim_amount", "allowed_amount"
    )
    feeds = []
    for df in (encounters, bills):
        folder = fresh_path(spark, "feed")
        df.write.parquet(folder)
        feeds.append(jobs.event_stream(spark, folder, df.schema))
    return plain(_ran(spark, jobs.late_bills(*feeds)))


WINDOW_SQL = """
SELECT window_start, window_start + INTERVAL {minutes} MINUTE AS window_end, user_id, count(*) AS events,
       count(*) FILTER (event_type = 'error') AS failures
FROM (SELECT *, unnest({starts}) AS window_start FROM events) e
WHERE window_start + INTERVAL {minutes} MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
GROUP BY 1, 2, 3"""

STREAMS = {
    "o01_streaming_ingest": (
        lambda spark, sf_dir: _ran(spark, jobs.deduplicated(_feed(spark, sf_dir, copies=2))),
        "SELECT * FROM events",
    ),
    "o02_tumbling_alerts": (
        lambda spark, sf_dir: _ran(spark, jobs.alert_counts(_feed(spark, sf_dir))),
        WINDOW_SQL.format(minutes=60, starts="[time_bucket(INTERVAL 1 HOUR, ts)]"),
    ),
    "o02_sliding_alerts": (
        lambda spark, sf_dir: _ran(spark, jobs.alert_counts(_feed(spark, sf_dir), slide="15 minutes")),
        WINDOW_SQL.format(
            minutes=60,
            starts="[" + ", ".join(f"time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL {m} MINUTE" for m in (0, 15, 30, 45)) + "]",
        ),
    ),
    "o03_access_sessions": (
        lambda spark, sf_dir: _ran(spark, jobs.access_sessions(_feed(spark, sf_dir))),
        """SELECT user_id, count(*) AS events, min(ts) AS first_at, max(ts) AS last_at FROM (
             SELECT *, sum(CASE WHEN ts - before < INTERVAL 1 HOUR THEN 0 ELSE 1 END)
                         OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session
             FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events) a) b
           GROUP BY user_id, session
           HAVING max(ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    ),
    "o04_late_bills": (
        _late_bill_rows,
        """SELECT encounter_id, CAST(claim_amount AS DOUBLE) AS claim_amount, CAST(allowed_amount AS DOUBLE) AS allowed_amount,
                  CAST(claim_date AS TIMESTAMP) AS billed_at, encounter_date AS encounter_at
           FROM billing JOIN encounters USING (encounter_id)
           WHERE CAST(claim_date AS TIMESTAMP) BETWEEN encounter_date - INTERVAL 7 DAY AND encounter_date + INTERVAL 7 DAY""",
    ),
}

QUERIES = {**LOADS, **STREAMS}
