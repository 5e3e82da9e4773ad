"""Registered queries over versioned stores: daily runs, what they leave in quarantine, and streams with state."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.change import path_exists
from wardlake.plans import daily
from wardlake.plans.queries_star import summarised_pairs, top_stored_pairs
from wardlake.plans.store import VersionedStore
from wardlake.registry.oracle_base import CTES, div, rnd
from wardlake.registry.warehouse_queries import AS_OF, money_as_double, plain, source
from wardlake.registry.warehouse_queries import QUERIES as WAREHOUSE
from wardlake.session import fresh_path
from wardlake.sources import fixture
from wardlake.streaming import jobs, ledger

CUTOFF = dt.date(2000, 1, 1)
TRACKING = daily.Tracking(
    {
        "patients": "CASE WHEN patient_id % 7 = 0 OR patient_id % 11 = 0 THEN DATE'2001-07-01' ELSE DATE'1990-01-01' END",
        "encounters": "encounter_date",
        "billing": "claim_date",
        "encounter_procedures": "procedure_date",
    },
    buckets=4,
)


def earlier_source(src):
    """The source as it stood at the cutoff: later encounters, bills and procedures, and some patients, are missing."""
    early = src["encounters"].where(F.col("encounter_date") < F.lit(CUTOFF))
    only = lambda t: src[t].join(early.select("encounter_id"), "encounter_id", "left_semi")
    renamed = F.when(F.expr("patient_id % 11 = 0"), F.lit("Before")).otherwise(F.col("last_name"))
    return src.replacing(
        encounters=early,
        patients=src["patients"].where("patient_id % 7 <> 0").withColumn("last_name", renamed),
        billing=only("billing").where(F.col("claim_date") < F.lit(CUTOFF)),
        encounter_diagnoses=only("encounter_diagnoses"),
        encounter_procedures=only("encounter_procedures").where(F.col("procedure_date") < F.lit(CUTOFF)),
    )


@lru_cache(maxsize=4)
def _runs(app: str, sf_dir: str, spark) -> VersionedStore:
    """A store after three runs: the source at the cutoff, the whole of it, and the whole of it again."""
    src = fixture.kept(source(spark, sf_dir), "encounter_diagnoses")
    store = VersionedStore(spark, fresh_path(spark, "store"))
    for name, tables in (("run-1", earlier_source(src)), ("run-2", src), ("run-3", src)):
        daily.run_daily_load(spark, tables, store, AS_OF, name, TRACKING, fixture.CALENDAR)
    return store


def after_runs(spark, sf_dir) -> VersionedStore:
    return _runs(spark.sparkContext.applicationId, sf_dir, spark)


def _star_table(name, version=None):
    return lambda spark, sf_dir: plain(daily.open_store(after_runs(spark, sf_dir), version)[name])


def _marks(spark, sf_dir):
    store = after_runs(spark, sf_dir)
    rows = [(m.version, m.run_id, t, at) for m in map(store.current, store.versions()) for t, at in m.marks.items()]
    df = spark.createDataFrame(rows, "version bigint, run_id string, table_name string, mark string")
    return df.withColumn("mark", F.col("mark").cast("timestamp_ntz"))


def _returned(spark, sf_dir):
    """What became of the rows that the first run put into quarantine."""
    store = after_runs(spark, sf_dir)
    first, last = daily.open_store(store, 1)[daily.QUARANTINE], daily.open_store(store)
    loaded = last["fact_encounters"].select("encounter_id", F.lit("loaded").alias("state"))
    kept = last[daily.QUARANTINE].where("first_run = 'run-1'").select("encounter_id", F.lit("kept").alias("state")).distinct()
    return first.join(loaded.unionByName(kept), "encounter_id", "left").select("encounter_id", "reason", "bad_value", "state")


def _mark_sql(version: int, cutoff: str) -> str:
    tables = [("encounters", "encounter_date"), ("billing", "claim_date"), ("encounter_procedures", "procedure_date")]
    early = "encounter_id IN (SELECT encounter_id FROM encounters WHERE encounter_date < DATE '2000-01-01') AND "
    return " UNION ALL ".join(
        [f"SELECT {version} AS version, 'run-{version}' AS run_id, 'patients' AS table_name, TIMESTAMP '2001-07-01' AS mark"]
        + [
            f"SELECT {version}, 'run-{version}', '{t}', CAST(max({c}) AS TIMESTAMP) FROM {t}" + (f" WHERE {early}{c} < DATE '2000-01-01'" if cutoff else "")
            for t, c in tables
        ]
    )


# Streams in three deliveries (files below), with rows of the first withheld or repeated --------------------------------

# Rows of a Parquet file of a feed. A delivery of more rows comes as several files that one batch takes together.
FEED_ROWS = 1_000_000


def feed_files(deliveries) -> int:
    """Parquet files of each delivery: those the largest one needs."""
    return max(1, -(-max(rows.count() for rows in deliveries) // FEED_ROWS))


def deliver(rows, folder: str, files: int) -> None:
    """Add rows to a feed as exactly this many Parquet files, so that a batch of as many files is this delivery."""
    listed = lambda: len(rows.sparkSession.read.schema(rows.schema).parquet(folder).inputFiles())
    before = listed() if path_exists(rows.sparkSession, folder) else 0
    rows.repartition(files).write.mode("append").parquet(folder)
    for _ in range(before + files - listed()):  # Partitions without rows leave no file.
        rows.sparkSession.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(folder)


FILE_OF = "CASE WHEN ts < TIMESTAMP_NTZ '2024-01-11' THEN 1 WHEN ts < TIMESTAMP_NTZ '2024-01-21' THEN 2 ELSE 3 END"


@lru_cache(maxsize=4)
def _ledger(app: str, sf_dir: str, spark) -> VersionedStore:
    """Events in three files. Every 17th event of the first comes with the third, every 10th of the second comes in it
    twice, every 5th of the last day of the first comes again with the second; the stream restarts after the first."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").withColumn("file", F.expr(FILE_OF))
    held = F.expr("file = 1 AND event_id % 17 = 0")
    twice = events.where("file = 2 AND event_id % 10 = 0")
    again = events.where("file = 1 AND event_id % 17 <> 0 AND event_id % 5 = 0 AND ts >= TIMESTAMP_NTZ '2024-01-10 22:30:00'")
    files = [
        events.where(F.expr("file = 1") & ~held),
        events.where("file = 2").unionByName(twice).unionByName(again),
        events.where("file = 3").unionByName(events.where(held)),
    ]
    folder, progress = fresh_path(spark, "feed"), fresh_path(spark, "progress")
    store = VersionedStore(spark, fresh_path(spark, "ledger"))
    kept = ledger.EventLedger(store)
    schema = events.drop("file").schema
    each = feed_files(files)
    for k, rows in enumerate(files):
        deliver(rows.drop("file"), folder, each)
        if k != 1:  # the second and third file wait for one start
            jobs.run_each_batch(jobs.event_stream(spark, folder, schema, files_per_trigger=each), progress, kept.take)
    # A batch that is delivered again changes nothing.
    kept.take(files[2].drop("file"), int(store.current().marks["batch"]))
    return store


def event_ledger(spark, sf_dir) -> VersionedStore:
    return _ledger(spark.sparkContext.applicationId, sf_dir, spark)


def _accounts(spark, sf_dir):
    store = event_ledger(spark, sf_dir)
    count = lambda name, n: store.table(name).agg(n.alias("events")).withColumn("outcome", F.lit(name))
    rows = F.count(F.lit(1))
    return count("accepted", rows).unionByName(count("late", rows)).unionByName(count("repeated", F.coalesce(F.sum("copies"), F.lit(0))))


def _late_events(spark, sf_dir):
    return event_ledger(spark, sf_dir).table("late").select("event_id", "ts", "user_id", "reason", "batch")


@lru_cache(maxsize=4)
def _totals(app: str, sf_dir: str, spark) -> VersionedStore:
    """Bills in three files by the last digit of their encounter and their date; the stream restarts after the first."""
    bills = source(spark, sf_dir)["billing"].select("encounter_id", "claim_amount", "allowed_amount", "claim_date")
    folder, progress = fresh_path(spark, "bills"), fresh_path(spark, "progress")
    store = VersionedStore(spark, fresh_path(spark, "totals"))
    kept = ledger.BillTotals(store, buckets=8)
    part = F.expr("CASE WHEN claim_date < DATE'1999-01-01' THEN 0 WHEN encounter_id % 3 = 0 THEN 1 ELSE 2 END")
    files = [bills.where(part == k) for k in range(3)]
    each = feed_files(files)
    for k, rows in enumerate(files):
        deliver(rows, folder, each)
        if k != 1:
            jobs.run_each_batch(jobs.event_stream(spark, folder, bills.schema, files_per_trigger=each), progress, kept.take)
    kept.take(files[2], int(store.current().marks["batch"]))
    return store


def _late_totals(spark, sf_dir):
    store = _totals(spark.sparkContext.applicationId, sf_dir, spark)
    return plain(ledger.BillTotals(store, buckets=8).totals().drop("last_batch"))


TAKEN = """(SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS file FROM events)"""
# The watermark that the third file meets: the latest event of the second less an hour; withheld ones are far behind it.
ON_TIME = "NOT (file = 1 AND event_id % 17 = 0)"
CTES["first_end"] = f"SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM {TAKEN} t WHERE file = 1 AND {ON_TIME}"
CTES["sent_again"] = f"""
SELECT t.*, ts >= mark AS in_time FROM {TAKEN} t, first_end
WHERE file = 1 AND event_id % 17 <> 0 AND event_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-10 22:30:00'"""

QUERIES = {
    "p02_incremental_run": (_star_table("fact_encounters"), money_as_double("fact_encounters")),
    "p02_incremental_patients": (_star_table("dim_patient"), "SELECT * FROM dim_patient"),
    "p02_incremental_diagnoses": (_star_table("bridge_encounter_diagnoses"), "SELECT * FROM bridge_encounter_diagnoses"),
    "p02_incremental_procedures": (_star_table("bridge_encounter_procedures"), "SELECT * FROM bridge_encounter_procedures"),
    "p02_incremental_marks": (_marks, " UNION ALL ".join([_mark_sql(1, "cutoff"), _mark_sql(2, ""), _mark_sql(3, "")])),
    "j18_incremental_fact": (_star_table("fact_encounters", 2), money_as_double("fact_encounters")),
    "j23_returned_rows": (
        _returned,
        """SELECT encounter_id, 'UNKNOWN_PATIENT' AS reason, CAST(patient_id AS VARCHAR) AS bad_value,
                  CASE WHEN encounter_type IS NULL THEN 'kept' ELSE 'loaded' END AS state
           FROM encounters WHERE encounter_date < DATE '2000-01-01' AND patient_id % 7 = 0
           UNION ALL SELECT encounter_id, 'UNKNOWN_ENCOUNTER_TYPE', NULL, 'kept' FROM encounters
           WHERE encounter_date < DATE '2000-01-01' AND encounter_type IS NULL""",
    ),
    "j16_after_changes": (
        lambda spark, sf_dir: summarised_pairs(daily.open_store(after_runs(spark, sf_dir))[daily.PAIRS]).withColumn(
            "avg_revenue", C.rounded(F.col("avg_revenue"), 6)
        ),
        WAREHOUSE["j16_pair_summary"][1],
    ),
    "k16_top_stored_pairs": (
        lambda spark, sf_dir: top_stored_pairs(summarised_pairs(daily.open_store(after_runs(spark, sf_dir))[daily.PAIRS])),
        f"""SELECT icd10_code, icd10_description, cpt_code, cpt_description, count(*) AS combination_count,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_revenue
            FROM primary_pairs GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3
            ORDER BY combination_count DESC, icd10_code, cpt_code LIMIT 10""",
    ),
    "o01_events_across_files": (
        lambda spark, sf_dir: event_ledger(spark, sf_dir).table("accepted").drop("day"),
        f"SELECT * EXCLUDE (file) FROM {TAKEN} t WHERE {ON_TIME}",
    ),
    "o01_event_accounts": (
        _accounts,
        f"""SELECT 'accepted' AS outcome, count(*) AS events FROM {TAKEN} t WHERE {ON_TIME}
            UNION ALL SELECT 'late', (SELECT count(*) FROM {TAKEN} t WHERE NOT ({ON_TIME})) + (SELECT count(*) FROM sent_again WHERE NOT in_time)
            UNION ALL SELECT 'repeated', (SELECT count(*) FROM {TAKEN} t WHERE file = 2 AND event_id % 10 = 0) + (SELECT count(*) FROM sent_again WHERE in_time)""",
    ),
    "o01_late_events": (
        _late_events,
        f"""SELECT event_id, ts, user_id, 'LATE' AS reason, 2 AS batch FROM {TAKEN} t WHERE NOT ({ON_TIME})
            UNION ALL SELECT event_id, ts, user_id, 'LATE', 1 FROM sent_again WHERE NOT in_time""",
    ),
    "o03_sessions_across_files": (
        lambda spark, sf_dir: event_ledger(spark, sf_dir).table("sessions").drop("day"),
        f"""SELECT user_id, count(*) AS events, min(ts) AS first_at, max(ts) AS last_at FROM (
              SELECT *, sum(CASE WHEN ts - before < INTERVAL 1 HOUR THEN 0 ELSE 1 END)
                          OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session
              FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM {TAKEN} t WHERE {ON_TIME}) a) b
            GROUP BY user_id, session
            HAVING max(ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    ),
    "o04_late_totals": (
        _late_totals,
        """SELECT encounter_id, CAST(sum(claim_amount) AS DOUBLE) AS total_claim_amount,
                  CAST(sum(allowed_amount) AS DOUBLE) AS total_allowed_amount, count(*) AS bills FROM billing GROUP BY 1""",
    ),
}
