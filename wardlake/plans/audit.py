"""Audit trail: change capture, PHI access, compliance reports, integrity checks and archiving."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.change import append_partitioned, move_partitions
from wardlake.operators.skew import union_all
from wardlake.sources.catalogs import SEVERITIES, audit_event_types, user_roles

AUDIT_SCHEMA = (
    "audit_id string, event_timestamp timestamp_ntz, event_type_code string, user_id string, user_role string, "
    "table_name string, operation_type string, record_id string, patient_id bigint, affected_columns array<string>, "
    "old_values map<string,string>, new_values map<string,string>, success boolean, error_message string, "
    "response_time_ms int, rows_affected bigint, compliance_notes string"
)

# Audited tables with their key and the event group of their changes.
AUDITED_TABLES = {
    "patients": ("patient_id", "PATIENT"),
    "providers": ("provider_id", "DATA"),
    "encounters": ("encounter_id", "DATA"),
    "diagnoses": ("diagnosis_id", "DIAGNOSIS"),
    "procedures": ("procedure_id", "DATA"),
    "billing": ("billing_id", "BILLING"),
}
OPERATION_CODES = {"INSERT": "CREATE", "UPDATE": "UPDATE", "DELETE": "DELETE"}

# Purpose of accesses from clinical changes, allowed silence, archive age, alert thresholds.
ACCESS_PURPOSE = "Clinical Care"
GAP_MICROS = C.MICROS_PER_HOUR
ARCHIVE_MONTHS = 84
GAP_WINDOW_DAYS = 7
REPORT_DAYS = 30


def append_events(events: DataFrame, path: str) -> None:
    """Append audit rows, partitioned by the day of the event; absent columns stay NULL."""
    spark = events.sparkSession
    shaped = spark.createDataFrame([], AUDIT_SCHEMA).unionByName(events, allowMissingColumns=True)
    append_partitioned(shaped.withColumn("event_date", F.to_date("event_timestamp")), path, ["event_date"])


def capture_changes(old: DataFrame, new: DataFrame, key: list[str], patient: str | None = None) -> DataFrame:
    """Row changes between two snapshots of a table, in place of row triggers.

    One full outer join on the key; columns are compared null-safe. Values are kept as maps of text. A row whose key is
    NULL has no counterpart: it is a DELETE of the old and an INSERT of the new snapshot.
    """
    columns = [c for c in new.columns if c not in key]
    o, n = old.select(F.lit(True).alias("_here"), "*").alias("o"), new.select(F.lit(True).alias("_here"), "*").alias("n")
    same_key = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key]
    condition = same_key[0]
    for part in same_key[1:]:
        condition = condition & part
    was, is_now = F.col("o._here").isNotNull(), F.col("n._here").isNotNull()
    differs = {c: ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in columns}
    operation = F.when(~was, "INSERT").when(~is_now, "DELETE").otherwise("UPDATE")
    changed = F.array_compact(F.array(*[F.when(d, F.lit(c)) for c, d in differs.items()]))

    def values(side: str) -> Column:
        pairs = [x for c in [*key, *columns] for x in (F.lit(c), F.col(f"{side}.{c}").cast("string"))]
        return F.create_map(*pairs)

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"n.{name}"), F.col(f"o.{name}"))

    compared = o.join(n, condition, "full_outer").select(
        operation.alias("operation_type"),
        F.concat_ws("|", *[either(k).cast("string") for k in key]).alias("record_id"),
        (either(patient).cast("bigint") if patient else F.lit(None).cast("bigint")).alias("patient_id"),
        F.when(was & is_now, changed).alias("affected_columns"),
        F.when(was, values("o")).alias("old_values"),
        F.when(is_now, values("n")).alias("new_values"),
    )
    return compared.where((F.col("operation_type") != "UPDATE") | (F.size("affected_columns") > 0))


def bucket_of(key: list[str], buckets: int) -> Column:
    """Bucket of a row by its key; a row without one has a bucket too."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def bucket_digests(rows: DataFrame, key: list[str], buckets: int) -> DataFrame:
    """Rows and digest of each bucket: sums of the row hashes, which need no order and combine before the shuffle.

    Two hashes of 64 bits a row, over all columns with their NULLs told apart from empty values.
    """
    whole = [x for c in rows.columns for x in (F.col(c), F.col(c).isNull())]
    first, second = F.xxhash64(*whole), F.xxhash64(F.lit("second"), *whole)
    wide = lambda h: F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)")
    return rows.groupBy(bucket_of(key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), wide(first).alias("first"), wide(second).alias("second")
    )


def differing_buckets(old: DataFrame, new: DataFrame, key: list[str], buckets: int) -> list[int]:
    """Buckets in which two states of a table differ: no more numbers than buckets reach the driver."""
    both = bucket_digests(old, key, buckets).unionByName(bucket_digests(new.select(*old.columns), key, buckets))
    same = both.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sides"), *[F.count_distinct(c).alias(c) for c in ("rows", "first", "second")]
    )
    changed = same.where("sides = 1 OR rows > 1 OR first > 1 OR second > 1")
    return sorted(r[0] for r in changed.select("bucket").collect())


def capture_changes_by_digest(old: DataFrame, new: DataFrame, key: list[str], patient: str | None = None, buckets: int = 4096) -> DataFrame:
    """As :func:`capture_changes`, comparing row by row only the buckets of keys whose digests differ.

    Both states are read once more, but of equal buckets no row is shuffled: a table with few changes moves little.
    """
    changed = differing_buckets(old, new, key, buckets)
    cut = lambda df: df.where(bucket_of(key, buckets).isin(changed)) if changed else df.where(F.lit(False))
    return capture_changes(cut(old), cut(new), key, patient)


def change_events(changes: DataFrame, table: str, at: dt.datetime, user: str, run_id: str) -> DataFrame:
    """Audit rows of captured changes. Ids are built from the run, table and record, so that a rerun repeats them."""
    group = AUDITED_TABLES[table][1]
    code = F
    for operation, suffix in OPERATION_CODES.items():
        code = code.when(F.col("operation_type") == operation, F.lit(f"{group}_{suffix}"))
    return changes.select(
        F.concat_ws("-", F.lit(run_id), F.lit(table), "operation_type", "record_id").alias("audit_id"),
        C.moment(at).alias("event_timestamp"),
        code.otherwise(F.lit(None)).alias("event_type_code"),
        F.lit(user).alias("user_id"),
        F.lit(table).alias("table_name"),
        "operation_type",
        "record_id",
        "patient_id",
        "affected_columns",
        "old_values",
        "new_values",
        F.lit(True).alias("success"),
    )


def phi_access(audit: DataFrame, patients: DataFrame) -> DataFrame:
    """Access rows of audit events that concern a patient, with the record number of the patient."""
    touched = audit.where(F.col("patient_id").isNotNull())
    return touched.join(patients.select("patient_id", F.col("mrn").alias("patient_mrn")), "patient_id", "left").select(
        F.concat(F.lit("phi-"), "audit_id").alias("phi_access_id"),
        "audit_id",
        "patient_id",
        "patient_mrn",
        F.array("table_name").alias("accessed_phi_elements"),
        F.lit(ACCESS_PURPOSE).alias("access_purpose"),
    )


def on_days(audit: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Only the day partitions from ``first`` to ``last``, where the trail is stored by ``event_date``.

    The day of an event is its partition, so this never changes a result; other days are not read.
    """
    if "event_date" not in audit.columns:
        return audit
    if first is not None:
        audit = audit.where(F.col("event_date") >= F.lit(first))
    return audit if last is None else audit.where(F.col("event_date") <= F.lit(last))


def severity_rank(severity: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity)


def hipaa_access_report(
    phi: DataFrame, audit: DataFrame, start: dt.date, end: dt.date, patient_id: int | None = None
) -> DataFrame:
    """Accesses per patient between two days: users, elements, first and last access, event types, highest severity.

    Only distinct element lists and event types are collected, which tables and catalogue bound, never the accesses.
    """
    day = F.to_date("event_timestamp")
    events = on_days(audit, start, end).where((day >= F.lit(start)) & (day <= F.lit(end))).select(
        "audit_id", "user_id", "event_timestamp", "event_type_code"
    )
    if patient_id is not None:
        phi = phi.where(F.col("patient_id") == patient_id)
    rank = severity_rank(F.col("severity_level"))
    types = audit_event_types(audit.sparkSession).select("event_type_code", rank.alias("_rank"))
    accesses = phi.join(events, "audit_id").join(F.broadcast(types), "event_type_code", "left")
    totals = accesses.groupBy("patient_id", "patient_mrn").agg(
        F.count("*").alias("access_count"),
        F.countDistinct("user_id").alias("unique_users"),
        F.min("event_timestamp").alias("first_access"),
        F.max("event_timestamp").alias("last_access"),
        F.array_join(F.array_sort(F.collect_set("event_type_code")), ", ").alias("access_types"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("accessed_phi_elements")))).alias("phi_elements"),
        F.max("_rank").alias("_rank"),
    )
    return (
        totals.select(
            "patient_id",
            "patient_mrn",
            "access_count",
            "unique_users",
            "phi_elements",
            "first_access",
            "last_access",
            "access_types",
            F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("_rank").cast("int")).alias(
                "highest_risk_access"
            ),
        )
        .orderBy(F.desc("access_count"), "patient_id")
    )


def audit_gaps(audit: DataFrame, since: dt.date, gap_micros: int = GAP_MICROS) -> DataFrame:
    """Silences longer than ``gap_micros`` between consecutive events.

    Two events of one time bucket of that width can never be so far apart. So the events shrink to one row per bucket,
    its first and last instant, before anything is put in order; the buckets are bounded by the span of time.
    """
    at = C.epoch_micros(F.col("event_timestamp"))
    buckets = (
        on_days(audit, since)
        .where(F.col("event_timestamp") >= F.lit(since))
        .groupBy(F.floor(at / gap_micros).alias("bucket"))
        .agg(F.min("event_timestamp").alias("first_at"), F.max("event_timestamp").alias("last_at"))
    )
    previous = F.lag("last_at").over(Window.orderBy("bucket"))
    return (
        buckets.select(previous.alias("prev_timestamp"), F.col("first_at").alias("event_timestamp"))
        .where(C.interval_micros(F.col("event_timestamp") - F.col("prev_timestamp")) > gap_micros)
        .withColumn("gap_micros", C.interval_micros(F.col("event_timestamp") - F.col("prev_timestamp")))
    )


def orphaned_phi(phi: DataFrame, audit: DataFrame) -> DataFrame:
    """Access rows without their audit row."""
    return phi.join(audit.select("audit_id"), "audit_id", "left_anti")


def past_retention(audit: DataFrame, as_of: dt.date) -> DataFrame:
    """Audit rows older than the retention of their event type."""
    types = F.broadcast(audit_event_types(audit.sparkSession).select("event_type_code", "retention_days"))
    limit = F.date_sub(F.lit(as_of), F.col("retention_days")).cast("timestamp_ntz")
    oldest = min(row["retention_days"] for row in audit_event_types(audit.sparkSession).select("retention_days").collect())
    old = on_days(audit, last=as_of - dt.timedelta(days=oldest))
    return old.join(types, "event_type_code").where(F.col("event_timestamp") < limit)


def verify_integrity(audit: DataFrame, phi: DataFrame, as_of: dt.date) -> DataFrame:
    """Continuity, link and retention checks, one row each."""

    def check(name, found, bad_status, good, before, after):
        n = F.col("record_count")
        return found.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias("check_name"),
            F.when(n == 0, "PASS").otherwise(bad_status).alias("status"),
            F.when(n == 0, good).otherwise(F.concat(F.lit(before), n.cast("string"), F.lit(after))).alias("message"),
            n,
        )

    # Names and messages of the checks.
    return union_all(
        [
            check(
                "Audit Log Continuity",
                audit_gaps(audit, as_of - dt.timedelta(days=GAP_WINDOW_DAYS)),
                "FAIL",
                "No gaps in audit log timestamps",
                "Found ",
                " potential gaps in audit log",
            ),
            check(
                "PHI Access Integrity",
                orphaned_phi(phi, audit),
                "FAIL",
                "All PHI access records linked to audit log",
                "Found ",
                " orphaned PHI access records",
            ),
            check(
                "Retention Compliance",
                past_retention(audit, as_of),
                "WARNING",
                "No audit records exceed retention period",
                "Found ",
                " audit records exceeding retention",
            ),
        ]
    )


def archive_cutoff(as_of: dt.date) -> dt.date:
    """First day that is not archived: seven years before."""
    years = ARCHIVE_MONTHS // 12
    day = min(as_of.day, 28) if as_of.month == 2 else as_of.day
    return dt.date(as_of.year - years, as_of.month, day)


def archive_records(spark: SparkSession, path: str, archive: str, as_of: dt.date, at: dt.datetime) -> int:
    """Move the day partitions older than seven years to the archive, log it, and return the rows moved."""
    cutoff = archive_cutoff(as_of)
    moved = move_partitions(spark, path, archive, "event_date", cutoff, ["audit_id"])
    note = f"Archived {moved} audit records older than {cutoff}"
    row = (f"archive-{cutoff}-{at.isoformat()}", at, "SYSTEM_ARCHIVE", "audit_log", "ARCHIVE", True, note)
    schema = "audit_id string, event_timestamp timestamp_ntz, event_type_code string, table_name string, operation_type string, success boolean, compliance_notes string"
    append_events(spark.createDataFrame([row], schema), path)
    return moved


def classified(audit: DataFrame) -> DataFrame:
    """Audit rows with the severity and HIPAA category of their type."""
    types = audit_event_types(audit.sparkSession).select("event_type_code", "severity_level", "hipaa_category")
    return audit.join(F.broadcast(types), "event_type_code", "left")


def unauthorized_phi_reads(audit: DataFrame) -> DataFrame:
    """Patient events by a role that may not see PHI, or by an unknown role."""
    roles = user_roles(audit.sparkSession).select(F.col("role_name").alias("user_role"), "access_level", "can_access_phi")
    return (
        audit.where(F.col("patient_id").isNotNull())
        .join(F.broadcast(roles), "user_role", "left")
        .where(~F.coalesce("can_access_phi", F.lit(False)))
    )


# Hexadecimal digits per lane of a digest; four lanes are added up per day.
LANE_DIGITS, LANES = 16, 4


def row_hashes(audit: DataFrame, columns: list[str]) -> DataFrame:
    """SHA-256 of each audit row over its named columns as JSON, NULLs included."""
    text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
    return audit.select("audit_id", F.to_date("event_timestamp").alias("event_date"), F.sha2(text, 256).alias("row_hash"))


def day_digests(hashes: DataFrame) -> DataFrame:
    """One digest per day that any added, lost or changed row alters.

    The row hashes are added lane by lane, which needs no order and combines on the map side; the digest is the hash of
    the count and the sums.
    """

    def lane(i: int) -> Column:
        digits = F.substring("row_hash", 1 + i * LANE_DIGITS, LANE_DIGITS)
        return F.sum(F.conv(digits, 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"lane_{i}")

    sums = hashes.groupBy("event_date").agg(F.count("*").alias("rows"), *[lane(i) for i in range(LANES)])
    text = F.concat_ws("-", F.col("rows").cast("string"), *[F.col(f"lane_{i}").cast("string") for i in range(LANES)])
    return sums.select("event_date", "rows", F.sha2(text, 256).alias("day_digest"))


def tampered_days(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Days whose stored digest differs from the current one, or that only one side has."""
    s = stored.select("event_date", F.col("day_digest").alias("stored_digest"))
    c = current.select("event_date", F.col("day_digest").alias("current_digest"))
    return s.join(c, "event_date", "full_outer").where(~F.col("stored_digest").eqNullSafe(F.col("current_digest")))


def anomalies(audit: DataFrame, phi_reads: int, failures: int) -> DataFrame:
    """Users with many patient events or many failures within one clock hour."""
    hour = F.floor(C.epoch_micros(F.col("event_timestamp")) / C.MICROS_PER_HOUR)
    counts = audit.groupBy("user_id", hour.alias("hour")).agg(
        F.count_if(F.col("patient_id").isNotNull()).alias("phi_reads"), F.count_if(~F.col("success")).alias("failures")
    )
    rules = F.array_compact(
        F.array(
            F.when(F.col("phi_reads") >= phi_reads, F.struct(F.lit("HIGH_PHI_READS").alias("rule"), F.col("phi_reads").alias("events"))),
            F.when(F.col("failures") >= failures, F.struct(F.lit("REPEATED_FAILURES").alias("rule"), F.col("failures").alias("events"))),
        )
    )
    return counts.select(
        "user_id", C.micros_to_timestamp(F.col("hour") * C.MICROS_PER_HOUR).alias("hour_start"), F.explode(rules).alias("r")
    ).select("user_id", "hour_start", "r.rule", "r.events")


def incident_bundle(audit: DataFrame, run_log: DataFrame, exports: DataFrame, start: dt.datetime, end: dt.datetime, user: str | None = None) -> dict[str, DataFrame]:
    """Audit slice, run log and export manifest of a time span, optionally of one user."""

    def during(df: DataFrame, moment: str) -> DataFrame:
        return df.where((F.col(moment) >= C.moment(start)) & (F.col(moment) < C.moment(end)))

    slice_ = during(on_days(audit, start.date(), end.date()), "event_timestamp")
    if user is not None:
        slice_ = slice_.where(F.col("user_id") == user)
    return {"audit": slice_, "run_log": during(run_log, "start_time"), "exports": during(exports, "export_timestamp")}


def unexplained_rows(changes: DataFrame, base: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Rows whose current state is not what the base and the recorded changes lead to.

    ``changes`` has record_id, operation_type, new_values and event_timestamp; the last change of a record decides.
    """
    columns = [c for c in current.columns if c != key]
    last = changes.groupBy("record_id").agg(
        F.max_by(F.struct("operation_type", "new_values"), F.struct("event_timestamp", "audit_id")).alias("last")
    )
    text = lambda df: df.select(F.col(key).cast("string").alias("record_id"), F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"}).alias("state"))
    logged = last.select(
        "record_id",
        F.col("last.operation_type").alias("operation_type"),
        F.to_json(
            F.struct(*[F.element_at("last.new_values", F.lit(c)).alias(c) for c in columns]), {"ignoreNullFields": "false"}
        ).alias("logged_state"),
    )
    expected = (
        text(base)
        .join(logged, "record_id", "full_outer")
        .where(~F.col("operation_type").eqNullSafe(F.lit("DELETE")))
        .select("record_id", F.when(F.col("operation_type").isNotNull(), F.col("logged_state")).otherwise(F.col("state")).alias("expected_state"))
    )
    return (
        expected.join(text(current), "record_id", "full_outer")
        .where(~F.col("expected_state").eqNullSafe(F.col("state")))
        .select("record_id", "expected_state", F.col("state").alias("current_state"))
    )
