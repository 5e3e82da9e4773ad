"""Registered validation, run-log, export and audit queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.plans import audit, exports, runlog, validate
from wardlake.registry.oracle_base import CTES, div, quoted, rnd, rows_sql
from wardlake.registry.warehouse_queries import AS_OF, plain, source, star
from wardlake.session import fresh_path
from wardlake.sources import fixture
from wardlake.sources.catalogs import EXPORT_RETENTION_DAYS, SEVERITIES
from wardlake.sources.tables import store_tables

AUDIT_AS_OF = fixture.AUDIT_AS_OF
# Seven years after the middle of the event feed, so that half of it has passed its retention.
LATER = dt.date(2031, 1, 15)
SPAN = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12))
# Alert thresholds low enough to be met by the feed.
PHI_READS, FAILURES = 2, 2


def logs(spark, sf_dir):
    return fixture.event_tables(spark, sf_dir)


# Validation -----------------------------------------------------------------------------------------------------------

ISSUE_COLUMNS = "table_name, column_name, issue_type, severity_level, weight, issue_description, affected_rows"


def issue_sql(table, column, issue, severity, weight, description, count_sql: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{issue}' AS issue_type, "
        f"'{severity}' AS severity_level, '{weight}' AS weight, '{description}' AS issue_description, "
        f"CAST(({count_sql}) AS BIGINT) AS affected_rows"
    )


def bad_rows(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


NULL_SQL = [
    issue_sql(t, c, "NULL_VIOLATION", "HIGH", "CRITICAL", "NULL values found", bad_rows(t, f"{c} IS NULL"))
    for t, c in validate.CRITICAL_COLUMNS
]
DUPLICATE_SQL = [
    issue_sql(t, k, "DUPLICATES", "HIGH", "CRITICAL", "duplicate values found",
              f"SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1) d")
    for t, k in validate.UNIQUE_KEYS
]
BIRTH_SQL = issue_sql("dim_patient", "date_of_birth", "INVALID_DATE_RANGE", "HIGH", "ERROR",
                      "Found patients with future birth dates", bad_rows("dim_patient", f"date_of_birth > DATE '{AS_OF}'"))
GENDER_SQL = issue_sql("dim_patient", "gender", "INVALID_VALUES", "MEDIUM", "WARNING",
                       "Found invalid gender values (not M/F/O/U)", bad_rows("dim_patient", "gender NOT IN ('M', 'F', 'O', 'U')"))
STAY_SQL = issue_sql("fact_encounters", "discharge_datetime", "INVALID_DATE_LOGIC", "HIGH", "ERROR",
                     "Found discharge dates before encounter dates", bad_rows("resolved", "discharge_datetime < encounter_datetime"))
ICD_SQL = issue_sql("dim_diagnosis", "icd10_code", "INVALID_FORMAT", "MEDIUM", "WARNING", "Found invalid ICD-10 code format",
                    bad_rows("dim_diagnosis", f"NOT regexp_matches(icd10_code, '{validate.ICD10_PATTERN}')"))
CPT_SQL = issue_sql("dim_procedure", "cpt_code", "INVALID_FORMAT", "MEDIUM", "WARNING",
                    "Found invalid CPT code format (should be 5 digits)",
                    bad_rows("dim_procedure", f"NOT regexp_matches(cpt_code, '{validate.CPT_PATTERN}')"))
PREBIRTH_SQL = issue_sql("fact_encounters", "encounter_datetime", "INVALID_DATE_LOGIC", "CRITICAL", "CRITICAL",
                         "Found encounters before patient birth date",
                         "SELECT count(*) FROM resolved JOIN dim_patient USING (patient_key) WHERE CAST(encounter_datetime AS DATE) < date_of_birth")
ORPHAN_SQL = {
    "patient": issue_sql("fact_encounters", "patient_key", "ORPHANED_REFERENCE", "CRITICAL", "CRITICAL",
                         "Found encounters with invalid patient references",
                         bad_rows("resolved", "patient_key NOT IN (SELECT patient_key FROM dim_patient)")),
    "provider": issue_sql("fact_encounters", "provider_key", "ORPHANED_REFERENCE", "CRITICAL", "CRITICAL",
                          "Found encounters with invalid provider references",
                          bad_rows("resolved", "provider_key NOT IN (SELECT provider_key FROM dim_provider)")),
    "specialty": issue_sql("dim_provider", "specialty_key", "ORPHANED_REFERENCE", "HIGH", "ERROR",
                           "Found providers with invalid specialty references",
                           bad_rows("dim_provider", "specialty_key NOT IN (SELECT specialty_key FROM dim_specialty)")),
}
MEASURE_SQL = " UNION ALL ".join(
    issue_sql("fact_encounters", c, i, s, w, d, bad_rows("fact_encounters", cond))
    for c, i, s, w, d, cond in [
        ("total_claim_amount", "NEGATIVE_AMOUNT", "HIGH", "ERROR", "Found negative claim totals", "total_claim_amount < 0"),
        ("total_allowed_amount", "NEGATIVE_AMOUNT", "HIGH", "ERROR", "Found negative allowed totals", "total_allowed_amount < 0"),
        ("length_of_stay_hours", "INVALID_VALUES", "HIGH", "ERROR", "Found negative stay hours", "length_of_stay_hours < 0"),
        ("diagnosis_count", "MISSING_DIAGNOSIS", "MEDIUM", "WARNING", "Found encounters without a diagnosis", "diagnosis_count = 0"),
    ]
)
NAMED_SQL = " UNION ALL ".join(
    issue_sql(t, c, i, "LOW", "WARNING", d, bad_rows(t, cond))
    for t, c, i, d, cond in [
        ("patients", "first_name", "LENGTH_CHECK", "Found values longer than 100", "length(first_name) > 100"),
        ("patients", "last_name", "LENGTH_CHECK", "Found values longer than 100", "length(last_name) > 100"),
        ("patients", "date_of_birth", "DATE_RANGE", "Found values outside 1900-01-01..2001-08-01", "date_of_birth NOT BETWEEN DATE '1900-01-01' AND DATE '2001-08-01'"),
        ("patients", "mrn", "UNIQUE_FORMAT", "Found values not like ^MRN[0-9]{6,}$", "NOT regexp_full_match(mrn, 'MRN[0-9]{6,}')"),
        ("providers", "first_name", "LENGTH_CHECK", "Found values longer than 100", "length(first_name) > 100"),
        ("providers", "last_name", "LENGTH_CHECK", "Found values longer than 100", "length(last_name) > 100"),
        ("providers", "credential", "CREDENTIAL_FORMAT", "Found values not like ^(MD|DO|NP|PA)$", "credential NOT IN ('MD', 'DO', 'NP', 'PA')"),
        ("specialties", "specialty_code", "CODE_FORMAT", "Found values not like ^[A-Z]{2,10}$", "NOT regexp_full_match(specialty_code, '[A-Z]{2,10}')"),
        ("departments", "floor", "FLOOR_RANGE", "Found values outside 0..50", "floor NOT BETWEEN 0 AND 50"),
        ("departments", "capacity", "CAPACITY_RANGE", "Found values outside 1..30", "capacity NOT BETWEEN 1 AND 30"),
        ("encounters", "encounter_date", "DATE_RANGE", "Found values outside 1900-01-01..2001-08-02", "encounter_date NOT BETWEEN DATE '1900-01-01' AND DATE '2001-08-02'"),
        ("encounters", "encounter_type", "ENCOUNTER_TYPE_VALUES", "Found missing or unknown types", "coalesce(encounter_type, '') NOT IN ('Outpatient', 'Inpatient', 'ER', 'Emergency', 'Consultation')"),
        ("encounters", "discharge_date", "DISCHARGE_LOGIC", "Found discharges before the encounter", "discharge_date < encounter_date"),
        ("diagnoses", "icd10_description", "LENGTH_CHECK", "Found values longer than 200", "length(icd10_description) > 200"),
        ("procedures", "cpt_description", "LENGTH_CHECK", "Found values longer than 200", "length(cpt_description) > 200"),
    ]
)

SPARK_TYPE = "CASE {t} WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE {t} END"


def _type_rows(side: int) -> str:
    parts = []
    for table in dict.fromkeys(m[side] for m in validate.COLUMN_MAPPINGS):
        columns = list(dict.fromkeys(m[side + 1] for m in validate.COLUMN_MAPPINGS if m[side] == table))
        name = "resolved" if table == "fact_encounters" else table
        types = ", ".join(f"typeof({c})" for c in columns)
        listed = ", ".join(f"'{c}'" for c in columns)
        parts.append(
            f"SELECT '{table}' AS t, unnest([{listed}]) AS c, unnest([{types}]) AS ty FROM (SELECT * FROM {name} LIMIT 1) x"
        )
    return " UNION ALL ".join(parts)


CTES["source_types"] = _type_rows(0)
CTES["target_types"] = _type_rows(2)
CTES["mapping_rows"] = rows_sql(
    ["source_table", "source_column", "target_table", "target_column", "source_expected", "target_expected"],
    validate.COLUMN_MAPPINGS,
)
SCHEMA_SQL = f"""
SELECT m.*, {SPARK_TYPE.format(t='s.ty')} AS source_actual, {SPARK_TYPE.format(t='g.ty')} AS target_actual,
       CASE WHEN {SPARK_TYPE.format(t='s.ty')} = source_expected THEN 'PASS' ELSE 'TYPE_MISMATCH' END AS source_status,
       CASE WHEN {SPARK_TYPE.format(t='g.ty')} = target_expected THEN 'PASS' ELSE 'TYPE_MISMATCH' END AS target_status
FROM mapping_rows m JOIN source_types s ON s.t = source_table AND s.c = source_column
     JOIN target_types g ON g.t = target_table AND g.c = target_column"""

ALL_ISSUES = " UNION ALL ".join(
    NULL_SQL + DUPLICATE_SQL + [BIRTH_SQL, GENDER_SQL, STAY_SQL, ICD_SQL, CPT_SQL, PREBIRTH_SQL, *ORPHAN_SQL.values()]
)
CTES["found_issues"] = f"SELECT * FROM ({ALL_ISSUES}) i WHERE affected_rows > 0"
VERDICT = """
SELECT count(*) FILTER (weight = 'CRITICAL') AS critical_issues, count(*) FILTER (weight = 'ERROR') AS validation_errors,
       count(*) FILTER (weight = 'WARNING') AS validation_warnings FROM found_issues"""
VERDICT_SQL = f"""
SELECT *, CASE WHEN critical_issues > 0 THEN 'FAILED' WHEN validation_errors > 0 THEN 'WARNING' ELSE 'COMPLETED' END AS status,
       CASE WHEN critical_issues > 0 THEN 'CRITICAL' WHEN validation_errors > 0 THEN 'HIGH'
            WHEN validation_warnings > 0 THEN 'MEDIUM' ELSE 'LOW' END AS severity_level,
       'Schema validation completed - Critical: ' || critical_issues || ', Errors: ' || validation_errors || ', Warnings: '
           || validation_warnings AS issue_description
FROM ({VERDICT}) v"""
CTES["verdict_row"] = VERDICT_SQL
CTES["schema_checked"] = SCHEMA_SQL
REPORT_SQL = """
SELECT '{"validation_summary":' || (SELECT CAST(to_json(v) AS VARCHAR) FROM verdict_row v)
    || ',"data_quality_issues":' || (SELECT CAST(to_json(list({'table_name': table_name, 'column_name': column_name,
         'issue_type': issue_type, 'severity': severity_level, 'affected_rows': affected_rows,
         'description': issue_description, 'timestamp': '{AS_OF} 08:30:00'} ORDER BY table_name, column_name)) AS VARCHAR) FROM found_issues)
    || ',"schema_validation_results":' || (SELECT CAST(to_json(list({'source_table': source_table,
         'source_column': source_column, 'target_table': target_table, 'target_column': target_column,
         'status': target_status, 'expected': target_expected, 'actual': target_actual}
         ORDER BY source_table, source_column)) AS VARCHAR) FROM schema_checked)
    || ',"performance_metrics":' || (SELECT CAST(to_json(list({'table_name': table_name, 'operation': operation_type,
         'duration_ms': duration_ms, 'rows_affected': rows_affected}
         ORDER BY table_name, operation_type, duration_ms, rows_affected)) AS VARCHAR) FROM performance_metrics
         WHERE execution_id = (SELECT execution_id FROM etl_execution_log WHERE procedure_name = 'validate_warehouse'
                               ORDER BY start_time DESC, execution_id LIMIT 1)) || '}' AS validation_report""".replace(
    "{AS_OF}", str(AS_OF)
)


def _present_tables(spark, sf_dir):
    """Rows of every required table, and whether the table is missing after one was taken away."""
    wh = star(spark, sf_dir)
    missing = validate.missing_tables(wh).select("table_name", F.lit(True).alias("is_missing"))
    from wardlake.plans.queries_source import table_sizes
    from wardlake.plans.warehouse import STAR_TABLES

    return table_sizes(wh, STAR_TABLES).join(missing, "table_name", "left").select(
        "table_name", "row_count", F.coalesce("is_missing", F.lit(False)).alias("is_missing")
    )


STAR_SIZES = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {'resolved' if t == 'fact_encounters' else t}) AS row_count, FALSE AS is_missing"
    for t in validate.STAR_TABLES
)


def _rules(make):
    def run(spark, sf_dir):
        return validate.rule_counts(star(spark, sf_dir), make())

    return run


def _one_rule(make, index):
    return _rules(lambda: [make()[index]])


def _integrity(column):
    def run(spark, sf_dir):
        return validate.integrity_issues(star(spark, sf_dir)).where(F.col("column_name") == column)

    return run


def _all_issues(spark, sf_dir):
    return validate.validate(source(spark, sf_dir), star(spark, sf_dir), AS_OF)


def _report(spark, sf_dir):
    src, wh = source(spark, sf_dir), star(spark, sf_dir)
    issues = validate.validate(src, wh, AS_OF).withColumn("created_at", C.moment(dt.datetime.combine(AS_OF, dt.time(8, 30))))
    latest = runlog.latest_run(logs(spark, sf_dir)["etl_execution_log"], "validate_warehouse")
    metrics = logs(spark, sf_dir)["performance_metrics"].join(latest.select("execution_id"), "execution_id", "left_semi")
    return validate.validation_report(issues, validate.schema_comparison(src, wh), validate.verdict(issues), metrics)


COUNT_PAIRS = [
    ("patients", "dim_patient"), ("specialties", "dim_specialty"), ("departments", "dim_department"),
    ("providers", "dim_provider"), ("diagnoses", "dim_diagnosis"), ("procedures", "dim_procedure"),
    ("encounters", "resolved"), ("encounter_diagnoses", "bridge_encounter_diagnoses"),
    ("encounter_procedures", "bridge_encounter_procedures"),
]
RECONCILE_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS source_table, (SELECT count(*) FROM {s}) AS source_rows, (SELECT count(*) FROM {t}) AS warehouse_rows, "
    f"(SELECT count(*) FROM {s}) - (SELECT count(*) FROM {t}) AS difference" for s, t in COUNT_PAIRS
)
REVENUE_SQL = """
SELECT specialty_name, CAST(a.claims AS DOUBLE) AS source_claims, CAST(b.claims AS DOUBLE) AS warehouse_claims,
       CAST(a.allowed AS DOUBLE) AS source_allowed, CAST(b.allowed AS DOUBLE) AS warehouse_allowed,
       CAST(a.claims - b.claims AS DOUBLE) AS claims_difference, CAST(a.allowed - b.allowed AS DOUBLE) AS allowed_difference
FROM (SELECT specialty_name, sum(claim_amount) AS claims, sum(allowed_amount) AS allowed
      FROM billing JOIN encounters USING (encounter_id) JOIN providers USING (provider_id)
           JOIN specialties USING (specialty_id) GROUP BY 1) a
FULL JOIN (SELECT specialty_name, sum(total_claim_amount) AS claims, sum(total_allowed_amount) AS allowed
      FROM fact_encounters JOIN dim_specialty USING (specialty_key) GROUP BY 1) b USING (specialty_name)"""
FRESH_SQL = f"""
SELECT side, latest, date_diff('day', CAST(latest AS DATE), DATE '{AS_OF}') AS days_behind
FROM (SELECT 'source' AS side, max(encounter_date) AS latest FROM encounters
      UNION ALL SELECT 'warehouse', max(encounter_datetime) FROM resolved) t"""

VALIDATION = {
    "l01_required_tables": (_present_tables, STAR_SIZES),
    "l02_column_types": (
        lambda spark, sf_dir: validate.schema_comparison(source(spark, sf_dir), star(spark, sf_dir)),
        "SELECT * FROM schema_checked",
    ),
    "l03_null_counts": (_rules(validate.null_rules), " UNION ALL ".join(NULL_SQL)),
    "l04_duplicate_keys": (
        lambda spark, sf_dir: validate.union_all(
            [validate.duplicate_issue(star(spark, sf_dir), t, k) for t, k in validate.UNIQUE_KEYS]
        ),
        " UNION ALL ".join(DUPLICATE_SQL),
    ),
    "l05_future_births": (_one_rule(lambda: validate.patient_rules(AS_OF), 0), BIRTH_SQL),
    "l06_encounters_before_birth": (_integrity("encounter_datetime"), PREBIRTH_SQL),
    "l07_discharge_before_encounter": (_rules(validate.stay_rules), STAY_SQL),
    "l08_gender_values": (_one_rule(lambda: validate.patient_rules(AS_OF), 1), GENDER_SQL),
    "l09_icd10_format": (_one_rule(validate.code_rules, 0), ICD_SQL),
    "l10_cpt_format": (_one_rule(validate.code_rules, 1), CPT_SQL),
    "l11_orphan_patients": (_integrity("patient_key"), ORPHAN_SQL["patient"]),
    "l12_orphan_providers": (_integrity("provider_key"), ORPHAN_SQL["provider"]),
    "l13_orphan_specialties": (_integrity("specialty_key"), ORPHAN_SQL["specialty"]),
    "l14_verdict": (lambda spark, sf_dir: validate.verdict(_all_issues(spark, sf_dir)), "SELECT * FROM verdict_row"),
    "l15_validation_report": (_report, REPORT_SQL),
    "l16_row_count_reconciliation": (
        lambda spark, sf_dir: validate.row_count_reconciliation(source(spark, sf_dir), star(spark, sf_dir)),
        RECONCILE_SQL,
    ),
    "l16_revenue_reconciliation": (
        lambda spark, sf_dir: validate.revenue_reconciliation(source(spark, sf_dir), star(spark, sf_dir)),
        REVENUE_SQL,
    ),
    "l16_freshness": (
        lambda spark, sf_dir: validate.freshness(source(spark, sf_dir), star(spark, sf_dir), AS_OF),
        FRESH_SQL,
    ),
    "l17_named_rules": (
        lambda spark, sf_dir: validate.rule_counts(
            source(spark, sf_dir), validate.named_rules(AS_OF, capacities=(1, 30))
        ),
        NAMED_SQL,
    ),
    "l18_measure_rules": (_rules(validate.measure_rules), MEASURE_SQL),
    "p03_validate": (_all_issues, f"SELECT {ISSUE_COLUMNS} FROM found_issues"),
}

# Run logs and exports -------------------------------------------------------------------------------------------------


def _step_events(spark, sf_dir):
    """Log rows written as start and end events, and merged again on reading."""
    log = logs(spark, sf_dir)["etl_execution_log"]
    shared = ["execution_id", "procedure_name", "step_name", "step_order"]
    no_rows = F.lit(None).cast("bigint")
    start = log.select(
        F.col("log_id").cast("string").alias("log_id"), *shared, F.lit("start").alias("event"),
        F.col("start_time").alias("event_time"), F.lit("RUNNING").alias("status"), no_rows.alias("rows_processed"),
        no_rows.alias("rows_inserted"), no_rows.alias("rows_updated"), no_rows.alias("rows_deleted"),
        F.lit(None).cast("string").alias("error_message"),
    )
    end = log.where(F.col("end_time").isNotNull()).select(
        F.col("log_id").cast("string").alias("log_id"), *shared, F.lit("end").alias("event"),
        F.col("end_time").alias("event_time"), "status", "rows_processed", "rows_inserted", "rows_updated",
        F.lit(0).cast("bigint").alias("rows_deleted"), "error_message",
    )
    path = fresh_path(spark, "steps")
    start.write.mode("append").parquet(path)
    end.write.mode("append").parquet(path)
    return runlog.read_run_log(spark, path)


def _csv_round_trip(table, columns, order):
    def run(spark, sf_dir):
        rows = exports.extract(logs(spark, sf_dir)[table], columns)
        path = fresh_path(spark, "csv")
        exports.write_csv(rows, path, order)
        back = exports.read_csv(spark, path, rows.schema)
        texts = [c for c in exports.BLANK_FILLED if c in columns]
        return back.na.fill("", texts)

    return run


def _json_round_trip(spark, sf_dir):
    path = fresh_path(spark, "json")
    schema = "section string, page int, entries string, execution_id string"
    exports.write_run_json(exports.run_documents(logs(spark, sf_dir)), path)
    return spark.read.schema(schema).json(path).drop(exports.FOLDER)


def _export_all(spark, sf_dir):
    history = exports.export_run_logs(logs(spark, sf_dir), fresh_path(spark, "exports"))
    return history.select(
        "execution_id", "export_type", "output_format", "export_status", "record_count",
        (F.col("file_size_bytes") > 0).alias("has_size"), (F.col("export_duration_ms") > 0).alias("has_duration"),
    )


def _summary_files(spark, sf_dir):
    folder = fresh_path(spark, "exports")
    exports.export_run_logs(logs(spark, sf_dir), folder, ("PERFORMANCE",))
    written = exports.read_csv(spark, f"{folder}/performance_csv", logs(spark, sf_dir)["performance_metrics"].schema)
    sizes = exports.export_sizes(spark, f"{folder}/performance_csv")
    return (
        written.groupBy("execution_id").agg(F.count("*").alias("record_count"))
        .join(sizes, "execution_id")
        .select("execution_id", "record_count", (F.col("file_size_bytes") > 0).alias("has_bytes"))
    )


def extract_sql(table, columns):
    filled = [
        f"coalesce({c}, 0) AS {c}" if c in exports.ZERO_FILLED else f"coalesce({c}, '') AS {c}" if c in exports.BLANK_FILLED else c
        for c in columns
    ]
    return f"SELECT {', '.join(filled)} FROM {table}"


INSTANT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def page_sql(section, page_entries=exports.PAGE_ENTRIES):
    table, order, _, fields, instants = exports.SECTIONS[section]
    moments = iter(instants)
    members = []
    for f in fields:
        c = f if isinstance(f, str) else next(moments)
        members.append(f"'{c}': {c if isinstance(f, str) else INSTANT.format(c=c)}")
    return f"""
SELECT execution_id, '{section}' AS section, CAST((p - 1) // {page_entries} AS INT) AS page,
       CAST(to_json(list({{{', '.join(members)}}} ORDER BY p)) AS VARCHAR) AS entries
FROM (SELECT *, row_number() OVER (PARTITION BY execution_id ORDER BY {', '.join(order)}) AS p FROM {table}) t
GROUP BY 1, 2, 3"""


RUN_SUMMARY = """
SELECT execution_id, count(*) AS total_steps, count(*) FILTER (status = 'COMPLETED') AS successful_steps,
       count(*) FILTER (status = 'FAILED') AS failed_steps, coalesce(CAST(sum(rows_processed) AS BIGINT), 0) AS total_rows_processed,
       CAST(coalesce(sum(CAST(duration_seconds AS DECIMAL(20,6))), 0) AS DOUBLE) AS total_duration_seconds
FROM etl_execution_log GROUP BY 1"""
CTES["run_summary"] = RUN_SUMMARY
DOCUMENT_SQL = " UNION ALL ".join(
    [
        """SELECT execution_id, 'etl_summary' AS section, 0 AS page, CAST(to_json({'total_steps': total_steps,
           'successful_steps': successful_steps, 'failed_steps': failed_steps, 'total_rows_processed': total_rows_processed,
           'total_duration_seconds': total_duration_seconds}) AS VARCHAR) AS entries FROM run_summary"""
    ]
    + [page_sql(s) for s in exports.SECTIONS]
)
HISTORY_SQL = " UNION ALL ".join(
    f"SELECT execution_id, '{kind}' AS export_type, '{form}' AS output_format, 'SUCCESS' AS export_status, {n} AS record_count, TRUE AS has_size, TRUE AS has_duration FROM {table} GROUP BY 1"
    for kind, form, table, n in [
        ("LOGS", "CSV", "etl_execution_log", "count(*)"),
        ("LOGS", "JSON", "etl_execution_log", "count(*)"),
        ("QUALITY_REPORT", "CSV", "data_quality_log", "count(*)"),
        ("PERFORMANCE", "CSV", "performance_metrics", "count(*)"),
        ("SUMMARY", "JSON", "etl_execution_log", "1"),
    ]
)


def over_logs(query, table, **kwargs):
    return lambda spark, sf_dir: query(logs(spark, sf_dir)[table], **kwargs)


RUN_LOGS = {
    "k20_rated_operations": (
        over_logs(runlog.rated_operations, "performance_metrics"),
        f"""SELECT *, row_number() OVER (PARTITION BY execution_id ORDER BY execution_time_ms, operation_type) AS performance_rank,
                   CASE WHEN execution_time_ms < 100 THEN 'Excellent' WHEN execution_time_ms < 500 THEN 'Good'
                        WHEN execution_time_ms < 1000 THEN 'Fair' ELSE 'Needs Optimization' END AS performance_rating
            FROM (SELECT execution_id, operation_type, {rnd(div('sum(duration_ms)', 'count(*)'), 2)} AS execution_time_ms
                  FROM performance_metrics GROUP BY 1, 2) t""",
    ),
    "k21_duration_statistics": (
        over_logs(runlog.duration_statistics, "performance_metrics"),
        f"""SELECT execution_id, count(*) AS total_queries_analyzed,
                   {rnd(div('sum(duration_ms)', 'count(duration_ms)'), 2)} AS avg_execution_time_ms,
                   min(duration_ms) AS min_execution_time_ms, max(duration_ms) AS max_execution_time_ms
            FROM performance_metrics GROUP BY 1""",
    ),
    "m01_step_events": (
        _step_events,
        """SELECT CAST(log_id AS VARCHAR) AS log_id, execution_id, procedure_name, step_name, step_order, start_time, end_time,
                  CASE WHEN end_time IS NULL THEN 'RUNNING' ELSE status END AS status,
                  CASE WHEN end_time IS NOT NULL THEN error_message END AS error_message,
                  CASE WHEN end_time IS NOT NULL THEN rows_processed END AS rows_processed,
                  CASE WHEN end_time IS NOT NULL THEN rows_inserted END AS rows_inserted,
                  CASE WHEN end_time IS NOT NULL THEN rows_updated END AS rows_updated,
                  CASE WHEN end_time IS NOT NULL THEN 0 END AS rows_deleted,
                  (epoch_us(end_time) - epoch_us(start_time)) / 1000000.0 AS duration_seconds
           FROM etl_execution_log""",
    ),
    "m02_quality_issue_rows": (
        lambda spark, sf_dir: _all_issues(spark, sf_dir).select(
            F.lit("run-1").alias("execution_id"), "table_name", "column_name", "issue_type", "severity_level",
            "affected_rows", "issue_description"),
        """SELECT 'run-1' AS execution_id, table_name, column_name, issue_type, severity_level, affected_rows, issue_description
           FROM found_issues""",
    ),
    "m03_run_summary": (over_logs(runlog.run_summary, "etl_execution_log"), "SELECT * FROM run_summary"),
    "m04_execution_log_csv": (
        _csv_round_trip("etl_execution_log", exports.LOG_EXTRACT, ["execution_id", "step_order", "log_id"]),
        extract_sql("etl_execution_log", exports.LOG_EXTRACT),
    ),
    "m04_quality_log_csv": (
        _csv_round_trip("data_quality_log", exports.ISSUE_EXTRACT, ["created_at", "quality_id"]),
        extract_sql("data_quality_log", exports.ISSUE_EXTRACT),
    ),
    "m04_metrics_csv": (
        _csv_round_trip("performance_metrics", exports.METRIC_EXTRACT, ["start_time", "metric_id"]),
        extract_sql("performance_metrics", exports.METRIC_EXTRACT),
    ),
    "m05_run_documents": (_json_round_trip, DOCUMENT_SQL),
    "m06_severity_rollup": (
        over_logs(runlog.severity_rollup, "data_quality_log"),
        f"""SELECT *, CASE WHEN critical_issues > 0 THEN 'CRITICAL ISSUES DETECTED' WHEN warnings > 0 THEN 'WARNINGS DETECTED'
                          ELSE 'ETL COMPLETED SUCCESSFULLY' END AS status_banner
           FROM (SELECT execution_id, count(*) FILTER (severity_level IN ({quoted(SEVERITIES[2:])})) AS critical_issues,
                        count(*) FILTER (severity_level = 'MEDIUM') AS warnings FROM data_quality_log GROUP BY 1) t""",
    ),
    "m07_export_run_logs": (_export_all, HISTORY_SQL),
    "m07_export_sizes": (
        _summary_files,
        "SELECT execution_id, count(*) AS record_count, TRUE AS has_bytes FROM performance_metrics GROUP BY 1",
    ),
    "m09_export_summary": (
        lambda spark, sf_dir: exports.export_summary(
            logs(spark, sf_dir)["export_history"], logs(spark, sf_dir)["etl_execution_log"]
        ),
        """SELECT h.*, r.procedure_name, r.start_time AS etl_start_time, r.end_time AS etl_end_time
           FROM export_history h LEFT JOIN (
             SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY execution_id ORDER BY step_order, start_time, log_id) AS p
                            FROM etl_execution_log) t WHERE p = 1) r USING (execution_id)""",
    ),
    "m10_export_retention": (
        lambda spark, sf_dir: exports.kept_history(
            logs(spark, sf_dir)["export_history"], dt.date(2024, 2, 14), EXPORT_RETENTION_DAYS
        ),
        "SELECT * FROM export_history WHERE export_timestamp >= DATE '2024-02-14' - 30",
    ),
    "f04_latest_run": (
        over_logs(runlog.latest_run, "etl_execution_log", procedure_name="validate_warehouse"),
        """SELECT execution_id, start_time FROM etl_execution_log WHERE procedure_name = 'validate_warehouse'
           ORDER BY start_time DESC, execution_id LIMIT 1""",
    ),
}

# Audit ----------------------------------------------------------------------------------------------------------------

CTES["phi_access"] = """
SELECT 'phi-' || audit_id AS phi_access_id, audit_id, patient_id, mrn AS patient_mrn, table_name AS element,
       'Clinical Care' AS access_purpose
FROM audit_log LEFT JOIN patients USING (patient_id) WHERE patient_id IS NOT NULL"""


def trail(spark, sf_dir):
    return logs(spark, sf_dir)["audit_log"]


def phi(spark, sf_dir):
    return audit.phi_access(trail(spark, sf_dir), source(spark, sf_dir)["patients"])


def _append_twice(spark, sf_dir):
    path, events = fresh_path(spark, "audit"), trail(spark, sf_dir)
    for part in (events.where("success"), events.where("NOT success")):
        audit.append_events(part, path)
    return (
        spark.read.parquet(path)
        .groupBy("event_date", "event_type_code")
        .agg(F.count("*").alias("events"), F.count("patient_id").alias("with_patient"), F.count("record_id").alias("with_record"))
    )


# A later state of each audited table: some rows changed, some gone, some new.
LATER_SQL = {
    "patients": """SELECT CASE WHEN patient_id % 11 = 3 THEN patient_id + 1000000 ELSE patient_id END AS patient_id,
                          CASE WHEN patient_id % 5 = 1 THEN coalesce(first_name, 'Known') ELSE first_name END AS first_name,
                          CASE WHEN patient_id % 7 = 2 THEN last_name || '-X' ELSE last_name END AS last_name,
                          date_of_birth, CASE WHEN patient_id % 13 = 4 THEN NULL ELSE gender END AS gender, mrn
                   FROM {patients}""",
    "providers": """SELECT provider_id, first_name, last_name, CASE WHEN provider_id % 3 = 0 THEN 'NP' ELSE credential END AS credential,
                           specialty_id, department_id FROM {providers}""",
    "encounters": """SELECT CASE WHEN encounter_id % 17 = 1 THEN encounter_id + 100000000 ELSE encounter_id END AS encounter_id,
                            patient_id, provider_id, coalesce(encounter_type, 'Outpatient') AS encounter_type, encounter_date,
                            coalesce(discharge_date, encounter_date + INTERVAL '5' HOUR) AS discharge_date, department_id
                     FROM {encounters}""",
    "diagnoses": """SELECT diagnosis_id, CASE WHEN icd10_code = 'z-bad' THEN 'R69' ELSE icd10_code END AS icd10_code,
                           icd10_description FROM {diagnoses}""",
    "procedures": """SELECT CASE WHEN cpt_code = 'X13' THEN procedure_id + 1000 ELSE procedure_id END AS procedure_id, cpt_code,
                            cpt_description FROM {procedures}""",
    "billing": """SELECT billing_id, claim_amount, CASE WHEN billing_id % 4 = 0 THEN claim_amount ELSE allowed_amount END AS allowed_amount
                  FROM {billing}""",
}
BILLING_SQL = "SELECT billing_id, claim_amount, allowed_amount FROM {billing}"
CTES["billing_rows"] = BILLING_SQL.format(billing="billing")


def snapshots(spark, sf_dir, table):
    src = source(spark, sf_dir)
    old = spark.sql(BILLING_SQL, billing=src["billing"]) if table == "billing" else src[table]
    return old, spark.sql(LATER_SQL[table], **{table: old})


def _captured(table, patient=None):
    def run(spark, sf_dir):
        old, new = snapshots(spark, sf_dir, table)
        found = audit.capture_changes_by_digest(old, new, [audit.AUDITED_TABLES[table][0]], patient)
        text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("~")))), ";")
        return found.select(
            "operation_type", "record_id", "patient_id", F.array_join("affected_columns", ",").alias("affected_columns"),
            text("old_values").alias("old_values"), text("new_values").alias("new_values"),
        )

    return run


TABLE_COLUMNS = {
    "patients": ["patient_id", "first_name", "last_name", "date_of_birth", "gender", "mrn"],
    "providers": ["provider_id", "first_name", "last_name", "credential", "specialty_id", "department_id"],
    "encounters": ["encounter_id", "patient_id", "provider_id", "encounter_type", "encounter_date", "discharge_date", "department_id"],
    "diagnoses": ["diagnosis_id", "icd10_code", "icd10_description"],
    "procedures": ["procedure_id", "cpt_code", "cpt_description"],
    "billing": ["billing_id", "claim_amount", "allowed_amount"],
}


def _captured_sql(table, patient=None):
    key, *rest = TABLE_COLUMNS[table]
    base = "billing_rows" if table == "billing" else table
    later = LATER_SQL[table].format(**{table: base})
    text = lambda s: " || ';' || ".join(f"'{c}=' || coalesce(CAST({s}.{c} AS VARCHAR), '~')" for c in TABLE_COLUMNS[table])
    changed = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in rest)
    patient_sql = f"coalesce(n.{patient}, o.{patient})" if patient else "CAST(NULL AS BIGINT)"
    return f"""
SELECT * FROM (
  SELECT CASE WHEN o.{key} IS NULL THEN 'INSERT' WHEN n.{key} IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation_type,
         CAST(coalesce(n.{key}, o.{key}) AS VARCHAR) AS record_id, {patient_sql} AS patient_id,
         CASE WHEN o.{key} IS NOT NULL AND n.{key} IS NOT NULL THEN concat_ws(',', {changed}) END AS affected_columns,
         CASE WHEN o.{key} IS NOT NULL THEN {text('o')} END AS old_values,
         CASE WHEN n.{key} IS NOT NULL THEN {text('n')} END AS new_values
  FROM {base} o FULL JOIN ({later}) n ON o.{key} = n.{key}) c
WHERE operation_type <> 'UPDATE' OR affected_columns <> ''"""


def _report_rows(spark, sf_dir):
    report = audit.hipaa_access_report(phi(spark, sf_dir), trail(spark, sf_dir), dt.date(2024, 1, 1), AUDIT_AS_OF)
    return report.withColumn("phi_elements", F.array_join("phi_elements", ","))


REPORT_ACCESS_SQL = """
SELECT patient_id, patient_mrn, count(*) AS access_count, count(DISTINCT user_id) AS unique_users,
       string_agg(DISTINCT element, ',' ORDER BY element) AS phi_elements, min(event_timestamp) AS first_access,
       max(event_timestamp) AS last_access, string_agg(DISTINCT event_type_code, ', ' ORDER BY event_type_code) AS access_types,
       ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'][max(list_position(['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'], severity_level))]
           AS highest_risk_access
FROM phi_access p JOIN audit_log a USING (audit_id) JOIN event_types USING (event_type_code)
WHERE CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1, 2""".replace(
    "SELECT patient_id", "SELECT p.patient_id"
)

CTES["gap_rows"] = """
SELECT prev_timestamp, event_timestamp, epoch_us(event_timestamp) - epoch_us(prev_timestamp) AS gap_micros
FROM (SELECT event_timestamp, lag(event_timestamp) OVER (ORDER BY event_timestamp) AS prev_timestamp
      FROM audit_log WHERE event_timestamp >= DATE '2024-01-24') t
WHERE event_timestamp - prev_timestamp > INTERVAL 1 HOUR"""
CTES["kept_audit"] = "SELECT * FROM audit_log WHERE event_timestamp >= DATE '2024-01-15'"
CTES["expired_audit"] = """
SELECT a.*, retention_days FROM audit_log a JOIN event_types USING (event_type_code)
WHERE event_timestamp < DATE '2031-01-15' - CAST(retention_days AS INT)"""


def _kept(spark, sf_dir):
    return trail(spark, sf_dir).where(F.col("event_timestamp") >= F.lit(dt.date(2024, 1, 15)))


def _archived(spark, sf_dir):
    path, archive = fresh_path(spark, "audit"), fresh_path(spark, "archive")
    audit.append_events(trail(spark, sf_dir), path)
    audit.archive_records(spark, path, archive, LATER, dt.datetime(2031, 1, 15))
    side = lambda p, name: spark.read.parquet(p).groupBy("event_date", "event_type_code").agg(
        F.count("*").alias("events"), F.max("compliance_notes").alias("note")
    ).select(F.lit(name).alias("side"), "event_date", "event_type_code", "events", "note")
    return side(path, "log").unionByName(side(archive, "archive"))


HASHED = ["audit_id", "event_timestamp", "event_type_code", "user_id", "user_role", "table_name", "operation_type", "patient_id", "success", "response_time_ms"]
CTES["row_hashes"] = f"""
SELECT audit_id, CAST(event_timestamp AS DATE) AS event_date,
       sha256(CAST(to_json({{{', '.join(f"'{c}': CAST({c} AS VARCHAR)" for c in HASHED)}}}) AS VARCHAR)) AS row_hash
FROM audit_log"""
LANE_SQL = " || '-' || ".join(
    f"CAST(sum(CAST('0x' || substr(row_hash, {1 + i * 16}, 16) AS HUGEINT)) AS VARCHAR)" for i in range(4)
)


def _incident(spark, sf_dir):
    tables = logs(spark, sf_dir)
    parts = audit.incident_bundle(tables["audit_log"], tables["etl_execution_log"], tables["export_history"], *SPAN)
    keys = {"audit": ("audit_id", "event_timestamp"), "run_log": ("log_id", "start_time"), "exports": ("export_id", "export_timestamp")}
    shaped = [
        df.select(F.lit(name).alias("part"), F.col(keys[name][0]).cast("string").alias("record"), F.col(keys[name][1]).alias("at"))
        for name, df in parts.items()
    ]
    return validate.union_all(shaped)


def _incident_files(spark, sf_dir):
    """The bundle written as JSON and counted from the files."""
    tables = logs(spark, sf_dir)
    parts = audit.incident_bundle(tables["audit_log"], tables["etl_execution_log"], tables["export_history"], *SPAN)
    folder = fresh_path(spark, "incident")
    for name, df in parts.items():
        df.write.json(f"{folder}/{name}")
    return validate.union_all(
        [spark.read.text(f"{folder}/{n}").agg(F.count("*").alias("rows")).select(F.lit(n).alias("part"), "rows") for n in parts]
    )


def _unexplained(spark, sf_dir):
    """Patients whose later state the change events do not explain, when gender changes were not captured."""
    old, new = snapshots(spark, sf_dir, "patients")
    seen = new.join(old.select("patient_id", F.col("gender").alias("_g"), F.lit(True).alias("_had")), "patient_id", "left")
    seen = seen.withColumn("gender", F.when(F.col("_had"), F.col("_g")).otherwise(F.col("gender"))).drop("_g", "_had")
    changes = audit.capture_changes(old, seen, ["patient_id"], "patient_id")
    events = audit.change_events(changes, "patients", dt.datetime(2024, 1, 1), "loader", "run-1")
    return audit.unexplained_rows(events, old, new, "patient_id").select("record_id")


def _change_events(spark, sf_dir):
    old, new = snapshots(spark, sf_dir, "diagnoses")
    patients = snapshots(spark, sf_dir, "patients")
    parts = [
        audit.change_events(audit.capture_changes(o, n, [k], p), t, dt.datetime(2024, 1, 1), "loader", "run-1")
        for t, o, n, k, p in [("diagnoses", old, new, "diagnosis_id", None), ("patients", *patients, "patient_id", "patient_id")]
    ]
    return audit.classified(validate.union_all(parts)).groupBy("table_name", "event_type_code", "severity_level").agg(
        F.count("*").alias("events")
    )


AUDIT = {
    "n01_append_events": (
        _append_twice,
        """SELECT CAST(event_timestamp AS DATE) AS event_date, event_type_code, count(*) AS events,
                  count(patient_id) AS with_patient, 0 AS with_record FROM audit_log GROUP BY 1, 2""",
    ),
    "n02_changed_patients": (_captured("patients", "patient_id"), _captured_sql("patients", "patient_id")),
    "n02_changed_providers": (_captured("providers"), _captured_sql("providers")),
    "n02_changed_encounters": (_captured("encounters", "patient_id"), _captured_sql("encounters", "patient_id")),
    "n02_changed_diagnoses": (_captured("diagnoses"), _captured_sql("diagnoses")),
    "n02_changed_procedures": (_captured("procedures"), _captured_sql("procedures")),
    "n02_changed_billing": (_captured("billing"), _captured_sql("billing")),
    "n02_change_events": (
        _change_events,
        f"""SELECT table_name, code AS event_type_code, severity_level, count(*) AS events FROM (
              SELECT 'patients' AS table_name, CASE operation_type WHEN 'INSERT' THEN 'PATIENT_CREATE' WHEN 'DELETE' THEN 'PATIENT_DELETE'
                     ELSE 'PATIENT_UPDATE' END AS code FROM ({_captured_sql('patients')}) a
              UNION ALL SELECT 'diagnoses', CASE operation_type WHEN 'INSERT' THEN 'DIAGNOSIS_CREATE' WHEN 'DELETE' THEN 'DIAGNOSIS_DELETE'
                     ELSE 'DIAGNOSIS_UPDATE' END FROM ({_captured_sql('diagnoses')}) b) c
            JOIN event_types ON event_type_code = code GROUP BY 1, 2, 3""",
    ),
    "n03_phi_access": (
        lambda spark, sf_dir: phi(spark, sf_dir).select(
            "phi_access_id", "audit_id", "patient_id", "patient_mrn",
            F.array_join("accessed_phi_elements", ",").alias("element"), "access_purpose"),
        "SELECT * FROM phi_access",
    ),
    "n04_hipaa_access_report": (_report_rows, REPORT_ACCESS_SQL),
    "n05_audit_gaps": (
        lambda spark, sf_dir: audit.audit_gaps(trail(spark, sf_dir), AUDIT_AS_OF - dt.timedelta(days=7)),
        "SELECT * FROM gap_rows",
    ),
    "n05_login_gaps": (
        lambda spark, sf_dir: audit.audit_gaps(
            trail(spark, sf_dir).where("event_type_code = 'USER_LOGIN'"), AUDIT_AS_OF - dt.timedelta(days=7)
        ),
        """SELECT prev_timestamp, event_timestamp, epoch_us(event_timestamp) - epoch_us(prev_timestamp) AS gap_micros
           FROM (SELECT event_timestamp, lag(event_timestamp) OVER (ORDER BY event_timestamp) AS prev_timestamp
                 FROM audit_log WHERE event_timestamp >= DATE '2024-01-24' AND event_type_code = 'USER_LOGIN') t
           WHERE event_timestamp - prev_timestamp > INTERVAL 1 HOUR""",
    ),
    "n06_orphaned_phi": (
        lambda spark, sf_dir: audit.orphaned_phi(phi(spark, sf_dir), _kept(spark, sf_dir)).select("phi_access_id", "audit_id"),
        "SELECT phi_access_id, audit_id FROM phi_access ANTI JOIN kept_audit USING (audit_id)",
    ),
    "n07_past_retention": (
        lambda spark, sf_dir: audit.past_retention(trail(spark, sf_dir), LATER),
        "SELECT * FROM expired_audit",
    ),
    "n08_archive": (
        _archived,
        """SELECT CASE WHEN event_timestamp < DATE '2024-01-15' THEN 'archive' ELSE 'log' END AS side,
                  CAST(event_timestamp AS DATE) AS event_date, event_type_code, count(*) AS events, CAST(NULL AS VARCHAR) AS note
           FROM audit_log GROUP BY 1, 2, 3
           UNION ALL SELECT 'log', DATE '2031-01-15', 'SYSTEM_ARCHIVE', 1,
             'Archived ' || count(*) || ' audit records older than 2024-01-15' FROM audit_log WHERE event_timestamp < DATE '2024-01-15'""",
    ),
    "n09_classified_events": (
        lambda spark, sf_dir: audit.classified(trail(spark, sf_dir)).groupBy("severity_level", "hipaa_category").agg(
            F.count("*").alias("events"), F.countDistinct("user_id").alias("users")),
        """SELECT severity_level, hipaa_category, count(*) AS events, count(DISTINCT user_id) AS users
           FROM audit_log JOIN event_types USING (event_type_code) GROUP BY 1, 2""",
    ),
    "n10_unauthorized_phi_reads": (
        lambda spark, sf_dir: audit.unauthorized_phi_reads(trail(spark, sf_dir)).select(
            "audit_id", "event_timestamp", "user_id", "user_role", "access_level", "patient_id"),
        """SELECT audit_id, event_timestamp, user_id, user_role, access_level, patient_id
           FROM audit_log JOIN roles ON role_name = user_role WHERE patient_id IS NOT NULL AND NOT can_access_phi""",
    ),
    "n11_row_hashes": (
        lambda spark, sf_dir: audit.row_hashes(trail(spark, sf_dir), HASHED), "SELECT * FROM row_hashes"),
    "n11_day_digests": (
        lambda spark, sf_dir: audit.day_digests(audit.row_hashes(trail(spark, sf_dir), HASHED)),
        f"""SELECT event_date, count(*) AS rows, sha256(count(*) || '-' || {LANE_SQL}) AS day_digest
            FROM row_hashes GROUP BY 1""",
    ),
    "n11_tampered_days": (
        lambda spark, sf_dir: audit.tampered_days(
            audit.day_digests(audit.row_hashes(trail(spark, sf_dir), HASHED)),
            audit.day_digests(audit.row_hashes(trail(spark, sf_dir).where("NOT (user_role = 'ANALYST' AND to_date(event_timestamp) = DATE '2024-01-09')"), HASHED)),
        ).select("event_date"),
        """SELECT DISTINCT CAST(event_timestamp AS DATE) AS event_date FROM audit_log
           WHERE user_role = 'ANALYST' AND CAST(event_timestamp AS DATE) = DATE '2024-01-09'""",
    ),
    "n12_anomalies": (
        lambda spark, sf_dir: audit.anomalies(trail(spark, sf_dir), PHI_READS, FAILURES),
        f"""SELECT * FROM (
              SELECT user_id, date_trunc('hour', event_timestamp) AS hour_start, 'HIGH_PHI_READS' AS rule, count(patient_id) AS events
              FROM audit_log GROUP BY 1, 2 HAVING count(patient_id) >= {PHI_READS}
              UNION ALL SELECT user_id, date_trunc('hour', event_timestamp), 'REPEATED_FAILURES', count(*) FILTER (NOT success)
              FROM audit_log GROUP BY 1, 2 HAVING count(*) FILTER (NOT success) >= {FAILURES}) t""",
    ),
    "n13_incident_bundle": (
        _incident,
        """SELECT 'audit' AS part, audit_id AS record, event_timestamp AS at FROM audit_log
           WHERE event_timestamp >= DATE '2024-01-10' AND event_timestamp < DATE '2024-01-12'
           UNION ALL SELECT 'run_log', CAST(log_id AS VARCHAR), start_time FROM etl_execution_log
           WHERE start_time >= DATE '2024-01-10' AND start_time < DATE '2024-01-12'
           UNION ALL SELECT 'exports', CAST(export_id AS VARCHAR), export_timestamp FROM export_history
           WHERE export_timestamp >= DATE '2024-01-10' AND export_timestamp < DATE '2024-01-12'""",
    ),
    "n13_incident_files": (
        _incident_files,
        """SELECT unnest(['audit', 'run_log', 'exports']) AS part, count(*) AS rows FROM events
           WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-12' GROUP BY 1""",
    ),
    "n14_unexplained_rows": (
        _unexplained,
        "SELECT CAST(patient_id AS VARCHAR) AS record_id FROM patients WHERE patient_id % 13 = 4 AND patient_id % 11 <> 3",
    ),
    "p06_verify_integrity": (
        lambda spark, sf_dir: audit.verify_integrity(_kept(spark, sf_dir), phi(spark, sf_dir), AUDIT_AS_OF),
        """SELECT 'Audit Log Continuity' AS check_name, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
                  CASE WHEN n = 0 THEN 'No gaps in audit log timestamps' ELSE 'Found ' || n || ' potential gaps in audit log' END AS message,
                  n AS record_count FROM (SELECT count(*) AS n FROM gap_rows) g
           UNION ALL SELECT 'PHI Access Integrity', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
                  CASE WHEN n = 0 THEN 'All PHI access records linked to audit log' ELSE 'Found ' || n || ' orphaned PHI access records' END, n
             FROM (SELECT count(*) AS n FROM phi_access ANTI JOIN kept_audit USING (audit_id)) o
           UNION ALL SELECT 'Retention Compliance', 'PASS', 'No audit records exceed retention period', 0""",
    ),
}

QUERIES = {**VALIDATION, **RUN_LOGS, **AUDIT}
