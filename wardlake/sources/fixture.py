"""Clinical, audit and log tables derived from the supplied order and event data.

Each text runs in Spark and in ANSI SQL engines alike; names in braces are the input tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators.skew import sequence_within
from wardlake.session import fresh_path
from wardlake.sources.tables import CLINICAL_SCHEMAS, TableSet

# Reference dates in place of the current date: the last order day and the day after the last event.
CLINICAL_AS_OF = dt.date(2001, 8, 1)
AUDIT_AS_OF = dt.date(2024, 1, 31)
# Calendar that covers all order, stay and ship dates.
CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))

# Number of a line among the lines of its order; lines that are equal in all columns may change places.
LINE_NUMBER = """CAST({l}l_orderkey * 1000 + row_number() OVER (PARTITION BY {l}l_orderkey ORDER BY {l}l_linenumber, {l}l_partkey,
       {l}l_suppkey, {l}l_extendedprice, {l}l_shipdate, {l}l_discount, {l}l_returnflag, {l}l_linestatus) AS BIGINT)"""

DERIVED_SQL = {
    "patients": """
SELECT c_custkey AS patient_id,
       CASE WHEN c_custkey % 40 = 7 THEN NULL ELSE c_mktsegment END AS first_name, c_name AS last_name,
       DATE '1920-01-01' + CAST((c_custkey * 37) % 27000 AS INT) AS date_of_birth,
       CASE c_custkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'M' WHEN 3 THEN 'F' ELSE 'O' END AS gender,
       'MRN' || lpad(CAST(c_custkey AS STRING), 6, '0') AS mrn
FROM {customer}""",
    "specialties": """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS specialty_id,
       CASE r_regionkey WHEN 0 THEN 'Cardiology' WHEN 1 THEN 'Internal Medicine' WHEN 2 THEN 'Orthopedic Surgery'
            WHEN 3 THEN 'Diagnostic Radiology' ELSE 'Neurology' END AS specialty_name,
       substr(r_name, 1, 4) AS specialty_code
FROM {region}""",
    "departments": """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS department_id,
       CASE n_nationkey % 5 WHEN 0 THEN 'Emergency' WHEN 1 THEN 'Internal Medicine' WHEN 2 THEN 'Outpatient Clinic'
            WHEN 3 THEN 'Neurology' ELSE 'Cardiology Unit' END || ' ' || n_name AS department_name,
       CAST(n_nationkey % 7 + 1 AS INT) AS floor, CAST(15 + n_nationkey AS INT) AS capacity
FROM {nation}""",
    "providers": """
SELECT s.s_suppkey + 101 AS provider_id, 'Dr' AS first_name, s.s_name AS last_name,
       CASE WHEN s.s_suppkey % 4 = 0 THEN 'DO' ELSE 'MD' END AS credential,
       CAST(n.n_regionkey + 1 AS BIGINT) AS specialty_id, CAST(s.s_nationkey + 1 AS BIGINT) AS department_id
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey""",
    "encounters": """
SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
       o_orderkey % (SELECT COUNT(*) FROM {supplier}) + 101 AS provider_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'ER' WHEN '2-HIGH' THEN 'Inpatient' WHEN '3-MEDIUM' THEN 'Outpatient'
            WHEN '5-LOW' THEN 'Emergency'
            ELSE CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'Consultation' END END AS encounter_type,
       o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS encounter_date,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE o_orderdate + (o_orderkey % 24 + 1 + o_orderkey % 47) * INTERVAL '1' HOUR
                 + (o_orderkey % 60) * INTERVAL '1' MINUTE END AS discharge_date,
       o_orderkey % 25 + 1 AS department_id
FROM {orders}""",
    "diagnoses": """
SELECT CAST(diagnosis_id AS BIGINT) AS diagnosis_id, icd10_code, icd10_description
FROM (SELECT DISTINCT
        CASE p_type WHEN 'ECONOMY' THEN 3002 WHEN 'LARGE' THEN 3003 WHEN 'MEDIUM' THEN 3004 WHEN 'PROMO' THEN 3005
                    WHEN 'SMALL' THEN 3006 ELSE 3007 END AS diagnosis_id,
        CASE p_type WHEN 'ECONOMY' THEN 'I10' WHEN 'LARGE' THEN 'E11.9' WHEN 'MEDIUM' THEN 'I50.9'
                    WHEN 'PROMO' THEN 'M79.9' WHEN 'SMALL' THEN 'G93.9' ELSE 'z-bad' END AS icd10_code,
        CASE p_type WHEN 'ECONOMY' THEN 'Hypertension' WHEN 'LARGE' THEN 'Type 2 Diabetes'
                    WHEN 'MEDIUM' THEN 'Heart Failure' WHEN 'PROMO' THEN 'Soft tissue disorder'
                    WHEN 'SMALL' THEN 'Disorder of brain' ELSE 'Unclassified' END AS icd10_description
      FROM {part}) t""",
    "diagnosis_lines": """
SELECT l.l_orderkey AS encounter_id,
       CAST(CASE p.p_type WHEN 'ECONOMY' THEN 3002 WHEN 'LARGE' THEN 3003 WHEN 'MEDIUM' THEN 3004
                          WHEN 'PROMO' THEN 3005 WHEN 'SMALL' THEN 3006 ELSE 3007 END AS BIGINT) AS diagnosis_id,
       l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_shipdate
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey""",
    "procedures": """
SELECT CAST(4001 + CAST(substr(p_brand, 7) AS INT) AS BIGINT) AS procedure_id,
       CASE WHEN substr(p_brand, 7) = '13' THEN 'X13'
            ELSE CAST(70000 + 10 * CAST(substr(p_brand, 7) AS INT) AS STRING) END AS cpt_code,
       CASE CAST(substr(p_brand, 7) AS INT) % 6 WHEN 0 THEN 'Office Visit' WHEN 1 THEN 'EKG' WHEN 2 THEN 'Chest X-ray'
            WHEN 3 THEN 'CT Head' WHEN 4 THEN 'Lab Test' ELSE 'Minor Surgery' END AS cpt_description
FROM (SELECT DISTINCT p_brand FROM {part}) t""",
    "encounter_procedures": f"""
SELECT {LINE_NUMBER.format(l='l.')} AS encounter_procedure_id, l.l_orderkey AS encounter_id, CAST(4001 + CAST(substr(p.p_brand, 7) AS INT) AS BIGINT) AS procedure_id,
       CAST(l.l_shipdate AS DATE) AS procedure_date
FROM {{lineitem}} l JOIN {{part}} p ON l.l_partkey = p.p_partkey WHERE l.l_returnflag <> 'N'""",
    "billing": f"""
SELECT {LINE_NUMBER.format(l='')} AS billing_id, l_orderkey AS encounter_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS claim_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(100 - CAST(round(l_discount * 100) AS INT) AS DECIMAL(5,0))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS allowed_amount,
       CAST(l_shipdate AS DATE) AS claim_date,
       CASE WHEN l_discount = 0 THEN 'Paid' WHEN l_linestatus = 'O' THEN 'Pending' ELSE 'Partial' END AS claim_status
FROM {{lineitem}} WHERE l_returnflag <> 'A'""",
}

# Run-log, export and audit tables over the event feed. The number in props is the step, row or patient it is about.
EVENT_NUMBER = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
DERIVED_SQL |= {
    "etl_execution_log": f"""
SELECT event_id AS log_id, 'run-' || lpad(CAST(user_id AS STRING), 8, '0') AS execution_id,
       CASE WHEN user_id % 2 = 0 THEN 'run_warehouse_load' ELSE 'validate_warehouse' END AS procedure_name,
       event_type AS step_name, {EVENT_NUMBER} + 1 AS step_order, ts AS start_time,
       CASE WHEN event_type = 'click' THEN NULL ELSE ts + CAST(floor(value) AS INT) * INTERVAL '1' SECOND END AS end_time,
       CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
       CAST({EVENT_NUMBER} * 10 AS BIGINT) AS rows_processed,
       CAST(CASE WHEN event_type = 'signup' THEN {EVENT_NUMBER} * 10 END AS BIGINT) AS rows_inserted,
       CAST(CASE WHEN event_type = 'purchase' THEN {EVENT_NUMBER} * 10 END AS BIGINT) AS rows_updated,
       CAST(NULL AS BIGINT) AS rows_deleted,
       CASE WHEN event_type = 'click' THEN NULL ELSE value END AS duration_seconds,
       CASE WHEN event_type = 'error' THEN 'step "' || props || '" failed' END AS error_message
FROM {{events}}""",
    "data_quality_log": f"""
SELECT event_id AS quality_id, 'run-' || lpad(CAST(user_id AS STRING), 8, '0') AS execution_id,
       CASE event_type WHEN 'view' THEN 'dim_patient' WHEN 'click' THEN 'dim_diagnosis' WHEN 'purchase' THEN 'fact_encounters'
            ELSE 'dim_provider' END AS table_name,
       CASE WHEN event_type = 'signup' THEN NULL ELSE event_type || '_column' END AS column_name,
       CASE event_type WHEN 'error' THEN 'ORPHANED_REFERENCE' WHEN 'purchase' THEN 'NULL_VIOLATION'
            WHEN 'view' THEN 'INVALID_FORMAT' ELSE 'INVALID_VALUES' END AS issue_type,
       CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'HIGH' WHEN 'view' THEN 'MEDIUM' ELSE 'LOW' END
           AS severity_level,
       CAST({EVENT_NUMBER} AS BIGINT) AS affected_rows, 'Found "' || event_type || '" rows' AS issue_description,
       CASE WHEN {EVENT_NUMBER} % 2 = 0 THEN props END AS sample_values, ts AS created_at
FROM {{events}}""",
    "performance_metrics": f"""
SELECT event_id AS metric_id, 'run-' || lpad(CAST(user_id AS STRING), 8, '0') AS execution_id,
       'fact_encounters' AS table_name, event_type AS operation_type, CAST(floor(value * 20) AS BIGINT) AS duration_ms,
       CAST({EVENT_NUMBER} AS BIGINT) AS rows_affected, ts AS start_time,
       ts + CAST(floor(value) AS INT) * INTERVAL '1' SECOND AS end_time
FROM {{events}}""",
    "export_history": f"""
SELECT event_id AS export_id, 'run-' || lpad(CAST(user_id AS STRING), 8, '0') AS execution_id,
       CASE WHEN {EVENT_NUMBER} % 2 = 0 THEN 'LOGS' ELSE 'SUMMARY' END AS export_type,
       CASE WHEN {EVENT_NUMBER} % 3 = 0 THEN 'CSV' ELSE 'JSON' END AS output_format,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS export_status,
       CAST({EVENT_NUMBER} * 100 AS BIGINT) AS file_size_bytes, CAST({EVENT_NUMBER} AS BIGINT) AS record_count,
       CAST(floor(value) AS BIGINT) AS export_duration_ms, ts AS export_timestamp
FROM {{events}}""",
    "audit_log": f"""
SELECT 'audit-' || lpad(CAST(event_id AS STRING), 12, '0') AS audit_id, ts AS event_timestamp,
       CASE event_type WHEN 'view' THEN 'PATIENT_ACCESS' WHEN 'purchase' THEN 'BILLING_UPDATE'
            WHEN 'click' THEN 'DIAGNOSIS_ACCESS' WHEN 'signup' THEN 'USER_LOGIN' ELSE 'FAILED_LOGIN' END AS event_type_code,
       'user-' || CAST(user_id AS STRING) AS user_id,
       CASE user_id % 7 WHEN 0 THEN 'PHYSICIAN' WHEN 1 THEN 'NURSE' WHEN 2 THEN 'BILLING_CLERK' WHEN 3 THEN 'IT_ADMIN'
            WHEN 4 THEN 'ANALYST' WHEN 5 THEN 'AUDITOR' ELSE 'ETL_SERVICE' END AS user_role,
       CASE event_type WHEN 'view' THEN 'patients' WHEN 'purchase' THEN 'billing' WHEN 'click' THEN 'encounter_diagnoses' END
           AS table_name,
       CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'purchase' THEN 'UPDATE' WHEN 'click' THEN 'SELECT' ELSE 'LOGIN' END
           AS operation_type,
       CAST(CASE WHEN event_type IN ('view', 'purchase', 'click') THEN {EVENT_NUMBER} END AS BIGINT) AS patient_id,
       event_type <> 'error' AS success, CAST(floor(value) AS INT) AS response_time_ms
FROM {{events}}""",
}

# Order of the lines of an encounter, which numbers its diagnoses.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

EVENT_TABLES = ["etl_execution_log", "data_quality_log", "performance_metrics", "export_history", "audit_log"]

INPUTS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def inputs(spark: SparkSession, sf_dir: str) -> TableSet:
    """The supplied Parquet tables."""
    return TableSet(
        spark, {name: (lambda n=name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet")) for name in INPUTS}
    )


def _derived(base: TableSet, name: str) -> DataFrame:
    text = DERIVED_SQL[name]
    used = {n: base[n] for n in INPUTS if "{" + n + "}" in text}
    return base.spark.sql(text, **used)


def event_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    """Run-log, export and audit tables over the supplied events."""
    base = inputs(spark, sf_dir)
    return TableSet(spark, {name: (lambda n=name: _derived(base, n)) for name in EVENT_TABLES})


def clinical_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    """The ten clinical source tables over the supplied data."""
    base = inputs(spark, sf_dir)

    def derived(name: str) -> DataFrame:
        return _derived(base, name)

    def encounter_diagnoses() -> DataFrame:
        return sequence_within(
            derived("diagnosis_lines"),
            "encounter_id",
            LINE_ORDER,
            "diagnosis_sequence",
            F.col("l_linenumber").cast("bigint"),
            base.hot_keys("lineitem", "l_orderkey"),
        ).select(
            (F.col("encounter_id") * 1000 + F.col("diagnosis_sequence")).alias("encounter_diagnosis_id"),
            "encounter_id",
            "diagnosis_id",
            "diagnosis_sequence",
        )

    makers = {name: (lambda n=name: derived(n)) for name in CLINICAL_SCHEMAS if name in DERIVED_SQL}
    makers["encounter_diagnoses"] = encounter_diagnoses
    # Both child tables hold at most the lines of an order.
    lines = (base, "lineitem", "l_orderkey")
    children = ("encounter_diagnoses", "encounter_procedures")
    return TableSet(spark, makers, {(child, "encounter_id"): lines for child in children})


def kept(src: TableSet, *names: str) -> TableSet:
    """Copy of the source in which some tables are stored as Parquet, for loads that read them in several steps."""
    stored = {}
    for name in names:
        path = fresh_path(src.spark, f"source-{name}")
        src[name].write.parquet(path)
        stored[name] = src.spark.read.schema(src[name].schema).parquet(path)
    return src.replacing(**stored)
