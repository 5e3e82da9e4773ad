"""Schema, quality and reconciliation checks of the warehouse.

Row rules of one table are counted together in a single pass. Every check yields issue rows of one shape, so that
verdicts and reports fold over them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.skew import union_all
from wardlake.plans.warehouse import STAR_TABLES
from wardlake.sources.catalogs import literal_rows

# Accepted genders and code patterns.
GENDERS = ["M", "F", "O", "U"]
ICD10_PATTERN = r"^[A-Z][0-9]{2}(\.[0-9A-Z]*)?$"
CPT_PATTERN = r"^[0-9]{5}$"

# Source column, warehouse column and the type on either side.
COLUMN_MAPPINGS = [
    ("patients", "patient_id", "dim_patient", "patient_id", "bigint", "bigint"),
    ("patients", "first_name", "dim_patient", "first_name", "string", "string"),
    ("patients", "last_name", "dim_patient", "last_name", "string", "string"),
    ("patients", "date_of_birth", "dim_patient", "date_of_birth", "date", "date"),
    ("patients", "gender", "dim_patient", "gender", "string", "string"),
    ("patients", "mrn", "dim_patient", "mrn", "string", "string"),
    ("providers", "provider_id", "dim_provider", "provider_id", "bigint", "bigint"),
    ("providers", "first_name", "dim_provider", "first_name", "string", "string"),
    ("providers", "last_name", "dim_provider", "last_name", "string", "string"),
    ("providers", "credential", "dim_provider", "credential", "string", "string"),
    ("specialties", "specialty_id", "dim_specialty", "specialty_id", "bigint", "bigint"),
    ("specialties", "specialty_name", "dim_specialty", "specialty_name", "string", "string"),
    ("specialties", "specialty_code", "dim_specialty", "specialty_code", "string", "string"),
    ("departments", "department_id", "dim_department", "department_id", "bigint", "bigint"),
    ("departments", "department_name", "dim_department", "department_name", "string", "string"),
    ("departments", "floor", "dim_department", "floor", "int", "int"),
    ("departments", "capacity", "dim_department", "capacity", "int", "int"),
    ("encounters", "encounter_id", "fact_encounters", "encounter_id", "bigint", "bigint"),
    ("encounters", "patient_id", "fact_encounters", "patient_key", "bigint", "bigint"),
    ("encounters", "provider_id", "fact_encounters", "provider_key", "bigint", "bigint"),
    ("encounters", "encounter_type", "fact_encounters", "encounter_type_key", "string", "bigint"),
    ("encounters", "encounter_date", "fact_encounters", "encounter_datetime", "timestamp_ntz", "timestamp_ntz"),
    ("encounters", "discharge_date", "fact_encounters", "discharge_datetime", "timestamp_ntz", "timestamp_ntz"),
    ("diagnoses", "diagnosis_id", "dim_diagnosis", "diagnosis_id", "bigint", "bigint"),
    ("diagnoses", "icd10_code", "dim_diagnosis", "icd10_code", "string", "string"),
    ("diagnoses", "icd10_description", "dim_diagnosis", "icd10_description", "string", "string"),
    ("procedures", "procedure_id", "dim_procedure", "procedure_id", "bigint", "bigint"),
    ("procedures", "cpt_code", "dim_procedure", "cpt_code", "string", "string"),
    ("procedures", "cpt_description", "dim_procedure", "cpt_description", "string", "string"),
]

# Columns that must not be NULL, and keys that must not repeat.
CRITICAL_COLUMNS = [
    ("dim_patient", "patient_id"),
    ("dim_provider", "provider_id"),
    ("dim_specialty", "specialty_id"),
    ("dim_department", "department_id"),
    ("fact_encounters", "encounter_id"),
    ("fact_encounters", "patient_key"),
    ("fact_encounters", "provider_key"),
]
UNIQUE_KEYS = [("dim_patient", "patient_id"), ("dim_provider", "provider_id"), ("fact_encounters", "encounter_id")]

CRITICAL, ERROR, WARNING = "CRITICAL", "ERROR", "WARNING"


@dataclass(frozen=True)
class Rule:
    """A condition that marks a row as bad; ``weight`` is how the verdict counts it."""

    table: str
    column: str
    issue: str
    severity: str
    weight: str
    description: str
    bad: Column


def _issue(table, column, issue, severity, weight, description, affected: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.lit(issue).alias("issue_type"),
        F.lit(severity).alias("severity_level"),
        F.lit(weight).alias("weight"),
        F.lit(description).alias("issue_description"),
        affected.cast("bigint").alias("affected_rows"),
    ]


def row_rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Bad rows of every rule of one table, from one pass over it: one row per rule."""
    counts = df.agg(*[F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(rules)])
    entries = F.array(
        *[
            F.struct(*_issue(r.table, r.column, r.issue, r.severity, r.weight, r.description, F.col(f"r{i}")))
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(entries))


def rule_counts(tables, rules: list[Rule]) -> DataFrame:
    """As ``row_rule_counts`` for rules of several tables."""
    names = list(dict.fromkeys(r.table for r in rules))
    return union_all([row_rule_counts(tables[n], [r for r in rules if r.table == n]) for n in names])


def count_issue(found: DataFrame, table, column, issue, severity, weight, description) -> DataFrame:
    """One issue row with the number of rows found."""
    return found.agg(F.count("*").alias("n")).select(
        *_issue(table, column, issue, severity, weight, description, F.col("n"))
    )


def null_rules() -> list[Rule]:
    return [
        Rule(t, c, "NULL_VIOLATION", "HIGH", CRITICAL, "NULL values found", F.col(c).isNull()) for t, c in CRITICAL_COLUMNS
    ]


def patient_rules(as_of: dt.date) -> list[Rule]:
    gender = F.col("gender")
    return [
        Rule("dim_patient", "date_of_birth", "INVALID_DATE_RANGE", "HIGH", ERROR, "Found patients with future birth dates", F.col("date_of_birth") > F.lit(as_of)),
        Rule("dim_patient", "gender", "INVALID_VALUES", "MEDIUM", WARNING, "Found invalid gender values (not M/F/O/U)", gender.isNotNull() & ~gender.isin(*GENDERS)),
    ]


def stay_rules() -> list[Rule]:
    early = F.col("discharge_datetime") < F.col("encounter_datetime")
    return [Rule("fact_encounters", "discharge_datetime", "INVALID_DATE_LOGIC", "HIGH", ERROR, "Found discharge dates before encounter dates", early)]


def code_rules() -> list[Rule]:
    icd, cpt = F.col("icd10_code"), F.col("cpt_code")
    return [
        Rule("dim_diagnosis", "icd10_code", "INVALID_FORMAT", "MEDIUM", WARNING, "Found invalid ICD-10 code format", icd.isNotNull() & ~icd.rlike(ICD10_PATTERN)),
        Rule("dim_procedure", "cpt_code", "INVALID_FORMAT", "MEDIUM", WARNING, "Found invalid CPT code format (should be 5 digits)", cpt.isNotNull() & ~cpt.rlike(CPT_PATTERN)),
    ]


def measure_rules() -> list[Rule]:
    """Checks of the loaded measures: amounts, stay hours, at least one diagnosis."""
    fact = "fact_encounters"
    return [
        Rule(fact, "total_claim_amount", "NEGATIVE_AMOUNT", "HIGH", ERROR, "Found negative claim totals", F.col("total_claim_amount") < 0),
        Rule(fact, "total_allowed_amount", "NEGATIVE_AMOUNT", "HIGH", ERROR, "Found negative allowed totals", F.col("total_allowed_amount") < 0),
        Rule(fact, "length_of_stay_hours", "INVALID_VALUES", "HIGH", ERROR, "Found negative stay hours", F.col("length_of_stay_hours") < 0),
        Rule(fact, "diagnosis_count", "MISSING_DIAGNOSIS", "MEDIUM", WARNING, "Found encounters without a diagnosis", F.col("diagnosis_count") < 1),
    ]


def named_rules(as_of: dt.date, earliest: dt.date = dt.date(1900, 1, 1), floors=(0, 50), capacities=(1, 40), name_length=100, text_length=200, types=("Outpatient", "Inpatient", "ER", "Emergency", "Consultation")) -> list[Rule]:
    """Format and range rules of the source tables; the bounds are arguments."""

    def too_long(table, column, limit):
        return Rule(table, column, "LENGTH_CHECK", "LOW", WARNING, f"Found values longer than {limit}", F.length(column) > limit)

    def outside(table, column, name, low, high):
        return Rule(table, column, name, "LOW", WARNING, f"Found values outside {low}..{high}", (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high)))

    def unlike(table, column, name, pattern):
        return Rule(table, column, name, "LOW", WARNING, f"Found values not like {pattern}", F.col(column).isNotNull() & ~F.col(column).rlike(pattern))

    return [
        too_long("patients", "first_name", name_length),
        too_long("patients", "last_name", name_length),
        outside("patients", "date_of_birth", "DATE_RANGE", earliest, as_of),
        unlike("patients", "mrn", "UNIQUE_FORMAT", "^MRN[0-9]{6,}$"),
        too_long("providers", "first_name", name_length),
        too_long("providers", "last_name", name_length),
        unlike("providers", "credential", "CREDENTIAL_FORMAT", "^(MD|DO|NP|PA)$"),
        unlike("specialties", "specialty_code", "CODE_FORMAT", "^[A-Z]{2,10}$"),
        outside("departments", "floor", "FLOOR_RANGE", *floors),
        outside("departments", "capacity", "CAPACITY_RANGE", *capacities),
        outside("encounters", "encounter_date", "DATE_RANGE", earliest, as_of + dt.timedelta(days=1)),
        Rule("encounters", "encounter_type", "ENCOUNTER_TYPE_VALUES", "LOW", WARNING, "Found missing or unknown types", ~F.coalesce(F.col("encounter_type").isin(*types), F.lit(False))),
        Rule("encounters", "discharge_date", "DISCHARGE_LOGIC", "LOW", WARNING, "Found discharges before the encounter", F.col("discharge_date") < F.col("encounter_date")),
        too_long("diagnoses", "icd10_description", text_length),
        too_long("procedures", "cpt_description", text_length),
    ]


def missing_tables(tables, required: list[str] = STAR_TABLES) -> DataFrame:
    """Required tables that are absent."""
    spark = tables.spark
    wanted = literal_rows(spark, ["table_name"], [(t,) for t in required])
    present = [t for t in required if _readable(tables, t)]
    if present:
        wanted = wanted.join(literal_rows(spark, ["table_name"], [(t,) for t in present]), "table_name", "left_anti")
    return wanted.select(*_issue(None, None, "TABLE_MISSING", "CRITICAL", CRITICAL, "Required table missing", F.lit(0)), F.col("table_name").alias("_name")).withColumn("table_name", F.col("_name")).drop("_name")


# Errors that mean that a table is not there; any other error is one, and goes on to the caller.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND")


def _readable(tables, name: str) -> bool:
    try:
        return name in tables and tables[name].schema is not None
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return False
        raise


def column_types(tables, names: list[str]) -> DataFrame:
    """Column names and types of the readable tables."""
    rows = [(t, f.name, f.dataType.simpleString()) for t in names if _readable(tables, t) for f in tables[t].schema]
    return literal_rows(tables.spark, ["table_name", "column_name", "data_type"], rows)


def schema_comparison(src, wh) -> DataFrame:
    """Every mapped column with its expected and actual type on both sides."""
    mapping = literal_rows(
        src.spark,
        ["source_table", "source_column", "target_table", "target_column", "source_expected", "target_expected"],
        COLUMN_MAPPINGS,
    )

    def side(tables, names, table, column, out):
        found = column_types(tables, names)
        return found.select(
            F.col("table_name").alias(table), F.col("column_name").alias(column), F.col("data_type").alias(out)
        )

    sources = list(dict.fromkeys(m[0] for m in COLUMN_MAPPINGS))
    targets = list(dict.fromkeys(m[2] for m in COLUMN_MAPPINGS))
    checked = mapping.join(side(src, sources, "source_table", "source_column", "source_actual"), ["source_table", "source_column"], "left").join(
        side(wh, targets, "target_table", "target_column", "target_actual"), ["target_table", "target_column"], "left"
    )

    def status(expected, actual):
        return F.when(F.col(actual).isNull(), "COLUMN_MISSING").when(F.col(actual) != F.col(expected), "TYPE_MISMATCH").otherwise("PASS")

    return checked.select(
        *mapping.columns,
        "source_actual",
        "target_actual",
        status("source_expected", "source_actual").alias("source_status"),
        status("target_expected", "target_actual").alias("target_status"),
    )


def schema_issues(comparison: DataFrame) -> DataFrame:
    """Issue rows of a schema comparison."""
    sides = []
    for side in ("source", "target"):
        bad = comparison.where(F.col(f"{side}_status") != "PASS")
        missing = F.col(f"{side}_status") == "COLUMN_MISSING"
        sides.append(
            bad.select(
                F.col(f"{side}_table").alias("table_name"),
                F.col(f"{side}_column").alias("column_name"),
                F.col(f"{side}_status").alias("issue_type"),
                F.when(missing, "CRITICAL").otherwise("HIGH").alias("severity_level"),
                F.lit(ERROR).alias("weight"),
                F.when(missing, "Required column missing")
                .otherwise(F.format_string("Expected %s but found %s", f"{side}_expected", f"{side}_actual"))
                .alias("issue_description"),
                F.lit(0).cast("bigint").alias("affected_rows"),
            )
        )
    return union_all(sides)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().where("count > 1")


def duplicate_issue(wh, table: str, key: str) -> DataFrame:
    found = duplicate_keys(wh[table], key)
    return count_issue(found, table, key, "DUPLICATES", "HIGH", CRITICAL, "duplicate values found")


def encounters_before_birth(wh) -> DataFrame:
    born = wh["dim_patient"].select("patient_key", "date_of_birth")
    return wh["fact_encounters"].join(born, "patient_key").where(F.to_date("encounter_datetime") < F.col("date_of_birth"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def orphan_issue(child: DataFrame, parent: DataFrame, table: str, key: str, severity, weight, description) -> DataFrame:
    """Orphans counted per key first, so that only distinct keys are joined."""
    keys = child.groupBy(key).agg(F.count("*").alias("_rows"))
    found = orphans(keys, parent, key).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))
    return found.select(*_issue(table, key, "ORPHANED_REFERENCE", severity, weight, description, F.col("n")))


def integrity_issues(wh) -> DataFrame:
    """Encounters before birth and unresolved keys."""
    fact, providers = wh["fact_encounters"], wh["dim_provider"]
    return union_all(
        [
            count_issue(encounters_before_birth(wh), "fact_encounters", "encounter_datetime", "INVALID_DATE_LOGIC", "CRITICAL", CRITICAL, "Found encounters before patient birth date"),
            orphan_issue(fact, wh["dim_patient"], "fact_encounters", "patient_key", "CRITICAL", CRITICAL, "Found encounters with invalid patient references"),
            orphan_issue(fact, providers, "fact_encounters", "provider_key", "CRITICAL", CRITICAL, "Found encounters with invalid provider references"),
            orphan_issue(providers, wh["dim_specialty"], "dim_provider", "specialty_key", "HIGH", ERROR, "Found providers with invalid specialty references"),
        ]
    )


def validate(src, wh, as_of: dt.date) -> DataFrame:
    """All issues found; a check without a bad row yields none."""
    rules = null_rules() + patient_rules(as_of) + stay_rules() + code_rules()
    present = [r for r in rules if _readable(wh, r.table) and r.column in wh[r.table].columns]
    parts = [rule_counts(wh, present)]
    parts += [duplicate_issue(wh, t, k) for t, k in UNIQUE_KEYS if _readable(wh, t)]
    if all(_readable(wh, t) for t in ("fact_encounters", "dim_patient", "dim_provider", "dim_specialty")):
        parts.append(integrity_issues(wh))
    counted = union_all(parts).where(F.col("affected_rows") > 0)
    return union_all([counted, schema_issues(schema_comparison(src, wh)), missing_tables(wh)])


def verdict(issues: DataFrame) -> DataFrame:
    """Outcome of a validation: numbers by weight, status, summary severity and text."""
    weights = {"critical_issues": CRITICAL, "validation_errors": ERROR, "validation_warnings": WARNING}
    counts = issues.agg(*[F.count_if(F.col("weight") == w).alias(c) for c, w in weights.items()])
    critical, errors, warnings = (F.col(c) for c in weights)
    return counts.select(
        *weights,
        F.when(critical > 0, "FAILED").when(errors > 0, "WARNING").otherwise("COMPLETED").alias("status"),
        F.when(critical > 0, "CRITICAL").when(errors > 0, "HIGH").when(warnings > 0, "MEDIUM").otherwise("LOW").alias("severity_level"),
        F.format_string("Schema validation completed - Critical: %d, Errors: %d, Warnings: %d", *weights).alias("issue_description"),
    )


def validation_report(issues: DataFrame, comparison: DataFrame, summary: DataFrame, metrics: DataFrame) -> DataFrame:
    """One JSON document of a run: summary, issues with their time, schema results, measured steps.

    The lists are bounded by the number of checks and of steps of a run.
    """

    keep_nulls = {"ignoreNullFields": "false"}

    def section(df: DataFrame, name: str, body: Column) -> DataFrame:
        return df.agg(body.alias("body")).select(F.lit(name).alias("section"), "body")

    def listed(df: DataFrame, name: str) -> DataFrame:
        entries = F.array_sort(F.collect_list(F.struct(*df.columns)))
        return section(df, name, F.to_json(entries, keep_nulls))

    quality = issues.select(
        "table_name",
        "column_name",
        "issue_type",
        F.col("severity_level").alias("severity"),
        "affected_rows",
        F.col("issue_description").alias("description"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
    measured = metrics.select("table_name", F.col("operation_type").alias("operation"), "duration_ms", "rows_affected")
    schema = comparison.select(
        "source_table",
        "source_column",
        "target_table",
        "target_column",
        F.col("target_status").alias("status"),
        F.col("target_expected").alias("expected"),
        F.col("target_actual").alias("actual"),
    )
    head = section(summary, "validation_summary", F.first(F.to_json(F.struct(*summary.columns), keep_nulls)))
    lists = {"data_quality_issues": quality, "schema_validation_results": schema, "performance_metrics": measured}
    parts = union_all([head] + [listed(df, name) for name, df in lists.items()])
    names = ["validation_summary", *lists]
    bodies = parts.agg(*[F.max(F.when(F.col("section") == n, F.col("body"))).alias(n) for n in names])
    members = [F.concat(F.lit(f'"{n}":'), F.col(n)) for n in names]
    return bodies.select(F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("validation_report"))


def row_count_reconciliation(src, wh) -> DataFrame:
    """Source and warehouse row counts of each pair of tables."""
    pairs = {
        "patients": "dim_patient",
        "specialties": "dim_specialty",
        "departments": "dim_department",
        "providers": "dim_provider",
        "diagnoses": "dim_diagnosis",
        "procedures": "dim_procedure",
        "encounters": "fact_encounters",
        "encounter_diagnoses": "bridge_encounter_diagnoses",
        "encounter_procedures": "bridge_encounter_procedures",
    }
    counts = lambda tables, names, out: union_all(
        [tables[n].agg(F.count("*").alias(out)).select(F.lit(s).alias("source_table"), out) for s, n in names]
    )
    left = counts(src, [(s, s) for s in pairs], "source_rows")
    right = counts(wh, list(pairs.items()), "warehouse_rows")
    return left.join(right, "source_table", "full_outer").withColumn(
        "difference", F.coalesce("source_rows", F.lit(0)) - F.coalesce("warehouse_rows", F.lit(0))
    )


def revenue_reconciliation(src, wh) -> DataFrame:
    """Claim and allowed totals by specialty, in the source and in the warehouse."""
    specialty = src["providers"].join(src["specialties"], "specialty_id").select("provider_id", "specialty_name")
    billed = (
        src["billing"]
        .join(src["encounters"].select("encounter_id", "provider_id"), "encounter_id")
        .join(specialty, "provider_id")
        .groupBy("specialty_name")
        .agg(F.sum("claim_amount").alias("source_claims"), F.sum("allowed_amount").alias("source_allowed"))
    )
    loaded = (
        wh["fact_encounters"]
        .join(wh["dim_specialty"].select("specialty_key", "specialty_name"), "specialty_key")
        .groupBy("specialty_name")
        .agg(F.sum("total_claim_amount").alias("warehouse_claims"), F.sum("total_allowed_amount").alias("warehouse_allowed"))
    )
    both = billed.join(loaded, "specialty_name", "full_outer")
    zero = F.lit(0).cast("decimal(12,2)")
    gap = lambda a, b: (F.coalesce(F.col(a), zero) - F.coalesce(F.col(b), zero)).cast("double")
    return both.select(
        "specialty_name",
        *[F.col(c).cast("double").alias(c) for c in ("source_claims", "warehouse_claims", "source_allowed", "warehouse_allowed")],
        gap("source_claims", "warehouse_claims").alias("claims_difference"),
        gap("source_allowed", "warehouse_allowed").alias("allowed_difference"),
    )


def freshness(src, wh, as_of: dt.date) -> DataFrame:
    """Latest encounter in source and warehouse, and the days the warehouse is behind the reference date."""
    latest = lambda df, c, name: df.agg(F.max(c).alias("latest")).select(F.lit(name).alias("side"), "latest")
    both = latest(src["encounters"], "encounter_date", "source").unionByName(
        latest(wh["fact_encounters"], "encounter_datetime", "warehouse")
    )
    return both.withColumn("days_behind", F.datediff(F.lit(as_of), F.to_date("latest")))
