"""The eight dimensions of the star schema.

Keys are stable across loads and need no shared counter: the natural id where there is one, a 60-bit hash for the
encounter type.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.functions import columns as C

# Labels and the text fragments or prefixes that select them, in order of precedence.
# 'er' also matches "Internal" and 'ct' matches any word that holds it; the labels keep that behavior.
SPECIALTY_CATEGORIES = [("Surgical", ["surgery", "surgical"]), ("Diagnostic", ["diagnostic", "radiology"])]
SPECIALTY_DEFAULT = "Medical"
DEPARTMENT_TYPES = [("Emergency", ["emergency", "er"]), ("Outpatient", ["outpatient", "clinic"])]
DEPARTMENT_DEFAULT = "Inpatient"
DIAGNOSIS_CATEGORIES = {"I": "Cardiovascular", "E": "Endocrine", "M": "Musculoskeletal", "G": "Neurological"}
DIAGNOSIS_CATEGORY_DEFAULT = "General"
BODY_SYSTEMS = {
    "I": "Cardiovascular System",
    "E": "Endocrine System",
    "M": "Musculoskeletal System",
    "G": "Nervous System",
}
BODY_SYSTEM_DEFAULT = "Multiple Systems"
CHRONIC_CONDITIONS = ["diabetes", "hypertension", "heart failure"]
PROCEDURE_CATEGORIES = [("Diagnostic", ["x-ray", "ct", "ekg"]), ("Therapeutic", ["surgery", "procedure"])]
PROCEDURE_CATEGORY_DEFAULT = "Clinical"
PROCEDURE_TYPES = [("Imaging", ["imaging", "x-ray", "ct"]), ("Laboratory", ["lab", "test"])]
PROCEDURE_TYPE_DEFAULT = "Clinical Procedure"
COST_RANGES = [("$100-300", ["visit"]), ("$200-500", ["x-ray"]), ("$800-2000", ["ct"])]
COST_RANGE_DEFAULT = "$300-800"
DURATION_MINUTES = [(30, ["visit"]), (15, ["x-ray"]), (10, ["ekg"]), (45, ["ct"])]
DURATION_DEFAULT = 20
# Encounter types with their description, usual hours and admission flag.
EMERGENCY_TYPES = ["ER", "Emergency"]
TYPE_DESCRIPTIONS = [
    ("Hospital admission requiring overnight stay", ["Inpatient"]),
    ("Emergency department visit", EMERGENCY_TYPES),
    ("Clinic visit, same-day discharge", ["Outpatient"]),
]
TYPE_DESCRIPTION_DEFAULT = "General healthcare encounter"
TYPE_HOURS = [(48, ["Inpatient"]), (4, EMERGENCY_TYPES)]
TYPE_HOURS_DEFAULT = 2


def calendar_columns(day: Column) -> list[Column]:
    return [
        C.date_key(day).alias("date_key"),
        day.alias("calendar_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        F.weekofyear(day).alias("week_of_year"),
        C.day_name(day).alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        C.fiscal_year(day).alias("fiscal_year"),
        C.fiscal_quarter(day).alias("fiscal_quarter"),
    ]


def dim_date(spark: SparkSession, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """One row per day of a given range, however long; none without a range.

    The days are made in parallel. A stay that ends in 9999 gives three million rows.
    """
    if start is not None and end is not None and start > end:
        raise ValueError(f"calendar {start}..{end} ends before it begins")
    days = 0 if start is None or end is None else (end - start).days + 1
    made = spark.range(days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("day"))
    return made.select(*calendar_columns(F.col("day")))


def calendar_bounds(src) -> tuple[dt.date | None, dt.date | None]:
    """First and last day used by encounters and procedures (one row of four dates); None if there is no day."""
    stays = src["encounters"].agg(
        F.min(F.to_date("encounter_date")).alias("first"),
        F.max(F.to_date(F.greatest("encounter_date", "discharge_date"))).alias("last"),
    )
    done = src["encounter_procedures"].agg(F.min("procedure_date"), F.max("procedure_date")).toDF("first", "last")
    first, last = stays.unionByName(done).agg(F.min("first"), F.max("last")).first()
    return first, last


def dim_specialty(src) -> DataFrame:
    return src["specialties"].select(
        F.col("specialty_id").alias("specialty_key"),
        "specialty_id",
        "specialty_name",
        "specialty_code",
        C.label_by_fragment(F.col("specialty_name"), SPECIALTY_CATEGORIES, SPECIALTY_DEFAULT).alias(
            "specialty_category"
        ),
    )


def dim_department(src) -> DataFrame:
    return src["departments"].select(
        F.col("department_id").alias("department_key"),
        "department_id",
        "department_name",
        "floor",
        "capacity",
        C.label_by_fragment(F.col("department_name"), DEPARTMENT_TYPES, DEPARTMENT_DEFAULT).alias("department_type"),
        F.concat(F.lit("CC"), C.zero_padded(F.col("department_id"), 4)).alias("cost_center_code"),
    )


def dim_encounter_type(src) -> DataFrame:
    """One row per type. Two types with one hash key would merge in every join, so they stop the load."""
    kind = F.col("encounter_type")
    key = F.col("encounter_type_key")
    types = src["encounters"].where(kind.isNotNull()).select(kind).distinct().withColumn("encounter_type_key", C.hash_key(kind))
    alike = F.count("*").over(Window.partitionBy("encounter_type_key"))
    return (
        types.withColumn("_alike", alike)
        .select(
            F.when(F.col("_alike") == 1, key)
            .otherwise(F.raise_error(F.concat(F.lit("two encounter types share the key of "), kind)))
            .alias("encounter_type_key"),
            kind,
            C.label_by_value(kind, TYPE_DESCRIPTIONS, TYPE_DESCRIPTION_DEFAULT).alias("type_description"),
            C.label_by_value(kind, TYPE_HOURS, TYPE_HOURS_DEFAULT).alias("typical_duration_hours"),
            (kind == "Inpatient").alias("requires_admission"),
        )
    )


def dim_diagnosis(src) -> DataFrame:
    code, text = F.col("icd10_code"), F.col("icd10_description")
    return src["diagnoses"].select(
        F.col("diagnosis_id").alias("diagnosis_key"),
        "diagnosis_id",
        code,
        text,
        C.label_by_prefix(code, DIAGNOSIS_CATEGORIES, DIAGNOSIS_CATEGORY_DEFAULT).alias("diagnosis_category"),
        C.label_by_prefix(code, BODY_SYSTEMS, BODY_SYSTEM_DEFAULT).alias("body_system"),
        F.coalesce(C.contains_any(text, CHRONIC_CONDITIONS), F.lit(False)).alias("chronic_flag"),
    )


def dim_procedure(src) -> DataFrame:
    text = F.col("cpt_description")
    return src["procedures"].select(
        F.col("procedure_id").alias("procedure_key"),
        "procedure_id",
        "cpt_code",
        text,
        C.label_by_fragment(text, PROCEDURE_CATEGORIES, PROCEDURE_CATEGORY_DEFAULT).alias("procedure_category"),
        C.label_by_fragment(text, PROCEDURE_TYPES, PROCEDURE_TYPE_DEFAULT).alias("procedure_type"),
        C.label_by_fragment(text, COST_RANGES, COST_RANGE_DEFAULT).alias("typical_cost_range"),
        C.label_by_fragment(text, DURATION_MINUTES, DURATION_DEFAULT).alias("duration_minutes"),
    )


def dim_patient(src, as_of: dt.date) -> DataFrame:
    """Patients with name, age and band on the reference date."""
    age = C.age_years(F.col("date_of_birth"), F.lit(as_of))
    return src["patients"].select(
        F.col("patient_id").alias("patient_key"),
        "patient_id",
        "first_name",
        "last_name",
        C.joined_text(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        "gender",
        "date_of_birth",
        age.alias("current_age"),
        C.age_band(age).alias("age_group"),
        "mrn",
    )


def with_first_encounter_age(patients: DataFrame, encounters: DataFrame) -> DataFrame:
    """Add the age at the first encounter, NULL for a patient without one."""
    first = encounters.groupBy("patient_id").agg(F.min("encounter_date").alias("_first"))
    return (
        patients.join(first, "patient_id", "left")
        .withColumn("age_at_first_encounter", C.age_years(F.col("date_of_birth"), F.col("_first").cast("date")))
        .drop("_first")
    )


def dim_provider(src, specialties: DataFrame, departments: DataFrame) -> DataFrame:
    """Providers with both keys and names looked up; one without a known specialty and department is left out."""
    return (
        src["providers"]
        .join(specialties.select("specialty_id", "specialty_key", "specialty_name"), "specialty_id")
        .join(departments.select("department_id", "department_key", "department_name"), "department_id")
        .select(
            F.col("provider_id").alias("provider_key"),
            "provider_id",
            "first_name",
            "last_name",
            C.joined_text(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
            "credential",
            "specialty_key",
            "department_key",
            "specialty_name",
            "department_name",
        )
    )
