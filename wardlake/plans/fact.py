"""The encounter fact, its two bridges, readmission measures and the wide analytics view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.intervals import returns_within
from wardlake.operators.skew import sequence_within

# Fixed value: days after a discharge in which a new encounter is a readmission.
READMISSION_DAYS = 30

MONEY = "decimal(12,2)"


def billing_totals(billing: DataFrame) -> DataFrame:
    return billing.groupBy("encounter_id").agg(
        F.sum("claim_amount").alias("total_claim_amount"), F.sum("allowed_amount").alias("total_allowed_amount")
    )


def resolved_encounters(encounters: DataFrame, patients: DataFrame, providers: DataFrame, types: DataFrame):
    """Encounters whose patient, provider and type are known, with the keys attached."""
    admitted, discharged = F.col("encounter_date"), F.col("discharge_date")
    return (
        encounters.join(providers.select("provider_id", "provider_key", "specialty_key", "department_key"), "provider_id")
        .join(types.select("encounter_type", "encounter_type_key"), "encounter_type")
        .join(patients.select("patient_id", "patient_key"), "patient_id")
        .select(
            F.col("encounter_id").alias("encounter_key"),
            "encounter_id",
            "patient_key",
            "provider_key",
            C.date_key(admitted.cast("date")).alias("encounter_date_key"),
            C.date_key(discharged.cast("date")).alias("discharge_date_key"),
            "encounter_type_key",
            "specialty_key",
            "department_key",
            F.col("department_id").alias("encounter_department_key"),
            F.coalesce(C.stay_hours(admitted, discharged), F.lit(0)).alias("length_of_stay_hours"),
            admitted.alias("encounter_datetime"),
            discharged.alias("discharge_datetime"),
            F.year(admitted.cast("date")).alias("encounter_year"),
        )
    )


def diagnosis_measures(links: DataFrame, dim: DataFrame) -> DataFrame:
    """Diagnoses per encounter, and the key of the first one, in one aggregate."""
    first = F.when(F.col("diagnosis_sequence") == 1, F.col("diagnosis_key"))
    return (
        links.join(dim.select("diagnosis_id", "diagnosis_key"), "diagnosis_id", "left")
        .groupBy("encounter_id")
        .agg(F.count("*").alias("diagnosis_count"), F.min(first).alias("primary_diagnosis_key"))
    )


def with_measures(
    base: DataFrame, billing: DataFrame, diagnoses: DataFrame, procedures: DataFrame, dim_diagnosis: DataFrame
) -> DataFrame:
    """Attach money totals, child counts and the primary diagnosis, each summed per encounter before the join."""
    dx = diagnosis_measures(diagnoses, dim_diagnosis)
    px = procedures.groupBy("encounter_id").agg(F.count("*").alias("procedure_count"))
    joined = (
        base.join(billing_totals(billing), "encounter_id", "left")
        .join(dx, "encounter_id", "left")
        .join(px, "encounter_id", "left")
    )
    money = {c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(22,2)") for c in ("total_claim_amount", "total_allowed_amount")}
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("diagnosis_count", "procedure_count")}
    return joined.withColumns({**money, **counts})


def readmission_measures(fact: DataFrame, hot: list, horizon_days: int = READMISSION_DAYS) -> DataFrame:
    """Readmission columns of every discharged encounter of the fact."""
    visits = fact.select(
        F.col("patient_key").alias("patient"),
        F.col("encounter_id").alias("visit"),
        C.epoch_micros(F.col("encounter_datetime")).alias("start_at"),
        C.epoch_micros(F.col("discharge_datetime")).alias("end_at"),
        F.lit(True).alias("is_index"),
        F.lit(True).alias("is_return"),
    )
    measured = returns_within(visits, horizon_days * C.MICROS_PER_DAY, hot)
    return measured.select(
        F.col("visit").alias("encounter_id"),
        (F.col("returns") > 0).alias("has_30day_readmission"),
        F.floor((F.col("first_return") - F.col("end_at")) / C.MICROS_PER_DAY).cast("int").alias("days_to_readmission"),
        F.col("is_return_visit").alias("is_readmission"),
        F.col("returns").cast("int").alias("readmission_count_30days"),
    )


def with_readmissions(fact: DataFrame, measures: DataFrame) -> DataFrame:
    """Update the fact with readmission columns; encounters without a discharge keep the defaults."""
    defaults = {
        "has_30day_readmission": F.lit(False),
        "is_readmission": F.lit(False),
        "readmission_count_30days": F.lit(0),
    }
    joined = fact.join(measures, "encounter_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def primary_diagnosis(bridge: DataFrame) -> DataFrame:
    """Diagnosis with sequence 1 per encounter."""
    return (
        bridge.where(F.col("diagnosis_sequence") == 1)
        .groupBy("encounter_key")
        .agg(F.min("diagnosis_key").alias("primary_diagnosis_key"))
    )


def with_primary_diagnosis(fact: DataFrame, bridge: DataFrame) -> DataFrame:
    return fact.join(primary_diagnosis(bridge), "encounter_key", "left")


def bridge_diagnoses(links: DataFrame, fact: DataFrame, dim: DataFrame) -> DataFrame:
    return (
        links.join(fact.select("encounter_id", "encounter_key"), "encounter_id")
        .join(dim.select("diagnosis_id", "diagnosis_key"), "diagnosis_id")
        .select(
            "encounter_key", "diagnosis_key", "diagnosis_sequence", F.lit(True).alias("diagnosis_present_on_admission")
        )
    )


def bridge_procedures(links: DataFrame, fact: DataFrame, dim: DataFrame, hot: list) -> DataFrame:
    """Procedures of loaded encounters, numbered by date and procedure.

    Lines alike in both are alike in the bridge, so their own ids need not be known to number them. Numbered by encounter
    id, by which the join has placed the rows already.
    """
    resolved = links.join(fact.select("encounter_id", "encounter_key"), "encounter_id").join(
        dim.select("procedure_id", "procedure_key"), "procedure_id"
    )
    numbered = sequence_within(
        resolved,
        "encounter_id",
        ["procedure_date", "procedure_id"],
        "procedure_sequence",
        F.unix_date("procedure_date").cast("bigint"),
        hot,
    )
    return numbered.select(
        "encounter_key",
        "procedure_key",
        C.date_key(F.col("procedure_date")).alias("procedure_date_key"),
        "procedure_sequence",
        F.lit("Completed").alias("procedure_status"),
    )


def encounter_analytics(wh) -> DataFrame:
    """Fact rows with the names of their dimensions and the reimbursement rate."""
    fact = wh["fact_encounters"]
    rate = C.percent(F.col("total_allowed_amount"), F.col("total_claim_amount"), 6)
    return (
        fact.join(wh["dim_date"].withColumnRenamed("date_key", "encounter_date_key"), "encounter_date_key")
        .join(wh["dim_specialty"].select("specialty_key", "specialty_name"), "specialty_key")
        .join(wh["dim_department"].select("department_key", "department_name"), "department_key")
        .join(wh["dim_encounter_type"].select("encounter_type_key", "encounter_type"), "encounter_type_key")
        .join(
            wh["dim_provider"].select(
                "provider_key", "provider_id", F.col("full_name").alias("provider_name"), "credential"
            ),
            "provider_key",
        )
        .join(
            wh["dim_patient"].select(
                "patient_key", "patient_id", F.col("full_name").alias("patient_name"), "age_group", "gender"
            ),
            "patient_key",
        )
        .select(
            "encounter_key",
            "encounter_id",
            F.col("calendar_date").alias("encounter_date"),
            F.col("year").alias("encounter_year"),
            F.col("month").alias("encounter_month"),
            F.col("quarter").alias("encounter_quarter"),
            "patient_id",
            "patient_name",
            "age_group",
            "gender",
            "provider_id",
            "provider_name",
            "credential",
            "specialty_name",
            "department_name",
            "encounter_type",
            "diagnosis_count",
            "procedure_count",
            "total_claim_amount",
            "total_allowed_amount",
            "length_of_stay_hours",
            rate.alias("reimbursement_rate_percent"),
        )
    )
