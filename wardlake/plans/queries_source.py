"""Business questions answered on the normalized source tables.

Q1 monthly encounters, Q2 diagnosis-procedure pairs, Q3 returns within 30 days, Q4 revenue. Every top-k ends its sort
with the key columns, so ties are settled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.intervals import returns_within, total_returns
from wardlake.operators.pairs import paired_counts
from wardlake.operators.skew import union_all
from wardlake.plans.fact import READMISSION_DAYS

# Stays that start the 30-day clock and visits that count as a return.
INPATIENT = "Inpatient"
RETURN_TYPES = ["Inpatient", "ER"]

SOURCE_TABLES = [
    "patients",
    "encounters",
    "providers",
    "specialties",
    "departments",
    "diagnoses",
    "procedures",
    "encounter_diagnoses",
    "encounter_procedures",
    "billing",
]


def provider_specialties(src) -> DataFrame:
    return src["providers"].join(src["specialties"], "specialty_id").select(
        "provider_id", "specialty_id", "specialty_name"
    )


def _month(moment: str) -> Column:
    """First day of the month: four bytes to group by; labels are made after the aggregate."""
    return F.trunc(F.to_date(moment), "month")


def monthly_encounters(src, month=C.month_label) -> DataFrame:
    """Encounters and patients by month, specialty and type; ``month`` is a label or a month start."""
    return (
        src["encounters"]
        .join(provider_specialties(src), "provider_id")
        .groupBy(_month("encounter_date").alias("_month"), "specialty_name", "encounter_type")
        .agg(F.count("*").alias("total_encounters"), F.countDistinct("patient_id").alias("unique_patients"))
        .select(
            month(F.col("_month")).alias("month"), "specialty_name", "encounter_type", "total_encounters", "unique_patients"
        )
        .orderBy("month", "specialty_name", "encounter_type")
    )


def diagnosis_procedure_pairs(src, described: bool = False, limit: int = 10) -> DataFrame:
    """Most frequent diagnosis-procedure pairs; ``described`` adds texts and keeps only known encounters."""
    diagnosed = src["encounter_diagnoses"]
    if described:
        diagnosed = diagnosed.join(src["encounters"].select("encounter_id"), "encounter_id", "left_semi")
    hot = src.hot_keys("encounter_diagnoses", "encounter_id") + src.hot_keys("encounter_procedures", "encounter_id")
    pairs = (
        paired_counts(diagnosed, src["encounter_procedures"], "encounter_id", "diagnosis_id", "procedure_id", hot)
        .groupBy("diagnosis_id", "procedure_id")
        .agg(F.sum("pairs").alias("pairs"))
    )
    shown = ["icd10_code", "icd10_description", "cpt_code", "cpt_description"] if described else ["icd10_code", "cpt_code"]
    return (
        pairs.join(src["diagnoses"], "diagnosis_id")
        .join(src["procedures"], "procedure_id")
        .groupBy(*shown)
        .agg(F.sum("pairs").alias("encounter_count"))
        .orderBy(F.desc("encounter_count"), *shown)
        .limit(limit)
    )


def _stays(src, is_return: Column) -> DataFrame:
    """Inpatient stays and the visits that count as a return."""
    return (
        src["encounters"]
        .select(
            F.col("patient_id").alias("patient"),
            F.col("encounter_id").alias("visit"),
            "provider_id",
            C.epoch_micros(F.col("encounter_date")).alias("start_at"),
            C.epoch_micros(F.col("discharge_date")).alias("end_at"),
            F.coalesce(F.col("encounter_type") == INPATIENT, F.lit(False)).alias("is_index"),
            F.coalesce(is_return, F.lit(False)).alias("is_return"),
        )
        .where("is_index OR is_return")
    )


HORIZON = READMISSION_DAYS * C.MICROS_PER_DAY


def highest_return_rate(src, with_all_stays: bool = False) -> DataFrame:
    """The specialty with the most returns per inpatient stay.

    As in the plain question, only stays with a return are counted below the line, so the rate is never under 100.
    ``with_all_stays`` counts every discharged stay.
    """
    returned = F.col("returns") > 0
    stays = F.count("*") if with_all_stays else F.count_if(returned)
    hot = src.hot_keys("encounters", "patient_id")
    measured = returns_within(_stays(src, F.lit(True)), HORIZON, hot, exclude_self=False, carry=("provider_id",))
    return (
        measured.join(provider_specialties(src), "provider_id")
        .groupBy("specialty_name")
        .agg(F.sum("returns").alias("readmission_count"), stays.alias("total_discharges"))
        .where(F.col("readmission_count") > 0 if not with_all_stays else F.lit(True))
        .withColumn(
            "readmission_rate_percentage",
            C.rounded(C.ratio(F.col("readmission_count"), F.col("total_discharges")) * 100, 6),
        )
        .orderBy(F.desc("readmission_rate_percentage"), "specialty_name")
        .limit(1)
    )


def inpatient_return_rates(src) -> DataFrame:
    """Returns to Inpatient or ER per discharged inpatient stay, for each specialty."""
    stays = _stays(src, F.col("encounter_type").isin(*RETURN_TYPES))
    per_provider = total_returns(stays, HORIZON, src.hot_keys("encounters", "patient_id"), "provider_id")
    return (
        per_provider.join(provider_specialties(src), "provider_id")
        .groupBy("specialty_id", "specialty_name")
        .agg(F.sum("visits").alias("total_discharges"), F.sum("returns").alias("total_readmissions"))
        .select(
            "specialty_name",
            "total_discharges",
            "total_readmissions",
            C.rounded(C.ratio(F.col("total_readmissions"), F.col("total_discharges")) * 100, 2).alias(
                "readmission_rate_percent"
            ),
        )
        .orderBy(F.desc("readmission_rate_percent"), "specialty_name")
    )


def _billed_encounters(src) -> DataFrame:
    """Encounters with the sums of their bills.

    The bills are summed per encounter before the join, which leaves one row per encounter: distinct encounters become
    plain counts, and a month is grouped without a second shuffle of the bills.
    """
    bills = src["billing"].groupBy("encounter_id").agg(
        F.sum("claim_amount").alias("claims"),
        F.sum("allowed_amount").alias("allowed"),
        F.count("allowed_amount").alias("bills"),
    )
    encounters = src["encounters"].select("encounter_id", "provider_id", _month("encounter_date").alias("_month"))
    return encounters.join(bills, "encounter_id").join(provider_specialties(src), "provider_id")


def monthly_claims(src) -> DataFrame:
    """Claimed amount by month and specialty."""
    return (
        _billed_encounters(src)
        .groupBy("_month", "specialty_name")
        .agg(F.sum("claims").cast("double").alias("total_revenue"))
        .select(C.month_start(F.col("_month")).alias("month"), "specialty_name", "total_revenue")
        .orderBy("month", "specialty_name")
    )


def monthly_revenue(src) -> DataFrame:
    """Claimed and allowed amount, billed encounters and mean allowed amount per bill, by month and specialty."""
    return (
        _billed_encounters(src)
        .groupBy("_month", "specialty_id", "specialty_name")
        .agg(
            F.sum("claims").alias("claims"),
            F.sum("allowed").alias("allowed"),
            F.sum("bills").alias("bills"),
            F.count("*").alias("total_encounters"),
        )
        .select(
            C.month_label(F.col("_month")).alias("month"),
            "specialty_name",
            F.col("claims").cast("double").alias("total_claim_amount"),
            F.col("allowed").cast("double").alias("total_allowed_amount"),
            "total_encounters",
            C.rounded(C.mean(F.col("allowed"), F.col("bills")), 2).alias("avg_allowed_per_encounter"),
        )
        .orderBy("month", F.desc("total_allowed_amount"), "specialty_name")
    )


def table_sizes(tables, names=SOURCE_TABLES) -> DataFrame:
    """Row count of each table."""
    return union_all(
        [tables[name].agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name in names]
    )
