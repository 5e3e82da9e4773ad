"""Business questions answered on the star schema.

``as_of`` stands for the current date and every minimum or limit is an argument. A year filter is put on the date
dimension and on the partition column of the fact, so that a stored fact is pruned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.intervals import days_over_returns, returns_within
from wardlake.operators.pairs import paired_counts
from wardlake.plans.dims import EMERGENCY_TYPES
from wardlake.plans.fact import READMISSION_DAYS, encounter_analytics
from wardlake.plans.queries_source import INPATIENT, RETURN_TYPES

# Readmission rate above which a specialty is at high or moderate risk.
RISK_BANDS = [(15, "High Risk"), (10, "Moderate Risk")]
LOWEST_RISK = "Low Risk"


def _specialty(wh, *columns: str) -> DataFrame:
    return wh["dim_specialty"].select("specialty_key", *(columns or ("specialty_name",)))


def _types(wh) -> DataFrame:
    return wh["dim_encounter_type"].select("encounter_type_key", "encounter_type")


def _dated(wh, from_year: int | None = None) -> DataFrame:
    """Fact rows with the year and month of the encounter, from a given year on."""
    fact, days = wh["fact_encounters"], wh["dim_date"].select("date_key", "year", "month")
    if from_year is not None:
        fact, days = fact.where(F.col("encounter_year") >= from_year), days.where(F.col("year") >= from_year)
    return fact.join(days, F.col("encounter_date_key") == F.col("date_key"))


def _total(name: str):
    return F.sum(name).alias(f"sum_{name}")


def _mean(name: str, places: int | None, out: str):
    """Mean of a column over all grouped rows, from its sum and the row count ``n``."""
    value = C.mean(F.col(f"sum_{name}"), F.col("n"))
    return (value if places is None else C.rounded(value, places)).alias(out)


def _double(name: str, out: str):
    return F.col(f"sum_{name}").cast("double").alias(out)



def _rows_per(df: DataFrame, key: str) -> DataFrame:
    """Rows per key as ``n``: what a join with the dimension of that key then handles is one row per key."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def monthly_volume(wh, as_of: dt.date) -> DataFrame:
    """Q1 with the split by kind of encounter, this and the two previous years."""
    kind = F.col("encounter_type")
    return (
        _dated(wh, as_of.year - 2)
        .join(_specialty(wh, "specialty_name", "specialty_category"), "specialty_key")
        .join(_types(wh), "encounter_type_key")
        .groupBy("year", "month", "specialty_name", "specialty_category")
        .agg(
            F.count("*").alias("n"),
            F.count_if(kind == INPATIENT).alias("inpatient_encounters"),
            F.count_if(kind == "Outpatient").alias("outpatient_encounters"),
            F.count_if(kind.isin(*EMERGENCY_TYPES)).alias("emergency_encounters"),
            _total("total_allowed_amount"),
        )
        .select(
            "year",
            "month",
            C.month_name(F.col("month")).alias("month_name"),
            "specialty_name",
            "specialty_category",
            F.col("n").alias("total_encounters"),
            "inpatient_encounters",
            "outpatient_encounters",
            "emergency_encounters",
            _mean("total_allowed_amount", 2, "avg_revenue_per_encounter"),
        )
        .orderBy(F.desc("year"), F.desc("month"), F.desc("total_encounters"), "specialty_name")
    )


def monthly_volume_short(wh, as_of: dt.date, limit: int = 15) -> DataFrame:
    """Q1, short form: latest months first."""
    return (
        _dated(wh, as_of.year - 1)
        .join(_specialty(wh), "specialty_key")
        .join(_types(wh).select("encounter_type_key"), "encounter_type_key")
        .groupBy("year", "month", "specialty_name")
        .agg(F.count("*").alias("n"), _total("total_allowed_amount"))
        .select(
            "year",
            "month",
            C.month_name(F.col("month")).alias("month_name"),
            "specialty_name",
            F.col("n").alias("total_encounters"),
            _mean("total_allowed_amount", 2, "avg_revenue"),
        )
        .orderBy(F.desc("year"), F.desc("month"), F.desc("total_encounters"), "specialty_name")
        .limit(limit)
    )


def monthly_patients(wh) -> DataFrame:
    """Q1 over all months, with patients."""
    return (
        _dated(wh)
        .join(_specialty(wh), "specialty_key")
        .join(_types(wh), "encounter_type_key")
        .groupBy("year", "month", "specialty_name", "encounter_type")
        .agg(F.count("*").alias("total_encounters"), F.countDistinct("patient_key").alias("unique_patients"))
        .orderBy("year", "month", "specialty_name", "encounter_type")
    )


def _one_key_per_label(links: DataFrame, dim: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """Replace each key by the lowest key with the same labels, so that counting by key counts by label."""
    lowest = F.min(key).over(Window.partitionBy(*labels))
    return links.join(dim.select(key, lowest.alias("_lowest")), key).withColumn(key, F.col("_lowest")).drop("_lowest")


def _pairs(wh, dx_labels: list[str], px_labels: list[str], primary_only: bool) -> DataFrame:
    """Per encounter, diagnosis label and procedure label: the number of pairs."""
    diagnosed = wh["bridge_encounter_diagnoses"]
    if primary_only:
        diagnosed = diagnosed.where(F.col("diagnosis_sequence") == 1)
    diagnosed = _one_key_per_label(diagnosed, wh["dim_diagnosis"], "diagnosis_key", dx_labels)
    treated = _one_key_per_label(wh["bridge_encounter_procedures"], wh["dim_procedure"], "procedure_key", px_labels)
    hot = wh.hot_keys("bridge_encounter_diagnoses", "encounter_key") + wh.hot_keys(
        "bridge_encounter_procedures", "encounter_key"
    )
    return paired_counts(diagnosed, treated, "encounter_key", "diagnosis_key", "procedure_key", hot)


def _pair_totals(wh, dx_labels: list[str], px_labels: list[str]) -> DataFrame:
    """Primary-diagnosis pairs with money and stay totals weighted by the pairs, labelled."""
    fact = wh["fact_encounters"].select("encounter_key", "total_allowed_amount", "length_of_stay_hours")
    return (
        _pairs(wh, dx_labels, px_labels, primary_only=True)
        .join(fact, "encounter_key")
        .groupBy("diagnosis_key", "procedure_key")
        .agg(
            F.sum("pairs").alias("n"),
            F.count("*").alias("encounters_with_pair"),
            F.sum(F.col("total_allowed_amount") * F.col("pairs").cast("decimal(20,0)")).alias(
                "sum_total_allowed_amount"
            ),
            F.sum(F.col("length_of_stay_hours") * F.col("pairs")).alias("sum_length_of_stay_hours"),
        )
        .join(wh["dim_diagnosis"].select("diagnosis_key", *dx_labels), "diagnosis_key")
        .join(wh["dim_procedure"].select("procedure_key", *px_labels), "procedure_key")
    )


def primary_pairs(wh, min_pairs: int = 10, limit: int = 20) -> DataFrame:
    """Q2 for primary diagnoses with volume, revenue and stay."""
    labels = ["icd10_code", "icd10_description", "diagnosis_category"]
    codes = ["cpt_code", "cpt_description", "procedure_category"]
    return (
        _pair_totals(wh, labels, codes)
        .where(F.col("n") >= min_pairs)
        .select(
            "icd10_code",
            F.col("icd10_description").alias("diagnosis_description"),
            "diagnosis_category",
            "cpt_code",
            F.col("cpt_description").alias("procedure_description"),
            "procedure_category",
            F.col("n").alias("combination_count"),
            "encounters_with_pair",
            _mean("total_allowed_amount", 2, "avg_revenue_per_encounter"),
            _mean("length_of_stay_hours", 1, "avg_length_of_stay_hours"),
        )
        .orderBy(F.desc("combination_count"), F.desc("avg_revenue_per_encounter"), "icd10_code", "cpt_code")
        .limit(limit)
    )


# Labels of a pair, and the totals kept for it.
PAIR_LABELS = ["icd10_code", "icd10_description", "cpt_code", "cpt_description"]
PAIR_TOTALS = ["n", "encounters_with_pair", "sum_total_allowed_amount", "sum_length_of_stay_hours"]


def pair_totals(wh) -> DataFrame:
    """Totals of every pair of labels, which can be added and taken away encounter by encounter."""
    return _pair_totals(wh, PAIR_LABELS[:2], PAIR_LABELS[2:]).select(
        *PAIR_LABELS,
        "n",
        "encounters_with_pair",
        F.col("sum_total_allowed_amount").cast("decimal(38,2)").alias("sum_total_allowed_amount"),
        F.col("sum_length_of_stay_hours").cast("bigint").alias("sum_length_of_stay_hours"),
    )


def pair_totals_after(stored: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """Stored totals less those of the old rows of changed encounters, plus those of their new rows."""
    minus = gone.select(*PAIR_LABELS, *[(-F.col(c)).cast(stored.schema[c].dataType).alias(c) for c in PAIR_TOTALS])
    all_rows = stored.unionByName(minus).unionByName(come)
    sums = [F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in PAIR_TOTALS]
    return all_rows.groupBy(*PAIR_LABELS).agg(*sums).where(F.col("n") > 0)


def pair_summary(wh, min_pairs: int = 3) -> DataFrame:
    """The stored aggregate behind Q2: write it with ``refresh_pair_summary`` and read it with ``top_stored_pairs``."""
    return summarised_pairs(pair_totals(wh), min_pairs)


def summarised_pairs(totals: DataFrame, min_pairs: int = 3) -> DataFrame:
    """The aggregate from the totals of the pairs."""
    return (
        totals.where(F.col("n") >= min_pairs)
        .select(
            "icd10_code",
            "icd10_description",
            "cpt_code",
            "cpt_description",
            F.col("n").alias("combination_count"),
            "encounters_with_pair",
            _mean("total_allowed_amount", None, "avg_revenue"),
        )
    )


def refresh_pair_summary(wh, path: str) -> None:
    """Rebuild the stored aggregate; one row per pair of codes."""
    pair_summary(wh).write.mode("overwrite").parquet(path)


def top_stored_pairs(summary: DataFrame, limit: int = 10) -> DataFrame:
    """Q2 from the stored aggregate."""
    return (
        summary.select(
            "icd10_code",
            "icd10_description",
            "cpt_code",
            "cpt_description",
            "combination_count",
            C.rounded(F.col("avg_revenue"), 2).alias("avg_revenue"),
        )
        .orderBy(F.desc("combination_count"), "icd10_code", "cpt_code")
        .limit(limit)
    )


def _labelled_pairs(wh, dx_labels, px_labels, primary_only: bool) -> DataFrame:
    return (
        _pairs(wh, dx_labels, px_labels, primary_only)
        .groupBy("diagnosis_key", "procedure_key")
        .agg(F.sum("pairs").alias("n"))
        .join(wh["dim_diagnosis"].select("diagnosis_key", *dx_labels), "diagnosis_key")
        .join(wh["dim_procedure"].select("procedure_key", *px_labels), "procedure_key")
    )


def pairs_without_summary(wh, min_pairs: int = 3) -> DataFrame:
    """Q2 when no stored aggregate exists."""
    return (
        _labelled_pairs(wh, ["icd10_code"], ["cpt_code"], primary_only=True)
        .where(F.col("n") >= min_pairs)
        .select("icd10_code", "cpt_code", F.col("n").alias("combination_count"))
    )


def all_pairs(wh, limit: int = 10) -> DataFrame:
    """Q2 over all diagnoses of an encounter."""
    shown = ["icd10_code", "icd10_description", "cpt_code", "cpt_description"]
    return (
        _labelled_pairs(wh, shown[:2], shown[2:], primary_only=False)
        .select(*shown, F.col("n").alias("encounter_count"))
        .orderBy(F.desc("encounter_count"), *shown)
        .limit(limit)
    )


def _visits(fact: DataFrame) -> DataFrame:
    return fact.select(
        F.col("patient_key").alias("patient"),
        F.col("encounter_id").alias("visit"),
        "specialty_key",
        C.epoch_micros(F.col("encounter_datetime")).alias("start_at"),
        C.epoch_micros(F.col("discharge_datetime")).alias("end_at"),
        F.lit(True).alias("is_return"),
        "encounter_date_key",
    )


def readmission_risk(
    wh, as_of: dt.date, min_discharges: int = 50, with_all_discharges: bool = False
) -> DataFrame:
    """Q3 of the last year with a risk band, from the visits themselves.

    The plain question pairs each discharge with its returns, so only discharges with a return are counted and the rate
    is 100. ``with_all_discharges`` counts every discharge.
    """
    since = as_of.replace(year=as_of.year - 1) if (as_of.month, as_of.day) != (2, 29) else dt.date(as_of.year - 1, 2, 28)
    since_key = since.year * 10000 + since.month * 100 + since.day
    hot = wh.hot_keys("fact_encounters", "patient_key")
    visits = _visits(wh["fact_encounters"]).withColumn("is_index", F.col("encounter_date_key") >= since_key)
    horizon = READMISSION_DAYS * C.MICROS_PER_DAY
    measured = returns_within(visits, horizon, hot, exclude_self=False, carry=("specialty_key",))
    days = days_over_returns(visits, measured, READMISSION_DAYS, hot)
    returned = F.col("returns") > 0
    rate = F.col("readmission_rate_percent")
    risk = F
    for limit, label in RISK_BANDS:
        risk = risk.when(rate > limit, F.lit(label))
    return (
        measured.join(days, "visit", "left")
        .join(_specialty(wh), "specialty_key")
        .groupBy("specialty_key", "specialty_name")
        .agg(
            (F.count("*") if with_all_discharges else F.count_if(returned)).alias("total_discharges"),
            F.count_if(returned).alias("readmissions_30day"),
            F.sum("returns").alias("pairs"),
            F.sum("day_sum").alias("days"),
        )
        .where(F.col("total_discharges") >= min_discharges)
        .select(
            F.col("specialty_name").alias("initial_specialty"),
            "total_discharges",
            "readmissions_30day",
            C.percent(F.col("readmissions_30day"), F.col("total_discharges"), 2).alias("readmission_rate_percent"),
            C.rounded(C.mean(F.col("days"), F.col("pairs")), 1).alias("avg_days_to_readmission"),
        )
        .withColumn("risk_category", risk.otherwise(F.lit(LOWEST_RISK)))
        .orderBy(F.desc("readmission_rate_percent"), F.desc("total_discharges"), "initial_specialty")
    )


def readmission_from_flags(wh, min_discharges: int = 10, limit: int = 10) -> DataFrame:
    """Q3 from the stored readmission columns."""
    flagged = F.col("has_30day_readmission")
    return (
        wh["fact_encounters"]
        .where(F.col("discharge_datetime").isNotNull())
        .join(_specialty(wh), "specialty_key")
        .groupBy("specialty_name")
        .agg(
            F.count("*").alias("total_discharges"),
            F.sum(F.when(flagged, 1).otherwise(0)).alias("readmissions"),
            F.sum(F.when(flagged, F.col("days_to_readmission"))).alias("days"),
            F.count(F.when(flagged, F.col("days_to_readmission"))).alias("with_days"),
        )
        .where(F.col("total_discharges") >= min_discharges)
        .select(
            "specialty_name",
            "total_discharges",
            "readmissions",
            C.percent(F.col("readmissions"), F.col("total_discharges"), 2).alias("readmission_rate_percent"),
            C.rounded(C.mean(F.col("days"), F.col("with_days")), 1).alias("avg_days_to_readmission"),
        )
        .orderBy(F.desc("readmission_rate_percent"), "specialty_name")
        .limit(limit)
    )


def inpatient_readmission_from_flags(wh) -> DataFrame:
    """Q3 from the stored columns for inpatient stays."""
    return (
        wh["fact_encounters"]
        .where(F.col("discharge_date_key").isNotNull())
        .join(_types(wh).where(F.col("encounter_type") == INPATIENT), "encounter_type_key")
        .join(_specialty(wh), "specialty_key")
        .groupBy("specialty_name")
        .agg(
            F.count("*").alias("total_inpatient_discharges"),
            F.sum(F.col("has_30day_readmission").cast("int")).alias("total_readmissions"),
        )
        .withColumn(
            "readmission_rate", C.percent(F.col("total_readmissions"), F.col("total_inpatient_discharges"), 2)
        )
        .orderBy(F.desc("readmission_rate"), "specialty_name")
    )


def calendar_day_returns(wh, with_all_stays: bool = False) -> DataFrame:
    """Q3 on calendar days: inpatient stays and returns to Inpatient or ER in the 30 days after the discharge day.

    The plain question keeps only stays with a return; ``with_all_stays`` counts every inpatient stay.
    """
    hot = wh.hot_keys("fact_encounters", "patient_key")
    days = wh["dim_date"].select("date_key", F.unix_date("calendar_date").cast("bigint").alias("day"))
    began = days.select(F.col("date_key").alias("encounter_date_key"), F.col("day").alias("start_at"))
    left = days.select(F.col("date_key").alias("discharge_date_key"), F.col("day").alias("end_at"))
    visits = (
        wh["fact_encounters"]
        .join(_types(wh), "encounter_type_key")
        .join(began, "encounter_date_key", "left")
        .join(left, "discharge_date_key", "left")
        .select(
            F.col("patient_key").alias("patient"),
            F.col("encounter_key").alias("visit"),
            "specialty_key",
            "start_at",
            "end_at",
            (F.col("encounter_type") == INPATIENT).alias("is_index"),
            F.col("encounter_type").isin(*RETURN_TYPES).alias("is_return"),
        )
        .where("is_index OR is_return")
    )
    # Time is counted in days here, so a slice of one day would be a slice of one unit.
    measured = returns_within(
        visits, READMISSION_DAYS, hot, exclude_self=False, carry=("specialty_key",), slice_micros=7
    )
    if not with_all_stays:
        measured = measured.where(F.col("returns") > 0)
    return (
        measured.join(_specialty(wh), "specialty_key")
        .groupBy("specialty_name")
        .agg(F.count("*").alias("total_discharges"), F.sum("returns").alias("total_readmissions"))
        .withColumn(
            "readmission_rate_percent",
            C.rounded(C.ratio(F.col("total_readmissions"), F.col("total_discharges")) * 100, 2),
        )
        .orderBy(F.desc("readmission_rate_percent"), "specialty_name")
    )


def _monthly_money(wh, as_of: dt.date, min_encounters: int) -> DataFrame:
    return (
        _dated(wh, as_of.year - 2)
        .where(F.col("total_claim_amount") >= 0)
        .join(_specialty(wh, "specialty_name", "specialty_category"), "specialty_key")
        .groupBy("year", "month", "specialty_key", "specialty_name", "specialty_category")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("total_claim_amount") > 0).alias("billable_encounters"),
            _total("total_claim_amount"),
            _total("total_allowed_amount"),
        )
        .where(F.col("n") >= min_encounters)
    )


def revenue_trend(wh, as_of: dt.date, min_encounters: int = 10, same_month: bool = False) -> DataFrame:
    """Q4 with the collection rate and the growth against an earlier month.

    The plain question looks 12 rows back among the months that remain; ``same_month`` compares with the same month of
    the year before.
    """
    cells = _monthly_money(wh, as_of, min_encounters)
    collected = F.col("sum_total_allowed_amount").cast("double")
    if same_month:
        earlier = cells.select(
            (F.col("year") + 1).alias("year"), "month", "specialty_key", collected.alias("earlier")
        )
        cells = cells.join(earlier, ["year", "month", "specialty_key"], "left")
    else:
        months = Window.partitionBy("specialty_key").orderBy("year", "month")
        cells = cells.withColumn("earlier", F.lag(collected, 12).over(months))
    growth = C.rounded(
        (F.col("sum_total_allowed_amount") - F.col("earlier").cast("decimal(22,2)")).cast("double") * 100
        / F.nullif(F.col("earlier"), F.lit(0.0)),
        1,
    )
    return cells.select(
        "year",
        "month",
        C.month_name(F.col("month")).alias("month_name"),
        "specialty_name",
        "specialty_category",
        F.col("n").alias("total_encounters"),
        "billable_encounters",
        _double("total_claim_amount", "total_charges"),
        _double("total_allowed_amount", "total_collections"),
        _mean("total_claim_amount", 2, "avg_charge_per_encounter"),
        _mean("total_allowed_amount", 2, "avg_collection_per_encounter"),
        C.percent(F.col("sum_total_allowed_amount"), F.col("sum_total_claim_amount"), 1).alias(
            "collection_rate_percent"
        ),
        growth.alias("yoy_growth_percent"),
    ).orderBy(F.desc("year"), F.desc("month"), F.desc("total_collections"), "specialty_name")


def revenue_short(wh, as_of: dt.date, min_encounters: int = 5, limit: int = 15) -> DataFrame:
    """Q4, short form: months with the most collected."""
    return (
        _dated(wh, as_of.year - 1)
        .join(_specialty(wh), "specialty_key")
        .groupBy("year", "month", "specialty_name")
        .agg(F.count("*").alias("n"), _total("total_claim_amount"), _total("total_allowed_amount"))
        .where(F.col("n") >= min_encounters)
        .select(
            "year",
            "month",
            "specialty_name",
            F.col("n").alias("total_encounters"),
            _double("total_claim_amount", "total_charges"),
            _double("total_allowed_amount", "total_collections"),
            _mean("total_allowed_amount", 2, "avg_revenue_per_encounter"),
        )
        .orderBy(F.desc("total_collections"), "year", "month", "specialty_name")
        .limit(limit)
    )


def revenue_all_months(wh) -> DataFrame:
    """Q4 over all months with the reimbursement rate."""
    return (
        _dated(wh)
        .join(_specialty(wh), "specialty_key")
        .groupBy("year", "month", "specialty_name")
        .agg(F.count("*").alias("n"), _total("total_claim_amount"), _total("total_allowed_amount"))
        .select(
            "year",
            "month",
            "specialty_name",
            _double("total_claim_amount", "total_claim_amount"),
            _double("total_allowed_amount", "total_allowed_amount"),
            F.col("n").alias("total_encounters"),
            _mean("total_allowed_amount", 2, "avg_allowed_per_encounter"),
            C.rounded(
                C.ratio(F.col("sum_total_allowed_amount"), F.col("sum_total_claim_amount")) * 100, 2
            ).alias("reimbursement_rate_percent"),
        )
        .orderBy("year", "month", F.desc("total_allowed_amount"), "specialty_name")
    )


def revenue_from_view(wh) -> DataFrame:
    """Q4 over the wide view."""
    return (
        encounter_analytics(wh)
        .groupBy("encounter_year", "encounter_month", "specialty_name")
        .agg(
            F.count("*").alias("n"),
            _total("total_claim_amount"),
            _total("total_allowed_amount"),
            F.sum(F.col("reimbursement_rate_percent").cast("decimal(20,6)")).alias("sum_rate"),
        )
        .select(
            "encounter_year",
            "encounter_month",
            "specialty_name",
            _double("total_claim_amount", "total_claim_amount"),
            _double("total_allowed_amount", "total_allowed_amount"),
            F.col("n").alias("total_encounters"),
            _mean("total_allowed_amount", 6, "avg_allowed_per_encounter"),
            _mean("rate", 6, "avg_reimbursement_rate"),
        )
        .orderBy("encounter_year", "encounter_month", F.desc("total_allowed_amount"), "specialty_name")
    )


def top_revenue_diagnoses(wh, min_encounters: int = 20, limit: int = 15) -> DataFrame:
    """Primary diagnoses that bring in the most."""
    labels = ["icd10_code", "icd10_description", "diagnosis_category"]
    fact = wh["fact_encounters"].select("encounter_key", "total_allowed_amount", "length_of_stay_hours")
    primary = wh["bridge_encounter_diagnoses"].where(F.col("diagnosis_sequence") == 1)
    return (
        primary.join(wh["dim_diagnosis"].select("diagnosis_key", *labels), "diagnosis_key")
        .join(fact, "encounter_key")
        .groupBy(*labels)
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("encounter_key").alias("total_encounters"),
            _total("total_allowed_amount"),
            _total("length_of_stay_hours"),
        )
        .where(F.col("total_encounters") >= min_encounters)
        .select(
            *labels,
            "total_encounters",
            _double("total_allowed_amount", "total_revenue"),
            _mean("total_allowed_amount", 2, "avg_revenue_per_encounter"),
            _mean("length_of_stay_hours", 1, "avg_length_of_stay"),
        )
        .orderBy(F.desc("total_revenue"), "icd10_code")
        .limit(limit)
    )


def demographics(wh, as_of: dt.date) -> DataFrame:
    """Encounters, patients and revenue by age band and gender, this and the previous year."""
    people = wh["dim_patient"].select("patient_key", "age_group", "gender")
    per_patient = _dated(wh, as_of.year - 1).groupBy("patient_key").agg(
        F.count("*").alias("encounters"), F.sum("total_allowed_amount").alias("total_allowed_amount")
    )
    return (
        per_patient.join(people, "patient_key")
        .groupBy("age_group", "gender")
        .agg(
            F.sum("encounters").alias("n"),
            F.count("*").alias("unique_patients"),
            _total("total_allowed_amount"),
        )
        .select(
            "age_group",
            "gender",
            F.col("n").alias("total_encounters"),
            "unique_patients",
            C.rounded(C.ratio(F.col("n"), F.col("unique_patients")), 1).alias("encounters_per_patient"),
            _double("total_allowed_amount", "total_revenue"),
            _mean("total_allowed_amount", 2, "avg_revenue_per_encounter"),
        )
        .orderBy(F.desc("total_encounters"), "age_group", "gender")
    )


def specialty_totals(wh) -> DataFrame:
    """Volume, patients, revenue and stay by specialty."""
    return (
        wh["fact_encounters"]
        .join(_specialty(wh), "specialty_key")
        .groupBy("specialty_name")
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("patient_key").alias("unique_patients"),
            _total("total_allowed_amount"),
            _total("length_of_stay_hours"),
            _total("diagnosis_count"),
        )
        .select(
            "specialty_name",
            F.col("n").alias("total_encounters"),
            "unique_patients",
            _double("total_allowed_amount", "total_revenue"),
            _mean("total_allowed_amount", 2, "avg_revenue_per_encounter"),
            _mean("length_of_stay_hours", 1, "avg_length_of_stay_hours"),
            _mean("diagnosis_count", 1, "avg_diagnoses_per_encounter"),
        )
        .orderBy(F.desc("total_revenue"), "specialty_name")
    )


def monthly_trend(wh) -> DataFrame:
    """Encounters and revenue by month with the same month of the previous year present."""
    years = Window.partitionBy("month").orderBy("year")
    cells = (
        _dated(wh)
        .groupBy("month", "year")
        .agg(F.count("*").alias("encounters"), F.sum("total_allowed_amount").cast("double").alias("revenue"))
    )
    previous = F.col("prev_year_encounters")
    return (
        cells.withColumn("prev_year_encounters", F.lag("encounters").over(years))
        .withColumn("prev_year_revenue", F.lag("revenue").over(years))
        .withColumn(
            "encounter_growth_percent", C.rounded(C.ratio(F.col("encounters") - previous, previous) * 100, 1)
        )
        .orderBy("year", "month")
    )


def patient_complexity(wh) -> DataFrame:
    """Mean diagnoses, procedures, cost and stay by age band and encounter type."""
    measures = ["diagnosis_count", "procedure_count", "total_allowed_amount", "length_of_stay_hours"]
    per_patient = wh["fact_encounters"].groupBy("patient_key", "encounter_type_key").agg(
        F.count("*").alias("encounters"), *[F.sum(m).alias(m) for m in measures]
    )
    return (
        per_patient.join(wh["dim_patient"].select("patient_key", "age_group"), "patient_key")
        .join(_types(wh), "encounter_type_key")
        .groupBy("age_group", "encounter_type")
        .agg(F.sum("encounters").alias("n"), *[_total(m) for m in measures])
        .select(
            "age_group",
            "encounter_type",
            F.col("n").alias("encounter_count"),
            _mean("diagnosis_count", 1, "avg_diagnoses"),
            _mean("procedure_count", 1, "avg_procedures"),
            _mean("total_allowed_amount", 2, "avg_cost"),
            _mean("length_of_stay_hours", 1, "avg_los_hours"),
        )
        .orderBy("age_group", "encounter_type")
    )


def encounters_per_year(wh) -> DataFrame:
    return _dated(wh).groupBy("year").agg(F.count("*").alias("total_encounters")).orderBy("year")


def claims_per_month(wh) -> DataFrame:
    return (
        _dated(wh)
        .groupBy("year", "month")
        .agg(F.sum("total_claim_amount").cast("double").alias("total_revenue"))
        .orderBy("year", "month")
    )


def encounters_per_department(wh) -> DataFrame:
    departments = wh["dim_department"].select("department_key", "department_name")
    providers = wh["dim_provider"].select("provider_key", F.col("department_key").alias("provider_department"))
    return (
        _rows_per(wh["fact_encounters"], "provider_key")
        .join(providers, "provider_key")
        .join(departments.withColumnRenamed("department_key", "provider_department"), "provider_department")
        .groupBy("department_name")
        .agg(F.sum("n").alias("encounter_count"))
        .orderBy(F.desc("encounter_count"), "department_name")
    )


def top_diagnoses(wh, limit: int = 10) -> DataFrame:
    shown = ["icd10_code", "icd10_description"]
    return (
        _rows_per(wh["bridge_encounter_diagnoses"], "diagnosis_key")
        .join(wh["dim_diagnosis"].select("diagnosis_key", *shown), "diagnosis_key")
        .groupBy(*shown)
        .agg(F.sum("n").alias("diagnosis_count"))
        .orderBy(F.desc("diagnosis_count"), *shown)
        .limit(limit)
    )


def provider_productivity(wh) -> DataFrame:
    providers = wh["dim_provider"].select("provider_key", "first_name", "last_name", F.col("specialty_key").alias("own"))
    return (
        _rows_per(wh["fact_encounters"], "provider_key")
        .join(providers, "provider_key")
        .join(_specialty(wh).withColumnRenamed("specialty_key", "own"), "own")
        .groupBy("first_name", "last_name", "specialty_name")
        .agg(F.sum("n").alias("total_encounters"))
        .orderBy(F.desc("total_encounters"), "last_name", "first_name", "specialty_name")
    )


def claim_per_type(wh) -> DataFrame:
    return (
        wh["fact_encounters"]
        .join(_types(wh), "encounter_type_key")
        .groupBy("encounter_type")
        .agg(F.count("*").alias("n"), _total("total_claim_amount"))
        .select("encounter_type", _mean("total_claim_amount", 6, "avg_claim"))
        .orderBy(F.desc("avg_claim"), "encounter_type")
    )


def encounters_per_age_band(wh) -> DataFrame:
    return (
        _rows_per(wh["fact_encounters"], "patient_key")
        .join(wh["dim_patient"].select("patient_key", "age_group"), "patient_key")
        .groupBy("age_group")
        .agg(F.sum("n").alias("encounter_count"))
        .orderBy(F.desc("encounter_count"), "age_group")
    )


def stay_days(wh) -> DataFrame:
    """Days from admission to discharge of every discharged encounter."""
    people = wh["dim_patient"].select("patient_key", "first_name", "last_name")
    return (
        wh["fact_encounters"]
        .where(F.col("discharge_datetime").isNotNull())
        .join(people, "patient_key")
        .join(wh["dim_date"].select(F.col("date_key").alias("encounter_date_key"), "calendar_date"), "encounter_date_key")
        .select(
            "first_name",
            "last_name",
            F.datediff(F.col("discharge_datetime").cast("date"), F.col("calendar_date")).alias("length_of_stay"),
        )
    )


def top_procedures(wh, limit: int = 10) -> DataFrame:
    shown = ["cpt_code", "cpt_description"]
    return (
        _rows_per(wh["bridge_encounter_procedures"], "procedure_key")
        .join(wh["dim_procedure"].select("procedure_key", *shown), "procedure_key")
        .groupBy(*shown)
        .agg(F.sum("n").alias("total_times_performed"))
        .orderBy(F.desc("total_times_performed"), *shown)
        .limit(limit)
    )


def revenue_per_diagnosis(wh) -> DataFrame:
    """Claims by diagnosis; an encounter counts once for each of its diagnoses."""
    shown = ["icd10_code", "icd10_description"]
    return (
        wh["bridge_encounter_diagnoses"]
        .join(wh["dim_diagnosis"].select("diagnosis_key", *shown), "diagnosis_key")
        .join(wh["fact_encounters"].select("encounter_key", "total_claim_amount"), "encounter_key")
        .groupBy(*shown)
        .agg(F.sum("total_claim_amount").cast("double").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), *shown)
    )
