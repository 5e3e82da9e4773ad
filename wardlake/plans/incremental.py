"""Incremental loads: changed patients and encounters, bridges, late bills, high-water marks, quarantine, archive.

A change set is a table of ids. Everything derived from it is computed for those ids alone and merged into the stored
table by an anti join, whose build side is the change set.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators.change import replace_children, split_by_age, update_from, upsert
from wardlake.operators.skew import union_all
from wardlake.plans import dims, fact
from wardlake.plans.audit import archive_cutoff
from wardlake.plans.warehouse import derive_warehouse

# Fixed value: days that billing may arrive late.
LATE_BILLING_DAYS = 7

READMISSION_COLUMNS = ["has_30day_readmission", "days_to_readmission", "is_readmission", "readmission_count_30days"]


def changed_since(df: DataFrame, modified: str | Column, mark) -> DataFrame:
    """Rows modified at or after the high-water mark; all rows when there is none yet."""
    if mark is None:
        return df
    column = F.col(modified) if isinstance(modified, str) else modified
    return df.where(column >= F.lit(mark))


def merge_patients(stored: DataFrame, src, changed: DataFrame, as_of: dt.date) -> DataFrame:
    """Patient dimension with the changed patients overwritten or added."""
    rows = dims.dim_patient(src.replacing(patients=changed), as_of)
    return upsert(stored, rows, ["patient_id"])


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids, "encounter_id", "left_semi")


def changed_slice(src, ids: DataFrame):
    """The source tables cut down to the changed encounters."""
    cut = {n: _only(src[n], ids) for n in ("encounters", "billing", "encounter_diagnoses", "encounter_procedures")}
    return src.replacing(**cut)


def merge_bridges(stored: dict[str, DataFrame], src, dims_of, ids: DataFrame, hot: list) -> dict[str, DataFrame]:
    """Both bridges with the rows of the changed encounters replaced."""
    part = changed_slice(src, ids)
    resolved = fact.resolved_encounters(
        part["encounters"], dims_of["dim_patient"], dims_of["dim_provider"], dims_of["dim_encounter_type"]
    )
    parents = ids.select(F.col("encounter_id").alias("encounter_key"))
    fresh = {
        "bridge_encounter_diagnoses": fact.bridge_diagnoses(
            part["encounter_diagnoses"], resolved, dims_of["dim_diagnosis"]
        ),
        "bridge_encounter_procedures": fact.bridge_procedures(
            part["encounter_procedures"], resolved, dims_of["dim_procedure"], hot
        ),
    }
    return {n: replace_children(stored[n], parents, fresh[n], "encounter_key") for n in fresh}


def apply_late_billing(stored: DataFrame, billing: DataFrame, as_of: dt.date, days: int = LATE_BILLING_DAYS, modified: str = "claim_date") -> DataFrame:
    """Fact with the money totals of encounters billed in the last ``days`` days computed again from all their bills."""
    recent = billing.where(F.col(modified) >= F.lit(as_of - dt.timedelta(days=days))).select("encounter_id").distinct()
    return recompute_billing(stored, billing, recent)


def recompute_billing(stored: DataFrame, billing: DataFrame, ids: DataFrame) -> DataFrame:
    totals = fact.billing_totals(billing.join(ids, "encounter_id", "left_semi"))
    money = ["total_claim_amount", "total_allowed_amount"]
    return update_from(stored, totals, ["encounter_id"], money)


def high_water_marks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest modification per table, to be stored after a load succeeded: table_name, last_modified."""
    return union_all(
        [
            df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("last_modified")).select(
                F.lit(name).alias("table_name"), "last_modified"
            )
            for name, (df, column) in tables.items()
        ]
    )


def read_mark(spark: SparkSession, path: str, table: str):
    """Stored mark of a table, or None: a single value."""
    row = spark.read.parquet(path).where(F.col("table_name") == table).select("last_modified").first()
    return row[0] if row else None


def refresh_small_dimensions(src, folder: str, as_of: dt.date) -> None:
    """Rebuild and overwrite the dimensions that are small reference tables."""
    wh = derive_warehouse(src, as_of)
    for name in ("dim_specialty", "dim_department", "dim_encounter_type", "dim_diagnosis", "dim_procedure"):
        wh[name].write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def quarantined(src, dims_of) -> DataFrame:
    """Encounters that cannot be loaded, with every reason; the load goes on with the others."""
    e = src["encounters"]
    tests = [
        ("UNKNOWN_PATIENT", "patient_id", dims_of["dim_patient"]),
        ("UNKNOWN_PROVIDER", "provider_id", dims_of["dim_provider"]),
        ("UNKNOWN_ENCOUNTER_TYPE", "encounter_type", dims_of["dim_encounter_type"]),
    ]
    found = [
        e.join(dim.select(key), key, "left_anti").select(
            "encounter_id", F.lit(reason).alias("reason"), F.col(key).cast("string").alias("bad_value")
        )
        for reason, key, dim in tests
    ]
    return union_all(found)


def split_archive(stored: DataFrame, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """(encounters to keep, encounters older than seven years)."""
    return split_by_age(stored, "encounter_datetime", F.lit(archive_cutoff(as_of)).cast("timestamp_ntz"))
