"""The star schema as a set of tables: derived on the fly, or stored and opened."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from wardlake.plans import dims, fact
from wardlake.sources.tables import TableSet

STAR_TABLES = [
    "dim_date",
    "dim_patient",
    "dim_specialty",
    "dim_department",
    "dim_provider",
    "dim_encounter_type",
    "dim_diagnosis",
    "dim_procedure",
    "fact_encounters",
    "bridge_encounter_diagnoses",
    "bridge_encounter_procedures",
]

# Steps of a fact build that later steps read; opened like tables but not part of the star.
FACT_STAGES = ["fact_resolved", "fact_measured", "fact_readmission"]


def derive_warehouse(src: TableSet, as_of: dt.date, calendar: tuple[dt.date, dt.date] | None = None) -> TableSet:
    """The star schema as unexecuted plans over the clinical tables.

    Each table is a plan of its own: a query pulls in only what it reads, and unused outer joins of the fact drop out.
    """
    spark = src.spark
    wh: TableSet

    def readmission():
        return fact.readmission_measures(wh["fact_resolved"], src.hot_keys("encounters", "patient_id"))

    def calendar_table():
        return dims.dim_date(spark, *(calendar or dims.calendar_bounds(src)))

    wh = TableSet(
        spark,
        {
            "dim_date": calendar_table,
            "dim_patient": lambda: dims.dim_patient(src, as_of),
            "dim_specialty": lambda: dims.dim_specialty(src),
            "dim_department": lambda: dims.dim_department(src),
            "dim_provider": lambda: dims.dim_provider(src, wh["dim_specialty"], wh["dim_department"]),
            "dim_encounter_type": lambda: dims.dim_encounter_type(src),
            "dim_diagnosis": lambda: dims.dim_diagnosis(src),
            "dim_procedure": lambda: dims.dim_procedure(src),
            "fact_resolved": lambda: fact.resolved_encounters(
                src["encounters"], wh["dim_patient"], wh["dim_provider"], wh["dim_encounter_type"]
            ),
            "fact_measured": lambda: fact.with_measures(
                wh["fact_resolved"],
                src["billing"],
                src["encounter_diagnoses"],
                src["encounter_procedures"],
                wh["dim_diagnosis"],
            ),
            "fact_readmission": readmission,
            "fact_encounters": lambda: fact.with_readmissions(wh["fact_measured"], wh["fact_readmission"]),
            "bridge_encounter_diagnoses": lambda: fact.bridge_diagnoses(
                src["encounter_diagnoses"], wh["fact_resolved"], wh["dim_diagnosis"]
            ),
            "bridge_encounter_procedures": lambda: fact.bridge_procedures(
                src["encounter_procedures"],
                wh["fact_resolved"],
                wh["dim_procedure"],
                src.hot_keys("encounter_procedures", "encounter_id"),
            ),
        },
        hot_from={
            ("fact_encounters", "patient_key"): (src, "encounters", "patient_id"),
            ("bridge_encounter_diagnoses", "encounter_key"): (src, "encounter_diagnoses", "encounter_id"),
            ("bridge_encounter_procedures", "encounter_key"): (src, "encounter_procedures", "encounter_id"),
        },
    )
    return wh


def open_warehouse(spark: SparkSession, folder: str) -> TableSet:
    """A stored star schema."""
    root = folder.rstrip("/")
    return TableSet(spark, {name: (lambda n=name: spark.read.parquet(f"{root}/{n}")) for name in STAR_TABLES})
