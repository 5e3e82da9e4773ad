"""The daily run over a versioned store: what has changed since the last marks is merged and published as one version.

The fact and both bridges are kept in partitions of year and patient bucket, each with the range of its encounter ids
and of its times. A change finds its old rows by ids in the partitions whose range may hold them, reading a few columns;
the visits it influences lie within 30 days of it and in partitions that reach into that time. Only partitions in which
a row really changes are read whole and written again. All tables and the marks are published together, so a run that
fails changes nothing and can be repeated, and a run without changes publishes the same rows.

Encounters that cannot be loaded are kept in ``quarantined_encounters`` with their reasons. When a missing key arrives, the run takes
them up again and their rows there end.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.change import upsert
from wardlake.operators.skew import union_all
from wardlake.plans import dims, fact
from wardlake.plans.incremental import LATE_BILLING_DAYS, READMISSION_COLUMNS, changed_slice, high_water_marks, quarantined
from wardlake.plans.queries_star import PAIR_LABELS, pair_totals, pair_totals_after
from wardlake.plans.runlog import RunLog
from wardlake.plans.store import NO_VALUE, Change, Manifest, VersionedStore
from wardlake.plans.warehouse import STAR_TABLES, derive_warehouse
from wardlake.session import fresh_path
from wardlake.sources.tables import TableSet

PARTITION = ["encounter_year", "patient_bucket"]
SMALL_DIMENSIONS = ["dim_specialty", "dim_department", "dim_encounter_type", "dim_diagnosis", "dim_procedure", "dim_provider"]
BRIDGES = ["bridge_encounter_diagnoses", "bridge_encounter_procedures"]
QUARANTINE = "quarantined_encounters"
PAIRS = "diagnosis_procedure_totals"
QUARANTINE_SCHEMA = "encounter_id bigint, reason string, bad_value string, first_run string"
VISIT = ["encounter_id", "patient_key", "encounter_datetime", "discharge_datetime", *READMISSION_COLUMNS, *PARTITION]
HORIZON = fact.READMISSION_DAYS * C.MICROS_PER_DAY
CHILDREN = ["billing", "encounter_diagnoses", "encounter_procedures"]


@dataclass
class Tracking:
    """How changes are seen: a SQL expression for the modification time of each tracked source table, and the days
    looked back further."""

    modified: Mapping[str, str]
    look_back: Mapping[str, int] = field(default_factory=lambda: {"billing": LATE_BILLING_DAYS})
    buckets: int = 64

    def moment(self, table: str) -> Column:
        return F.expr(self.modified[table]).cast("timestamp_ntz")


def _micros(column: str) -> Column:
    return C.epoch_micros(F.col(column))


def extent() -> dict[str, Column]:
    """Kept for each partition: the range of the ids, and of the times from the first start or end to the last."""
    start, end = _micros("encounter_datetime"), _micros("discharge_datetime")
    return {
        "low_id": F.min("encounter_id"),
        "high_id": F.max("encounter_id"),
        "begins": F.min(F.least(start, end)),
        "ends": F.max(F.greatest(start, end)),
    }


def bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("patient_bucket", F.pmod(F.xxhash64("patient_key"), F.lit(buckets)).cast("int"))


class DailyRun:
    """One run: reads a version, writes what changes, publishes the next version."""

    def __init__(self, spark: SparkSession, src: TableSet, store: VersionedStore, as_of: dt.date, run_id: str,
                 tracking: Tracking, calendar: tuple[dt.date, dt.date] | None = None):
        self.spark, self.src, self.store, self.as_of, self.run_id = spark, src, store, as_of, run_id
        self.tracking, self.calendar = tracking, calendar
        self.base: Manifest = store.current()
        self.changes: dict[str, Change] = {}
        self.made: dict[str, DataFrame] = {}

    # Small helpers

    def _staged(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, f"{self.run_id}-{label}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stored(self, name: str, parts=None) -> DataFrame:
        return self.store.table(name, parts, self.base)

    def parts_where(self, condition: Column, of: DataFrame | None = None) -> list[str]:
        """Partitions of the fact by their extent: at most one row each reaches the driver."""
        extents = self.store.extents("fact_encounters", self.base) if of is None else of
        return [r[0] for r in extents.where(condition).select("_part").distinct().collect()]

    def new_marks(self) -> dict[str, str]:
        """Latest modification of each tracked table; rows beyond it are left to the next run."""
        tables = {t: (self.src[t].select(self.tracking.moment(t).alias("at")), "at") for t in self.tracking.modified}
        rows = high_water_marks(tables).collect()  # one row a tracked table
        return {r["table_name"]: r["last_modified"].isoformat(sep=" ") for r in rows if r["last_modified"]}

    def changed(self, table: str) -> DataFrame:
        """Rows modified since the mark, with the table's look-back; without a mark all rows, those without a time too."""
        at, upto, mark = self.tracking.moment(table), self.marks.get(table), self.base.marks.get(table)
        known = at <= C.moment(dt.datetime.fromisoformat(upto)) if upto else F.lit(False)
        if mark is None:
            return self.src[table].where(known | at.isNull())
        since = dt.datetime.fromisoformat(mark) - dt.timedelta(days=self.tracking.look_back.get(table, 0))
        return self.src[table].where(known & (at >= C.moment(since)))

    # Steps

    def dimensions(self) -> None:
        """Small reference tables anew; patients by the changed ones."""
        planned = derive_warehouse(self.src, self.as_of)
        for name in SMALL_DIMENSIONS:
            self.changes[name] = self.store.write(name, planned[name])
        if "dim_patient" not in self.base.tables or "patients" not in self.tracking.modified:
            self.changes["dim_patient"] = self.store.write("dim_patient", planned["dim_patient"])
        else:
            rows = dims.dim_patient(self.src.replacing(patients=self.changed("patients")), self.as_of)
            rows = self._staged(rows, "patients")
            if not rows.isEmpty():
                self.changes["dim_patient"] = self.store.write("dim_patient", upsert(self.stored("dim_patient"), rows, ["patient_id"]))
        self.made |= {n: self._written(n) for n in self.changes}
        if "dim_patient" not in self.made:
            self.made["dim_patient"] = self.stored("dim_patient")

    def _written(self, name: str, base: Manifest | None = None) -> DataFrame:
        """What this run has written of a table, on top of the base version if one is given."""
        return self.store.table(name, manifest=self.store.changed(base or Manifest(), {name: self.changes[name]}))

    def grown_calendar(self, part: TableSet) -> None:
        """The calendar reaches over the wanted days, those it has, and every day the changed rows use."""
        bounds = [self.calendar or (None, None), dims.calendar_bounds(part)]
        if "dim_date" in self.base.tables:
            bounds.append(self.stored("dim_date").agg(F.min("calendar_date"), F.max("calendar_date")).first())
        first = min((b[0] for b in bounds if b[0] is not None), default=None)
        last = max((b[1] for b in bounds if b[1] is not None), default=None)
        if len(bounds) < 3 or (first, last) != tuple(bounds[2]):
            self.changes["dim_date"] = self.store.write("dim_date", dims.dim_date(self.spark, first, last))

    def changed_encounters(self) -> DataFrame:
        """Ids of encounters to build again, from every cause a rebuilt row may have."""
        tracked = [t for t in ("encounters", *CHILDREN) if t in self.tracking.modified]
        found = [self.changed(t).select("encounter_id") for t in tracked]
        if self.base.version:
            encounters = self.src["encounters"]
            # Providers whose keys have changed, and links whose diagnosis or procedure has become known.
            keys = ["provider_id", "provider_key", "specialty_key", "department_key"]
            moved = self.made["dim_provider"].select(*keys).exceptAll(self.stored("dim_provider").select(*keys))
            moved = self._staged(moved, "moved")
            if not moved.isEmpty():
                found.append(encounters.join(moved.select("provider_id"), "provider_id", "left_semi").select("encounter_id"))
            for links, dim, key in (("encounter_diagnoses", "dim_diagnosis", "diagnosis_id"), ("encounter_procedures", "dim_procedure", "procedure_id")):
                fresh = self.made[dim].select(key).join(self.stored(dim).select(key), key, "left_anti")
                if fresh.isEmpty():
                    continue  # The links of all encounters aren't read for nothing.
                found.append(self.src[links].join(fresh, key, "left_semi").select("encounter_id"))
            found.append(self.stored(QUARANTINE).select("encounter_id"))
        ids = union_all(found).where(F.col("encounter_id").isNotNull()).distinct()
        return self._staged(ids, "changed")

    def old_visits(self, ids: DataFrame) -> DataFrame:
        """Stored rows of the changed encounters: a few columns of the partitions whose ids reach into theirs."""
        low, high = ids.agg(F.min("encounter_id"), F.max("encounter_id")).first()
        if low is None or not self.base.version:
            return self.spark.createDataFrame([], self._visit_schema())
        parts = self.parts_where((F.col("low_id") <= high) & (F.col("high_id") >= low))
        return self._staged(self.stored("fact_encounters", parts).select(*VISIT).join(ids, "encounter_id", "left_semi"), "old")

    def _visit_schema(self):
        return self.rebuilt.select(*VISIT).schema

    def slice(self, ids: DataFrame) -> TableSet:
        """The source cut down to the changed encounters. What several steps read is made once; bills are read once anyway."""
        part = changed_slice(self.src, ids)
        kept = {
            "encounters": part["encounters"],
            "encounter_diagnoses": part["encounter_diagnoses"].select("encounter_id", "diagnosis_id", "diagnosis_sequence"),
            "encounter_procedures": part["encounter_procedures"].select("encounter_id", "procedure_id", "procedure_date"),
        }
        return part.replacing(**{n: self._staged(rows, f"slice-{n}") for n, rows in kept.items()})

    def build(self, part: TableSet) -> DataFrame:
        """Rows of the changed encounters, without readmissions."""
        resolved = fact.resolved_encounters(part["encounters"], self.made["dim_patient"], self.made["dim_provider"], self.made["dim_encounter_type"])
        rows = fact.with_measures(resolved, *[part[c] for c in CHILDREN], self.made["dim_diagnosis"])
        blank = {
            "has_30day_readmission": F.lit(False),
            "days_to_readmission": F.lit(None).cast("int"),
            "is_readmission": F.lit(False),
            "readmission_count_30days": F.lit(0),
        }
        return self._staged(bucketed(rows.withColumns(blank), self.tracking.buckets), "rebuilt")

    def renewed_visits(self, ids: DataFrame, old: DataFrame) -> DataFrame:
        """Readmission columns of the rebuilt visits, and of stored ones that the change makes different."""
        times = [F.min(F.least(_micros("encounter_datetime"), _micros("discharge_datetime"))).alias("low"),
                 F.max(F.greatest(_micros("encounter_datetime"), _micros("discharge_datetime"))).alias("high")]
        visits = self.rebuilt.select(*VISIT)
        touched = self._staged(old.unionByName(visits).groupBy("patient_key", "patient_bucket").agg(*times), "touched")
        if self.base.version:
            reach = self.store.extents("fact_encounters", self.base).join(touched, "patient_bucket")
            parts = self.parts_where((F.col("begins") <= F.col("high") + HORIZON) & (F.col("ends") >= F.col("low") - HORIZON), reach)
            around = self.stored("fact_encounters", parts).select(*VISIT).join(ids, "encounter_id", "left_anti")
            around = around.join(touched.select("patient_key", "low", "high"), "patient_key")
            start, end = _micros("encounter_datetime"), _micros("discharge_datetime")
            low, high = F.col("low") - HORIZON, F.col("high") + HORIZON
            near = F.coalesce(start.between(low, high), F.lit(False)) | F.coalesce(end.between(low, high), F.lit(False))
            around = self._staged(around.where(near), "around")
            visits = visits.unionByName(around.select(*VISIT))
        hot = self.src.hot_keys("encounters", "patient_id")
        measured = fact.readmission_measures(visits, hot)
        if not self.base.version:
            return measured.select("encounter_id", *READMISSION_COLUMNS, *[F.lit(None).cast("int").alias(c) for c in PARTITION])
        # A change can move the returns of a visit that ends within the horizon before it, and the return flag of one
        # that starts within the horizon after it; beyond that not all of the visit's neighbours are at hand.
        # The ids around are none of the changed ones, so one pass over the measures serves both kinds of visits.
        new = measured.select("encounter_id", *[F.col(c).alias(f"_{c}") for c in READMISSION_COLUMNS])
        returns = F.coalesce(end.between(F.col("low") - HORIZON, F.col("high")), F.lit(False))
        flag = F.coalesce(start.between(F.col("low"), F.col("high") + HORIZON), F.lit(False))
        joined = new.join(around.withColumn("_around", F.lit(True)), "encounter_id", "left")
        rebuilt = F.col("_around").isNull()
        taken = {c: F.when(rebuilt | (flag if c == "is_readmission" else returns), F.col(f"_{c}")).otherwise(F.col(c)) for c in READMISSION_COLUMNS}
        differs = rebuilt
        for c, value in taken.items():
            differs = differs | ~value.eqNullSafe(F.col(c))
        return joined.where(differs).select("encounter_id", *[v.alias(c) for c, v in taken.items()], *PARTITION)

    def fact_and_bridges(self) -> None:
        ids = self.changed_encounters()
        part = self.part = self.slice(ids)
        self.grown_calendar(part)
        self.rebuilt = self.build(part)
        old = self.old_visits(ids)
        renewed = self._staged(self.renewed_visits(ids, old), "renewed")

        # Partitions in which a row goes, comes or changes.
        by = lambda rows: rows.select(*PARTITION)
        places = union_all([by(old), by(self.rebuilt), by(renewed.where("patient_bucket IS NOT NULL"))]).distinct()
        touched = [self._part(r) for r in places.collect()]  # at most one row a partition
        columns, rows = self.rebuilt.columns, self.rebuilt
        if self.base.version:
            kept = self.stored("fact_encounters", touched).join(ids, "encounter_id", "left_anti")
            rows = kept.select(*columns).unionByName(rows)
        news = renewed.select("encounter_id", *[F.col(c).alias(f"_{c}") for c in READMISSION_COLUMNS], F.lit(True).alias("_new"))
        renew = {c: F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)) for c in READMISSION_COLUMNS}
        rows = rows.join(news, "encounter_id", "left").withColumns(renew).select(*columns)
        replaces = touched if self.base.version else None
        self.changes["fact_encounters"] = self.store.write("fact_encounters", rows, PARTITION, extent(), replaces)

        # Bridge rows lie in the partition of their encounter, so only places of old and rebuilt ones are written.
        places = union_all([by(old), by(self.rebuilt)]).distinct()
        touched = [self._part(r) for r in places.collect()]
        hot = self.src.hot_keys("encounter_procedures", "encounter_id")
        fresh = {
            BRIDGES[0]: fact.bridge_diagnoses(part["encounter_diagnoses"], self.rebuilt, self.made["dim_diagnosis"]),
            BRIDGES[1]: fact.bridge_procedures(part["encounter_procedures"], self.rebuilt, self.made["dim_procedure"], hot),
        }
        fresh = {n: self._staged(rows, n) for n, rows in fresh.items()}
        self._pairs(ids, touched, fresh)
        for name, rows in fresh.items():
            rows = rows.join(self.rebuilt.select("encounter_key", *PARTITION), "encounter_key")
            if self.base.version:
                gone = ids.select(F.col("encounter_id").alias("encounter_key"))
                rows = self.stored(name, touched).join(gone, "encounter_key", "left_anti").select(*rows.columns).unionByName(rows)
            self.changes[name] = self.store.write(name, rows, PARTITION, replaces=touched if self.base.version else None)
        self._quarantine(ids)

    def _pairs(self, ids: DataFrame, touched: list[str], fresh: Mapping[str, DataFrame]) -> None:
        """Totals of diagnosis and procedure pairs kept by what the changed encounters had and have.

        Built anew where a label of a known diagnosis or procedure has changed, as its rows then move between pairs.
        """
        rows = {"fact_encounters": lambda: self.rebuilt} | {n: (lambda n=n: fresh[n]) for n in BRIDGES}
        dims_now = {n: (lambda n=n: self.made[n]) for n in ("dim_diagnosis", "dim_procedure")}
        come = pair_totals(self._set(rows | dims_now))
        if PAIRS not in self.base.tables:
            self.changes[PAIRS] = self.store.write(PAIRS, come)
            return
        keys = ids.select(F.col("encounter_id").alias("encounter_key"))
        before = {n: (lambda n=n: self.stored(n, touched).join(keys, "encounter_key", "left_semi")) for n in ["fact_encounters", *BRIDGES]}
        gone = pair_totals(self._set(before | {n: (lambda n=n: self.stored(n)) for n in dims_now}))
        self.changes[PAIRS] = self.store.write(PAIRS, pair_totals_after(self.stored(PAIRS), gone, come))

    def _relabelled(self) -> bool:
        """Whether a diagnosis or procedure that pairs are kept for has another label than before."""
        return any(
            not self.stored(dim).select(key, *labels).exceptAll(self.made[dim].select(key, *labels)).isEmpty()
            for dim, key, labels in (("dim_diagnosis", "diagnosis_key", PAIR_LABELS[:2]), ("dim_procedure", "procedure_key", PAIR_LABELS[2:]))
        )

    def _set(self, makers: dict) -> TableSet:
        children = {(BRIDGES[0], "encounter_key"): "encounter_diagnoses", (BRIDGES[1], "encounter_key"): "encounter_procedures"}
        return TableSet(self.spark, makers, {place: (self.src, table, "encounter_id") for place, table in children.items()})

    def _part(self, row) -> str:
        return "/".join(f"_{c}={NO_VALUE if row[c] is None else row[c]}" for c in PARTITION)

    def _quarantine(self, ids: DataFrame) -> None:
        """Reasons of the encounters of this run that could not be loaded; earlier ones stay from their first run on."""
        now = quarantined(self.part, self.made)
        if self.base.version:
            first = self.stored(QUARANTINE).groupBy("encounter_id").agg(F.min("first_run").alias("first_run"))
            now = now.join(first, "encounter_id", "left").withColumn("first_run", F.coalesce("first_run", F.lit(self.run_id)))
            earlier = self.stored(QUARANTINE).join(ids, "encounter_id", "left_anti")
            now = earlier.unionByName(now)
        else:
            now = now.withColumn("first_run", F.lit(self.run_id))
        self.changes[QUARANTINE] = self.store.write(QUARANTINE, now.select("encounter_id", "reason", "bad_value", "first_run"))

    def run(self, log_path: str | None = None) -> Manifest:
        log = RunLog(self.spark, log_path or f"{self.store.root}/etl_logs", self.run_id, "run_daily_load")
        with log.step("Read high-water marks"):
            self.marks = self.new_marks()
        with log.step("Merge dimensions"):
            self.dimensions()
        with log.step("Merge fact and bridges"):
            self.fact_and_bridges()
        if self.base.version and self._relabelled():
            with log.step("Build pair totals anew"):
                written = {n: (lambda n=n: self._written(n, self.base)) for n in ["fact_encounters", *BRIDGES]}
                whole = self._set(written | {n: (lambda n=n: self.made[n]) for n in ("dim_diagnosis", "dim_procedure")})
                self.changes[PAIRS] = self.store.write(PAIRS, pair_totals(whole))
        with log.step("Publish version"):
            return self.store.publish(self.base, self.run_id, self.changes, self.marks)


def run_daily_load(spark: SparkSession, src: TableSet, store: VersionedStore, as_of: dt.date, run_id: str,
                   tracking: Tracking, calendar: tuple[dt.date, dt.date] | None = None) -> Manifest:
    """Merge everything changed since the store's marks and publish it; the first run loads all rows."""
    return DailyRun(spark, src, store, as_of, run_id, tracking, calendar).run()


def open_store(store: VersionedStore, version: int | None = None) -> TableSet:
    """The star schema of a version, and the quarantine."""
    manifest = store.current(version)

    def maker(name: str):
        return lambda: store.table(name, manifest=manifest).drop("patient_bucket", *(["encounter_year"] if name in BRIDGES else []))

    return TableSet(store.spark, {name: maker(name) for name in [*STAR_TABLES, QUARANTINE, PAIRS]})
