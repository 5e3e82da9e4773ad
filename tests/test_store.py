"""Versioned stores: daily runs against a full build, publishing, and streams with state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardlake.plans import daily, fact
from wardlake.plans.queries_star import pair_totals
from wardlake.plans.store import Manifest, VersionedStore
from wardlake.plans.warehouse import STAR_TABLES, derive_warehouse
from wardlake.registry import store_queries
from wardlake.session import fresh_path
from wardlake.sources import fixture
from wardlake.sources.tables import CLINICAL_SCHEMAS, TableSet
from wardlake.streaming import jobs
from wardlake.streaming.ledger import BillTotals, EventLedger

AS_OF = dt.date(2003, 1, 1)
CALENDAR = (dt.date(1998, 1, 1), dt.date(2003, 12, 31))
TRACKED = ["patients", "encounters", "billing", "encounter_diagnoses", "encounter_procedures"]
D = dt.datetime


class Hospital:
    """A small source whose rows change; every changed row gets the time of its change."""

    def __init__(self, spark, seed=2):
        self.spark, self.rng, self.now = spark, random.Random(seed), D(2002, 1, 1)
        self.tables = {
            "patients": {k: (k, "A", f"N{k}", dt.date(1950 + k, 1, 1), "F", f"MRN{k:06d}") for k in range(1, 13)},
            "specialties": {k: (k, n, "S") for k, n in enumerate(["Surgery", "Cardiology"], 1)},
            "departments": {k: (k, f"Ward {k}", 1, 5) for k in (1, 2)},
            "providers": {10: (10, "A", "B", "MD", 1, 1), 11: (11, "C", "D", "RN", 2, 2)},
            "encounters": {},
            "diagnoses": {1: (1, "I10", "Hypertension"), 2: (2, "E11.9", "Diabetes")},
            "encounter_diagnoses": {},
            "procedures": {1: (1, "70450", "CT Head")},
            "encounter_procedures": {},
            "billing": {},
        }
        self.changed = {}
        for k in range(1, 61):
            self.encounter(k)

    def put(self, table, key, row):
        self.now += dt.timedelta(seconds=1)
        self.tables[table][key] = row
        self.changed[table, key] = self.now

    def encounter(self, k):
        rng = self.rng
        start = D(1999, 10, 1) + dt.timedelta(hours=rng.randint(0, 24 * 500))
        end = rng.choice([None, start + dt.timedelta(hours=rng.randint(1, 24 * rng.choice([2, 40, 400]))), start - dt.timedelta(hours=3)])
        kind = rng.choice(["ER", "Inpatient", "Inpatient", None])
        self.put("encounters", k, (k, rng.randint(1, 14), rng.choice([10, 11, 12]), kind, start, end, 1))
        for line in range(rng.randint(0, 3)):
            self.put("encounter_diagnoses", (k, line), (10 * k + line, k, rng.choice([1, 2, 3]), line + 1))
            self.put("encounter_procedures", (k, line), (10 * k + line, k, rng.choice([1, 2]), start.date() + dt.timedelta(days=line)))
            self.put("billing", (k, line), (100 * k + line, k, f"{rng.randint(1, 900)}.50", "7.25", start.date(), "Paid"))

    def change(self, step):
        self.now += dt.timedelta(days=1)
        for _ in range(3):
            self.encounter(self.rng.randint(1, 70))
        k = self.rng.randint(1, 70)
        self.put("billing", (k, 90 + step), (100 * k + 90 + step, k, "11.00", "1.00", dt.date(2002, 1, 1), "Paid"))
        if step == 0:
            self.put("patients", 13, (13, "New", "One", dt.date(1960, 1, 1), "F", "MRN000013"))
            self.put("patients", 1, (1, "Other", "Name", dt.date(1960, 1, 1), "M", "MRN000001"))
        if step == 1:
            self.tables["diagnoses"][3] = (3, "M79.9", "New")
            self.tables["providers"][12] = (12, "E", "F", "MD", 1, 1)
        if step == 2:
            self.tables["providers"][10] = (10, "A", "B", "MD", 2, 1)
            self.tables["procedures"][2] = (2, "X", "Office Visit")
            self.tables["diagnoses"][2] = (2, "I10", "Hypertension")

    def source(self) -> TableSet:
        def maker(name):
            rows = [(*row, self.changed.get((name, key), D(2002, 1, 1))) for key, row in self.tables[name].items()]
            schema = CLINICAL_SCHEMAS[name].replace("decimal(12,2)", "string") + ", changed_at timestamp_ntz"
            df = self.spark.createDataFrame(rows, schema)
            if name == "billing":
                df = df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("claim_amount", "allowed_amount")})
            return lambda: df

        return TableSet(self.spark, {name: maker(name) for name in CLINICAL_SCHEMAS})


def tracking(buckets=3):
    return daily.Tracking({t: "changed_at" for t in TRACKED}, buckets=buckets)


def same(a, b):
    columns = sorted(b.columns)
    assert sorted(a.columns) == columns
    count = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert count(a) == count(b)


def folders(store, name):
    return {k: tuple(p["folders"]) for k, p in store.current().tables[name]["parts"].items()}


def test_daily_runs_equal_a_full_build(spark):
    place = Hospital(spark)
    store = VersionedStore(spark, fresh_path(spark, "store"))
    for step in range(4):
        src = place.source()
        version = daily.run_daily_load(spark, src, store, AS_OF, f"run-{step}", tracking(), CALENDAR)
        assert version.version == step + 1 == store.current().version
        assert version.marks["encounters"] == str(max(at for (t, _), at in place.changed.items() if t == "encounters"))
        stored, full = daily.open_store(store), derive_warehouse(src, AS_OF, CALENDAR)
        for name in STAR_TABLES if step == 3 else ["fact_encounters", *daily.BRIDGES]:
            same(stored[name], full[name])
        same(stored[daily.PAIRS], pair_totals(full))
        quarantined = {r.encounter_id for r in stored[daily.QUARANTINE].collect()}
        loaded = {r.encounter_id for r in stored["fact_encounters"].collect()}
        assert quarantined | loaded == set(place.tables["encounters"]) and not quarantined & loaded
        place.change(step)
    first = {r.encounter_id: r.first_run for r in daily.open_store(store)[daily.QUARANTINE].collect()}
    assert "run-0" in first.values()


def test_only_touched_partitions_are_written(spark):
    place = Hospital(spark)
    store = VersionedStore(spark, fresh_path(spark, "store"))
    daily.run_daily_load(spark, place.source(), store, AS_OF, "first", tracking(40), CALENDAR)
    before = {n: folders(store, n) for n in ["fact_encounters", *daily.BRIDGES]}
    # One more bill for a loaded encounter. Rows at the marks are taken up again: one of each table, of two encounters.
    loaded = sorted(r.encounter_id for r in daily.open_store(store)["fact_encounters"].collect())
    place.now += dt.timedelta(days=1)
    place.put("billing", (loaded[0], 99), (100 * loaded[0] + 99, loaded[0], "3.00", "2.00", dt.date(2002, 1, 2), "Paid"))
    changed = tracking(40)
    changed.look_back = {}
    daily.run_daily_load(spark, place.source(), store, AS_OF, "second", changed, CALENDAR)
    assert len(before["fact_encounters"]) > 10
    for name in before:
        later = folders(store, name)
        assert 1 <= len([k for k in later if later[k] != before[name].get(k)]) <= 4, name
    same(daily.open_store(store)["fact_encounters"], derive_warehouse(place.source(), AS_OF, CALENDAR)["fact_encounters"])


def test_a_failed_run_changes_nothing(spark, monkeypatch):
    place = Hospital(spark)
    store = VersionedStore(spark, fresh_path(spark, "store"))
    daily.run_daily_load(spark, place.source(), store, AS_OF, "first", tracking(), CALENDAR)
    before, rows = store.current(), daily.open_store(store)["fact_encounters"].collect()
    place.change(1)
    with monkeypatch.context() as broken:
        broken.setattr(daily.DailyRun, "_quarantine", lambda self, ids: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily.run_daily_load(spark, place.source(), store, AS_OF, "second", tracking(), CALENDAR)
    assert store.current() == before and daily.open_store(store)["fact_encounters"].collect() == rows
    log = spark.read.parquet(f"{store.root}/etl_logs")
    assert log.where("execution_id = 'second' AND status = 'FAILED'").count() == 1
    daily.run_daily_load(spark, place.source(), store, AS_OF, "second", tracking(), CALENDAR)
    same(daily.open_store(store)["fact_encounters"], derive_warehouse(place.source(), AS_OF, CALENDAR)["fact_encounters"])


def test_children_of_changed_encounters_are_derived_once(spark):
    # Diagnoses differ each time they are derived, so fact and bridge agree only if both read one derivation.
    place, any_diagnosis = Hospital(spark), F.expr("1 + CAST(java_method('java.lang.Math', 'random') < '0.5' AS BIGINT)")
    src = place.source()
    src = src.replacing(encounter_diagnoses=src["encounter_diagnoses"].withColumn("diagnosis_id", any_diagnosis))
    store = VersionedStore(spark, fresh_path(spark, "store"))
    daily.run_daily_load(spark, src, store, AS_OF, "first", tracking(), CALENDAR)
    stored = daily.open_store(store)
    first = stored["bridge_encounter_diagnoses"].where("diagnosis_sequence = 1").select("encounter_key", "diagnosis_key")
    joined = stored["fact_encounters"].join(first, "encounter_key")
    assert joined.count() > 10 and joined.where("NOT primary_diagnosis_key <=> diagnosis_key").isEmpty()
    assert joined.select("diagnosis_key").distinct().count() == 2


def test_two_runs_cannot_publish_from_one_version(spark):
    store = VersionedStore(spark, fresh_path(spark, "store"))
    rows = spark.range(4).withColumn("part", (F.col("id") % 2).cast("int"))
    base = store.current()
    one, two = store.write("t", rows, ["part"]), store.write("t", rows.where("id > 1"), ["part"])
    store.publish(base, "one", {"t": one}, {"t": "1"})
    with pytest.raises(RuntimeError, match="another run"):
        store.publish(base, "two", {"t": two}, {"t": "2"})
    assert store.table("t").count() == 4 and store.current().marks == {"t": "1"}


def test_versions_stay_readable_until_they_expire(spark):
    store = VersionedStore(spark, fresh_path(spark, "store"))
    rows = spark.range(6).withColumn("part", F.when(F.col("id") < 5, F.col("id") % 2).cast("int"))
    first = store.publish(store.current(), "one", {"t": store.write("t", rows, ["part"], {"most": F.max("id")})}, {})
    assert {k: p["extent"] for k, p in first.tables["t"]["parts"].items()}["_part=0"] == {"rows": 3, "most": 4}
    assert store.extents("t", first).where("_part IS NOT NULL").count() == 3
    second = store.publish(first, "two", {"t": store.write("t", rows.where("id < 0"), ["part"], replaces=["_part=0"])}, {})
    assert sorted(r.id for r in store.table("t").collect()) == [1, 3, 5]
    assert store.table("t", manifest=first).count() == 6
    third = second
    for run in ("three", "four"):
        third = store.publish(third, run, {"t": store.write("t", rows, ["part"])}, {})
    assert store.expire(2) == 2 and store.versions() == [3, 4]
    assert store.table("t").count() == 6 and store.expire(2) == 0


def test_appended_partitions_are_gathered(spark):
    store = VersionedStore(spark, fresh_path(spark, "store"))
    for k in range(5):
        base = store.current()
        rows = spark.range(k, k + 2).withColumn("part", F.lit(1))
        store.publish(base, f"run-{k}", {"t": store.append("t", rows, base, ["part"], most_folders=2)}, {})
        part = store.current().tables["t"]["parts"]["_part=1"]
        assert len(part["folders"]) <= 2 and part["extent"]["rows"] == 2 * k + 2
    assert sorted(r.id for r in store.table("t").collect()) == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5]
    assert Manifest() == VersionedStore(spark, fresh_path(spark, "none")).current()


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"


def test_events_are_taken_once_and_sessions_wait_for_their_timer(spark):
    at = lambda hours: D(2024, 1, 1) + dt.timedelta(hours=hours)
    batches = [
        [(1, at(0), 7, "a"), (2, at(0.5), 7, "a"), (2, at(0.5), 7, "a"), (None, at(1), 7, "a"), (3, None, 7, "a")],
        [(4, at(1.2), 7, "a"), (2, at(0.5), 7, "a"), (5, at(6), 8, "a")],
        [(6, at(4), 7, "a"), (5, at(6), 8, "a"), (7, at(5.5), 7, "a"), (8, at(12), None, "a")],
        [],
    ]
    store = VersionedStore(spark, fresh_path(spark, "ledger"))
    kept = EventLedger(store)
    for k, rows in enumerate(batches):
        for _ in range(2):
            kept.take(spark.createDataFrame(rows, EVENTS), k)
    assert store.versions() == [1, 2, 3, 4]
    ids = lambda name: sorted((r.event_id or 0, r.batch) for r in store.table(name).collect())
    assert sorted(r.event_id for r in store.table("accepted").collect()) == [1, 2, 4, 5, 7, 8]
    assert ids("late") == [(0, 0), (3, 0), (6, 2)]
    assert sorted((r.event_id, r.copies, r.batch) for r in store.table("repeated").collect()) == [(2, 1, 0), (2, 1, 1), (5, 1, 2)]
    session = lambda r: (r.user_id, r.events, r.first_at, r.last_at)
    assert sorted(map(session, store.table("sessions").collect())) == [
        (7, 1, at(5.5), at(5.5)), (7, 3, at(0), at(1.2)), (8, 1, at(6), at(6)),
    ]
    assert [r.user_id for r in store.table("open_sessions").collect()] == [None]


def test_bill_totals_take_late_bills_and_repeated_batches(spark):
    store = VersionedStore(spark, fresh_path(spark, "totals"))
    kept = BillTotals(store, buckets=4)
    bill = lambda k, claim: (k, claim, "1.00")
    batches = [[bill(1, "10.00"), bill(2, "5.00")], [bill(1, "2.50")], [bill(3, "1.00"), bill(1, None)], []]
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "encounter_id bigint, claim string, allowed string").select(
            "encounter_id", F.col("claim").cast("decimal(12,2)").alias("claim_amount"), F.col("allowed").cast("decimal(12,2)").alias("allowed_amount")
        )
        for _ in range(2):
            kept.take(df, k)
    got = {r.encounter_id: (float(r.total_claim_amount), float(r.total_allowed_amount), r.bills, r.last_batch) for r in kept.totals().collect()}
    assert got == {1: (12.5, 3.0, 3, 2), 2: (5.0, 1.0, 1, 0), 3: (1.0, 1.0, 1, 2)}
    assert {r.encounter_id for r in kept.since(1).collect()} == {1, 3}


def test_delivery_of_many_files_is_one_batch(spark, monkeypatch):
    monkeypatch.setattr(store_queries, "FEED_ROWS", 10)
    # The second delivery has fewer rows than files; the last is empty.
    deliveries = [spark.range(a, b) for a, b in ((0, 95), (100, 103), (200, 200))]
    each = store_queries.feed_files(deliveries)
    assert each == 10
    folder, progress, batches = fresh_path(spark, "feed"), fresh_path(spark, "progress"), {}
    for k, rows in enumerate(deliveries):
        store_queries.deliver(rows, folder, each)
        if k != 1:
            stream = jobs.event_stream(spark, folder, rows.schema, files_per_trigger=each)
            jobs.run_each_batch(stream, progress, lambda b, n: batches.update({n: sorted(r.id for r in b.collect())}))
    assert batches == {0: list(range(95)), 1: [100, 101, 102], 2: []}
    assert max(r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()) < 50


def test_readmissions_of_a_run_are_measured_once(spark, monkeypatch):
    place, plans, staged = Hospital(spark), {}, daily.DailyRun._staged

    def watched(self, df, label):
        plans[self.run_id, label] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(self, df, label)

    monkeypatch.setattr(daily.DailyRun, "_staged", watched)
    store = VersionedStore(spark, fresh_path(spark, "store"))
    for step in range(2):
        daily.run_daily_load(spark, place.source(), store, AS_OF, f"run-{step}", tracking(), CALENDAR)
        place.change(step)
    once = plans["run-0", "renewed"].count("Window [")
    assert once and plans["run-1", "renewed"].count("Window [") == once


def test_procedures_are_numbered_without_their_own_ids(spark):
    place = Hospital(spark)
    src = place.source()
    wh = derive_warehouse(src, AS_OF, CALENDAR)
    links = src["encounter_procedures"]
    links = links.unionByName(links.withColumn("encounter_procedure_id", F.col("encounter_procedure_id") + 10**6))
    bridge = lambda rows: fact.bridge_procedures(rows, wh["fact_resolved"], wh["dim_procedure"], [])
    numbered = bridge(links.drop("encounter_procedure_id"))
    assert numbered.count() > 10
    last = numbered.groupBy("encounter_key").agg(F.count("*").alias("n"), F.countDistinct("procedure_sequence").alias("d"), F.max("procedure_sequence").alias("m"))
    assert last.where("n <> d OR n <> m").isEmpty()
    same(numbered, bridge(links))


def test_kept_tables_of_a_source_are_derived_once(spark):
    src = Hospital(spark).source()
    src = src.replacing(encounter_diagnoses=src["encounter_diagnoses"].withColumn("mark", F.expr("java_method('java.lang.Math', 'random')")))
    kept = fixture.kept(src, "encounter_diagnoses")
    assert kept["encounter_diagnoses"].count() == src["encounter_diagnoses"].count() > 10
    same(kept["encounter_diagnoses"], kept["encounter_diagnoses"])
    assert kept["patients"] is not None and kept["encounter_diagnoses"].schema.simpleString() == src["encounter_diagnoses"].schema.simpleString()
