import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from wardlake.plans import fact, incremental, load, queries_source, queries_star, validate
from wardlake.plans.fact import encounter_analytics
from wardlake.plans.warehouse import derive_warehouse, open_warehouse
from wardlake.session import fresh_path
from wardlake.sources.fixture import CALENDAR, CLINICAL_AS_OF, clinical_tables
from wardlake.sources.tables import CLINICAL_SCHEMAS, TableSet

AS_OF = dt.date(2001, 1, 1)
YEAR = (dt.date(2000, 1, 1), dt.date(2000, 12, 31))
D = dt.datetime


def at(day, hour=0, minute=0):
    return D(2000, 1, 1, hour, minute) + dt.timedelta(days=day)


ROWS = {
    "patients": [
        (1, "Ann", "Lee", dt.date(1950, 1, 1), "F", "MRN000001"),
        (2, None, "Poe", dt.date(2000, 6, 1), "X", "MRN000002"),
        (3, "Bo", "Ray", dt.date(2002, 1, 1), "M", "bad"),
    ],
    "specialties": [(1, "General Surgery", "SURG"), (2, "Internal Medicine", "x1")],
    "departments": [(1, "Internal Medicine", 1, 20), (2, "Outpatient Clinic", 2, 10), (3, "Ward", 3, 5)],
    "providers": [(10, "A", "B", "MD", 1, 1), (11, "C", "D", "RN", 9, 1)],
    "encounters": [
        (100, 1, 10, "Inpatient", at(0), at(2), 3),
        (101, 1, 10, "ER", at(32), at(33), 3),  # exactly 30 days after the first discharge
        (102, 1, 10, "Outpatient", at(40), None, 3),
        (103, 2, 10, "Inpatient", at(10), at(9), 3),  # discharged before the encounter, born later
        (104, 1, 10, None, at(50), at(51), 3),  # no type
        (105, 9, 10, "ER", at(50), at(51), 3),  # unknown patient
        (106, 1, 11, "ER", at(50), at(51), 3),  # provider without a known specialty
    ],
    "diagnoses": [(1, "I10", "Hypertension"), (2, "zz", "Fracture")],
    "encounter_diagnoses": [(1, 100, 2, 2), (2, 100, 1, 1), (3, 101, 2, 1)],
    "procedures": [(1, "70450", "CT Head"), (2, "X", "Office Visit")],
    "encounter_procedures": [(1, 100, 2, dt.date(2000, 1, 2)), (2, 100, 1, dt.date(2000, 1, 1))],
    "billing": [
        (1, 100, "100.00", "80.00", dt.date(2000, 1, 5), "Paid"),
        (2, 100, "50.50", "0.25", dt.date(2000, 1, 6), "Paid"),
        (3, 101, "0.00", "0.00", dt.date(2000, 2, 5), "Paid"),
    ],
}


@pytest.fixture
def src(spark):
    def maker(name):
        schema = CLINICAL_SCHEMAS[name]
        if name != "billing":
            return lambda: spark.createDataFrame(ROWS[name], schema)
        text = schema.replace("decimal(12,2)", "string")
        return lambda: spark.createDataFrame(ROWS[name], text).withColumns(
            {c: F.col(c).cast("decimal(12,2)") for c in ("claim_amount", "allowed_amount")}
        )

    return TableSet(spark, {name: maker(name) for name in CLINICAL_SCHEMAS})


@pytest.fixture
def wh(src):
    return derive_warehouse(src, AS_OF, YEAR)


def test_fact_sums_bills_and_leaves_out_unresolved_rows(wh):
    fact = {r.encounter_id: r for r in wh["fact_encounters"].collect()}
    assert sorted(fact) == [100, 101, 102, 103]
    first = fact[100]
    assert (float(first.total_claim_amount), float(first.total_allowed_amount)) == (150.5, 80.25)
    assert (first.diagnosis_count, first.procedure_count, first.primary_diagnosis_key) == (2, 2, 1)
    assert (first.length_of_stay_hours, first.encounter_date_key, first.discharge_date_key) == (48, 20000101, 20000103)
    assert (first.department_key, first.encounter_department_key) == (1, 3)


def test_readmission_columns(wh):
    fact = {r.encounter_id: r for r in wh["fact_encounters"].collect()}
    assert (fact[100].has_30day_readmission, fact[100].days_to_readmission, fact[100].readmission_count_30days) == (True, 30, 1)
    assert (fact[101].has_30day_readmission, fact[101].days_to_readmission, fact[101].is_readmission) == (True, 7, True)
    # Without a discharge the defaults stay; a stay that ends before it starts is not its own return.
    assert (fact[102].has_30day_readmission, fact[102].days_to_readmission, fact[102].is_readmission) == (False, None, False)
    assert (fact[103].has_30day_readmission, fact[103].is_readmission) == (False, False)


def test_dimension_labels(wh):
    assert {r.specialty_name: r.specialty_category for r in wh["dim_specialty"].collect()} == {
        "General Surgery": "Surgical",
        "Internal Medicine": "Medical",
    }
    kinds = {r.department_name: (r.department_type, r.cost_center_code) for r in wh["dim_department"].collect()}
    assert kinds == {
        "Internal Medicine": ("Emergency", "CC0001"),  # "er" occurs in the word
        "Outpatient Clinic": ("Outpatient", "CC0002"),
        "Ward": ("Inpatient", "CC0003"),
    }
    patients = {r.patient_id: r for r in wh["dim_patient"].collect()}
    assert (patients[1].full_name, patients[1].current_age, patients[1].age_group) == ("Ann Lee", 51, "36-60")
    assert patients[2].full_name is None
    assert [r.provider_id for r in wh["dim_provider"].collect()] == [10]
    assert {r.cpt_code: r.duration_minutes for r in wh["dim_procedure"].collect()} == {"70450": 45, "X": 30}


def test_bridges(wh):
    assert sorted((r.encounter_key, r.procedure_key, r.procedure_sequence) for r in wh["bridge_encounter_procedures"].collect()) == [
        (100, 1, 1),
        (100, 2, 2),
    ]
    assert wh["bridge_encounter_diagnoses"].count() == 3


def test_rate_is_zero_without_a_claim(wh):
    rates = {r.encounter_id: r.reimbursement_rate_percent for r in encounter_analytics(wh).collect()}
    assert rates[101] == 0.0 and rates[100] == pytest.approx(80.25 / 150.5 * 100, abs=1e-6)


def test_validation_finds_every_bad_row(src, wh):
    issues = {(r.table_name, r.column_name, r.issue_type): r.affected_rows for r in validate.validate(src, wh, AS_OF).collect()}
    assert issues == {
        ("dim_patient", "date_of_birth", "INVALID_DATE_RANGE"): 1,
        ("dim_patient", "gender", "INVALID_VALUES"): 1,
        ("fact_encounters", "discharge_datetime", "INVALID_DATE_LOGIC"): 1,
        ("fact_encounters", "encounter_datetime", "INVALID_DATE_LOGIC"): 1,
        ("dim_diagnosis", "icd10_code", "INVALID_FORMAT"): 1,
        ("dim_procedure", "cpt_code", "INVALID_FORMAT"): 1,
    }
    outcome = validate.verdict(validate.validate(src, wh, AS_OF)).first()
    assert (outcome.critical_issues, outcome.validation_errors, outcome.validation_warnings, outcome.status) == (1, 2, 3, "FAILED")


def test_validation_of_a_broken_warehouse(spark, src, wh):
    fact = wh["fact_encounters"]
    broken = wh.replacing(
        dim_patient=wh["dim_patient"].where("patient_id <> 1").unionByName(wh["dim_patient"].where("patient_id = 3")),
        dim_diagnosis=wh["dim_diagnosis"].drop("icd10_description"),
        dim_department=wh["dim_department"].withColumn("floor", F.col("floor").cast("string")),
        fact_encounters=fact.withColumn("provider_key", F.when(F.col("encounter_id") == 100, None).otherwise(F.col("provider_key"))),
    )
    tables = TableSet(spark, {n: (lambda n=n: broken[n]) for n in broken if n != "dim_date"})
    found = {(r.table_name, r.column_name, r.issue_type): r.affected_rows for r in validate.validate(src, tables, AS_OF).collect()}
    for key, rows in {
        ("dim_date", None, "TABLE_MISSING"): 0,
        ("dim_diagnosis", "icd10_description", "COLUMN_MISSING"): 0,
        ("dim_department", "floor", "TYPE_MISMATCH"): 0,
        ("fact_encounters", "provider_key", "NULL_VIOLATION"): 1,
        ("dim_patient", "patient_id", "DUPLICATES"): 1,
        ("fact_encounters", "patient_key", "ORPHANED_REFERENCE"): 3,
        ("fact_encounters", "provider_key", "ORPHANED_REFERENCE"): 1,
    }.items():
        assert found.get(key) == rows, key


def test_quarantine_names_every_reason(src, wh):
    reasons = {(r.encounter_id, r.reason) for r in incremental.quarantined(src, wh).collect()}
    assert reasons == {(104, "UNKNOWN_ENCOUNTER_TYPE"), (105, "UNKNOWN_PATIENT"), (106, "UNKNOWN_PROVIDER")}


def test_calendar_must_be_a_range(spark, src):
    with pytest.raises(ValueError):
        derive_warehouse(src, AS_OF, (YEAR[1], YEAR[0]))["dim_date"]


def test_stored_load_equals_the_derived_tables_and_repeats(spark, small):
    src = clinical_tables(spark, small)
    derived = derive_warehouse(src, CLINICAL_AS_OF, CALENDAR)
    folder = fresh_path(spark, "warehouse")
    for run in ("run-1", "run-2"):
        load.run_warehouse_load(spark, src, folder, CLINICAL_AS_OF, run, CALENDAR)
    stored = open_warehouse(spark, folder)
    for name in ("fact_encounters", "bridge_encounter_procedures", "dim_provider"):
        columns = sorted(derived[name].columns)
        assert sorted(stored[name].columns) == columns
        a, b = derived[name].select(*columns), stored[name].select(*columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_late_bills_are_merged_twice_with_one_result(spark, src, wh):
    stored = wh["fact_encounters"].withColumns({c: F.lit(0).cast("decimal(22,2)") for c in ("total_claim_amount", "total_allowed_amount")})
    once = incremental.apply_late_billing(stored, src["billing"], dt.date(2000, 1, 8))
    twice = incremental.apply_late_billing(once, src["billing"], dt.date(2000, 1, 8))
    totals = lambda df: {r.encounter_id: float(r.total_claim_amount) for r in df.collect()}
    assert totals(once) == totals(twice) == {100: 150.5, 101: 0.0, 102: 0.0, 103: 0.0}


def test_slices_do_not_change_any_table(spark, small):
    """Every patient and encounter treated as if it held too many rows for one task."""
    plain, cut = clinical_tables(spark, small), clinical_tables(spark, small)
    patients = [r[0] for r in plain["patients"].select("patient_id").collect()]
    encounters = [r[0] for r in plain["encounters"].select("encounter_id").collect()]
    cut._hot = {
        ("encounters", "patient_id"): patients,
        ("encounter_procedures", "encounter_id"): encounters,
        ("encounter_diagnoses", "encounter_id"): encounters,
    }
    a, b = (derive_warehouse(s, CLINICAL_AS_OF, CALENDAR) for s in (plain, cut))
    for table in ("fact_readmission", "bridge_encounter_procedures"):
        assert a[table].exceptAll(b[table]).count() == 0 and b[table].exceptAll(a[table]).count() == 0
    for query in (
        lambda w: queries_star.all_pairs(w),
        lambda w: queries_star.readmission_risk(w, CLINICAL_AS_OF, min_discharges=1),
        lambda w: queries_star.calendar_day_returns(w, with_all_stays=True),
    ):
        assert query(a).collect() == query(b).collect()


def test_stored_flags_agree_with_the_source_question(spark, small):
    """Inpatient stays with a later visit, from the source tables and from the fact."""
    src = clinical_tables(spark, small)
    flags = queries_star.inpatient_readmission_from_flags(derive_warehouse(src, CLINICAL_AS_OF, CALENDAR)).collect()
    rates = {r.specialty_name: r.total_discharges for r in queries_source.inpatient_return_rates(src).collect()}
    assert {r.specialty_name: r.total_inpatient_discharges for r in flags} == rates


def test_backfilled_months_measure_readmissions_over_their_borders(spark):
    path = fresh_path(spark, "backfill")
    moment = lambda text: dt.datetime.fromisoformat(text)
    rows = [
        (1, 7, moment("2000-01-28 08:00:00"), moment("2000-01-30 08:00:00"), 2000),
        (2, 7, moment("2000-02-10 08:00:00"), moment("2000-02-11 08:00:00"), 2000),
        (3, 7, moment("2000-06-01 08:00:00"), None, 2000),
        (4, 8, moment("2000-12-30 08:00:00"), moment("2000-12-31 08:00:00"), 2000),
        (5, 8, moment("2001-01-05 08:00:00"), moment("2001-01-06 08:00:00"), 2001),
    ]
    schema = "encounter_id bigint, patient_key bigint, encounter_datetime timestamp_ntz, discharge_datetime timestamp_ntz, encounter_year int"
    base = spark.createDataFrame(rows, schema)
    months = [dt.date(2000, m, 1) for m in range(1, 13)] + [dt.date(2001, 1, 1), dt.date(2001, 2, 1)]
    slices = list(zip(months, months[1:]))
    for order in (slices, slices[::-1], slices[:1]):
        load.backfill_slices(spark, base, order, path, [])
        got = {r.encounter_id: (r.has_30day_readmission, r.is_readmission) for r in spark.read.parquet(path).collect()}
        assert got == {1: (True, False), 2: (False, True), 3: (False, False), 4: (True, False), 5: (False, True)}
    with pytest.raises(ValueError):
        load.backfill_slices(spark, base, [(dt.date(2000, 1, 15), dt.date(2000, 2, 1))], path, [])


def test_backfill_derives_the_visits_once(spark):
    # The mark differs each time the visits are derived; the same slice, loaded twice, must meet the same marks.
    base = spark.range(20).selectExpr(
        "id AS encounter_id", "id % 3 AS patient_key", "make_timestamp_ntz(2000, 1, 1 + CAST(id AS INT), 0, 0, 0) AS encounter_datetime",
        "make_timestamp_ntz(2000, 1, 2 + CAST(id AS INT), 0, 0, 0) AS discharge_datetime", "2000 AS encounter_year",
        "java_method('java.lang.Math', 'random') AS mark",
    )
    seen = []
    finish = lambda own: seen.append(sorted(map(tuple, own.select("encounter_id", "mark").collect()))) or own
    january = (dt.date(2000, 1, 1), dt.date(2000, 2, 1))
    load.backfill_slices(spark, base, [january, january], fresh_path(spark, "backfill"), [], finish)
    assert len(seen) == 2 and len(seen[0]) == 20 and seen[0] == seen[1]


def test_backfilled_slices_equal_one_measurement(spark):
    """Stays longer than a slice, ends before starts, missing ends and repeated times, cut at every month."""
    rng = random.Random(11)
    rows = []
    for i in range(600):
        start = dt.datetime(2000, 1, 1) + dt.timedelta(hours=rng.randint(0, 24 * 364))
        end = rng.choice([None, start + dt.timedelta(days=rng.choice([0, 1, 3, 29, 30, 31, 90])), start - dt.timedelta(days=rng.choice([2, 45, 100]))])
        rows.append((i, rng.randint(1, 25), start, end, start.year))
    schema = "encounter_id bigint, patient_key bigint, encounter_datetime timestamp_ntz, discharge_datetime timestamp_ntz, encounter_year int"
    base = spark.createDataFrame(rows, schema)
    path = fresh_path(spark, "backfill")
    months = [dt.date(2000, m, 1) for m in (1, 2, 5, 6, 9, 12)] + [dt.date(2001, 1, 1)]
    load.backfill_slices(spark, base, list(zip(months, months[1:])), path, [])
    whole = fact.with_readmissions(base, fact.readmission_measures(base, []))
    loaded = spark.read.parquet(path).select(whole.columns)
    assert loaded.exceptAll(whole).isEmpty() and whole.exceptAll(loaded).isEmpty()



def test_full_run_records_its_outcome_and_reports_from_storage(spark, small, monkeypatch):
    src, folder = clinical_tables(spark, small), fresh_path(spark, "warehouse")
    history = load.run_everything(spark, src, folder, CLINICAL_AS_OF, "run-1", CALENDAR).collect()
    assert {(r.export_type, r.export_status) for r in history} >= {("LOGS", "SUCCESS"), ("SUMMARY", "SUCCESS")}
    assert all(r.file_size_bytes > 0 and r.export_duration_ms > 0 for r in history)
    report = json.loads(load.stored_report(spark, folder).first()[0])
    assert list(report) == ["validation_summary", "data_quality_issues", "schema_validation_results", "performance_metrics"]
    assert {m["operation"] for m in report["performance_metrics"]} >= {"Populate fact_encounters", "Validate warehouse"}
    assert all(i["timestamp"] for i in report["data_quality_issues"])

    def refuse(*_):
        raise RuntimeError("no validation")

    monkeypatch.setattr(load, "validate", refuse)
    with pytest.raises(RuntimeError, match="no validation"):
        load.run_everything(spark, src, folder, CLINICAL_AS_OF, "run-2", CALENDAR)
    ended = spark.read.parquet(f"{folder}/audit_log").where("event_type_code = 'ETL_EXECUTION'").orderBy("event_timestamp").collect()
    assert [(r.success, r.error_message) for r in ended] == [(True, None), (False, "no validation")]
    assert json.loads(load.stored_report(spark, folder, "run-1").first()[0]) == report
