"""Registered single operators: predicates, joins, aggregates, windows, sorts, scalar functions.

Each runs over whole tables, so that an operator can be checked apart from the questions that use it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.operators.intervals import returns_within
from wardlake.operators.skew import sequence_within, tally, union_all
from wardlake.plans import dims, fact
from wardlake.plans.exports import document_pages
from wardlake.plans.queries_source import RETURN_TYPES, provider_specialties
from wardlake.plans.validate import CPT_PATTERN
from wardlake.registry.check_queries import logs, page_sql, snapshots
from wardlake.registry.oracle_base import div, key_of, pct, rnd
from wardlake.registry.warehouse_queries import AS_OF, source, star

HORIZON = fact.READMISSION_DAYS * C.MICROS_PER_DAY


def on_source(query):
    return lambda spark, sf_dir: query(source(spark, sf_dir))


def on_star(query):
    return lambda spark, sf_dir: query(star(spark, sf_dir))


def on_logs(query):
    return lambda spark, sf_dir: query(logs(spark, sf_dir))


# Projections, filters, predicates -------------------------------------------------------------------------------------

PREDICATES = {
    "a02_calendar_rows": (
        lambda spark, sf_dir: source(spark, sf_dir)["encounters"]
        .agg(F.min(F.to_date("encounter_date")).alias("a"), F.max(F.to_date("encounter_date")).alias("b"))
        .select(F.explode(F.sequence("a", "b")).alias("calendar_date")),
        """SELECT CAST(unnest(generate_series(CAST(min(encounter_date) AS DATE)::TIMESTAMP, CAST(max(encounter_date) AS DATE)::TIMESTAMP,
                  INTERVAL 1 DAY)) AS DATE) AS calendar_date FROM encounters""",
    ),
    "b01_projection": (
        on_source(lambda s: s["patients"].select(F.col("patient_id").alias("id"), F.col("mrn").alias("record_number"))),
        "SELECT patient_id AS id, mrn AS record_number FROM patients",
    ),
    "b02_case_when": (
        on_source(
            lambda s: s["encounters"].select(
                "encounter_id", C.label_by_value(F.col("encounter_type"), dims.TYPE_HOURS, dims.TYPE_HOURS_DEFAULT).alias("hours")
            )
        ),
        """SELECT encounter_id, CASE WHEN encounter_type = 'Inpatient' THEN 48 WHEN encounter_type IN ('ER', 'Emergency') THEN 4
                                     ELSE 2 END AS hours FROM encounters""",
    ),
    "b03_equality_and_in": (
        on_source(
            lambda s: s["encounters"]
            .where(F.col("encounter_type").isin(*RETURN_TYPES) | (F.col("encounter_type") == "Outpatient"))
            .select("encounter_id", "encounter_type")
        ),
        "SELECT encounter_id, encounter_type FROM encounters WHERE encounter_type IN ('Inpatient', 'ER') OR encounter_type = 'Outpatient'",
    ),
    "b04_not_in_with_null_guard": (
        on_source(
            lambda s: s["patients"]
            .where(F.col("first_name").isNotNull() & ~F.col("first_name").isin("BUILDING", "MACHINERY"))
            .select("patient_id", "first_name")
        ),
        "SELECT patient_id, first_name FROM patients WHERE first_name NOT IN ('BUILDING', 'MACHINERY')",
    ),
    "b05_null_tests": (
        on_source(
            lambda s: s["encounters"]
            .where(F.col("discharge_date").isNull() & F.col("encounter_type").isNotNull())
            .select("encounter_id", "encounter_type")
        ),
        "SELECT encounter_id, encounter_type FROM encounters WHERE discharge_date IS NULL AND encounter_type IS NOT NULL",
    ),
    "b06_like_prefix": (
        on_source(
            lambda s: s["encounter_diagnoses"]
            .join(s["diagnoses"].where(F.col("icd10_code").like("I%")), "diagnosis_id")
            .select("encounter_id", "diagnosis_sequence", "icd10_code")
        ),
        """SELECT encounter_id, diagnosis_sequence, icd10_code FROM encounter_diagnoses JOIN diagnoses USING (diagnosis_id)
           WHERE icd10_code LIKE 'I%'""",
    ),
    "b07_ilike_contains": (
        on_source(lambda s: s["departments"].where(F.col("department_name").ilike("%er%")).select("department_id", "department_name")),
        "SELECT department_id, department_name FROM departments WHERE department_name ILIKE '%er%'",
    ),
    "b08_regex_mismatch": (
        on_source(
            lambda s: s["encounter_procedures"]
            .join(s["procedures"].where(~F.col("cpt_code").rlike(CPT_PATTERN)), "procedure_id")
            .select("encounter_id", "cpt_code", "procedure_date")
        ),
        f"""SELECT encounter_id, cpt_code, procedure_date FROM encounter_procedures JOIN procedures USING (procedure_id)
           WHERE NOT regexp_matches(cpt_code, '{CPT_PATTERN}')""",
    ),
    "b09_date_range": (
        on_source(
            lambda s: s["encounters"]
            .where(F.col("encounter_date").between(C.moment(dt.datetime(2000, 8, 1)), C.moment(dt.datetime(2001, 8, 1))))
            .select("encounter_id", "encounter_date")
        ),
        """SELECT encounter_id, encounter_date FROM encounters
           WHERE encounter_date BETWEEN TIMESTAMP '2000-08-01' AND TIMESTAMP '2001-08-01'""",
    ),
    "b10_is_distinct_from": (
        lambda spark, sf_dir: (lambda old, new: old.alias("o").join(new.alias("n"), "patient_id")
        .where(~F.col("o.gender").eqNullSafe(F.col("n.gender")))
        .select("patient_id", F.col("o.gender").alias("old_gender"), F.col("n.gender").alias("new_gender")))(*snapshots(spark, sf_dir, "patients")),
        "SELECT patient_id, p.gender AS old_gender, n.gender AS new_gender FROM patients p JOIN later_patients n USING (patient_id) WHERE p.gender IS DISTINCT FROM n.gender",
    ),
    "b11_optional_filter": (
        on_logs(
            lambda t: union_all(
                [
                    (t["audit_log"] if p is None else t["audit_log"].where(F.col("patient_id") == p))
                    .agg(F.count("*").alias("events"))
                    .select(F.lit(p).cast("bigint").alias("patient_id"), "events")
                    for p in (None, 42)
                ]
            )
        ),
        """SELECT NULL::BIGINT AS patient_id, count(*) AS events FROM audit_log
           UNION ALL SELECT 42, count(*) FROM audit_log WHERE patient_id = 42""",
    ),
    "b12_distinct": (
        on_source(lambda s: s["encounters"].select("encounter_type", "department_id").distinct()),
        "SELECT DISTINCT encounter_type, department_id FROM encounters",
    ),
}

# Joins ----------------------------------------------------------------------------------------------------------------


def _visits(s, is_index, is_return):
    return s["encounters"].select(
        F.col("patient_id").alias("patient"),
        F.col("encounter_id").alias("visit"),
        C.epoch_micros(F.col("encounter_date")).alias("start_at"),
        C.epoch_micros(F.col("discharge_date")).alias("end_at"),
        F.coalesce(is_index, F.lit(False)).alias("is_index"),
        F.coalesce(is_return, F.lit(False)).alias("is_return"),
    )


def _returns(s, keep_all):
    """Returns per discharge; the inner form keeps only discharges with a return."""
    found = returns_within(_visits(s, F.lit(True), F.lit(True)), HORIZON, s.hot_keys("encounters", "patient_id"))
    found = found if keep_all else found.where(F.col("returns") > 0)
    return found.select(
        F.col("visit").alias("encounter_id"),
        "returns",
        F.floor((F.col("first_return") - F.col("end_at")) / C.MICROS_PER_DAY).cast("int").alias("days_to_first"),
        "is_return_visit",
    )


BACK = """
SELECT r.*, coalesce(k.back, FALSE) AS is_return_visit FROM ({rows}) r
LEFT JOIN (SELECT DISTINCT x.encounter_id, TRUE AS back FROM encounters x JOIN encounters y ON x.patient_id = y.patient_id
             AND x.encounter_id <> y.encounter_id AND x.encounter_date > y.discharge_date
             AND x.encounter_date <= y.discharge_date + INTERVAL 30 DAY) k USING (encounter_id)"""
PLAIN_RETURNS = """
SELECT a.encounter_id, count(b.encounter_id) AS returns,
       CAST(min((epoch_us(b.encounter_date) - epoch_us(a.discharge_date)) // 86400000000) AS INT) AS days_to_first
FROM encounters a {kind} JOIN encounters b ON a.patient_id = b.patient_id AND b.encounter_date > a.discharge_date
     AND b.encounter_date <= a.discharge_date + INTERVAL 30 DAY AND b.encounter_id <> a.encounter_id
WHERE a.discharge_date IS NOT NULL GROUP BY a.encounter_id"""

JOINS = {
    "c01_fact_dimension_chain": (
        on_star(
            lambda w: w["fact_resolved"]
            .join(w["dim_specialty"].select("specialty_key", "specialty_name"), "specialty_key")
            .join(w["dim_department"].select("department_key", "department_type"), "department_key")
            .select("encounter_id", "specialty_name", "department_type")
        ),
        """SELECT encounter_id, specialty_name, department_type FROM resolved JOIN dim_specialty USING (specialty_key)
           JOIN dim_department USING (department_key)""",
    ),
    "c02_source_chain": (
        on_source(lambda s: s["encounters"].join(provider_specialties(s), "provider_id").select("encounter_id", "specialty_name")),
        "SELECT encounter_id, specialty_name FROM encounters JOIN providers USING (provider_id) JOIN specialties USING (specialty_id)",
    ),
    "c03_left_join_aggregated_child": (
        on_source(
            lambda s: s["encounters"]
            .join(fact.billing_totals(s["billing"]), "encounter_id", "left")
            .select("encounter_id", F.coalesce(F.col("total_claim_amount").cast("double"), F.lit(0.0)).alias("claims"))
        ),
        """SELECT encounter_id, coalesce(CAST(n AS DOUBLE), 0) AS claims FROM encounters
           LEFT JOIN (SELECT encounter_id, sum(claim_amount) AS n FROM billing GROUP BY 1) b USING (encounter_id)""",
    ),
    "c05_interval_left_join": (on_source(lambda s: _returns(s, True).drop("is_return_visit")), PLAIN_RETURNS.format(kind="LEFT")),
    "c06_interval_inner_join": (on_source(lambda s: _returns(s, False).drop("is_return_visit")), PLAIN_RETURNS.format(kind="")),
    "c07_interval_existence": (
        on_source(lambda s: _returns(s, True).select("encounter_id", "is_return_visit")),
        "SELECT encounter_id, is_return_visit FROM (" + BACK.format(rows=PLAIN_RETURNS.format(kind="LEFT")) + ") t",
    ),
    "c08_correlated_min_and_count": (
        on_source(lambda s: _returns(s, True)),
        BACK.format(rows=PLAIN_RETURNS.format(kind="LEFT")),
    ),
    "c09_first_child_lookup": (
        on_source(
            lambda s: s["encounters"]
            .select("encounter_id")
            .join(
                s["encounter_diagnoses"]
                .where(F.col("diagnosis_sequence") == 1)
                .groupBy("encounter_id")
                .agg(F.min("diagnosis_id").alias("diagnosis_id")),
                "encounter_id",
                "left",
            )
        ),
        """SELECT encounter_id, min(diagnosis_id) FILTER (diagnosis_sequence = 1) AS diagnosis_id
           FROM encounters LEFT JOIN encounter_diagnoses USING (encounter_id) GROUP BY 1""",
    ),
    "c10_anti_join": (
        on_source(lambda s: s["encounters"].join(s["billing"].select("encounter_id"), "encounter_id", "left_anti").select("encounter_id")),
        "SELECT encounter_id FROM encounters WHERE encounter_id NOT IN (SELECT encounter_id FROM billing)",
    ),
    "c11_theta_after_equi_join": (
        on_source(
            lambda s: s["billing"]
            .join(s["encounters"].select("encounter_id", "discharge_date"), "encounter_id")
            .where(F.col("claim_date") <= F.to_date("discharge_date"))
            .select("encounter_id", "claim_date", "discharge_date")
        ),
        """SELECT encounter_id, claim_date, discharge_date FROM billing JOIN encounters USING (encounter_id)
           WHERE claim_date <= CAST(discharge_date AS DATE)""",
    ),
    "c12_full_outer_compare": (
        lambda spark, sf_dir: (lambda old, new: old.select("patient_id", F.lit(1).alias("was"))
        .join(new.select("patient_id", F.lit(1).alias("now")), "patient_id", "full_outer"))(*snapshots(spark, sf_dir, "patients")),
        """SELECT patient_id, a.was, b.now FROM (SELECT patient_id, 1 AS was FROM patients) a
           FULL JOIN (SELECT patient_id, 1 AS now FROM later_patients) b USING (patient_id)""",
    ),
    "c13_calendar_join": (
        on_star(
            lambda w: w["fact_resolved"]
            .select("encounter_id", F.to_date("encounter_datetime").alias("calendar_date"))
            .join(w["dim_date"].select("calendar_date", "date_key", "fiscal_quarter"), "calendar_date")
        ),
        """SELECT encounter_id, CAST(encounter_datetime AS DATE) AS calendar_date, date_key, fiscal_quarter
           FROM resolved JOIN dim_date ON calendar_date = CAST(encounter_datetime AS DATE)""",
    ),
}

# Aggregates -----------------------------------------------------------------------------------------------------------

AGGREGATES = {
    "d01_basic_aggregates": (
        on_source(
            lambda s: s["billing"].groupBy("claim_status").agg(
                F.count("*").alias("bills"),
                F.sum("claim_amount").cast("double").alias("claims"),
                C.rounded(C.mean(F.sum("claim_amount"), F.count("claim_amount")), 6).alias("mean_claim"),
                F.min("claim_date").alias("first_day"),
                F.max("claim_date").alias("last_day"),
            )
        ),
        f"""SELECT claim_status, count(*) AS bills, CAST(sum(claim_amount) AS DOUBLE) AS claims,
                   {rnd(div('sum(claim_amount)', 'count(claim_amount)'), 6)} AS mean_claim, min(claim_date) AS first_day,
                   max(claim_date) AS last_day FROM billing GROUP BY 1""",
    ),
    "d02_count_distinct": (
        on_source(lambda s: s["encounters"].groupBy("department_id").agg(F.countDistinct("patient_id").alias("patients"))),
        "SELECT department_id, count(DISTINCT patient_id) AS patients FROM encounters GROUP BY 1",
    ),
    "d03_conditional_count": (
        on_source(
            lambda s: s["encounters"].groupBy("department_id").agg(
                F.count(F.when(F.col("encounter_type") == "Inpatient", 1)).alias("inpatient")
            )
        ),
        "SELECT department_id, count(CASE WHEN encounter_type = 'Inpatient' THEN 1 END) AS inpatient FROM encounters GROUP BY 1",
    ),
    "d04_conditional_distinct": (
        on_source(
            lambda s: s["encounters"].groupBy("department_id").agg(
                F.countDistinct(F.when(F.col("encounter_type").isin(*RETURN_TYPES), F.col("patient_id"))).alias("patients")
            )
        ),
        """SELECT department_id, count(DISTINCT patient_id) FILTER (encounter_type IN ('Inpatient', 'ER')) AS patients
           FROM encounters GROUP BY 1""",
    ),
    "d05_conditional_sum": (
        on_star(
            lambda w: w["fact_readmission"].agg(
                F.sum(F.when(F.col("has_30day_readmission"), 1).otherwise(0)).alias("readmitted"),
                F.sum(F.when(F.col("is_readmission"), F.col("readmission_count_30days"))).alias("chained"),
            )
        ),
        """SELECT count(*) FILTER (has_30day_readmission) AS readmitted,
                  CAST(sum(readmission_count_30days) FILTER (is_readmission) AS BIGINT) AS chained FROM readmission""",
    ),
    "d06_filtered_counts": (
        on_logs(
            lambda t: t["etl_execution_log"].groupBy("procedure_name").agg(
                *tally({"completed": F.col("status") == "COMPLETED", "failed": F.col("status") == "FAILED"})
            )
        ),
        """SELECT procedure_name, count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'FAILED') AS failed
           FROM etl_execution_log GROUP BY 1""",
    ),
    "d07_conditional_average": (
        on_star(
            lambda w: w["fact_readmission"].groupBy("is_readmission").agg(
                C.rounded(F.avg(F.when(F.col("has_30day_readmission"), F.col("days_to_readmission"))), 1).alias("mean_days")
            )
        ),
        f"""SELECT is_readmission, {rnd('avg(days_to_readmission) FILTER (has_30day_readmission)', 1)} AS mean_days
            FROM readmission GROUP BY 1""",
    ),
    "d08_having": (
        on_source(
            lambda s: s["encounters"].groupBy("patient_id").agg(F.count("*").alias("visits")).where(F.col("visits") >= 15)
        ),
        "SELECT patient_id, count(*) AS visits FROM encounters GROUP BY 1 HAVING count(*) >= 15",
    ),
    "d09_two_level_aggregate": (
        on_source(
            lambda s: fact.billing_totals(s["billing"])
            .join(s["encounters"].select("encounter_id", "department_id"), "encounter_id")
            .groupBy("department_id")
            .agg(F.max("total_claim_amount").cast("double").alias("largest"), F.count("*").alias("billed"))
        ),
        """SELECT department_id, CAST(max(claims) AS DOUBLE) AS largest, count(*) AS billed
           FROM (SELECT encounter_id, sum(claim_amount) AS claims FROM billing GROUP BY 1) b JOIN encounters USING (encounter_id)
           GROUP BY 1""",
    ),
    "d10_guarded_ratio": (
        on_source(
            lambda s: s["encounters"].groupBy("patient_id").agg(
                C.percent(F.count_if(F.col("encounter_type") == "ER"), F.count_if(F.col("encounter_type").isin(*RETURN_TYPES)), 2).alias("er_share")
            )
        ),
        f"""SELECT patient_id, {pct("count(*) FILTER (encounter_type = 'ER')", "count(*) FILTER (encounter_type IN ('Inpatient', 'ER'))", 2)} AS er_share
            FROM encounters GROUP BY 1""",
    ),
    "d11_group_by_expression": (
        on_source(
            lambda s: s["encounters"].groupBy(C.month_label(F.col("encounter_date")).alias("month")).agg(F.count("*").alias("encounters"))
        ),
        "SELECT strftime(encounter_date, '%Y-%m') AS month, count(*) AS encounters FROM encounters GROUP BY 1",
    ),
    "d12_distinct_text_list": (
        on_logs(
            lambda t: t["audit_log"].groupBy("user_id").agg(
                F.array_join(F.array_sort(F.collect_set("event_type_code")), ", ").alias("types")
            )
        ),
        "SELECT user_id, string_agg(DISTINCT event_type_code, ', ' ORDER BY event_type_code) AS types FROM audit_log GROUP BY 1",
    ),
    "d13_array_union": (
        on_logs(
            lambda t: t["audit_log"]
            .select("user_id", F.explode(F.array_compact(F.array("table_name", "operation_type"))).alias("element"))
            .groupBy("user_id")
            .agg(F.array_join(F.array_sort(F.collect_set("element")), ",").alias("elements"))
        ),
        """SELECT user_id, string_agg(DISTINCT element, ',' ORDER BY element) AS elements
           FROM (SELECT user_id, unnest([table_name, operation_type]) AS element FROM audit_log) t GROUP BY 1""",
    ),
    "d14_ordered_struct_list": (
        on_logs(lambda t: document_pages(t, "data_quality_issues", page_entries=25)),
        page_sql("data_quality_issues", 25),
    ),
    "d15_duplicates": (
        on_source(
            lambda s: s["encounter_procedures"].groupBy("encounter_id", "procedure_id").count().where("count > 1")
            .withColumnRenamed("count", "copies")
        ),
        "SELECT encounter_id, procedure_id, count(*) AS copies FROM encounter_procedures GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "d16_global_aggregate": (
        on_source(
            lambda s: s["billing"].agg(
                F.count("*").alias("bills"), F.sum("allowed_amount").cast("double").alias("allowed"), F.max("claim_date").alias("last_day")
            )
        ),
        "SELECT count(*) AS bills, CAST(sum(allowed_amount) AS DOUBLE) AS allowed, max(claim_date) AS last_day FROM billing",
    ),
}

# Windows, sorts, set operations ---------------------------------------------------------------------------------------


def _monthly(s):
    return s["encounters"].groupBy(
        F.year(F.to_date("encounter_date")).alias("year"), F.month(F.to_date("encounter_date")).alias("month")
    ).agg(F.count("*").alias("encounters"))


MONTHLY_SQL = "SELECT year(encounter_date) AS year, month(encounter_date) AS month, count(*) AS encounters FROM encounters GROUP BY 1, 2"

ORDERED = {
    "e01_row_number_in_group": (
        on_source(
            lambda s: sequence_within(
                s["encounter_procedures"], "encounter_id", ["procedure_date", "procedure_id", "encounter_procedure_id"], "position",
                F.unix_date("procedure_date").cast("bigint"), s.hot_keys("encounter_procedures", "encounter_id"),
            )
        ),
        """SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY procedure_date, procedure_id, encounter_procedure_id) AS position
           FROM encounter_procedures""",
    ),
    "e02_rank_of_groups": (
        on_source(
            lambda s: s["encounters"].groupBy("encounter_type").agg(F.count("*").alias("n"))
            .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "encounter_type")))
        ),
        """SELECT *, row_number() OVER (ORDER BY n DESC, encounter_type NULLS FIRST) AS rank
           FROM (SELECT encounter_type, count(*) AS n FROM encounters GROUP BY 1) t""",
    ),
    "e03_lag_twelve_rows": (
        on_source(
            lambda s: s["encounters"].groupBy("department_id", C.month_label(F.col("encounter_date")).alias("month"))
            .agg(F.count("*").alias("n"))
            .withColumn("earlier", F.lag("n", 12).over(Window.partitionBy("department_id").orderBy("month")))
        ),
        """SELECT *, lag(n, 12) OVER (PARTITION BY department_id ORDER BY month) AS earlier
           FROM (SELECT department_id, strftime(encounter_date, '%Y-%m') AS month, count(*) AS n FROM encounters GROUP BY 1, 2) t""",
    ),
    "e04_lag_same_month": (
        on_source(
            lambda s: _monthly(s).withColumn("previous", F.lag("encounters").over(Window.partitionBy("month").orderBy("year")))
        ),
        f"SELECT *, lag(encounters) OVER (PARTITION BY month ORDER BY year) AS previous FROM ({MONTHLY_SQL}) t",
    ),
    "f01_mixed_sort": (
        on_source(lambda s: _monthly(s).orderBy(F.desc("year"), "month")),
        f"SELECT * FROM ({MONTHLY_SQL}) t ORDER BY year DESC, month",
    ),
    "f02_top_k": (
        on_source(
            lambda s: s["encounters"].groupBy("patient_id").agg(F.count("*").alias("visits"))
            .orderBy(F.desc("visits"), "patient_id").limit(10)
        ),
        "SELECT patient_id, count(*) AS visits FROM encounters GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    ),
    "f03_best_group": (
        on_source(
            lambda s: s["billing"].groupBy("claim_status").agg(F.sum("claim_amount").cast("double").alias("claims"))
            .orderBy(F.desc("claims"), "claim_status").limit(1)
        ),
        "SELECT claim_status, CAST(sum(claim_amount) AS DOUBLE) AS claims FROM billing GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    ),
    "g02_stacked_results": (
        on_source(
            lambda s: union_all(
                [
                    s["encounters"].where(F.col("encounter_type").isNull()).select("encounter_id", F.lit("no type").alias("finding")),
                    s["encounters"].where(F.col("discharge_date").isNull()).select("encounter_id", F.lit("no discharge").alias("finding")),
                ]
            )
        ),
        """SELECT encounter_id, 'no type' AS finding FROM encounters WHERE encounter_type IS NULL
           UNION ALL SELECT encounter_id, 'no discharge' FROM encounters WHERE discharge_date IS NULL""",
    ),
}

# Scalar functions -----------------------------------------------------------------------------------------------------


def _dates(s):
    day = F.to_date("encounter_date")
    return s["encounters"].select(
        "encounter_id",
        C.date_key(day).alias("date_key"),
        C.date_key(F.to_date("discharge_date")).alias("discharge_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("iso_week"),
        F.dayofweek(day).alias("day_of_week"),
        C.day_name(day).alias("day_name"),
        C.month_name(F.month(day)).alias("month_name"),
        C.month_label(F.col("encounter_date")).alias("month_label"),
        C.month_start(F.col("encounter_date")).alias("month_start"),
        C.fiscal_year(day).alias("fiscal_year"),
        C.fiscal_quarter(day).alias("fiscal_quarter"),
    )


def _durations(s):
    a, d = F.col("encounter_date"), F.col("discharge_date")
    return s["encounters"].select(
        "encounter_id",
        C.stay_hours(a, d).alias("hours"),
        C.whole_days(d, a).alias("days"),
        F.datediff(F.to_date(d), F.to_date(a)).alias("calendar_days"),
        (d + F.expr("INTERVAL 30 DAYS")).alias("limit_at"),
        F.date_sub(F.to_date(a), 7).alias("week_before"),
        F.add_months(F.to_date(a), -84).alias("seven_years_before"),
    )


SCALARS = {
    "h_date_parts": (
        on_source(_dates),
        f"""SELECT encounter_id, {key_of('encounter_date')} AS date_key, {key_of('discharge_date')} AS discharge_key,
                   year(encounter_date) AS year, quarter(encounter_date) AS quarter, month(encounter_date) AS month,
                   day(encounter_date) AS day, weekofyear(encounter_date) AS iso_week, dayofweek(encounter_date) + 1 AS day_of_week,
                   dayname(encounter_date) AS day_name, rpad(monthname(encounter_date), 9, ' ') AS month_name,
                   strftime(encounter_date, '%Y-%m') AS month_label, date_trunc('month', encounter_date) AS month_start,
                   CASE WHEN month(encounter_date) > 6 THEN year(encounter_date) + 1 ELSE year(encounter_date) END AS fiscal_year,
                   (month(encounter_date) + 5) % 12 // 3 + 1 AS fiscal_quarter FROM encounters""",
    ),
    "h_ages_and_bands": (
        on_source(
            lambda s: s["patients"].select(
                "patient_id",
                C.age_years(F.col("date_of_birth"), F.lit(AS_OF)).alias("age"),
                C.age_band(C.age_years(F.col("date_of_birth"), F.lit(AS_OF))).alias("band"),
                C.age_band(F.when(F.col("first_name").isNotNull(), C.age_years(F.col("date_of_birth"), F.lit(AS_OF)))).alias("band_or_oldest"),
            )
        ),
        """SELECT patient_id, current_age AS age, age_group AS band,
                  CASE WHEN first_name IS NULL THEN '60+' ELSE age_group END AS band_or_oldest FROM dim_patient""",
    ),
    "h_durations": (
        on_source(_durations),
        """SELECT encounter_id, CAST(round((epoch_us(discharge_date) - epoch_us(encounter_date)) / 3600000000.0) AS INT) AS hours,
                  CAST((epoch_us(discharge_date) - epoch_us(encounter_date)) // 86400000000 AS INT) AS days,
                  date_diff('day', CAST(encounter_date AS DATE), CAST(discharge_date AS DATE)) AS calendar_days,
                  discharge_date + INTERVAL 30 DAY AS limit_at, CAST(encounter_date AS DATE) - 7 AS week_before,
                  CAST(CAST(encounter_date AS DATE) - INTERVAL 84 MONTH AS DATE) AS seven_years_before FROM encounters""",
    ),
    "h_texts": (
        on_source(
            lambda s: s["patients"].select(
                "patient_id",
                C.joined_text(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
                C.zero_padded(F.col("patient_id"), 8).alias("padded"),
                F.length("last_name").alias("name_length"),
                F.replace(F.col("last_name"), F.lit("#"), F.lit("-")).alias("replaced"),
                F.lower("last_name").alias("lowered"),
                F.locate("#", F.col("last_name")).alias("position"),
                F.left(F.col("last_name"), F.lit(4)).alias("head"),
                F.element_at(F.split("last_name", "#"), 2).alias("tail"),
                F.format_string("Patient %s of %s", "mrn", "gender").alias("template"),
            )
        ),
        """SELECT patient_id, first_name || ' ' || last_name AS full_name, lpad(CAST(patient_id AS VARCHAR), 8, '0') AS padded,
                  length(last_name) AS name_length, replace(last_name, '#', '-') AS replaced, lower(last_name) AS lowered,
                  instr(last_name, '#') AS position, left(last_name, 4) AS head, split_part(last_name, '#', 2) AS tail,
                  'Patient ' || mrn || ' of ' || gender AS template FROM patients""",
    ),
    "h_nulls_rounding_casts": (
        on_source(
            lambda s: s["billing"].groupBy("encounter_id").agg(
                F.sum("claim_amount").alias("claims"), F.sum("allowed_amount").alias("allowed"), F.max("claim_date").alias("last_day")
            ).select(
                "encounter_id",
                C.rounded(C.ratio(F.col("allowed"), F.col("claims")) * 100, 1).alias("rate"),
                F.nullif(F.col("claims").cast("double"), F.col("allowed").cast("double")).alias("claims_unless_paid"),
                F.coalesce(F.nullif(F.col("claims").cast("double"), F.col("allowed").cast("double")), F.lit(-1.0)).alias("or_minus_one"),
                F.col("last_day").cast("string").alias("day_text"),
            )
        ),
        f"""SELECT encounter_id, {rnd(div('allowed', 'claims') + ' * 100', 1)} AS rate,
                   nullif(CAST(claims AS DOUBLE), CAST(allowed AS DOUBLE)) AS claims_unless_paid,
                   coalesce(nullif(CAST(claims AS DOUBLE), CAST(allowed AS DOUBLE)), -1) AS or_minus_one, CAST(last_day AS VARCHAR) AS day_text
            FROM (SELECT encounter_id, sum(claim_amount) AS claims, sum(allowed_amount) AS allowed, max(claim_date) AS last_day
                  FROM billing GROUP BY 1) t""",
    ),
    "h20_json_lookup": (
        lambda spark, sf_dir: spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select(
            "event_id",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.element_at(F.from_json("props", "map<string,int>"), F.lit("k")).alias("k_of_map"),
            F.to_json(F.struct("event_id", "event_type")).alias("as_json"),
        ),
        """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(json_extract_string(props, '$.k') AS INT) AS k_of_map,
                  CAST(to_json({'event_id': event_id, 'event_type': event_type}) AS VARCHAR) AS as_json FROM events""",
    ),
}

QUERIES = {**PREDICATES, **JOINS, **AGGREGATES, **ORDERED, **SCALARS}
