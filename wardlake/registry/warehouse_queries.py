"""Registered warehouse builders and business queries: name -> (Spark callable, SQL counterpart or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlake.functions import columns as C
from wardlake.plans import dims, fact
from wardlake.plans import queries_source as QS
from wardlake.plans import queries_star as Q
from wardlake.plans.dims import EMERGENCY_TYPES
from wardlake.plans.warehouse import derive_warehouse
from wardlake.registry.oracle_base import div, month_name, pct, quoted, rnd
from wardlake.sources import fixture

AS_OF = fixture.CLINICAL_AS_OF


def source(spark, sf_dir):
    return fixture.clinical_tables(spark, sf_dir)


def star(spark, sf_dir):
    return derive_warehouse(source(spark, sf_dir), AS_OF, fixture.CALENDAR)


def over_source(query, **kwargs):
    return lambda spark, sf_dir: query(source(spark, sf_dir), **kwargs)


def over_star(query, **kwargs):
    return lambda spark, sf_dir: query(star(spark, sf_dir), **kwargs)


def shown(table, money=()):
    """A whole table, decimals as double."""
    return lambda spark, sf_dir: plain(star(spark, sf_dir)[table])


def plain(df):
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema]
    )


MONEY = ("total_claim_amount", "total_allowed_amount")


def money_as_double(table: str) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY)
    return f"SELECT * REPLACE ({casts}) FROM {table}"


PAIR_SQL = """
SELECT {cols}, count(*) AS encounter_count
FROM encounter_diagnoses ed JOIN encounter_procedures ep USING (encounter_id)
     JOIN diagnoses USING (diagnosis_id) JOIN procedures USING (procedure_id) {extra}
GROUP BY ALL ORDER BY encounter_count DESC, {cols} LIMIT 10"""

RETURN_SQL = """
SELECT specialty_name, n AS readmission_count, stays AS total_discharges, {rate} AS readmission_rate_percentage
FROM (SELECT s.specialty_name, count(b.encounter_id) AS n, count(DISTINCT a.encounter_id) AS stays
      FROM encounters a {kind} JOIN encounters b ON a.patient_id = b.patient_id AND b.encounter_date > a.discharge_date
           AND b.encounter_date <= a.discharge_date + INTERVAL 30 DAY
      JOIN providers USING (provider_id) JOIN specialties s USING (specialty_id)
      WHERE a.encounter_type = 'Inpatient' AND a.discharge_date IS NOT NULL GROUP BY 1) t
ORDER BY readmission_rate_percentage DESC, specialty_name LIMIT 1"""
RETURN_SQL = RETURN_SQL.replace("JOIN providers USING (provider_id)", "JOIN providers pv ON pv.provider_id = a.provider_id").replace(
    "JOIN specialties s USING (specialty_id)", "JOIN specialties s ON s.specialty_id = pv.specialty_id"
).replace("{rate}", rnd(div("n", "stays") + " * 100", 6))

RISK_SQL = f"""
SELECT specialty_name AS initial_specialty, total_discharges, readmissions_30day,
       {pct('readmissions_30day', 'total_discharges', 2)} AS readmission_rate_percent,
       {rnd(div('days', 'pairs'), 1)} AS avg_days_to_readmission,
       CASE WHEN readmissions_30day * 100.0 / total_discharges > 15 THEN 'High Risk'
            WHEN readmissions_30day * 100.0 / total_discharges > 10 THEN 'Moderate Risk' ELSE 'Low Risk' END AS risk_category
FROM (SELECT s.specialty_name, count(DISTINCT a.encounter_id) AS total_discharges,
             count(DISTINCT a.encounter_id) FILTER (b.encounter_id IS NOT NULL) AS readmissions_30day,
             count(b.encounter_id) AS pairs,
             sum((epoch_us(b.encounter_datetime) - epoch_us(a.discharge_datetime)) // 86400000000) AS days
      FROM resolved a {{kind}} JOIN resolved b ON a.patient_key = b.patient_key
           AND b.encounter_datetime > a.discharge_datetime
           AND b.encounter_datetime <= a.discharge_datetime + INTERVAL 30 DAY
      JOIN dim_specialty s ON s.specialty_key = a.specialty_key
      WHERE a.discharge_datetime IS NOT NULL AND a.encounter_date_key >= 20000801
      GROUP BY 1 HAVING count(DISTINCT a.encounter_id) >= 50) t"""

CALENDAR_SQL = f"""
SELECT specialty_name, total_discharges, total_readmissions,
       {rnd(div('total_readmissions', 'total_discharges') + ' * 100', 2)} AS readmission_rate_percent
FROM (SELECT s.specialty_name, count(DISTINCT a.encounter_key) AS total_discharges,
             count(b.encounter_key) AS total_readmissions
      FROM resolved a JOIN dim_encounter_type t ON t.encounter_type_key = a.encounter_type_key
      {{kind}} JOIN (SELECT * FROM resolved JOIN dim_encounter_type USING (encounter_type_key)
            WHERE encounter_type IN ('Inpatient', 'ER')) b
        ON a.patient_key = b.patient_key
       AND CAST(b.encounter_datetime AS DATE) > CAST(a.discharge_datetime AS DATE)
       AND CAST(b.encounter_datetime AS DATE) <= CAST(a.discharge_datetime AS DATE) + 30
      JOIN dim_specialty s ON s.specialty_key = a.specialty_key
      WHERE t.encounter_type = 'Inpatient' AND a.discharge_datetime IS NOT NULL GROUP BY 1) x"""

TREND_SQL = f"""
SELECT year, month, {month_name('month')} AS month_name, specialty_name, specialty_category,
       n AS total_encounters, billable_encounters, CAST(claims AS DOUBLE) AS total_charges,
       CAST(allowed AS DOUBLE) AS total_collections, {rnd(div('claims', 'n'), 2)} AS avg_charge_per_encounter,
       {rnd(div('allowed', 'n'), 2)} AS avg_collection_per_encounter,
       {pct('allowed', 'claims', 1)} AS collection_rate_percent,
       {rnd('CAST(allowed - earlier AS DOUBLE) * 100 / nullif(CAST(earlier AS DOUBLE), 0)', 1)} AS yoy_growth_percent
FROM (SELECT c.*, {{earlier}} AS earlier
      FROM (SELECT year, month, specialty_key, specialty_name, specialty_category, count(*) AS n,
                   count(*) FILTER (total_claim_amount > 0) AS billable_encounters,
                   sum(total_claim_amount) AS claims, sum(total_allowed_amount) AS allowed
            FROM dated WHERE year >= 1999 AND total_claim_amount >= 0
            GROUP BY ALL HAVING count(*) >= 10) c {{join}}) t"""
CELLS = """(SELECT year + 1 AS year, month, specialty_key, sum(total_allowed_amount) AS allowed FROM dated
            WHERE year >= 1999 AND total_claim_amount >= 0 GROUP BY ALL HAVING count(*) >= 10)"""

TABLES_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in QS.SOURCE_TABLES
)


def _first_age(spark, sf_dir):
    src = source(spark, sf_dir)
    return dims.with_first_encounter_age(dims.dim_patient(src, AS_OF), src["encounters"]).select(
        "patient_id", "date_of_birth", "age_at_first_encounter"
    )


def _data_calendar(spark, sf_dir):
    src = source(spark, sf_dir)
    return derive_warehouse(src, AS_OF)["dim_date"]


def _bridge_primary(spark, sf_dir):
    wh = star(spark, sf_dir)
    return fact.with_primary_diagnosis(
        wh["fact_resolved"].select("encounter_key"), wh["bridge_encounter_diagnoses"]
    )


QUERIES = {
    "j01_dim_date": (
        _data_calendar,
        """SELECT * FROM dim_date
           WHERE calendar_date BETWEEN
             (SELECT least(min(CAST(encounter_date AS DATE)), (SELECT min(procedure_date) FROM encounter_procedures)) FROM encounters)
             AND (SELECT greatest(max(CAST(greatest(encounter_date, discharge_date) AS DATE)),
                                  (SELECT max(procedure_date) FROM encounter_procedures)) FROM encounters)""",
    ),
    "j02_dim_specialty": (shown("dim_specialty"), "SELECT * FROM dim_specialty"),
    "j03_dim_department": (shown("dim_department"), "SELECT * FROM dim_department"),
    "j04_dim_encounter_type": (shown("dim_encounter_type"), "SELECT * FROM dim_encounter_type"),
    "j05_dim_diagnosis": (shown("dim_diagnosis"), "SELECT * FROM dim_diagnosis"),
    "j06_dim_procedure": (shown("dim_procedure"), "SELECT * FROM dim_procedure"),
    "j07_dim_patient": (shown("dim_patient"), "SELECT * FROM dim_patient"),
    "j08_dim_provider": (shown("dim_provider"), "SELECT * FROM dim_provider"),
    "j09_fact_encounters": (shown("fact_encounters"), money_as_double("fact_encounters")),
    "j10_bridge_encounter_diagnoses": (
        shown("bridge_encounter_diagnoses"),
        "SELECT * FROM bridge_encounter_diagnoses",
    ),
    "j11_bridge_encounter_procedures": (
        shown("bridge_encounter_procedures"),
        "SELECT * FROM bridge_encounter_procedures",
    ),
    "j12_readmission_metrics": (shown("fact_readmission"), "SELECT * FROM readmission"),
    "j13_primary_diagnosis": (
        _bridge_primary,
        """SELECT encounter_key, min(diagnosis_key) FILTER (diagnosis_sequence = 1) AS primary_diagnosis_key
           FROM resolved LEFT JOIN bridge_encounter_diagnoses USING (encounter_key) GROUP BY 1""",
    ),
    "j14_encounter_analytics": (
        lambda spark, sf_dir: plain(fact.encounter_analytics(star(spark, sf_dir))),
        money_as_double("analytics"),
    ),
    "j15_age_at_first_encounter": (
        _first_age,
        """SELECT patient_id, any_value(date_of_birth) AS date_of_birth,
                  CAST(date_sub('year', any_value(date_of_birth), CAST(min(encounter_date) AS DATE)) AS INT)
                      AS age_at_first_encounter
           FROM patients LEFT JOIN encounters USING (patient_id) GROUP BY 1""",
    ),
    "j16_pair_summary": (
        lambda spark, sf_dir: Q.pair_summary(star(spark, sf_dir)).withColumn(
            "avg_revenue", C.rounded(F.col("avg_revenue"), 6)
        ),
        f"""SELECT icd10_code, icd10_description, cpt_code, cpt_description, count(*) AS combination_count,
                   count(DISTINCT encounter_key) AS encounters_with_pair,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 6)} AS avg_revenue
            FROM primary_pairs GROUP BY ALL HAVING count(*) >= 3""",
    ),
    "k01_monthly_encounters": (
        over_source(QS.monthly_encounters),
        """SELECT strftime(e.encounter_date, '%Y-%m') AS month, s.specialty_name, e.encounter_type,
                  count(*) AS total_encounters, count(DISTINCT e.patient_id) AS unique_patients
           FROM encounters e JOIN providers USING (provider_id) JOIN specialties s USING (specialty_id) GROUP BY ALL""",
    ),
    "k01_monthly_encounters_by_month_start": (
        over_source(QS.monthly_encounters, month=C.month_start),
        """SELECT date_trunc('month', e.encounter_date) AS month, s.specialty_name, e.encounter_type,
                  count(*) AS total_encounters, count(DISTINCT e.patient_id) AS unique_patients
           FROM encounters e JOIN providers USING (provider_id) JOIN specialties s USING (specialty_id) GROUP BY ALL""",
    ),
    "k02_pairs_by_code": (
        over_source(QS.diagnosis_procedure_pairs),
        PAIR_SQL.format(cols="icd10_code, cpt_code", extra=""),
    ),
    "k03_pairs_described": (
        over_source(QS.diagnosis_procedure_pairs, described=True),
        PAIR_SQL.format(
            cols="icd10_code, icd10_description, cpt_code, cpt_description",
            extra="JOIN encounters ec ON ec.encounter_id = ed.encounter_id",
        ),
    ),
    "k04_highest_return_rate": (over_source(QS.highest_return_rate), RETURN_SQL.format(kind="")),
    "k04_highest_return_rate_fixed": (
        over_source(QS.highest_return_rate, with_all_stays=True),
        RETURN_SQL.format(kind="LEFT"),
    ),
    "k05_inpatient_return_rates": (
        over_source(QS.inpatient_return_rates),
        f"""SELECT specialty_name, stays AS total_discharges, n AS total_readmissions,
                   {rnd(div('n', 'stays') + ' * 100', 2)} AS readmission_rate_percent
            FROM (SELECT s.specialty_id, s.specialty_name, count(DISTINCT a.encounter_id) AS stays, count(b.encounter_id) AS n
                  FROM encounters a JOIN providers pv ON pv.provider_id = a.provider_id
                       JOIN specialties s ON s.specialty_id = pv.specialty_id
                       LEFT JOIN encounters b ON b.patient_id = a.patient_id AND b.encounter_type IN ({quoted(QS.RETURN_TYPES)})
                            AND b.encounter_date > a.discharge_date
                            AND b.encounter_date <= a.discharge_date + INTERVAL 30 DAY
                  WHERE a.encounter_type = 'Inpatient' AND a.discharge_date IS NOT NULL GROUP BY 1, 2) t""",
    ),
    "k06_monthly_claims": (
        over_source(QS.monthly_claims),
        """SELECT date_trunc('month', encounter_date) AS month, specialty_name,
                  CAST(sum(claim_amount) AS DOUBLE) AS total_revenue
           FROM billing JOIN encounters USING (encounter_id) JOIN providers USING (provider_id)
                JOIN specialties USING (specialty_id) GROUP BY 1, 2""",
    ),
    "k07_monthly_revenue": (
        over_source(QS.monthly_revenue),
        f"""SELECT strftime(encounter_date, '%Y-%m') AS month, specialty_name,
                   CAST(sum(claim_amount) AS DOUBLE) AS total_claim_amount,
                   CAST(sum(allowed_amount) AS DOUBLE) AS total_allowed_amount,
                   count(DISTINCT encounter_id) AS total_encounters,
                   {rnd(div('sum(allowed_amount)', 'count(allowed_amount)'), 2)} AS avg_allowed_per_encounter
            FROM billing JOIN encounters USING (encounter_id) JOIN providers USING (provider_id)
                 JOIN specialties USING (specialty_id) GROUP BY 1, 2, specialty_id""",
    ),
    "k08_table_sizes": (over_source(QS.table_sizes), TABLES_SQL),
    "k09_monthly_volume": (
        over_star(Q.monthly_volume, as_of=AS_OF),
        f"""SELECT year, month, {month_name('month')} AS month_name, specialty_name, specialty_category,
                   count(*) AS total_encounters,
                   count(*) FILTER (encounter_type = 'Inpatient') AS inpatient_encounters,
                   count(*) FILTER (encounter_type = 'Outpatient') AS outpatient_encounters,
                   count(*) FILTER (encounter_type IN ({quoted(EMERGENCY_TYPES)})) AS emergency_encounters,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_revenue_per_encounter
            FROM dated WHERE year >= 1999 GROUP BY year, month, specialty_name, specialty_category""",
    ),
    "k10_primary_pairs": (
        over_star(Q.primary_pairs),
        f"""SELECT icd10_code, icd10_description AS diagnosis_description, diagnosis_category, cpt_code,
                   cpt_description AS procedure_description, procedure_category, count(*) AS combination_count,
                   count(DISTINCT encounter_key) AS encounters_with_pair,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_revenue_per_encounter,
                   {rnd(div('sum(length_of_stay_hours)', 'count(*)'), 1)} AS avg_length_of_stay_hours
            FROM primary_pairs GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) >= 10
            ORDER BY combination_count DESC, avg_revenue_per_encounter DESC, icd10_code, cpt_code LIMIT 20""",
    ),
    "k11_readmission_risk": (over_star(Q.readmission_risk, as_of=AS_OF), RISK_SQL.format(kind="")),
    "k11_readmission_risk_fixed": (
        over_star(Q.readmission_risk, as_of=AS_OF, with_all_discharges=True),
        RISK_SQL.format(kind="LEFT"),
    ),
    "k12_revenue_trend": (
        over_star(Q.revenue_trend, as_of=AS_OF),
        TREND_SQL.format(
            earlier="lag(c.allowed, 12) OVER (PARTITION BY c.specialty_key ORDER BY c.year, c.month)", join=""
        ),
    ),
    "k12_revenue_trend_fixed": (
        over_star(Q.revenue_trend, as_of=AS_OF, same_month=True),
        TREND_SQL.format(
            earlier="p.allowed", join=f"LEFT JOIN {CELLS} p USING (year, month, specialty_key)"
        ).replace("SELECT c.*, p.allowed", "SELECT c.year, c.month, c.specialty_name, c.specialty_category, c.n, c.billable_encounters, c.claims, c.allowed, p.allowed"),
    ),
    "k13_top_revenue_diagnoses": (
        over_star(Q.top_revenue_diagnoses),
        f"""SELECT icd10_code, icd10_description, diagnosis_category, count(DISTINCT encounter_key) AS total_encounters,
                   CAST(sum(total_allowed_amount) AS DOUBLE) AS total_revenue,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_revenue_per_encounter,
                   {rnd(div('sum(length_of_stay_hours)', 'count(*)'), 1)} AS avg_length_of_stay
            FROM bridge_encounter_diagnoses bd JOIN dim_diagnosis USING (diagnosis_key) JOIN fact_encounters USING (encounter_key)
            WHERE bd.diagnosis_sequence = 1 GROUP BY 1, 2, 3 HAVING count(DISTINCT encounter_key) >= 20
            ORDER BY total_revenue DESC, icd10_code LIMIT 15""",
    ),
    "k14_demographics": (
        over_star(Q.demographics, as_of=AS_OF),
        f"""SELECT age_group, gender, count(*) AS total_encounters, count(DISTINCT patient_key) AS unique_patients,
                   {rnd(div('count(*)', 'count(DISTINCT patient_key)'), 1)} AS encounters_per_patient,
                   CAST(sum(total_allowed_amount) AS DOUBLE) AS total_revenue,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_revenue_per_encounter
            FROM dated JOIN dim_patient USING (patient_key) WHERE year >= 2000 GROUP BY 1, 2""",
    ),
    "k15_monthly_volume_short": (
        over_star(Q.monthly_volume_short, as_of=AS_OF),
        f"""SELECT year, month, {month_name('month')} AS month_name, specialty_name, count(*) AS total_encounters,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_revenue
            FROM dated WHERE year >= 2000 GROUP BY year, month, specialty_name
            ORDER BY year DESC, month DESC, total_encounters DESC, specialty_name LIMIT 15""",
    ),
    "k17_pairs_without_summary": (
        over_star(Q.pairs_without_summary),
        """SELECT icd10_code, cpt_code, count(*) AS combination_count FROM primary_pairs
           GROUP BY 1, 2 HAVING count(*) >= 3""",
    ),
    "k18_readmission_from_flags": (
        over_star(Q.readmission_from_flags),
        f"""SELECT specialty_name, count(*) AS total_discharges, count(*) FILTER (has_30day_readmission) AS readmissions,
                   {pct('count(*) FILTER (has_30day_readmission)', 'count(*)', 2)} AS readmission_rate_percent,
                   {rnd(div('sum(days_to_readmission)', 'count(days_to_readmission)'), 1)} AS avg_days_to_readmission
            FROM fact_encounters JOIN dim_specialty USING (specialty_key) WHERE discharge_datetime IS NOT NULL
            GROUP BY 1 HAVING count(*) >= 10 ORDER BY readmission_rate_percent DESC, specialty_name LIMIT 10""",
    ),
    "k19_revenue_short": (
        over_star(Q.revenue_short, as_of=AS_OF),
        f"""SELECT year, month, specialty_name, count(*) AS total_encounters,
                   CAST(sum(total_claim_amount) AS DOUBLE) AS total_charges,
                   CAST(sum(total_allowed_amount) AS DOUBLE) AS total_collections,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_revenue_per_encounter
            FROM dated WHERE year >= 2000 GROUP BY 1, 2, 3 HAVING count(*) >= 5
            ORDER BY total_collections DESC, year, month, specialty_name LIMIT 15""",
    ),
    "k22_monthly_patients": (
        over_star(Q.monthly_patients),
        """SELECT year, month, specialty_name, encounter_type, count(*) AS total_encounters,
                  count(DISTINCT patient_key) AS unique_patients FROM dated GROUP BY 1, 2, 3, 4""",
    ),
    "k23_all_pairs": (
        over_star(Q.all_pairs),
        """SELECT icd10_code, icd10_description, cpt_code, cpt_description, count(*) AS encounter_count
           FROM bridge_encounter_diagnoses JOIN bridge_encounter_procedures USING (encounter_key)
                JOIN dim_diagnosis USING (diagnosis_key) JOIN dim_procedure USING (procedure_key)
           GROUP BY 1, 2, 3, 4 ORDER BY encounter_count DESC, 1, 2, 3, 4 LIMIT 10""",
    ),
    "k24_calendar_day_returns": (over_star(Q.calendar_day_returns), CALENDAR_SQL.format(kind="")),
    "k24_calendar_day_returns_fixed": (
        over_star(Q.calendar_day_returns, with_all_stays=True),
        CALENDAR_SQL.format(kind="LEFT"),
    ),
    "k25_inpatient_readmission_from_flags": (
        over_star(Q.inpatient_readmission_from_flags),
        f"""SELECT specialty_name, count(*) AS total_inpatient_discharges,
                   count(*) FILTER (has_30day_readmission) AS total_readmissions,
                   {pct('count(*) FILTER (has_30day_readmission)', 'count(*)', 2)} AS readmission_rate
            FROM dated WHERE encounter_type = 'Inpatient' AND discharge_date_key IS NOT NULL GROUP BY 1""",
    ),
    "k26_revenue_all_months": (
        over_star(Q.revenue_all_months),
        f"""SELECT year, month, specialty_name, CAST(sum(total_claim_amount) AS DOUBLE) AS total_claim_amount,
                   CAST(sum(total_allowed_amount) AS DOUBLE) AS total_allowed_amount, count(*) AS total_encounters,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_allowed_per_encounter,
                   {rnd(div('sum(total_allowed_amount)', 'sum(total_claim_amount)') + ' * 100', 2)} AS reimbursement_rate_percent
            FROM dated GROUP BY year, month, specialty_name""",
    ),
    "k27_revenue_from_view": (
        over_star(Q.revenue_from_view),
        f"""SELECT encounter_year, encounter_month, specialty_name,
                   CAST(sum(total_claim_amount) AS DOUBLE) AS total_claim_amount,
                   CAST(sum(total_allowed_amount) AS DOUBLE) AS total_allowed_amount, count(*) AS total_encounters,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 6)} AS avg_allowed_per_encounter,
                   {rnd(div('sum(CAST(reimbursement_rate_percent AS DECIMAL(20,6)))', 'count(*)'), 6)} AS avg_reimbursement_rate
            FROM analytics GROUP BY 1, 2, 3""",
    ),
    "k28_specialty_totals": (
        over_star(Q.specialty_totals),
        f"""SELECT specialty_name, count(*) AS total_encounters, count(DISTINCT patient_key) AS unique_patients,
                   CAST(sum(total_allowed_amount) AS DOUBLE) AS total_revenue,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_revenue_per_encounter,
                   {rnd(div('sum(length_of_stay_hours)', 'count(*)'), 1)} AS avg_length_of_stay_hours,
                   {rnd(div('sum(diagnosis_count)', 'count(*)'), 1)} AS avg_diagnoses_per_encounter
            FROM fact_encounters JOIN dim_specialty USING (specialty_key) GROUP BY 1""",
    ),
    "k29_monthly_trend": (
        over_star(Q.monthly_trend),
        f"""SELECT month, year, encounters, revenue, p_n AS prev_year_encounters, p_rev AS prev_year_revenue,
                   {rnd(div('encounters - p_n', 'p_n') + ' * 100', 1)} AS encounter_growth_percent
            FROM (SELECT *, lag(encounters) OVER w AS p_n, lag(revenue) OVER w AS p_rev
                  FROM (SELECT month, year, count(*) AS encounters, CAST(sum(total_allowed_amount) AS DOUBLE) AS revenue
                        FROM dated GROUP BY 1, 2) g WINDOW w AS (PARTITION BY month ORDER BY year)) t""",
    ),
    "k30_patient_complexity": (
        over_star(Q.patient_complexity),
        f"""SELECT age_group, encounter_type, count(*) AS encounter_count,
                   {rnd(div('sum(diagnosis_count)', 'count(*)'), 1)} AS avg_diagnoses,
                   {rnd(div('sum(procedure_count)', 'count(*)'), 1)} AS avg_procedures,
                   {rnd(div('sum(total_allowed_amount)', 'count(*)'), 2)} AS avg_cost,
                   {rnd(div('sum(length_of_stay_hours)', 'count(*)'), 1)} AS avg_los_hours
            FROM dated JOIN dim_patient USING (patient_key) GROUP BY 1, 2""",
    ),
    "k31_encounters_per_year": (
        over_star(Q.encounters_per_year),
        "SELECT year, count(*) AS total_encounters FROM dated GROUP BY 1",
    ),
    "k32_claims_per_month": (
        over_star(Q.claims_per_month),
        "SELECT year, month, CAST(sum(total_claim_amount) AS DOUBLE) AS total_revenue FROM dated GROUP BY 1, 2",
    ),
    "k33_encounters_per_department": (
        over_star(Q.encounters_per_department),
        """SELECT d.department_name, count(*) AS encounter_count
           FROM fact_encounters f JOIN dim_provider p USING (provider_key)
                JOIN dim_department d ON d.department_key = p.department_key GROUP BY 1""",
    ),
    "k34_top_diagnoses": (
        over_star(Q.top_diagnoses),
        """SELECT icd10_code, icd10_description, count(*) AS diagnosis_count
           FROM bridge_encounter_diagnoses JOIN dim_diagnosis USING (diagnosis_key)
           GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    ),
    "k35_provider_productivity": (
        over_star(Q.provider_productivity),
        """SELECT p.first_name, p.last_name, p.specialty_name, count(*) AS total_encounters
           FROM fact_encounters f JOIN dim_provider p USING (provider_key) GROUP BY 1, 2, 3""",
    ),
    "k36_claim_per_type": (
        over_star(Q.claim_per_type),
        f"""SELECT encounter_type, {rnd(div('sum(total_claim_amount)', 'count(*)'), 6)} AS avg_claim
            FROM fact_encounters JOIN dim_encounter_type USING (encounter_type_key) GROUP BY 1""",
    ),
    "k37_encounters_per_age_band": (
        over_star(Q.encounters_per_age_band),
        """SELECT age_group, count(*) AS encounter_count FROM fact_encounters JOIN dim_patient USING (patient_key)
           GROUP BY 1""",
    ),
    "k38_stay_days": (
        over_star(Q.stay_days),
        """SELECT first_name, last_name, date_diff('day', calendar_date, CAST(discharge_datetime AS DATE)) AS length_of_stay
           FROM dated JOIN dim_patient USING (patient_key) WHERE discharge_datetime IS NOT NULL""",
    ),
    "k39_top_procedures": (
        over_star(Q.top_procedures),
        """SELECT cpt_code, cpt_description, count(*) AS total_times_performed
           FROM bridge_encounter_procedures JOIN dim_procedure USING (procedure_key)
           GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    ),
    "k40_revenue_per_diagnosis": (
        over_star(Q.revenue_per_diagnosis),
        """SELECT icd10_code, icd10_description, CAST(sum(total_claim_amount) AS DOUBLE) AS total_revenue
           FROM bridge_encounter_diagnoses JOIN dim_diagnosis USING (diagnosis_key)
                JOIN fact_encounters USING (encounter_key) GROUP BY 1, 2""",
    ),
}
