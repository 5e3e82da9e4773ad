"""Building blocks of the SQL counterparts: the source and star tables as named subqueries."""

from __future__ import annotations

import re

from wardlake.functions import columns as C
from wardlake.plans import dims
from wardlake.sources import fixture
from wardlake.sources.catalogs import (
    ADDED_EVENT_TYPES,
    AUDIT_EVENT_TYPES,
    EXPORT_CONFIG,
    EXPORT_RETENTION_DAYS,
    RETENTION_DAYS,
    USER_ROLES,
)

AS_OF = f"DATE '{fixture.CLINICAL_AS_OF}'"
AUDIT_AS_OF = f"DATE '{fixture.AUDIT_AS_OF}'"


def quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def age_case(age: str) -> str:
    """The age band of an age, from the marked bands."""
    bands = " ".join(f"WHEN {age} <= {limit} THEN '{label}'" for limit, label in C.AGE_BANDS)
    return f"CASE {bands} ELSE '{C.OLDEST_BAND}' END"


def rnd(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def div(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0))"


def pct(part: str, whole: str, places: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN {rnd(f'CAST({part} AS DOUBLE) * 100 / CAST({whole} AS DOUBLE)', places)} ELSE 0.0 END"


def key_of(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INT)"


def month_name(month: str) -> str:
    return f"rpad(monthname(make_date(2000, CAST({month} AS INT), 1)), 9, ' ')"


def like_case(column: str, rules, default) -> str:
    def quoted(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    arms = " ".join(
        "WHEN " + " OR ".join(f"{column} ILIKE '%{f}%'" for f in fragments) + f" THEN {quoted(label)}"
        for label, fragments in rules
    )
    return f"CASE {arms} ELSE {quoted(default)} END"


def first_letter_case(column: str, labels: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE left({column}, 1) {arms} ELSE '{default}' END"


def rows_sql(columns: list[str], rows) -> str:
    def literal(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {values}) t({', '.join(columns)})"


CTES: dict[str, str] = {
    name: text.format(**{n: n for n in fixture.INPUTS}).strip() for name, text in fixture.DERIVED_SQL.items()
}
CTES["encounter_diagnoses"] = f"""
SELECT encounter_id * 1000 + diagnosis_sequence AS encounter_diagnosis_id, * FROM (
  SELECT encounter_id, diagnosis_id,
         CAST(row_number() OVER (PARTITION BY encounter_id ORDER BY {', '.join(fixture.LINE_ORDER)}) AS INT) AS diagnosis_sequence
  FROM diagnosis_lines) d"""

CTES["dim_date"] = f"""
SELECT {key_of('d')} AS date_key, d AS calendar_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
       day(d) AS day_of_month, weekofyear(d) AS week_of_year, dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend,
       year(d + INTERVAL 6 MONTH) AS fiscal_year, quarter(d + INTERVAL 6 MONTH) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(DATE '{fixture.CALENDAR[0]}', DATE '{fixture.CALENDAR[1]}', INTERVAL 1 DAY)) AS DATE) AS d) x"""
CTES["dim_specialty"] = f"""
SELECT specialty_id AS specialty_key, specialty_id, specialty_name, specialty_code,
       {like_case('specialty_name', dims.SPECIALTY_CATEGORIES, dims.SPECIALTY_DEFAULT)} AS specialty_category
FROM specialties"""
CTES["dim_department"] = f"""
SELECT department_id AS department_key, department_id, department_name, floor, capacity,
       {like_case('department_name', dims.DEPARTMENT_TYPES, dims.DEPARTMENT_DEFAULT)} AS department_type,
       'CC' || lpad(CAST(department_id AS VARCHAR), 4, '0') AS cost_center_code
FROM departments"""
CTES["dim_encounter_type"] = """
SELECT CAST('0x' || substr(md5(encounter_type), 1, 15) AS BIGINT) AS encounter_type_key, encounter_type,
       CASE encounter_type WHEN 'Inpatient' THEN 'Hospital admission requiring overnight stay'
            WHEN 'Outpatient' THEN 'Clinic visit, same-day discharge'
            WHEN 'ER' THEN 'Emergency department visit' WHEN 'Emergency' THEN 'Emergency department visit'
            ELSE 'General healthcare encounter' END AS type_description,
       CASE encounter_type WHEN 'Inpatient' THEN 48 WHEN 'ER' THEN 4 WHEN 'Emergency' THEN 4 ELSE 2 END
           AS typical_duration_hours,
       encounter_type = 'Inpatient' AS requires_admission
FROM encounters WHERE encounter_type IS NOT NULL GROUP BY encounter_type"""
CTES["dim_diagnosis"] = f"""
SELECT diagnosis_id AS diagnosis_key, diagnosis_id, icd10_code, icd10_description,
       {first_letter_case('icd10_code', dims.DIAGNOSIS_CATEGORIES, dims.DIAGNOSIS_CATEGORY_DEFAULT)} AS diagnosis_category,
       {first_letter_case('icd10_code', dims.BODY_SYSTEMS, dims.BODY_SYSTEM_DEFAULT)} AS body_system,
       regexp_matches(lower(icd10_description), '{'|'.join(dims.CHRONIC_CONDITIONS)}') AS chronic_flag
FROM diagnoses"""
CTES["dim_procedure"] = f"""
SELECT procedure_id AS procedure_key, procedure_id, cpt_code, cpt_description,
       {like_case('cpt_description', dims.PROCEDURE_CATEGORIES, dims.PROCEDURE_CATEGORY_DEFAULT)} AS procedure_category,
       {like_case('cpt_description', dims.PROCEDURE_TYPES, dims.PROCEDURE_TYPE_DEFAULT)} AS procedure_type,
       {like_case('cpt_description', dims.COST_RANGES, dims.COST_RANGE_DEFAULT)} AS typical_cost_range,
       {like_case('cpt_description', dims.DURATION_MINUTES, dims.DURATION_DEFAULT)} AS duration_minutes
FROM procedures"""
CTES["aged_patients"] = f"""
SELECT *, CAST(date_sub('year', date_of_birth, {AS_OF}) AS INT) AS current_age FROM patients"""
CTES["dim_patient"] = f"""
SELECT patient_id AS patient_key, patient_id, first_name, last_name, first_name || ' ' || last_name AS full_name, gender,
       date_of_birth, current_age,
       {age_case('current_age')} AS age_group, mrn
FROM aged_patients"""
CTES["dim_provider"] = """
SELECT provider_id AS provider_key, provider_id, first_name, last_name, first_name || ' ' || last_name AS full_name,
       credential, specialty_key, department_key, specialty_name, department_name
FROM providers JOIN dim_specialty USING (specialty_id) JOIN dim_department USING (department_id)"""
CTES["resolved"] = f"""
SELECT encounter_id AS encounter_key, encounter_id, patient_key, provider_key, encounter_type_key, specialty_key,
       department_key, e.department_id AS encounter_department_key,
       {key_of('encounter_date')} AS encounter_date_key, {key_of('discharge_date')} AS discharge_date_key,
       coalesce(CAST(round((epoch_us(discharge_date) - epoch_us(encounter_date)) / 3600000000.0) AS INT), 0)
           AS length_of_stay_hours,
       encounter_date AS encounter_datetime, discharge_date AS discharge_datetime, year(encounter_date) AS encounter_year
FROM encounters e JOIN dim_provider USING (provider_id) JOIN dim_encounter_type USING (encounter_type)
     JOIN dim_patient USING (patient_id)"""
CTES["readmission"] = """
SELECT r.encounter_id, r.n > 0 AS has_30day_readmission, r.days AS days_to_readmission,
       coalesce(b.back, FALSE) AS is_readmission, CAST(r.n AS INT) AS readmission_count_30days
FROM (SELECT x.encounter_id, count(y.encounter_id) AS n,
             CAST(min((epoch_us(y.encounter_datetime) - epoch_us(x.discharge_datetime)) // 86400000000) AS INT) AS days
      FROM resolved x LEFT JOIN resolved y
        ON x.patient_key = y.patient_key AND y.encounter_id <> x.encounter_id
       AND y.encounter_datetime > x.discharge_datetime
       AND y.encounter_datetime <= x.discharge_datetime + INTERVAL 30 DAY
      WHERE x.discharge_datetime IS NOT NULL GROUP BY x.encounter_id) r
LEFT JOIN (SELECT DISTINCT x.encounter_id, TRUE AS back
      FROM resolved x JOIN resolved y
        ON x.patient_key = y.patient_key AND y.encounter_id <> x.encounter_id
       AND x.encounter_datetime > y.discharge_datetime
       AND x.encounter_datetime <= y.discharge_datetime + INTERVAL 30 DAY) b USING (encounter_id)"""
CTES["fact_encounters"] = """
SELECT r.*, coalesce(m.claims, 0) AS total_claim_amount, coalesce(m.allowed, 0) AS total_allowed_amount,
       coalesce(dx.n, 0) AS diagnosis_count, coalesce(px.n, 0) AS procedure_count, dx.first_key AS primary_diagnosis_key,
       coalesce(ra.has_30day_readmission, FALSE) AS has_30day_readmission, ra.days_to_readmission,
       coalesce(ra.is_readmission, FALSE) AS is_readmission,
       coalesce(ra.readmission_count_30days, 0) AS readmission_count_30days
FROM resolved r
LEFT JOIN (SELECT encounter_id, sum(claim_amount) AS claims, sum(allowed_amount) AS allowed
           FROM billing GROUP BY ALL) m USING (encounter_id)
LEFT JOIN (SELECT encounter_id, count(*) AS n, min(diagnosis_id) FILTER (diagnosis_sequence = 1) AS first_key
           FROM encounter_diagnoses GROUP BY ALL) dx USING (encounter_id)
LEFT JOIN (SELECT encounter_id, count(*) AS n FROM encounter_procedures GROUP BY ALL) px USING (encounter_id)
LEFT JOIN readmission ra USING (encounter_id)"""
CTES["bridge_encounter_diagnoses"] = """
SELECT r.encounter_key, d.diagnosis_key, ed.diagnosis_sequence, TRUE AS diagnosis_present_on_admission
FROM encounter_diagnoses ed JOIN resolved r USING (encounter_id) JOIN dim_diagnosis d USING (diagnosis_id)"""
CTES["bridge_encounter_procedures"] = f"""
SELECT r.encounter_key, p.procedure_key, {key_of('ep.procedure_date')} AS procedure_date_key,
       CAST(row_number() OVER (PARTITION BY ep.encounter_id
            ORDER BY ep.procedure_date, ep.procedure_id, ep.encounter_procedure_id) AS INT) AS procedure_sequence,
       'Completed' AS procedure_status
FROM encounter_procedures ep JOIN resolved r USING (encounter_id) JOIN dim_procedure p USING (procedure_id)"""
CTES["dated"] = """
SELECT f.*, dd.year, dd.month, dd.calendar_date, sp.specialty_name, sp.specialty_category, ty.encounter_type
FROM fact_encounters f JOIN dim_date dd ON dd.date_key = f.encounter_date_key
     JOIN dim_specialty sp USING (specialty_key) JOIN dim_encounter_type ty USING (encounter_type_key)"""
CTES["analytics"] = f"""
SELECT f.encounter_key, f.encounter_id, dd.calendar_date AS encounter_date, dd.year AS encounter_year,
       dd.month AS encounter_month, dd.quarter AS encounter_quarter, pa.patient_id, pa.full_name AS patient_name,
       pa.age_group, pa.gender, pr.provider_id, pr.full_name AS provider_name, pr.credential, sp.specialty_name,
       de.department_name, ty.encounter_type, f.diagnosis_count, f.procedure_count, f.total_claim_amount,
       f.total_allowed_amount, f.length_of_stay_hours,
       {pct('f.total_allowed_amount', 'f.total_claim_amount', 6)} AS reimbursement_rate_percent
FROM fact_encounters f
     JOIN dim_date dd ON dd.date_key = f.encounter_date_key JOIN dim_patient pa USING (patient_key)
     JOIN dim_provider pr USING (provider_key) JOIN dim_specialty sp ON sp.specialty_key = f.specialty_key
     JOIN dim_department de ON de.department_key = f.department_key JOIN dim_encounter_type ty USING (encounter_type_key)"""
CTES["primary_pairs"] = """
SELECT d.icd10_code, d.icd10_description, d.diagnosis_category, p.cpt_code, p.cpt_description, p.procedure_category,
       bd.encounter_key, f.total_allowed_amount, f.length_of_stay_hours
FROM bridge_encounter_diagnoses bd JOIN bridge_encounter_procedures bp USING (encounter_key)
     JOIN dim_diagnosis d USING (diagnosis_key) JOIN dim_procedure p USING (procedure_key)
     JOIN fact_encounters f USING (encounter_key)
WHERE bd.diagnosis_sequence = 1"""
CTES["event_types"] = rows_sql(
    ["event_type_code", "event_description", "severity_level", "hipaa_category", "retention_days"],
    [(*r, RETENTION_DAYS) for r in AUDIT_EVENT_TYPES + ADDED_EVENT_TYPES],
)
CTES["roles"] = rows_sql(["role_name", "role_description", "access_level", "department", "can_access_phi"], USER_ROLES)
CTES["export_config"] = rows_sql(
    ["export_type", "output_format", "auto_export", "retention_days"],
    [(*r, EXPORT_RETENTION_DAYS) for r in EXPORT_CONFIG],
)


def _needs(text: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", text)]


def with_tables(body: str) -> str:
    """Prefix a query with the subqueries it needs, each after those it is built on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _needs(CTES[name]):
            if other != name:
                visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in _needs(body):
        visit(name)
    if not ordered:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in ordered) + "\n" + body.strip()
