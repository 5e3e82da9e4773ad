"""Reference rows that the clinical and audit catalogues start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Audit event catalogue (code, description, severity, HIPAA category).
AUDIT_EVENT_TYPES = [
    ("PATIENT_ACCESS", "Patient record accessed", "MEDIUM", "PHI_ACCESS"),
    ("PATIENT_CREATE", "New patient record created", "HIGH", "PHI_CREATE"),
    ("PATIENT_UPDATE", "Patient record modified", "HIGH", "PHI_MODIFY"),
    ("PATIENT_DELETE", "Patient record deleted", "CRITICAL", "PHI_DELETE"),
    ("DIAGNOSIS_ACCESS", "Diagnosis information accessed", "MEDIUM", "CLINICAL_ACCESS"),
    ("DIAGNOSIS_CREATE", "New diagnosis entered", "HIGH", "CLINICAL_CREATE"),
    ("BILLING_ACCESS", "Billing information accessed", "MEDIUM", "FINANCIAL_ACCESS"),
    ("BILLING_UPDATE", "Billing information modified", "HIGH", "FINANCIAL_MODIFY"),
    ("USER_LOGIN", "User authentication successful", "LOW", "SECURITY"),
    ("USER_LOGOUT", "User session terminated", "LOW", "SECURITY"),
    ("FAILED_LOGIN", "Authentication attempt failed", "MEDIUM", "SECURITY"),
    ("PRIVILEGE_ESCALATION", "User privileges elevated", "HIGH", "SECURITY"),
    ("DATA_EXPORT", "Healthcare data exported", "HIGH", "PHI_EXPORT"),
    ("SYSTEM_BACKUP", "System backup performed", "MEDIUM", "SYSTEM"),
    ("ETL_EXECUTION", "ETL process executed", "LOW", "SYSTEM"),
    ("SCHEMA_CHANGE", "Database schema modified", "HIGH", "SYSTEM"),
]

# Codes that change capture and archiving emit and the catalogue above lacks.
ADDED_EVENT_TYPES = [
    ("DIAGNOSIS_UPDATE", "Diagnosis changed", "HIGH", "CLINICAL_MODIFY"),
    ("DIAGNOSIS_DELETE", "Diagnosis removed", "CRITICAL", "CLINICAL_DELETE"),
    ("BILLING_CREATE", "Billing row added", "HIGH", "FINANCIAL_CREATE"),
    ("BILLING_DELETE", "Billing row removed", "CRITICAL", "FINANCIAL_DELETE"),
    ("DATA_CREATE", "Row added", "MEDIUM", "DATA_CREATE"),
    ("DATA_UPDATE", "Row changed", "MEDIUM", "DATA_MODIFY"),
    ("DATA_DELETE", "Row removed", "HIGH", "DATA_DELETE"),
    ("SYSTEM_ARCHIVE", "Audit rows archived", "LOW", "SYSTEM"),
]

# Fixed value: seven years of retention for every event type.
RETENTION_DAYS = 2555

# Role catalogue (name, description, access level, department, may read PHI).
USER_ROLES = [
    ("PHYSICIAN", "Licensed physician with full patient access", "WRITE", "CLINICAL", True),
    ("NURSE", "Registered nurse with patient care access", "WRITE", "CLINICAL", True),
    ("BILLING_CLERK", "Billing department with financial access", "WRITE", "BILLING", True),
    ("IT_ADMIN", "System administrator", "ADMIN", "IT", True),
    ("ANALYST", "Data analyst with aggregated data access", "READ", "ANALYTICS", False),
    ("AUDITOR", "Compliance auditor with audit trail access", "READ", "COMPLIANCE", True),
    ("ETL_SERVICE", "Automated ETL service account", "SYSTEM", "SYSTEM", True),
]

# Default exports (type, format, exported automatically). The retention is in days.
EXPORT_CONFIG = [
    ("LOGS", "CSV", True),
    ("LOGS", "JSON", True),
    ("QUALITY_REPORT", "HTML", True),
    ("PERFORMANCE", "CSV", False),
    ("SUMMARY", "JSON", True),
]
EXPORT_RETENTION_DAYS = 30

# Severity order, lowest first.
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_rows(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Small fixed rows as a local relation, whose exact size the optimizer knows."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def audit_event_types(spark: SparkSession, extended: bool = True) -> DataFrame:
    rows = AUDIT_EVENT_TYPES + (ADDED_EVENT_TYPES if extended else [])
    return literal_rows(
        spark,
        ["event_type_code", "event_description", "severity_level", "hipaa_category", "retention_days"],
        [(*row, RETENTION_DAYS) for row in rows],
    )


def user_roles(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark, ["role_name", "role_description", "access_level", "department", "can_access_phi"], USER_ROLES
    )


def export_config(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark,
        ["export_type", "output_format", "auto_export", "retention_days"],
        [(*row, EXPORT_RETENTION_DAYS) for row in EXPORT_CONFIG],
    )
