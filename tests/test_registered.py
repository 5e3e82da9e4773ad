"""Registered queries against their SQL counterparts on the smallest data.

All of them run with ``WARDLAKE_ALL=1``; otherwise one of each kind.
"""

import os

import pytest

from wardlake.registry import catalog
from wardlake.registry.compare import differences

ORACLE = catalog.oracle_sql()
CHOSEN = [
    "a11_contiguous_key",
    "c08_correlated_min_and_count",
    "d14_ordered_struct_list",
    "j09_fact_encounters",
    "j14_encounter_analytics",
    "j18_incremental_fact",
    "j16_after_changes",
    "j23_returned_rows",
    "k01_monthly_encounters",
    "k03_pairs_described",
    "k05_inpatient_return_rates",
    "k07_monthly_revenue",
    "k10_primary_pairs",
    "k12_revenue_trend",
    "l15_validation_report",
    "m04_execution_log_csv",
    "m05_run_documents",
    "n02_changed_patients",
    "n04_hipaa_access_report",
    "n08_archive",
    "n11_day_digests",
    "o02_sliding_alerts",
    "o03_access_sessions",
    "o01_event_accounts",
    "o04_late_totals",
]
NAMES = list(ORACLE) if os.environ.get("WARDLAKE_ALL") else CHOSEN


def test_every_query_has_a_counterpart_and_unique_columns():
    assert set(ORACLE) == set(catalog.queries())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, small, name):
    _, notes = differences(catalog.queries()[name](spark, small), ORACLE[name], small)
    assert not notes
