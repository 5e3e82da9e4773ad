"""Timing of the headline queries over stored tables; prints one JSON line.

The four business questions run on the clinical source tables and on the stored star schema. Every query produces its
whole result (``noop`` sink); the figure is the median of several runs, the first run is reported apart. Writing the source tables is
not timed; the load of the warehouse and of the stored pair aggregate is reported apart.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from wardlake.plans import queries_source as QS
from wardlake.plans import queries_star as Q
from wardlake.plans.load import run_warehouse_load
from wardlake.plans.warehouse import open_warehouse
from wardlake.session import build_session, fresh_path
from wardlake.sources.fixture import CALENDAR, CLINICAL_AS_OF, clinical_tables
from wardlake.sources.tables import open_clinical_parquet, store_tables


def timed(action, runs: int) -> tuple[float, float]:
    """Seconds of the first run, with the look-up of hot keys and the compiling, and the median of the later ones."""
    seconds = []
    for _ in range(runs + 1):
        begin = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - begin)
    return round(seconds[0], 4), round(statistics.median(seconds[1:]), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    clinical = fresh_path(spark, "clinical")
    store_tables(clinical_tables(spark, sf_dir), clinical, files=int(cpus))
    src = open_clinical_parquet(spark, clinical)

    star = fresh_path(spark, "warehouse")
    begin = time.perf_counter()
    run_warehouse_load(spark, src, star, CLINICAL_AS_OF, "bench", CALENDAR)
    load_seconds = round(time.perf_counter() - begin, 3)
    wh = open_warehouse(spark, star)
    begin = time.perf_counter()
    Q.refresh_pair_summary(wh, f"{star}/pairs")
    pair_seconds = round(time.perf_counter() - begin, 3)
    summary = spark.read.parquet(f"{star}/pairs")

    as_of = CLINICAL_AS_OF
    queries = {
        "q1_source": lambda: QS.monthly_encounters(src),
        "q2_source": lambda: QS.diagnosis_procedure_pairs(src, described=True),
        "q3_source": lambda: QS.inpatient_return_rates(src),
        "q4_source": lambda: QS.monthly_revenue(src),
        "q1_star": lambda: Q.monthly_volume_short(wh, as_of),
        "q1_star_full": lambda: Q.monthly_volume(wh, as_of),
        "q2_star_stored": lambda: Q.top_stored_pairs(summary),
        "q2_star": lambda: Q.primary_pairs(wh),
        "q3_star": lambda: Q.readmission_from_flags(wh),
        "q4_star": lambda: Q.revenue_short(wh, as_of),
        "q4_star_full": lambda: Q.revenue_trend(wh, as_of),
    }
    seconds, first = {}, {}
    for name, make in queries.items():
        first[name], seconds[name] = timed(lambda: make().write.format("noop").mode("overwrite").save(), runs)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "first_run": first,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "encounters": src["encounters"].count(),
        "warehouse_load_sec": load_seconds,
        "pair_aggregate_build_sec": pair_seconds,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    sys.exit(main())
