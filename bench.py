"""Benchmark the headline queries.

Runs each query in ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8): one cold run,
then the median of ``$BENCH_REPS`` (default 3) warm runs, each with full execution
(results are consumed by a no-op sink) and the planning of its own query. Opening
the book (calendar, macro snapshots) and composing parts A and B, which all
queries share, is timed apart as ``setup_sec``.
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "stage_ecl",            # flagship: SICR staging, 12m vs lifetime allowance by stage
    "portfolio_kpis",       # part A: macro path, lookup, PIT PD, LGD/EAD/ECL, KPIs
    "vintage_stats",
    "stress_totals",        # part A additive stress
    "stage_ecl_stressed",   # part B ramp scenario, multiplicative stress, re-staging
    "allowance_increase",
    "basel_std_totals",     # part C standardised capital
    "irb_by_stage",         # part C IRB capital (normal quantile / CDF as expressions)
    "describe_pd",          # exact distributed quartiles
    "auc",                  # exact distributed rank-sum AUC
    "final_table",          # 26-column loan-grain export
    "stage_mix_stressed",   # base and stressed stage mix in one aggregate
    "basel_grade_band_join",  # grades by interval lookup
    "tape_reconciliation",  # orders, loans and unmatched orders by year
    "champion_metrics",     # exact split, documented scorecard, AUC and Brier
    "pd_backtest",          # the same with a fitted logistic regression
    "pk_check",             # primary keys of the mapped tables
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from creditspark.plans.registry import book, queries
    from creditspark.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="creditspark-bench")
    t0 = time.time()
    b = book(spark, sf_dir)  # the book's calendar: one small aggregate per directory
    b.part_a_stressed(), b.part_b_stressed()
    setup = time.time() - t0
    qs = queries()
    names = only or HEADLINE
    timings: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in names:
        runs = []
        for i in range(reps + 1):
            t = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t)
        cold[name] = round(runs[0], 3)
        timings[name] = round(statistics.median(runs[1:]), 3)
    sf = Path(sf_dir).name.replace("sf", "")
    out = {
        "metric": "sum_of_warm_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "cold": cold,
        "setup_sec": round(setup, 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "reps": reps,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
