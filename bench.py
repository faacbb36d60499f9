"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the tables, ``BENCH_CPUS`` (default 8) the cores. Every query runs
once to warm up - that run also writes the mart tables it reads - and then ``BENCH_RUNS`` times (default 1); the median
counts. Results go to Spark's noop sink, so all rows are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.compare import local_session  # noqa: E402
from checks.registry import CHECKS  # noqa: E402

HEADLINE = (
    "invoice_revenue", "invoice_material_costs", "invoice_po_costs", "invoice_labor_costs",
    "invoice_labor_costs_multiplied", "job_returns", "sa_period_measures", "employee_commission_rates",
    "dim_job", "dim_serviceagreement", "fact_invoice_star", "fact_invoiceitem", "fact_sa_period", "report_jobs_side",
    "report_sa_side", "commission_report_union", "job_metrics", "sa_metrics", "invoice_metrics", "employee_metrics",
    "metrics_long", "metric_compare", "baseline_diff", "surrogate_key_dense", "sa_renewal_year", "eav_latest",
    "eav_pivot_rates", "listagg_distinct_numeric", "period_replace", "dq_unique_keys",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))

    def once(name: str) -> float:
        started = time.perf_counter()
        CHECKS[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times, first = {}, {}
    for name in HEADLINE:
        first[name] = round(once(name), 3)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "first_run": first, "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
