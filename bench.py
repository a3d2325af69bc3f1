"""Benchmark: build the sales model and run every analysis at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_SHUFFLE_PARTITIONS (default twice the cores, at least 8).
Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is forced with the ``noop`` sink, so the whole plan runs without collecting rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.api import QUERIES  # noqa: E402
from ledgerline.plans.model import build_model  # noqa: E402
from ledgerline.session import local_session, scratch_root  # noqa: E402

# Headline queries: the modelling job first, then every question asked of the model.
TIMED = [
    "margin_by_category",
    "margin_waterfall",
    "customer_abc",
    "critical_customers",
    "discount_bands",
    "freight_subsidy",
    "monthly_trend",
    "loss_products",
    "seller_performance",
    "panel",
    "load_counts",
    "fact_integrity",
    "parse_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus)))
    spark = local_session(cpus, shuffle_partitions=partitions, app="ledgerline-bench")
    scratch_root(spark)
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM and codegen warm-up

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    build_model(spark, sf_dir)
    times["build_model"] = round(time.perf_counter() - t0, 3)
    for name in TIMED:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sales_model_build_plus_analyses",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
