"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores, and
``BENCH_WORK_DIR`` the folder of intermediate tables (default a temporary one: the
session is local).
Every query is run to the last row into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratamart.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "stg_customers",
    "stg_orders",
    "stg_order_items",
    "stg_products",
    "stg_fx_rates",
    "fct_orders",
    "fct_order_items",
    "asof_fx_orders",
    "revenue_by_category",
    "revenue_by_country",
    "customer_segment_kpis",
    "top_category_last_month",
    "dq_orphan_items",
    "dq_revenue_range",
    "scd2_user_state",
    "merge_upsert",
    "stream_landing_upsert",
    "layered_build_log",  # the whole build: land, load, staging, curated, marts
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the JVM

    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
