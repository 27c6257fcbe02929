"""Time the headline queries: BENCH_SF_DIR and BENCH_CPUS choose input and cores; prints one JSON line.

Every timed query is computed to its last row and column through Spark's ``noop`` sink. Tables
a query reads (silver, dimensions) are written beforehand and timed as steps of their own.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import SETTINGS
from tidemark.sources.schemas import DATASETS
from tidemark.suite import lake
from tidemark.suite.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MEMORY = os.environ.get("BENCH_DRIVER_MEMORY", "16g")

HEADLINE = (
    *(f"silver_{name}" for name in DATASETS),
    "dedup_latest",
    "aggregate_order_items",
    "assign_surrogate_key",
    "merge_upsert",
    "merge_keep_surrogate",
    "join_events_sessions",
    "attach_dimension_key",
    "order_costs",
    "event_duration",
    "funnel_checkout_dates",
    "scd2_apply",
    "gold_dim_country",
    "gold_dim_customers",
    "gold_dim_products",
    "gold_dim_date",
    "gold_fact_order",
    "gold_fact_order_item",
    "gold_fact_web_events",
    "gold_fact_review",
    "gold_fact_session",
    "gold_fact_customer_funnel",
)


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("tidemark bench")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": MEMORY,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    timings: dict[str, float] = {}

    def timed(name: str, work) -> None:
        began = time.perf_counter()
        work()
        timings[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)

    # Start the JVM's compilers on a small job, which is not reported.
    drain(spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count())
    staged = lake.stage(spark, SF_DIR)
    timed("write_silver_tables", staged.all_silver)
    timed("write_dimension_tables", staged.dims)
    for name in HEADLINE:
        timed(name, lambda name=name: drain(QUERIES[name](spark, SF_DIR)))
    timed("two_deliveries_end_to_end", lambda: lake.two_deliveries(spark, SF_DIR))

    report = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": SF_DIR.rstrip("/").rsplit("/sf", 1)[-1],
        "cpus": int(CPUS),
        "driver_memory": MEMORY,
        "spark": spark.version,
        "python": platform.python_version(),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
