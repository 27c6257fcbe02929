"""What must and must not appear in physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keys, lookup, succession
from tidemark.plans import gold
from tidemark.suite import lake
from tidemark.suite.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark):
    stage = lake.stage(spark, SF)
    stage.all_silver()
    stage.dims()
    return stage


BUILT_FROM_STAGE = [n for n in QUERIES if n.startswith(("gold_", "funnel_", "join_events", "event_duration"))]


@pytest.mark.parametrize("name", [*BUILT_FROM_STAGE, "silver_events", "scd2_apply", "merge_keep_surrogate"])
def test_no_python_rows_no_pairs_no_single_task_windows(spark, staged, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text
    # One task may finish a global aggregate; it must not sort or number a table.
    lines = text.splitlines()
    for above, line in zip(lines, lines[1:], strict=False):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[]" in above, above


def test_scans_read_only_what_a_fact_needs(staged):
    text = plan(gold.fact_rows("fact_session", staged.all_silver(), staged.dims()))
    sessions = next(t for t in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if "session_id" in t)
    columns = {re.sub(r"#\d+L?", "", c) for c in sessions.split(",")}
    assert "session_hour" not in columns and "is_weekend" not in columns
    assert "PushedFilters: [IsNull(validation_errors)]" in text


def test_lookups_follow_the_known_size(spark, staged):
    """A small stored dimension is broadcast; one above the threshold is not."""
    orders = staged.silver("orders").select("order_id", "country")
    dimension = staged.dimension("dim_country")
    arguments = ("country", dimension, "country_name", "country_key", "country_key")
    assert "BroadcastHashJoin" in plan(lookup.attach_dimension_key(orders, *arguments))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(lookup.attach_dimension_key(orders, *arguments))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_hot_session_is_spread_over_tasks(spark):
    """One session with all events: no window partition may hold a large share of them."""
    events = spark.range(40000).select(
        F.lit(1).cast("long").alias("session_id"),
        F.col("id").alias("event_id"),
        (F.lit(1704067200) + F.col("id") * 30).cast("timestamp").alias("timestamp"),
    )
    rows = succession.seconds_to_next(events, "session_id", "timestamp", "event_id", "duration")
    text = plan(rows)
    windows = re.findall(r"Window \[lead\(.*?\], \[(.*?)\], \[", text)
    assert any("_slot" in partition for partition in windows)
    slots = events.groupBy("session_id", succession._slot("timestamp").alias("slot")).count()
    assert slots.agg(F.max("count")).first()[0] <= 10
    durations = {r["duration"]: r["count"] for r in rows.groupBy("duration").count().collect()}
    assert durations == {30.0: 39999, 0.0: 1}


def test_bounds_come_from_footers(spark, store):
    from tidemark.sources import statistics

    frame = spark.range(1000).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS day", "id % 3 AS p", "CAST(id AS STRING) AS name")
    store.overwrite("gold", "t", frame, "p")
    rows = statistics.bounds_frame(spark, store.path("gold", "t"), store.schema("gold", "t"), ["id", "day"])
    assert "PushedAggregation: [MIN(id), MAX(id), MIN(day), MAX(day)]" in plan(rows)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    found = store.bounds("gold", "t", ["id", "day", "name"])
    assert found["id"] == (0, 999) and str(found["day"][1]) == "2026-09-26" and found["name"] == ("0", "999")
    # a partition without the later column, and one without rows
    store.upsert("gold", "t", spark.sql("SELECT 5000L AS id, 7L AS p, 1L AS late"), ["id"])
    store.upsert("gold", "t", spark.sql("SELECT 5000L AS id, 8L AS p, 2L AS late"), ["id"])
    assert store.bounds("gold", "t", ["late", "id"]) == {"late": (2, 2), "id": (0, 5000)}


def test_history_is_read_once(spark, store):
    from tidemark.operators.dimensions import scd2_dimension

    source = spark.range(100).selectExpr("id AS k", "id % 7 AS a")
    store.overwrite("gold", "d", scd2_dimension(source, "k", "s", ["a"], "2024-01-01 00:00:00"))
    later = spark.range(50, 150).selectExpr("id AS k", "id % 5 AS a")
    start = store.bounds("gold", "d", ["s"])["s"][1]
    rows = scd2_dimension(later, "k", "s", ["a"], "2024-02-01 00:00:00", store.read("gold", "d"), start)
    text = plan(rows)
    assert text.count("FileScan parquet") == 1 and "FullOuter" in text
    same = sum(i % 7 == i % 5 for i in range(50, 100))
    assert rows.count() == 100 + 50 + (50 - same) and rows.where("is_current").count() == 150


def test_numbering_takes_one_exchange(spark):
    text = plan(keys.assign_surrogate_key(spark.range(10), "k", ["id"]))
    assert text.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in text


@pytest.mark.parametrize("hot", [7, None])
def test_hot_lookup_keys_are_split(spark, hot):
    """Above the broadcast threshold, a key (or the NULL key) with most rows is read by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 > 0, F.lit(hot)).otherwise(F.col("id") % 1000).cast("int")
        facts = spark.range(0, 600000, 1, 16).select(key.alias("customer_id"), F.rand(1).alias("payload"))
        dimension = spark.range(1000).selectExpr(
            "CAST(id AS INT) AS customer_id", "id + 1 AS customer_key", "true AS is_current"
        )
        rows = lookup.attach_current(facts, dimension, "customer_id", "customer_key")
        assert rows.agg(F.count("*"), F.count("payload"), F.count("customer_key")).first()[0] == 600000
        # Executing the frame itself makes its adaptive plan final.
        rows._jdf.queryExecution().executedPlan().executeCollect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
