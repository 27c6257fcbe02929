"""Whole layers: the gate, failures, watermarks, increments against full builds, the command line."""

import pytest
from pyspark.sql import functions as F

from tidemark import __main__ as cli
from tidemark.plans import gold, runs
from tidemark.plans.bronze import to_bronze
from tidemark.plans.watermark import Watermark
from tidemark.sources.catalog import GOLD_TABLES, gold_table
from tidemark.sources import tables
from tidemark.sources.schemas import DATASETS
from tidemark.sources.tables import TableStore

D1, D2, D3 = "2024-01-15", "2024-01-16", "2024-01-17"


def at(day):
    return f"{day} 06:00:00"


ROWS = {
    "customers": [(1, "Ann", "ann@x.example", "NL", 30, "2023-01-01", "yes"), (2, "Bo", "b@x.example", "BE", 40, "2023-01-02", "no")],
    "products": [(10, "toys", "Top", 10.0, 4.0, 6.0), (11, "food", "Fig", 3.0, 1.0, 2.0)],
    "orders": [(100, 1, "2024-01-10 10:00:00", "card", 0.0, 20.0, 20.0, "NL", "web", "ads")],
    "order_items": [(100, 10, 10.0, 2, 20.0)],
    "reviews": [(1000, 100, 10, 5, "fine", "2024-01-11 10:00:00")],
    "sessions": [(1, 1, "2024-01-10 09:00:00", "web", "ads", "NL")],
    "events": [
        (1, 1, "2024-01-10 09:00:00", "page_view", 10.0, None, None, None, None, None),
        (2, 1, "2024-01-10 09:01:00", "add_to_cart", 10.0, 1.0, None, None, None, None),
        (3, 1, "2024-01-10 09:02:00", "checkout", None, None, 1.0, None, None, None),
        (4, 1, "2024-01-10 10:00:00", "purchase", None, None, None, "card", None, 20.0),
    ],
}

LATER = {
    "orders": [(101, 2, "2024-01-12 10:00:00", "bank", 0.0, 6.0, 6.0, "BE", "app", "mail")],
    "order_items": [(101, 11, 3.0, 2, 6.0), (101, 99, 1.0, 1, 1.0)],
    "reviews": [(1001, 101, 11, 2, "meh", "2024-01-13 10:00:00")],
    "sessions": [(2, 2, "2024-01-12 09:00:00", "app", "mail", "BE")],
    "events": [
        (5, 1, "2024-01-10 11:30:00", "page_view", 11.0, None, None, None, None, None),
        (6, 2, "2024-01-12 09:00:00", "page_view", 11.0, None, None, None, None, None),
    ],
}


def deliver(spark, store, day, rows):
    for name, dataset in DATASETS.items():
        frame = spark.createDataFrame(rows.get(name, []), dataset.schema)
        store.add_bronze(name, to_bronze(frame, name, day, at(day)))


def refine(store, day):
    summary = runs.run_silver(store, day, at(day))
    assert summary.succeeded, summary.failed


def content(frame, without=()):
    keep = [c for c in sorted(frame.columns) if c not in without]
    return sorted(map(tuple, frame.select(*keep).collect()), key=str)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Two deliveries, the second built incrementally."""
    store = TableStore(spark, str(tmp_path_factory.mktemp("lake")))
    deliver(spark, store, D1, ROWS)
    refine(store, D1)
    first = runs.run_gold(store, D1, at(D1))
    keys = {t: {r[1]: r[0] for r in gold_table(store, t).collect()} for t in gold.FACTS if t != "fact_customer_funnel"}
    deliver(spark, store, D2, LATER)
    refine(store, D2)
    second = runs.run_gold(store, D2, at(D2))
    return store, first, second, keys


def test_gate():
    assert runs.decide("incremental", None, None) == runs.Gate("skip")
    assert runs.decide("incremental", D1, None) == runs.Gate("full")
    assert runs.decide("incremental", D1, D1) == runs.Gate("skip")
    assert runs.decide("incremental", D2, D1) == runs.Gate("incremental", D1)
    assert runs.decide("full", D1, D1) == runs.Gate("full")


def test_arguments():
    with pytest.raises(ValueError, match="mode"):
        runs.check_gold_arguments("fact_order", "half")
    with pytest.raises(ValueError, match="supported"):
        runs.check_gold_arguments("fact_nothing", "full")
    with pytest.raises(ValueError, match="layer"):
        runs.run_layer(None, "platinum", D1, at(D1))


def test_first_run_is_full_and_second_incremental(lake):
    store, first, second, _ = lake
    assert first.succeeded and set(first.done) == {*GOLD_TABLES, runs.WATERMARK_STEP}
    assert {first.done[t] for t in GOLD_TABLES} == {"full"}
    incremental = {t for t in GOLD_TABLES if second.done[t] == "incremental"}
    assert incremental == set(gold.FACTS)
    assert Watermark(store).get() == D2


def test_increment_equals_full_build(lake):
    store = lake[0]
    silver, dims = runs.read_silver(store), runs._dims(store)
    for table, fact in gold.FACTS.items():
        full = gold.keyed(gold.fact_rows(table, silver, dims), table)
        assert content(gold_table(store, table), [fact.key]) == content(full, [fact.key]), table


def test_a_funnel_increment_reads_new_events_only(spark, lake):
    store = lake[0]
    fresh = gold.funnel_steps(gold.processed_since(gold.valid_rows(store.read("silver", "events")), D1))
    text = fresh._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "PartitionFilters" in line or "FileScan" in line]
    assert scans and all(f"(silver_process_date" in line and f"> {D1})" in line for line in scans)
    # a cart of the first delivery is checked out in the second one, an order of the first bought by a late purchase event
    steps = spark.createDataFrame(
        [("d1", 1, "add_to_cart", 10, "2024-01-01 10:00:00"), ("d2", 1, "checkout", None, "2024-01-02 09:00:00"), ("d2", 1, "purchase", None, "2024-01-02 10:00:00")]
        + [("d1", 2, "page_view", 11, "2024-01-01 10:00:00")],
        "silver_process_date STRING, session_id LONG, event_type STRING, product_id LONG, timestamp STRING",
    ).selectExpr("*", "CAST(timestamp AS TIMESTAMP) AS t").drop("timestamp").withColumnRenamed("t", "timestamp")
    steps = steps.selectExpr("*", "to_date(timestamp) AS event_date")
    day = "'d1' AS silver_process_date"
    sessions = spark.sql(f"SELECT * FROM VALUES (1L, 7L), (2L, 8L) AS s(session_id, customer_id)").selectExpr("*", day)
    orders = spark.sql(
        f"SELECT 5L AS order_id, 7L AS customer_id, TIMESTAMP'2024-01-02 10:00:00' AS order_time, DATE'2024-01-02' AS order_date, {day}"
    )
    items = spark.sql(f"SELECT 5L AS order_id, 12L AS product_id, {day}")
    delta = gold.funnel_delta(steps, sessions, orders, items, "d1")
    whole = gold.funnel_dates(steps, sessions, orders, items)
    text = lambda frame: sorted(str(tuple(r)) for r in frame.collect())
    assert text(delta) == text(whole.where("customer_id = 7")) and delta.count() == 2


def test_shares_of_sessions_make_the_same_increment(lake, monkeypatch):
    store = lake[0]
    monkeypatch.setattr(tables, "AT_ONCE", store.bytes_under(store.path("silver", "events")) // 3)
    silver, dims = runs.read_silver(store), runs._dims(store)
    parts = runs._by_sessions(store, {name: silver[name] for name in ("events", "sessions")})
    whole = gold.delta_rows("fact_web_events", silver, D1, dims)
    cut = [gold.delta_rows("fact_web_events", {**silver, **part}, D1, dims) for part in parts]
    text = lambda frames: sorted(str(tuple(r)) for frame in frames for r in frame.collect())
    assert len(parts) > 2 and text(cut) == text([whole]) and whole.count() > 0


def test_increment_keeps_keys(lake):
    store, _, _, keys = lake
    for table, before in keys.items():
        after = {r[1]: r[0] for r in gold_table(store, table).collect()}
        if table != "fact_order_item":
            assert {k: after[k] for k in before} == before
        assert len(set(after.values())) == len(after)


def test_duration_reaches_across_deliveries(lake):
    """The last event of the first delivery gets its gap once a later event of the session arrives."""
    got = {r["event_id"]: r["duration"] for r in gold_table(lake[0], "fact_web_events").collect()}
    assert got == {1: 60.0, 2: 60.0, 3: 3480.0, 4: 5400.0, 5: 0.0, 6: 0.0}


def test_lines_of_unknown_products_are_not_repeated(spark, lake):
    """Delivered again, a line without a product key is updated, not added."""
    store = lake[0]
    before = gold_table(store, "fact_order_item").where("product_key IS NULL").count()
    deliver(spark, store, D3, {"order_items": LATER["order_items"]})
    refine(store, D3)
    assert runs.run_gold(store, D3, at(D3)).succeeded
    assert gold_table(store, "fact_order_item").where("product_key IS NULL").count() == before == 1


def test_nothing_new_skips(lake):
    store = lake[0]
    assert runs.build_gold(store, "fact_order", D3, at(D3)) == "skip"
    done = runs.run_gold(store, D3, at(D3)).done
    assert {done[table] for table in GOLD_TABLES} == {"skip"}


def test_failure_stops_the_watermark_only(spark, store):
    deliver(spark, store, D1, ROWS)
    refine(store, D1)
    broken = store.read("silver", "reviews").drop("rating")
    store.overwrite("silver", "reviews", broken)
    summary = runs.run_gold(store, D1, at(D1))
    assert set(summary.failed) == {"fact_review"}
    assert "fact_session" in summary.done and runs.WATERMARK_STEP not in summary.done
    assert Watermark(store).get() is None


def test_missing_dependencies_are_named(spark, store):
    deliver(spark, store, D1, ROWS)
    refine(store, D1)
    with pytest.raises(RuntimeError, match="gold.dim_category"):
        runs.build_gold(store, "dim_products", D1, at(D1))


def test_missing_fact_is_built_whole(spark, store):
    deliver(spark, store, D1, ROWS)
    refine(store, D1)
    for table in ("dim_category", "dim_products", runs.WATERMARK_STEP):
        runs.build_gold(store, table, D1, at(D1))
    for table in ("dim_country", "dim_source", "dim_device", "dim_payment_method", "dim_date", "dim_customers"):
        runs.build_gold(store, table, D1, at(D1), "full")
    deliver(spark, store, D2, LATER)
    refine(store, D2)
    assert runs.build_gold(store, "fact_review", D2, at(D2)) == "full"
    assert gold_table(store, "fact_review").count() == 2


def test_late_dataset_with_its_own_watermark(spark, store):
    """Reviews of an older date that arrive after a newer run are picked up only with marks per dataset."""
    deliver(spark, store, D1, ROWS)
    deliver(spark, store, D2, {"reviews": LATER["reviews"]})
    deliver(spark, store, D3, {"sessions": LATER["sessions"]})
    refine(store, D1)
    runs.refine_silver(store, "sessions", D3, at(D3))
    assert runs.run_gold(store, D3, at(D3), per_dataset=True).succeeded
    runs.refine_silver(store, "reviews", D2, at(D2))
    assert runs.gate(store, "incremental") == runs.Gate("skip")
    summary = runs.run_gold(store, D3, at(D3), per_dataset=True)
    assert summary.done["fact_review"] == "incremental" and summary.done["fact_session"] == "skip"
    assert gold_table(store, "fact_review").count() == 2


def test_replayed_day_changes_nothing(spark, store):
    for _ in range(2):
        deliver(spark, store, D1, ROWS)
        refine(store, D1)
    assert store.read("silver", "order_items").select(F.sum("quantity")).first()[0] == 2


def test_command_line(spark, store, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for name, dataset in DATASETS.items():
        lines = [",".join("" if v is None else str(v) for v in row) for row in ROWS[name]]
        (landing / f"{name}.csv").write_text("\n".join([",".join(dataset.columns), *lines]) + "\n")

    def call(*arguments):
        return cli.run(cli.parse(["--base", store.base, "--at", at(D1), *arguments]), store)

    assert len(call("bronze", D1, str(landing)).done) == 7
    assert call("bronze", D1, str(landing / "events.csv")).done == {"events": "ok"}
    assert call("bronze", D1, str(landing / "events.csv"), "events", "--append", "--report").done == {"events": "ok"}
    assert store.bronze("events").count() == 8
    assert call("silver", D1, "events").done == {"events": "ok"}
    assert len(call("silver", D1).done) == 7
    assert call("gold", D1, "dim_country").done == {"dim_country": "full"}
    assert len(call("gold", D1, "--mode", "full").done) == 15
    assert not call("bronze", D1, str(tmp_path / "absent.csv"), "events").succeeded
