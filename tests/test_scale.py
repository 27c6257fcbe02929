"""Disk and memory of layered runs: shuffle files, partitions sized by the input, exchanges that are not needed."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm.common import stage
from tidemark.operators.succession import seconds_to_next
from tidemark.plans import runs
from tidemark.sources import tables
from tidemark.sources.schemas import DATASETS
from tidemark.suite import fixtures, lake

PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.fixture()
def settings(spark):
    names = (PARTITIONS, session.ADVISORY, session.SHUFFLE_CLEANUP)
    before = {name: spark.conf.get(name) for name in names}
    yield before
    for name, value in before.items():
        spark.conf.set(name, value)


def _blocks(spark):
    """Names of the shuffle files on disk."""
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    names = {found.apply(i).name() for i in range(found.size())}
    return {name for name in names if name.startswith("shuffle_")}


def test_writes_drop_their_shuffle_files(spark, tmp_path, settings):
    rows = spark.range(50_000).repartition(8, "id")
    folder = str(tmp_path / "shuffles")
    with session.shuffles_dropped(spark):
        rows.write.parquet(folder)
        assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == settings[session.SHUFFLE_CLEANUP]
    assert spark.read.parquet(folder).count() == 50_000
    before = _blocks(spark)
    stage(spark.range(50_000).repartition(8, "id"), "shuffle-test")
    assert not _blocks(spark) - before


def test_a_side_of_unknown_size_is_broadcast_only_if_small(spark, tmp_path, settings, monkeypatch):
    before = spark.conf.get(session.BROADCAST)

    def plan():
        left, right = (spark.read.parquet(str(tmp_path / side)) for side in ("left", "right"))
        return left.join(right, "id")._jdf.queryExecution().executedPlan().toString()

    try:
        for side in ("left", "right"):
            spark.range(200_000).write.parquet(str(tmp_path / side))
        # three quarters of a megabyte in its file, five in memory
        monkeypatch.setattr(session, "BROADCAST_UNSEEN", 2**19)
        spark.conf.set(session.BROADCAST, "10m")
        assert "BroadcastHashJoin" in plan()
        session.fit_shuffles(spark, [])
        assert "SortMergeJoin" in plan()
        for lower in ("1k", "-1"):
            spark.conf.set(session.BROADCAST, lower)
            session.fit_shuffles(spark, [])
            assert spark.conf.get(session.BROADCAST) == lower
    finally:
        spark.conf.set(session.BROADCAST, before)


def test_partitions_follow_the_input(spark, tmp_path, settings, monkeypatch):
    (tmp_path / "t.parquet").mkdir()
    pq.write_table(pa.table({"a": list(range(10_000))}), tmp_path / "t.parquet" / "part-0.parquet")
    size = os.path.getsize(tmp_path / "t.parquet" / "part-0.parquet")
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", size // 40)
    spark.conf.set(PARTITIONS, "8")
    session.fit_shuffles(spark, [str(tmp_path / "t.parquet"), str(tmp_path / "none.parquet")])
    assert 40 <= int(spark.conf.get(PARTITIONS)) <= 42
    assert int(spark.conf.get(session.ADVISORY).rstrip("b")) == session.TASK_SHARE
    # more partitions, or smaller ones, stay
    spark.conf.set(PARTITIONS, "211")
    spark.conf.set(session.ADVISORY, "16k")
    session.fit_shuffles(spark, [str(tmp_path / "t.parquet")])
    assert (spark.conf.get(PARTITIONS), spark.conf.get(session.ADVISORY)) == ("211", "16k")


def test_a_delivery_of_one_date_is_written_without_an_exchange(spark, store):
    # eight tasks of 10 rows each leave eight files; brought together by date they were one
    rows = spark.range(0, 80, 1, 8).withColumn("day", F.lit("2024-01-15"))
    store.overwrite("silver", "t", rows, "day", few_partitions=True)
    files = [name for name in os.listdir(f"{store.path('silver', 't')}/day=2024-01-15") if name.endswith(".parquet")]
    assert len(files) == 8 and all(".zstd." in name for name in files)
    assert store.read("silver", "t").count() == 80 and store.has_few_partitions("silver", "t")
    later = spark.range(40, 120).withColumn("day", F.lit("2024-01-31"))
    store.upsert("silver", "t", later, ["id"], partition_by="day")
    assert {tuple(row) for row in store.read("silver", "t").groupBy("day").count().collect()} == {("2024-01-15", 40), ("2024-01-31", 80)}


def test_stored_rows_stand_for_derived_ones(spark, tmp_path):
    columns = DATASETS["events"].columns
    row = {name: None for name in columns} | {"event_id": 1, "timestamp": "1999-12-31 00:00:00", "event_type": "checkout"}
    types = fixtures.raw(spark, "/root/testdata/sf0.001", "events").schema
    stored = spark.createDataFrame([tuple((row | change)[n] for n in types.names) for change in ({}, {"event_id": 2, "timestamp": "2001-01-01 00:00:00"}, {"event_id": None, "event_type": None})], types)
    first = fixtures.raw(spark, "/nowhere", "events", 1, stored=stored)
    second = fixtures.raw(spark, "/nowhere", "events", 2, stored=stored)
    assert [r.event_id for r in first.orderBy(F.col("event_id").asc_nulls_first()).collect()] == [None, 1]
    assert [r.event_id for r in second.orderBy("event_id").collect()] == [1, 2]


def test_landing_files_are_compressed(spark, tmp_path):
    path = lake.write_landing(spark.createDataFrame([(1, " a ")], "id INT, name STRING"), str(tmp_path / "t.csv"))
    assert all(name.endswith(".csv.gz") for name in os.listdir(path) if name.startswith("part-"))
    back = spark.read.option("header", True).options(**lake.csv_options("customers")).csv(path)
    assert [tuple(r) for r in back.collect()] == [("1", " a ")]


def test_deliveries_keep_tables_only(spark, tmp_path, settings):
    deliveries = lake.TwoDeliveries(spark, "/root/testdata/sf0.001")
    folder = deliveries.store.base.rsplit("/", 1)[0].removeprefix("file:")
    assert os.listdir(folder) == ["tables"] or sorted(os.listdir(folder)) == ["landing", "tables"]
    assert not os.path.exists(f"{folder}/events")
    assert not [name for _, _, names in os.walk(f"{folder}/landing") for name in names]
    assert deliveries.gold("fact_order").count() > 0


def test_files_are_cut_into_bounded_shares(spark, tmp_path):
    before = spark.conf.get(session.SPLIT)
    try:
        for given, kept in (("128m", str(session.TASK_SHARE)), ("1m", "1m")):
            spark.conf.set(session.SPLIT, given)
            session.fit_shuffles(spark, [str(tmp_path / "none.parquet")])
            assert spark.conf.get(session.SPLIT) == kept
    finally:
        spark.conf.set(session.SPLIT, before)


def test_large_layers_run_one_table_at_a_time(spark, store, tmp_path, monkeypatch):
    assert (runs.abreast(runs.LARGE), runs.abreast(runs.LARGE + 1)) == (runs.SIDE_BY_SIDE, 1)
    seen = []
    monkeypatch.setattr(runs, "run_all", lambda items, at_once=None: seen.append(at_once) or runs.Summary())
    monkeypatch.setattr(runs, "gate", lambda *_: runs.Gate("skip"))
    (tmp_path / "landed.csv").write_text("a" * 10)
    for table in ("bronze", "silver"):
        spark.range(10).write.parquet(store.path(table, "orders"))
    for large in (1, 2**40):
        monkeypatch.setattr(runs, "LARGE", large)
        runs.run_bronze(store, dict.fromkeys(DATASETS, str(tmp_path / "landed.csv")), "2024-01-15", "2024-01-15 06:00:00")
        runs.run_silver(store, "2024-01-15", "2024-01-15 06:00:00")
        runs.run_gold(store, "2024-01-15", "2024-01-15 06:00:00")
    layers = 2 + len(runs.GOLD_GROUPS)
    marks = [None]  # the watermark is a single item
    assert seen == [1] * layers + marks + [runs.SIDE_BY_SIDE] * layers + marks


def test_staged_rows_are_gone_afterwards(spark, store):
    with store.staged("gold", "t", spark.range(20)) as rows:
        assert rows.count() == 20 and os.listdir(f"{store.base}/_staging")
    assert not os.listdir(f"{store.base}/_staging")


OWNED = [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:00:00", 2), ("a", "2024-01-01 02:00:00", 3), ("a", None, 4), ("a", None, 5),
         ("b", "2024-01-01 00:00:07", 6), ("b", None, 7), ("c", "2024-01-01 00:00:01", 8), (None, "2024-01-01 00:00:01", 9), (None, None, 10)]


def _owned(spark):
    rows = spark.createDataFrame(OWNED, "session STRING, at STRING, id INT").withColumn("at", F.col("at").cast("timestamp"))
    owners = spark.createDataFrame([("a", 100), ("b", 200), ("b", 201), ("d", 300), (None, 400)], "session STRING, owner INT")
    return rows, owners


def test_owners_come_with_the_summary_as_by_a_join(spark):
    rows, owners = _owned(spark)
    after = seconds_to_next(rows, "session", "at", "id", "gap").join(owners, "session").select("id", "owner", "gap")
    together = seconds_to_next(rows, "session", "at", "id", "gap", owners).select("id", "owner", "gap")
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, after.collect()))
    assert {r.id: r.gap for r in together.where("owner = 100").collect()} == {1: 0.0, 2: 7200.0, 3: 0.0, 4: 0.0, 5: 0.0}


def test_rows_with_owners_are_shuffled_once(spark, settings):
    rows, owners = _owned(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = seconds_to_next(rows, "session", "at", "id", "gap", owners)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the rows and the summary's parts by group and slot, the summary by slot order, by group and back again, the owners
    by_group = [line for line in plan.splitlines() if "Exchange hashpartitioning(session" in line and "_slot" not in line]
    assert len(by_group) == 2, plan  # the summary for its order and the owners; never the rows


def _moved(spark, store, monkeypatch, at_once):
    """A table merged twice, rows moving between partitions, with jobs of at most ``at_once`` bytes; and the partitions of each job."""
    monkeypatch.setattr(tables, "AT_ONCE", at_once)
    jobs, replace = [], store._replace_partitions
    monkeypatch.setattr(store, "_replace_partitions", lambda path, rows, by, wanted: jobs.append(sorted(wanted)) or replace(path, rows, by, wanted))
    first = spark.range(40).selectExpr("id AS k", "concat('p', id % 5) AS part", "'old' AS v")
    later = [
        spark.range(20, 30).selectExpr("id AS k", "nullif(concat('p', (id + 1) % 5), 'p3') AS part", "'new' AS v"),
        spark.range(38, 45).selectExpr("id AS k", "concat('p', id % 7) AS part", "'new' AS v"),
    ]
    for rows in (first, later, later):
        store.upsert("gold", "moved", rows, ["k"], "key", "part") if store.exists("gold", "moved") else store.overwrite(
            "gold", "moved", rows.selectExpr("k + 100 AS key", "*"), "part"
        )
    stored = store.read("gold", "moved").select("key", "k", "part", "v")
    return sorted(map(tuple, stored.collect()), key=str), jobs


def test_a_merge_rewrites_partitions_in_bounded_jobs(spark, tmp_path, monkeypatch):
    at_once, whole = _moved(spark, tables.TableStore(spark, str(tmp_path / "a")), monkeypatch, 2**40)
    one_by_one, cut = _moved(spark, tables.TableStore(spark, str(tmp_path / "b")), monkeypatch, 1000)
    assert one_by_one == at_once and len(at_once) == 45 and len({row[0] for row in at_once}) == 45
    assert len(whole) == 2 and all(len(job) == 1 for job in cut)
    assert sorted(part for job in cut for part in job) == sorted(part for job in whole for part in job)


def test_lines_are_shuffled_once_by_order_for_events(spark, settings):
    plan = fixtures.raw(spark, "/root/testdata/sf0.001", "events")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "order_id" in line]
    assert len(exchanges) == 2 and not any("product_id" in line.split("]")[0] for line in exchanges), plan
