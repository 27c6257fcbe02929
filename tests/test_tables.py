"""The table store: replaced partitions, merges, key indexes, bronze loads, catalog."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.upsert import matches
from tidemark.sources import catalog
from tidemark.sources.index import COMPACT_AFTER, KeyIndex
from tidemark.sources.landing import read_landing
from tidemark.sources.tables import AmbiguousMerge, DriftedType, TableMissing, TableStore
from tidemark.sources.workspace import shared_folder


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_missing_tables(store):
    assert not store.exists("gold", "x") and store.read_if_exists("gold", "x") is None
    with pytest.raises(TableMissing, match="gold.x"):
        store.read("gold", "x")
    with pytest.raises(TableMissing, match="bronze.x"):
        store.bronze("x")


def test_declared_columns_are_read_without_a_job(spark, store):
    kinds = "a BIGINT, b STRING, c TIMESTAMP, d DECIMAL(28,6), e DATE, f ARRAY<STRUCT<x: INT, y: DOUBLE>>, part_month INT"
    empty = spark.createDataFrame([], kinds)
    store.overwrite("gold", "t", empty)
    context = spark.sparkContext
    context.setJobGroup("declared-columns", "reading them")
    try:
        assert store.schema("gold", "t") == empty.schema == store.read("gold", "t").schema
        assert store.schema("gold", "none") is None
        assert not context.statusTracker().getJobIdsForGroup("declared-columns")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    # columns that another writer declared count at once
    TableStore(spark, store.base).overwrite("gold", "t", spark.range(1).select("id"))
    assert store.schema("gold", "t").names == ["id"]


def test_overwrite_from_itself(spark, store):
    for by in (None, "p"):
        store.overwrite("gold", f"t_{by}", spark.range(3).selectExpr("id AS a", "id % 2 AS p"), by)
        rebuilt = store.read("gold", f"t_{by}").selectExpr("a + 10 AS a", "p + 1 AS p").where("a < 12 AND p < 2")
        store.overwrite("gold", f"t_{by}", rebuilt, by)
        assert rows(store.read("gold", f"t_{by}")) == [(10, 1)]


def test_a_failed_rebuild_leaves_the_table(spark, store):
    for by in (None, "p"):
        store.overwrite("gold", f"t_{by}", spark.range(3).selectExpr("id AS a", "id % 2 AS p"), by)
        broken = store.read("gold", f"t_{by}").selectExpr("CAST(raise_error('no') AS BIGINT) AS a", "p")
        with pytest.raises(Exception, match="no"):
            store.overwrite("gold", f"t_{by}", broken, by)
        assert rows(store.read("gold", f"t_{by}")) == [(0, 0), (1, 1), (2, 0)]


def test_empty_tables_keep_their_schema(spark, store):
    empty = spark.range(0).selectExpr("id AS a", "CAST(id AS STRING) AS p")
    for by in (None, "p"):
        store.overwrite("gold", f"t_{by}", empty, by)
        frame = store.read("gold", f"t_{by}")
        assert frame.columns == ["a", "p"] and frame.count() == 0


def test_upsert_rewrites_only_touched_partitions(spark, store):
    first = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2"), (3, "c", "p3")], "k INT, v STRING, p STRING")
    store.upsert("silver", "t", first, ["k"], partition_by="p")
    # Row 1 moves from p1 to p2; p3 is not concerned.
    second = spark.createDataFrame([(1, "A", "p2"), (4, "d", "p4")], "k INT, v STRING, p STRING")
    store.upsert("silver", "t", second, ["k"])
    assert rows(store.read("silver", "t")) == [(1, "A", "p2"), (2, "b", "p2"), (3, "c", "p3"), (4, "d", "p4")]
    names = lambda part: store._files.names(f"{store.path('silver', 't')}/p={part}")
    untouched, moved = names("p3"), names("p2")
    store.upsert("silver", "t", second, ["k"])
    assert rows(store.read("silver", "t")) == [(1, "A", "p2"), (2, "b", "p2"), (3, "c", "p3"), (4, "d", "p4")]
    assert names("p3") == untouched and names("p2") != moved


def test_null_escaped_and_emptied_partitions(spark, store):
    shape = "k INT, v STRING, p STRING"
    first = [(1, "a", "p1"), (2, "b", "x/y z=%"), (3, "c", None), (4, "d", None), (5, "e", "p5"), (6, "f", "p5")]
    store.upsert("silver", "t", spark.createDataFrame(first, shape), ["k"], partition_by="p")
    # p1 and the odd one lose their only rows, one row leaves the NULL partition and one stays in it.
    second = [(1, "A", None), (2, "B", "p5"), (3, "C", "x/y z=%2"), (5, "E", "p5")]
    store.upsert("silver", "t", spark.createDataFrame(second, shape), ["k"])
    want = [*second, (4, "d", None), (6, "f", "p5")]
    assert rows(store.read("silver", "t")) == sorted(want, key=str)
    assert rows(store.read("silver", "t").where("p = 'x/y z=%2'")) == [(3, "C", "x/y z=%2")]
    for part in ("p1", "x/y z=%"):
        assert store.read("silver", "t").where(F.col("p") == part).count() == 0
    store.upsert("silver", "t", spark.createDataFrame([(1, "back", "p1")], shape), ["k"])
    assert store.read("silver", "t").where("k = 1").first()["p"] == "p1" and store.read("silver", "t").count() == 6


def test_partition_columns_keep_their_type(spark, store):
    frame = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-05', 7L), (2, NULL, 8L) AS t(k, d, p)")
    store.overwrite("gold", "dates", frame, "d")
    store.overwrite("gold", "longs", frame, "p")
    for name in ("dates", "longs"):
        assert store.read("gold", name).schema.simpleString() == frame.schema.simpleString()
    store.upsert("gold", "dates", frame.selectExpr("k", "DATE'2024-02-01' AS d", "p + 1 AS p"), ["k"])
    assert [r["p"] for r in store.read("gold", "dates").where("d = '2024-02-01'").orderBy("k").collect()] == [8, 9]
    assert store.read("gold", "dates").count() == 2


def test_null_keys_match_nothing(spark, store):
    frame = spark.createDataFrame([(None, 1), (1, 1)], "k INT, v INT")
    store.upsert("silver", "t", frame, ["k"])
    store.upsert("silver", "t", frame, ["k"])
    assert rows(store.read("silver", "t")) == [(1, 1), (None, 1), (None, 1)]


def test_the_index_follows_many_merges(spark, store):
    """Merges append to the key index; it is written anew now and then, and taken from the table where it fell behind."""
    shape, want = "k INT, v INT, p STRING", {}
    for step in range(COMPACT_AFTER + 3):
        delta = [(step + i, step, f"p{(step + i) % 3}") for i in range(3)] + [(100, step, f"p{step % 4}")]
        store.upsert("silver", "t", spark.createDataFrame(delta, shape), ["k"], partition_by="p")
        want |= {k: (k, v, p) for k, v, p in delta}
        if step == 4:  # a merge that wrote the table and died before the index
            KeyIndex(spark, store._files, store.base, "silver", "t", ["k"], ["p"], 64).begin()
    assert rows(store.read("silver", "t")) == sorted(want.values(), key=str)


def test_a_merge_reads_the_keys_once_and_moves_the_delta_only(spark, store):
    store.upsert("gold", "t", spark.range(1000).selectExpr("id AS s", "id AS k", "id % 3 AS p"), ["k"], "s", "p")
    delta = spark.range(990, 1010).selectExpr("id AS k", "id % 2 AS p")
    store.upsert("gold", "t", delta, ["k"], "s")
    index = KeyIndex(spark, store._files, store.base, "gold", "t", ["k"], ["s", "p"], 8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.read.schema(delta.schema).parquet(store.path("gold", "t"))
        found = matches(index.current(), stored, ["k"])
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found.count() == 1010
    assert text.count("Exchange") == 1 and "SortMergeJoin" in text
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and sum("Bucketed: true" in line for line in scans) == 1


def test_repeated_keys_of_the_table_are_merged_wherever_they_lie(spark, store):
    shape = "s LONG, k INT, v STRING, p STRING"
    store.overwrite("gold", "t", spark.createDataFrame([(5, 1, "a", "p1"), (4, 1, "b", "p2"), (6, 2, "c", "p3")], shape), "p")
    store.upsert("gold", "t", spark.createDataFrame([(1, "A", "p9")], "k INT, v STRING, p STRING"), ["k"], "s")
    assert rows(store.read("gold", "t").select("s", "k", "v", "p")) == [(4, 1, "A", "p9"), (6, 2, "c", "p3")]


def test_upsert_evolves_the_schema_of_untouched_partitions(spark, store):
    store.upsert("silver", "t", spark.createDataFrame([(1, "p1"), (2, "p2")], "k INT, p STRING"), ["k"], partition_by="p")
    store.upsert("silver", "t", spark.createDataFrame([(2, "p2", 5)], "k INT, p STRING, extra INT"), ["k"])
    assert rows(store.read("silver", "t").select("k", "p", "extra")) == [(1, "p1", None), (2, "p2", 5)]


def test_upsert_refuses_ambiguous_rows_and_changes_nothing(spark, store):
    store.upsert("silver", "t", spark.createDataFrame([(1, "a")], "k INT, v STRING"), ["k"])
    with pytest.raises(AmbiguousMerge):
        store.upsert("silver", "t", spark.createDataFrame([(1, "b"), (1, "c")], "k INT, v STRING"), ["k"])
    assert rows(store.read("silver", "t")) == [(1, "a")]


def test_upsert_keeps_surrogates(spark, store):
    store.upsert("gold", "t", spark.createDataFrame([(7, 1, "a"), (9, 2, "b")], "s LONG, k INT, v STRING"), ["k"], "s")
    store.upsert("gold", "t", spark.createDataFrame([(2, "B"), (3, "c")], "k INT, v STRING"), ["k"], "s")
    got = {r["k"]: (r["s"], r["v"]) for r in store.read("gold", "t").collect()}
    assert got[1] == (7, "a") and got[2] == (9, "B") and got[3][0] > 9 and got[3][1] == "c"


def test_bronze_replay(spark, store):
    day = spark.createDataFrame([(1, "2024-01-15")], "a INT, ingest_date STRING")
    other = spark.createDataFrame([(2, "2024-01-16")], "a INT, ingest_date STRING")
    for frame in (day, other, day):
        store.add_bronze("t", frame)
    assert rows(store.bronze("t")) == [(1, "2024-01-15"), (2, "2024-01-16")]
    store.add_bronze("t", day, "append")
    assert rows(store.bronze("t", "2024-01-15")) == [(1, "2024-01-15")] * 2
    with pytest.raises(ValueError):
        store.add_bronze("t", day, "merge")


def test_an_empty_redelivery_empties_its_date(spark, store):
    store.add_bronze("t", spark.createDataFrame([], "a INT, ingest_date STRING"), ingest_date="2024-01-14")
    assert store.bronze("t").count() == 0 and store.bronze("t").columns == ["a", "ingest_date"]
    for day in ("2024-01-15", "2024-01-16"):
        store.add_bronze("t", spark.createDataFrame([(1, day)], "a INT, ingest_date STRING"), ingest_date=day)
    store.add_bronze("t", spark.createDataFrame([], "a INT, ingest_date STRING"), ingest_date="2024-01-15")
    assert rows(store.bronze("t")) == [(1, "2024-01-16")]
    store.add_bronze("t", spark.createDataFrame([(2, "2024-01-15")], "a INT, ingest_date STRING"), ingest_date="2024-01-15")
    assert rows(store.bronze("t")) == [(1, "2024-01-16"), (2, "2024-01-15")]


def test_drifted_deliveries_are_read_under_one_schema(spark, store):
    """Columns that come later, go, or widen; deliveries of any order."""
    store.add_bronze("t", spark.createDataFrame([(1, 2, 0.5, "d1")], "a INT, b INT, c DOUBLE, ingest_date STRING"))
    store.add_bronze("t", spark.createDataFrame([(2**40, 1.5, "new", "d2")], "a LONG, b DOUBLE, late STRING, ingest_date STRING"))
    store.add_bronze("t", spark.createDataFrame([(3, "d3")], "a INT, ingest_date STRING"))
    frame = store.bronze("t")
    assert dict(frame.dtypes) == {"a": "bigint", "b": "double", "c": "double", "ingest_date": "string", "late": "string"}
    got = rows(frame.select("a", "b", "c", "late", "ingest_date"))
    assert got == sorted([(1, 2.0, 0.5, None, "d1"), (2**40, 1.5, None, "new", "d2"), (3, None, None, None, "d3")], key=str)
    with pytest.raises(DriftedType, match="column a was bigint and is now string"):
        store.add_bronze("t", spark.createDataFrame([("x", "d4")], "a STRING, ingest_date STRING"))
    assert store.bronze("t").count() == 3


def test_partition_scans_are_pruned(spark, store):
    for day in ("2024-01-15", "2024-01-16"):
        store.add_bronze("t", spark.range(1).withColumn("ingest_date", F.lit(day)))
        store.upsert(
            "silver", "t", spark.range(1).selectExpr(f"hash('{day}') AS k", f"'{day}' AS silver_process_date"),
            ["k"], partition_by="silver_process_date",
        )
    for frame in (
        store.bronze("t", "2024-01-16"),
        store.read("silver", "t").where("silver_process_date > '2024-01-15'"),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(" in plan
        assert frame.count() == 1


def test_landing_scan(spark, tmp_path):
    file = tmp_path / "products.csv"
    file.write_text("Product,category,name,price_usd,cost_usd,margin_usd\n1,toys,Top,ten,4.5,\nx,,,,,\n")
    got = [tuple(r) for r in read_landing(spark, str(file), "products").collect()]
    assert got == [(1, "toys", "Top", None, 4.5, None), (None,) * 6]
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_landing(spark, str(file), "products", strict_header=True).collect()
    assert read_landing(spark, str(file), "unheard_of").dtypes[0] == ("Product", "string")
    assert read_landing(spark, str(file), "products", with_source_file=True).first()["source_file"].endswith(file.name)


def test_sql_access(spark, store):
    store.overwrite("gold", "dim_country", spark.createDataFrame([(1, "NL")], "country_key LONG, country_name STRING"))
    assert catalog.register_gold(store, "v_") == ["v_dim_country"]
    assert spark.sql("SELECT country_name FROM v_dim_country").first()[0] == "NL"
    for _ in range(2):
        name = catalog.save_to_catalog(store, "dim_country", "tidemark_test")
    assert spark.table(name).first()["country_name"] == "NL"
    catalog.drop_from_catalog(spark, "tidemark_test")
    assert store.read("gold", "dim_country").count() == 1
    files = store.path("gold", "dim_country")
    assert catalog.select_from_files(spark, files, "SELECT count(*) FROM {files}").first()[0] == 1
    with pytest.raises(ValueError):
        catalog.select_from_files(spark, "a`b", "SELECT 1 FROM {files}")


def test_partitioned_facts_by_catalog_name(spark, store):
    shape = "session_key LONG, session_id STRING, customer_key LONG, start_time STRING, date_key INT, device_key LONG, source_key LONG, country_key LONG, part_month INT"
    month = lambda k, m: (k, f"s{k}", k, "08:00:00", m * 100 + 1, 1, 1, 1, m)
    first = spark.createDataFrame([month(1, 202401), month(2, 202402), (3, "s3", None, None, None, None, None, None, 0)], shape)
    store.overwrite("gold", "fact_session", first, "part_month")
    name = catalog.save_to_catalog(store, "fact_session", "tidemark_test")
    assert spark.table(name).columns[-1] == "part_month" and spark.table(name).count() == 3
    one = spark.sql(f"SELECT session_id FROM {name} WHERE part_month >= 202402")
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_month" in text and "Batched: true" in text
    assert [r[0] for r in one.collect()] == ["s2"]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["part_month=0", "part_month=202401", "part_month=202402"]
    # a merge brings a month, a rebuild takes one away, and a column comes
    store.upsert("gold", "fact_session", spark.createDataFrame([month(4, 202403)], shape), ["session_id"], "session_key")
    assert catalog.save_gold_to_catalog(store, "tidemark_test") == [name]
    assert spark.table(name).where("part_month = 202403").count() == 1
    store.overwrite("gold", "fact_session", store.read("gold", "fact_session").where("part_month > 202401").withColumn("note", F.lit("n")), "part_month")
    catalog.save_to_catalog(store, "fact_session", "tidemark_test")
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["part_month=202402", "part_month=202403"]
    assert spark.table(name).columns[-2:] == ["note", "part_month"] and spark.table(name).count() == 2
    catalog.drop_from_catalog(spark, "tidemark_test")
    assert store.read("gold", "fact_session").count() == 2


class Session:
    """Just what choosing a folder looks at."""

    def __init__(self, configured, master):
        self.conf, self.sparkContext, self.master = {"spark.checkpoint.dir": configured}, self, master

    def getCheckpointDir(self):
        return None


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(Session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(None, "yarn"))
    assert shared_folder(spark) == shared_folder(spark)


def test_store_paths(spark):
    assert TableStore(spark, "hdfs:///lake/").path("gold", "t") == "hdfs:///lake/gold/t"
