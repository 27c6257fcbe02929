"""Registered queries: one Spark callable and one DuckDB statement per name.

Every query runs over the whole of the tables it reads.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import attribute_hash, blank_to_null
from tidemark.operators import dedup, dimensions, keys, lookup, succession, upsert
from tidemark.plans import gold, runs, watermark
from tidemark.plans import bronze as bronze_plan
from tidemark.plans import silver as silver_plan
from tidemark.sources import catalog, statistics
from tidemark.sources.landing import read_landing
from tidemark.sources.schemas import DATASETS
from tidemark.sources.tables import TableStore
from tidemark.sources.workspace import fresh_folder
from tidemark.suite import oracle as sql
from tidemark.suite.fixtures import FIRST_DATE, FIRST_TS, SECOND_DATE, SECOND_TS, given, raw
from tidemark.suite.lake import (
    bronze,
    csv_options,
    silver,
    stage,
    two_deliveries,
    write_landing,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, statement: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        ORACLES[name] = statement
        return function

    return register


def scratch(spark: SparkSession) -> TableStore:
    return TableStore(spark, fresh_folder(spark, "query"))


# ------------------------------------------------------------------- sources


@query("scan_csv_declared", "SELECT * FROM landed_orders")
def scan_csv_declared(spark: SparkSession, sf: str) -> DataFrame:
    path = write_landing(raw(spark, sf, "orders"), fresh_folder(spark, "orders.csv"))
    return read_landing(spark, path, "orders", strict_header=True, **csv_options("orders"))


@query(
    "scan_csv_inferred",
    "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def scan_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = write_landing(given(spark, sf, "supplier"), fresh_folder(spark, "suppliers.csv"))
    return read_landing(spark, path, "suppliers")


_SECOND_BRONZE_ORDERS = sql.bronze("orders", "raw2", SECOND_DATE, SECOND_TS, None)


def _bronze_orders(spark: SparkSession, sf: str) -> TableStore:
    store = scratch(spark)
    for delivery in (1, 2):
        store.add_bronze("orders", bronze(spark, sf, "orders", delivery))
    return store


@query("bronze_partition_scan", _SECOND_BRONZE_ORDERS)
def bronze_partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_orders(spark, sf).bronze("orders", SECOND_DATE).drop("source_file")


@query("silver_scan", f"SELECT * FROM s2_orders WHERE silver_process_date = '{FIRST_DATE}'")
def silver_scan(spark: SparkSession, sf: str) -> DataFrame:
    return gold.processed_on(two_deliveries(spark, sf).store.read("silver", "orders"), FIRST_DATE)


@query("silver_since", f"SELECT * FROM s2_orders WHERE silver_process_date > '{FIRST_DATE}'")
def silver_since(spark: SparkSession, sf: str) -> DataFrame:
    return gold.processed_since(two_deliveries(spark, sf).store.read("silver", "orders"), FIRST_DATE)


@query(
    "sql_catalog_query",
    """SELECT c.country_name, d.year, count(*) AS orders,
      CAST(sum(CAST(f.gross_revenue_usd AS DECIMAL(28,6))) AS DOUBLE) AS revenue_usd
    FROM f2_order f JOIN g2_country c ON f.country_key = c.country_key JOIN g2_date d ON f.date_key = d.date_key
    GROUP BY c.country_name, d.year""",
)
def sql_catalog_query(spark: SparkSession, sf: str) -> DataFrame:
    catalog.register_gold(two_deliveries(spark, sf).store)
    return spark.sql(
        """SELECT country_name, year, count(*) AS orders,
             CAST(sum(CAST(gross_revenue_usd AS DECIMAL(28,6))) AS DOUBLE) AS revenue_usd
           FROM gold_fact_order JOIN gold_dim_country USING (country_key) JOIN gold_dim_date USING (date_key)
           GROUP BY country_name, year"""
    )


@query(
    "sql_on_files",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS total_price
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def sql_on_files(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.select_from_files(
        spark,
        f"{sf}/lineitem.parquet",
        """SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS total_price
           FROM {files} GROUP BY l_returnflag, l_linestatus""",
    )


# -------------------------------------------------------------- bronze, silver


def _register_layers(dataset: str) -> None:
    key = ", ".join(DATASETS[dataset].key)

    @query(f"bronze_{dataset}", sql.bronze(dataset, "landed", FIRST_DATE, FIRST_TS, f"{dataset}.csv"))
    def from_landing(spark: SparkSession, sf: str) -> DataFrame:
        folder = f"{fresh_folder(spark, 'landing')}/{dataset}.csv"
        path = write_landing(raw(spark, sf, dataset), folder)
        landing = read_landing(spark, path, dataset, with_source_file=True, **csv_options(dataset))
        rows = bronze_plan.to_bronze(landing, dataset, FIRST_DATE, FIRST_TS)
        # The landing folder's own name; what lies before it differs between machines.
        return rows.withColumn("source_file", F.element_at(F.split("source_file", "/"), -2))

    @query(f"silver_{dataset}", f"SELECT * FROM s_{dataset}")
    def cleaned(spark: SparkSession, sf: str) -> DataFrame:
        return silver(spark, sf, dataset)

    @query(f"validate_{dataset}", f"SELECT {key}, validation_errors FROM s_{dataset}")
    def validated(spark: SparkSession, sf: str) -> DataFrame:
        rows = silver_plan.prepared(bronze(spark, sf, dataset), dataset)
        return silver_plan.with_validation(rows, dataset, FIRST_DATE).select(
            *DATASETS[dataset].key, "validation_errors"
        )


    @query(f"silver_hard_{dataset}", f"SELECT * FROM h_{dataset}")
    def cleaned_of_faults(spark: SparkSession, sf: str) -> DataFrame:
        rows = bronze_plan.to_bronze(raw(spark, sf, dataset, kind="hard"), dataset, FIRST_DATE, FIRST_TS)
        return silver_plan.clean(rows, dataset, FIRST_DATE, FIRST_TS)


for _dataset in DATASETS:
    _register_layers(_dataset)


@query(
    "fault_report",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS dataset, coalesce(code, 'valid') AS code, count(*) AS records
        FROM (SELECT unnest(string_split(coalesce(validation_errors, 'valid'), ',')) AS code FROM h_{name}) GROUP BY code"""
        for name in DATASETS
    ),
)
def fault_report(spark: SparkSession, sf: str) -> DataFrame:
    # Every rule that a usable record can break is broken somewhere.
    parts = []
    for name in DATASETS:
        rows = bronze_plan.to_bronze(raw(spark, sf, name, kind="hard"), name, FIRST_DATE, FIRST_TS)
        checked = silver_plan.with_validation(silver_plan.prepared(rows, name), name, FIRST_DATE)
        codes = F.explode(F.split(F.coalesce("validation_errors", F.lit("valid")), ",")).alias("code")
        parts.append(checked.select(F.lit(name).alias("dataset"), codes).groupBy("dataset", "code").agg(F.count("*").alias("records")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "load_report",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS dataset, count(*) AS records, count(*) FILTER ({named}) AS usable,
        count(*) FILTER (NOT ({named})) AS unusable FROM hard_{name}"""
        for name, named in (
            (name, " OR ".join(f"{key} IS NOT NULL" for key in DATASETS[name].key)) for name in DATASETS
        )
    ),
)
def load_report(spark: SparkSession, sf: str) -> DataFrame:
    # Counted while the rows are written; nothing is read again.
    store, parts = scratch(spark), []
    for name in DATASETS:
        rows = bronze_plan.to_bronze(raw(spark, sf, name, kind="hard"), name, FIRST_DATE, FIRST_TS)
        report = runs.add_with_report(store, name, rows, "replace", FIRST_DATE)
        parts.append((name, report.records, report.usable, report.unusable))
    return spark.createDataFrame(parts, "dataset STRING, records LONG, usable LONG, unusable LONG")


@query(
    "normalize_columns",
    "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region FROM nation",
)
def normalize_columns(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_plan.normalize_columns(
        given(spark, sf, "nation").toDF("Nation Key", " NATION_Name ", "REGION")
    )


@query(
    "record_id_single",
    "SELECT event_id, trim(CAST(event_id AS VARCHAR)) AS record_id, 'event_id' AS record_id_source FROM raw_events",
)
def record_id_single(spark: SparkSession, sf: str) -> DataFrame:
    rows = keys.with_record_id(raw(spark, sf, "events"), "events")
    return rows.select("event_id", "record_id", "record_id_source")


@query(
    "record_id_composite",
    """SELECT order_id, product_id, concat(order_id, '_', product_id) AS record_id,
      'order_id_product_id' AS record_id_source FROM raw_order_items""",
)
def record_id_composite(spark: SparkSession, sf: str) -> DataFrame:
    rows = keys.with_record_id(raw(spark, sf, "order_items"), "order_items")
    return rows.select("order_id", "product_id", "record_id", "record_id_source")


@query(
    "dq_flags",
    """SELECT record_id, CASE WHEN record_id IS NULL THEN 'NULL_RECORD_ID' WHEN record_id = '' THEN 'EMPTY_RECORD_ID'
      END AS dq_error, coalesce(record_id, '') <> '' AS is_valid_record_id
    FROM (SELECT CASE WHEN email IS NOT NULL THEN trim(name) END AS record_id FROM raw_customers)""",
)
def dq_flags(spark: SparkSession, sf: str) -> DataFrame:
    # Names are blank, and e-mail addresses missing, in part of the rows.
    rows = raw(spark, sf, "customers").select(
        F.when(F.col("email").isNotNull(), F.trim("name")).alias("record_id")
    )
    return bronze_plan.with_quality_flags(rows)


@query(
    "safe_trim",
    """SELECT customer_id, nullif(trim(name), '') AS name, nullif(trim(email), '') AS email,
      nullif(trim(marketing_opt_in), '') AS marketing_opt_in FROM raw_customers""",
)
def safe_trim(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw(spark, sf, "customers").select("customer_id", "name", "email", "marketing_opt_in")
    return blank_to_null(rows, ["name", "email", "marketing_opt_in", "not_there"])


@query(
    "dedup_latest",
    f"""SELECT customer_id, email, ingestion_timestamp FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ingestion_timestamp DESC, email) AS place
      FROM (SELECT customer_id, email, TIMESTAMP '{FIRST_TS}' AS ingestion_timestamp FROM raw1_customers UNION ALL
            SELECT customer_id, email, TIMESTAMP '{SECOND_TS}' FROM raw2_customers)) WHERE place = 1""",
)
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    both = bronze(spark, sf, "customers", 1).unionByName(bronze(spark, sf, "customers", 2))
    return dedup.latest_per_key(both.select("customer_id", "email", "ingestion_timestamp"), ["customer_id"])


@query("valid_rows", "SELECT * FROM s_orders WHERE validation_errors IS NULL")
def valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    return stage(spark, sf).valid("orders")


@query(
    "attribute_hash",
    """SELECT customer_id, sha256(concat_ws('||', coalesce(name, '__NULL__'), coalesce(email, '__NULL__'),
      coalesce(CAST(age AS VARCHAR), '__NULL__'))) AS attr_hash FROM s_customers""",
)
def attribute_hashes(spark: SparkSession, sf: str) -> DataFrame:
    customers = stage(spark, sf).silver("customers")
    return customers.select("customer_id", attribute_hash(["name", "email", "age"]).alias("attr_hash"))


@query(
    "aggregate_order_items",
    """SELECT order_id, product_id, min(unit_price_usd) AS unit_price_usd, CAST(sum(quantity) AS BIGINT) AS quantity,
      CAST(sum(CAST(line_total_usd AS DECIMAL(28,6))) AS DOUBLE) AS line_total_usd
    FROM raw_order_items GROUP BY order_id, product_id""",
)
def aggregate_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.aggregate_order_items(raw(spark, sf, "order_items"))


# ------------------------------------------------------------- sinks and merges


@query(
    "bronze_append_replay",
    f"""SELECT order_id, product_id, '{FIRST_DATE}' AS ingest_date, CAST(2 * count(*) AS BIGINT) AS deliveries,
      CAST(2 * sum(quantity) AS BIGINT) AS quantity FROM raw_order_items GROUP BY order_id, product_id""",
)
def bronze_append_replay(spark: SparkSession, sf: str) -> DataFrame:
    store, rows = scratch(spark), bronze(spark, sf, "order_items")
    store.add_bronze("order_items", rows, "append")
    store.add_bronze("order_items", rows, "append")
    return (
        store.bronze("order_items")
        .groupBy("order_id", "product_id", "ingest_date")
        .agg(F.count("*").alias("deliveries"), F.sum("quantity").alias("quantity"))
    )


@query(
    "bronze_replace_replay",
    f"""SELECT order_id, product_id, '{FIRST_DATE}' AS ingest_date, count(*) AS deliveries,
      CAST(sum(quantity) AS BIGINT) AS quantity FROM raw_order_items GROUP BY order_id, product_id""",
)
def bronze_replace_replay(spark: SparkSession, sf: str) -> DataFrame:
    store, rows = scratch(spark), bronze(spark, sf, "order_items")
    store.add_bronze("order_items", rows)
    store.add_bronze("order_items", rows)
    return (
        store.bronze("order_items")
        .groupBy("order_id", "product_id", "ingest_date")
        .agg(F.count("*").alias("deliveries"), F.sum("quantity").alias("quantity"))
    )


@query("ingest_report_partitions", f"SELECT '{FIRST_DATE}' AS ingest_date UNION ALL SELECT '{SECOND_DATE}'")
def ingest_report_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_plan.report_partitions(_bronze_orders(spark, sf).bronze("orders"))


@query(
    "ingest_report_validity",
    f"""SELECT is_valid_record_id, count(*) AS count FROM (
      {sql.bronze("orders", "raw1", FIRST_DATE, FIRST_TS, None)} UNION ALL {_SECOND_BRONZE_ORDERS})
      GROUP BY is_valid_record_id""",
)
def ingest_report_validity(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_plan.report_validity(_bronze_orders(spark, sf).bronze("orders"))


@query("merge_upsert", "SELECT * FROM s2_customers")
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _customers(spark, sf, 1), _customers(spark, sf, 2)
    return upsert.merge_rows(first, second, ["customer_id"])


def _customers(spark: SparkSession, sf: str, delivery: int) -> DataFrame:
    day, stamp = (FIRST_DATE, FIRST_TS) if delivery == 1 else (SECOND_DATE, SECOND_TS)
    return silver_plan.clean(bronze(spark, sf, "customers", delivery), "customers", day, stamp)


@query(
    "merge_schema_evolution",
    """SELECT customer_id, name, email, CAST(NULL AS VARCHAR) AS country FROM raw1_customers t
      WHERE customer_id NOT IN (SELECT customer_id FROM raw2_customers)
    UNION ALL SELECT s.customer_id, t.name, s.email, s.country
      FROM raw2_customers s LEFT JOIN raw1_customers t ON s.customer_id = t.customer_id""",
)
def merge_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    target = raw(spark, sf, "customers", 1).select("customer_id", "name", "email")
    source = raw(spark, sf, "customers", 2).select("customer_id", "email", "country")
    return upsert.merge_rows(target, source, ["customer_id"])


@query(
    "merge_keep_surrogate",
    """SELECT * FROM order_totals1 WHERE order_id NOT IN (SELECT order_id FROM raw2_orders)
    UNION ALL SELECT * FROM order_totals2""",
)
def merge_keep_surrogate(spark: SparkSession, sf: str) -> DataFrame:
    first = raw(spark, sf, "orders", 1).select("order_id", "total_usd")
    target = keys.assign_surrogate_key(first, "total_key", ["order_id"])
    incoming = raw(spark, sf, "orders", 2).select("order_id", "total_usd")
    return upsert.merge_keep_surrogate(target, incoming, ["order_id"], "total_key")


@query("gold_overwrite", "SELECT * FROM g_country")
def gold_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    store = scratch(spark)
    dimension = stage(spark, sf).build_dimension("dim_country")
    store.overwrite("gold", "dim_country", dimension)
    # A table may be rebuilt from itself.
    store.overwrite("gold", "dim_country", store.read("gold", "dim_country"))
    return store.read("gold", "dim_country")


@query(
    "merge_moves_partitions",
    """SELECT * REPLACE (nullif(payment_method, '') AS payment_method) FROM (
      SELECT * FROM raw1_orders WHERE order_id NOT IN (SELECT order_id FROM raw2_orders)
      UNION ALL SELECT * REPLACE (CASE WHEN order_id % 3 = 0 THEN NULL ELSE payment_method END AS payment_method) FROM raw2_orders)""",
)
def merge_moves_partitions(spark: SparkSession, sf: str) -> DataFrame:
    # Partitions are NULL (an empty text counts as NULL there), hold blanks, and gain and lose rows; merging the same rows again changes nothing.
    store = scratch(spark)
    later = raw(spark, sf, "orders", 2).withColumn(
        "payment_method", F.when(F.col("order_id") % 3 != 0, F.col("payment_method"))
    )
    for rows in (raw(spark, sf, "orders", 1), later, later):
        store.upsert("silver", "orders", rows, ["order_id"], partition_by="payment_method")
    return store.read("silver", "orders")


@query(
    "bronze_empty_redelivery",
    f"""SELECT order_id, total_usd, '{FIRST_DATE}' AS ingest_date FROM raw1_orders""",
)
def bronze_empty_redelivery(spark: SparkSession, sf: str) -> DataFrame:
    # The second delivery comes again without rows, which empties its date.
    store = _bronze_orders(spark, sf)
    store.add_bronze("orders", bronze(spark, sf, "orders", 2).where("order_id IS NULL"), ingest_date=SECOND_DATE)
    return store.bronze("orders").select("order_id", "total_usd", "ingest_date")


@query(
    "bronze_drifted_deliveries",
    f"""SELECT order_id, product_id, CAST(quantity AS BIGINT) AS quantity, CAST(NULL AS DOUBLE) AS line_total_usd,
      '{FIRST_DATE}' AS ingest_date FROM raw1_order_items
    UNION ALL SELECT order_id, product_id, CAST(quantity AS BIGINT) + 5000000000, line_total_usd, '{SECOND_DATE}' FROM raw2_order_items""",
)
def bronze_drifted_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    # The second delivery widens one column and brings another.
    store = scratch(spark)
    first = raw(spark, sf, "order_items", 1).select("order_id", "product_id", "quantity", F.lit(FIRST_DATE).alias("ingest_date"))
    second = raw(spark, sf, "order_items", 2).select(
        "order_id",
        "product_id",
        (F.col("quantity").cast("long") + 5_000_000_000).alias("quantity"),
        "line_total_usd",
        F.lit(SECOND_DATE).alias("ingest_date"),
    )
    store.add_bronze("order_items", first)
    store.add_bronze("order_items", second)
    return store.bronze("order_items").select("order_id", "product_id", "quantity", "line_total_usd", "ingest_date")


@query(
    "catalog_month_scan",
    """SELECT date_key // 100 AS part_month, count(*) AS orders,
      CAST(sum(CAST(gross_revenue_usd AS DECIMAL(28,6))) AS DOUBLE) AS revenue_usd
    FROM f2_order WHERE date_key // 100 > (SELECT min(date_key) // 100 FROM f2_order) GROUP BY date_key // 100""",
)
def catalog_month_scan(spark: SparkSession, sf: str) -> DataFrame:
    # All months but the first, by the table's name in the catalog.
    store = two_deliveries(spark, sf).store
    name = catalog.save_to_catalog(store, "fact_order", "tidemark_gold")
    first = store.bounds("gold", "fact_order", ["date_key"])["date_key"][0]
    return spark.sql(
        f"""SELECT part_month, count(*) AS orders, CAST(sum(CAST(gross_revenue_usd AS DECIMAL(28,6))) AS DOUBLE) AS revenue_usd
        FROM {name} WHERE part_month > {first // 100} GROUP BY part_month"""
    )


@query(
    "stored_bounds",
    """SELECT min(order_date) AS min_order_date, max(order_date) AS max_order_date, min(order_id) AS min_order_id,
      max(order_id) AS max_order_id, min(total_usd) AS min_total_usd, max(total_usd) AS max_total_usd FROM s2_orders""",
)
def stored_bounds(spark: SparkSession, sf: str) -> DataFrame:
    # Answered from file footers.
    store = two_deliveries(spark, sf).store
    schema = store.schema("silver", "orders")
    return statistics.bounds_frame(spark, store.path("silver", "orders"), schema, ["order_date", "order_id", "total_usd"])


# ------------------------------------------------------------------- watermark


@query(
    "latest_process_date",
    "SELECT max(d) AS latest_process_date FROM ("
    + " UNION ALL ".join(f"SELECT silver_process_date AS d FROM s2_{name}" for name in DATASETS)
    + ")",
)
def latest_process_date(spark: SparkSession, sf: str) -> DataFrame:
    store = two_deliveries(spark, sf).store
    return watermark.latest_process_date({name: store.read("silver", name) for name in DATASETS})


@query(
    "latest_process_dates",
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, max(silver_process_date) AS latest_process_date FROM s2_{name}"
        for name in DATASETS
    ),
)
def latest_process_dates(spark: SparkSession, sf: str) -> DataFrame:
    store = two_deliveries(spark, sf).store
    return watermark.latest_process_dates({name: store.read("silver", name) for name in DATASETS})


@query(
    "watermark_read",
    "SELECT max(CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS last_process_date FROM orders WHERE o_orderstatus = 'F'",
)
def watermark_read(spark: SparkSession, sf: str) -> DataFrame:
    # Many marks per name: the reader has to take the largest of the one asked for.
    marks = given(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("pipeline_name"),
        F.col("o_orderdate").cast("date").cast("string").alias("last_process_date"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
    )
    return watermark.read_mark(marks, "F")


@query(
    "watermark_upsert",
    f"""SELECT 'gold_star_schema' AS pipeline_name, max(silver_process_date) AS last_process_date,
      TIMESTAMP '{SECOND_TS}' AS updated_at FROM s2_orders""",
)
def watermark_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return two_deliveries(spark, sf).store.read("gold", watermark.TABLE)


# ------------------------------------------------------------- keys, dimensions


@query(
    "assign_surrogate_key",
    f"""SELECT {sql.surrogate(["order_id", "product_id"], "1000")} AS item_key, order_id, product_id
    FROM (SELECT DISTINCT order_id, product_id FROM raw_order_items)""",
)
def assign_surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    pairs = raw(spark, sf, "order_items").select("order_id", "product_id").distinct()
    return keys.assign_surrogate_key(pairs, "item_key", ["order_id", "product_id"], 1000)


@query("max_surrogate", "SELECT max(customer_key) AS max_key FROM g_customers")
def max_surrogate(spark: SparkSession, sf: str) -> DataFrame:
    return keys.largest_key(stage(spark, sf).dimension("dim_customers"), "customer_key")


@query("static_dim_initial", sql.static_dim("SELECT name FROM all_names", "name", "name_key"))
def static_dim_initial(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.static_dimension(raw(spark, sf, "customers").select("name"), "name", "name_key")


@query(
    "static_dim_increment",
    sql.static_dim("SELECT name FROM all_names", "name", "name_key", "names1"),
)
def static_dim_increment(spark: SparkSession, sf: str) -> DataFrame:
    first = raw(spark, sf, "customers", 1).select("name")
    known = dimensions.static_dimension(first, "name", "name_key")
    return dimensions.static_dimension(
        raw(spark, sf, "customers").select("name"), "name", "name_key", known
    )


@query("union_dimension_values", sql.feed("", sql.FEEDS["country"], "country_name"))
def union_dimension_values(spark: SparkSession, sf: str) -> DataFrame:
    silver_tables = stage(spark, sf).several("customers", "orders", "sessions")
    feeds = gold.KEY_DIMENSIONS["dim_country"].feeds
    pairs = [(silver_tables[name], column) for name, column in feeds]
    return dimensions.union_values("country_name", *pairs)


@query(
    "distinct_values",
    "SELECT DISTINCT payment_method FROM s_orders WHERE payment_method IS NOT NULL",
)
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.distinct_values(stage(spark, sf).silver("orders"), "payment_method")


@query(
    "date_bounds",
    f"SELECT min(full_date) AS min_date, max(full_date) AS max_date FROM ({sql.feed('', sql.DATES, 'full_date')})",
)
def date_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.date_bounds(gold.calendar_dates(stage(spark, sf).all_silver()), "full_date")


def _register_dimension(table: str, relation: str) -> None:
    @query(f"gold_{table}", f"SELECT * FROM {relation}")
    def built(spark: SparkSession, sf: str) -> DataFrame:
        return stage(spark, sf).build_dimension(table)


for _table in (*gold.KEY_DIMENSIONS, "dim_date", "dim_customers", "dim_products"):
    _register_dimension(_table, "g_" + _table.removeprefix("dim_"))


def _scd2_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customer dimension after the first delivery, customer attributes after the second."""
    first = _customers(spark, sf, 1)
    merged = upsert.merge_rows(first, _customers(spark, sf, 2), ["customer_id"])
    dimension = gold.dim_customers(first, FIRST_DATE, FIRST_TS)
    return dimension, gold.customer_source(merged, SECOND_DATE)


@query("scd2_initial", "SELECT * FROM g_customers")
def scd2_initial(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_customers(silver(spark, sf, "customers"), FIRST_DATE, FIRST_TS)


@query(
    "scd2_changes",
    sql.scd2_changed("customer_source2", "g1_customers", "customer_id", sql.CUSTOMER_ATTRS),
)
def scd2_changes(spark: SparkSession, sf: str) -> DataFrame:
    dimension, source = _scd2_inputs(spark, sf)
    return dimensions.scd2_changes(
        source, lookup.current_versions(dimension), "customer_id", gold.CUSTOMER_ATTRIBUTES
    )


@query("scd2_apply", "SELECT * FROM g2_customers")
def scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    dimension, source = _scd2_inputs(spark, sf)
    return dimensions.scd2_dimension(
        source, "customer_id", "customer_key", gold.CUSTOMER_ATTRIBUTES, SECOND_TS, dimension
    )


@query("scd2_current", "SELECT * FROM g2_products WHERE is_current")
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.current_versions(two_deliveries(spark, sf).gold("dim_products"))


# ----------------------------------------------------------------------- joins


@query("join_events_sessions", "SELECT * FROM visits")
def join_events_sessions(spark: SparkSession, sf: str) -> DataFrame:
    st = stage(spark, sf)
    return lookup.with_session_customer(st.valid("events"), st.valid("sessions"))


@query(
    "join_semi_delta_items",
    f"""SELECT * FROM s2_order_items WHERE validation_errors IS NULL
      AND order_id IN (SELECT order_id FROM {sql.since("orders")})""",
)
def join_semi_delta_items(spark: SparkSession, sf: str) -> DataFrame:
    store = two_deliveries(spark, sf).store
    fresh = lookup.valid_rows(gold.processed_since(store.read("silver", "orders"), FIRST_DATE))
    return lookup.restrict_to(lookup.valid_rows(store.read("silver", "order_items")), fresh, "order_id")


@query(
    "join_semi_delta_sessions",
    f"""SELECT e.*, s.customer_id FROM {sql.since("events")} e JOIN
      (SELECT * FROM s2_sessions WHERE validation_errors IS NULL) s ON e.session_id = s.session_id""",
)
def join_semi_delta_sessions(spark: SparkSession, sf: str) -> DataFrame:
    store = two_deliveries(spark, sf).store
    fresh = lookup.valid_rows(gold.processed_since(store.read("silver", "events"), FIRST_DATE))
    sessions = lookup.valid_rows(store.read("silver", "sessions"))
    return lookup.with_session_customer(fresh, lookup.restrict_to(sessions, fresh, "session_id"))


@query(
    "attach_dimension_key",
    f"""SELECT order_id, payment_method, {sql.look("payment_method", "g_payment_method", "payment_method_name",
      "payment_method_key")} AS payment_method_key FROM s_orders""",
)
def attach_dimension_key(spark: SparkSession, sf: str) -> DataFrame:
    st = stage(spark, sf)
    orders = st.silver("orders").select("order_id", "payment_method")
    return lookup.attach_dimension_key(
        orders,
        "payment_method",
        st.dimension("dim_payment_method"),
        "payment_method_name",
        "payment_method_key",
        "payment_method_key",
    )


@query("order_costs", sql.costs("", sql.valid("s_order_items")))
def order_costs(spark: SparkSession, sf: str) -> DataFrame:
    st = stage(spark, sf)
    return gold.order_costs(st.valid("order_items"), st.dimension("dim_products"))


@query(
    "event_duration",
    f"SELECT event_id, session_id, duration FROM ({sql.durations(sql.valid('s_events'))})",
)
def event_duration(spark: SparkSession, sf: str) -> DataFrame:
    events = stage(spark, sf).valid("events").select("event_id", "session_id", "timestamp")
    rows = succession.seconds_to_next(events, "session_id", "timestamp", "event_id", "duration")
    return rows.drop("timestamp")


# ---------------------------------------------------------------------- funnel


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    st = stage(spark, sf)
    return lookup.with_session_customer(st.valid("events"), st.valid("sessions"))


@query("funnel_view_dates", "SELECT * FROM view_dates")
def funnel_view_dates(spark: SparkSession, sf: str) -> DataFrame:
    return gold.first_event_dates(_visits(spark, sf), "page_view", "first_view_date")


@query("funnel_cart_dates", "SELECT * FROM cart_dates")
def funnel_cart_dates(spark: SparkSession, sf: str) -> DataFrame:
    return gold.first_event_dates(_visits(spark, sf), "add_to_cart", "first_add_to_cart_date")


@query("funnel_checkout_dates", "SELECT * FROM checkout_dates")
def funnel_checkout_dates(spark: SparkSession, sf: str) -> DataFrame:
    st = stage(spark, sf)
    return gold.funnel_checkout_dates(st.valid("events"), st.valid("sessions"))


@query("session_order_map", "SELECT * FROM order_map")
def session_order_map(spark: SparkSession, sf: str) -> DataFrame:
    st = stage(spark, sf)
    return gold.session_order_map(st.valid("events"), st.valid("sessions"), st.valid("orders"))


@query("funnel_purchase_dates", "SELECT * FROM purchase_dates")
def funnel_purchase_dates(spark: SparkSession, sf: str) -> DataFrame:
    return gold.funnel_purchase_dates(*_funnel_inputs(spark, sf))


@query("funnel_base", "SELECT * FROM funnel_pairs")
def funnel_base(spark: SparkSession, sf: str) -> DataFrame:
    return gold.funnel_dates(*_funnel_inputs(spark, sf)).select("customer_id", "product_id")


def _funnel_inputs(spark: SparkSession, sf: str) -> list[DataFrame]:
    st = stage(spark, sf)
    return [st.valid(name) for name in ("events", "sessions", "orders", "order_items")]


# ----------------------------------------------------------------------- facts


def _columns(relation: str, table: str) -> str:
    fact = gold.FACTS[table]
    return f"SELECT {', '.join((fact.key, *fact.columns))} FROM {relation}"


def _register_fact(table: str) -> None:
    stem = table.removeprefix("fact_")

    @query(f"gold_{table}", _columns(f"f_{stem}", table))
    def built(spark: SparkSession, sf: str) -> DataFrame:
        return stage(spark, sf).fact(table)

    @query(f"incr_{table}", _columns(f"f2_{stem}", table))
    def merged(spark: SparkSession, sf: str) -> DataFrame:
        return two_deliveries(spark, sf).gold(table)


for _table in gold.FACTS:
    _register_fact(_table)
