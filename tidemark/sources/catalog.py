"""Stored tables as SQL views, and SQL straight over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.gold import FACTS, KEY_DIMENSIONS
from tidemark.sources.tables import TableStore

# Tables of the star schema in build order.
GOLD_TABLES = (
    "dim_country",
    "dim_source",
    "dim_device",
    "dim_payment_method",
    "dim_date",
    "dim_category",
    "dim_customers",
    "dim_products",
    "fact_order",
    "fact_order_item",
    "fact_web_events",
    "fact_review",
    "fact_session",
    "fact_customer_funnel",
)
assert set(GOLD_TABLES) >= {*KEY_DIMENSIONS, *FACTS}


def gold_table(store: TableStore, table: str) -> DataFrame:
    """A gold table with its published columns only."""
    rows = store.read("gold", table)
    if table in FACTS:
        return rows.select(FACTS[table].key, *FACTS[table].columns)
    return rows


def register_gold(store: TableStore, prefix: str = "gold_") -> list[str]:
    """Make every stored gold table a temporary view ``<prefix><table>``; returns the view names.

    Views show the content at the time of the call; call again after a run.
    """
    names = []
    for table in GOLD_TABLES:
        if store.exists("gold", table):
            gold_table(store, table).createOrReplaceTempView(prefix + table)
            names.append(prefix + table)
    return names


def save_to_catalog(store: TableStore, table: str, database: str = "gold") -> str:
    """Register a stored gold table as an external catalog table ``database.table`` over its files; returns that name.

    A partitioned table is registered with its partitions, one catalog entry per folder, so a filter on the partition column
    picks folders in the catalog before any file is listed. The catalog table has all stored columns, unpublished ones last.
    Calling again takes over new columns, and new and vanished partitions.
    """
    spark, name = store.spark, f"{database}.{table}"
    rows, by = store.read("gold", table), store.partition_column("gold", table)
    published = gold_table(store, table).columns
    hidden = [column for column in rows.columns if column not in published]
    order = [column for column in (*published, *hidden) if column != by] + ([by] if by else [])
    types = {entry.name: entry.dataType.simpleString() for entry in rows.schema}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{store.base}/_catalog/{database}'")
    if spark.catalog.tableExists(name) and _definition(spark, name) == (store.path("gold", table), [(column, types[column]) for column in order]):
        refresh(spark, name, by is not None)
        return name
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{column}` {types[column]}" for column in order)
    partitioned = f"PARTITIONED BY (`{by}`)" if by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioned} LOCATION '{store.path('gold', table)}'")
    refresh(spark, name, by is not None)
    return name


def _definition(spark: SparkSession, name: str) -> tuple[str, list[tuple[str, str]]]:
    """Where a catalog table lies, without scheme, and its columns."""
    details = {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return details["Location"].removeprefix("file:"), [(entry.name, entry.dataType.simpleString()) for entry in spark.table(name).schema]


def refresh(spark: SparkSession, name: str, partitioned: bool) -> None:
    """Bring a catalog table up to date with its folders and forget cached file lists."""
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def save_gold_to_catalog(store: TableStore, database: str = "gold") -> list[str]:
    """Register every stored gold table; returns the names."""
    return [save_to_catalog(store, table, database) for table in GOLD_TABLES if store.exists("gold", table)]


def drop_from_catalog(spark: SparkSession, database: str = "gold") -> None:
    """Forget a database of external tables; their files stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def select_from_files(spark: SparkSession, path: str, query: str, source: str = "parquet") -> DataFrame:
    """Run ``query`` with ``{files}`` standing for the files at ``path``."""
    if "`" in path:
        raise ValueError("path must not contain a backtick")
    return spark.sql(query.replace("{files}", f"{source}.`{path}`"))
