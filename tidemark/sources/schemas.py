"""The seven declared datasets: landing columns, business keys, bronze columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Dataset:
    """One landing dataset; ``ddl`` lists its columns in file order."""

    name: str
    key: tuple[str, ...]
    ddl: str

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


# Dataset names, columns and keys of the landing contract. Event and
# session ids are BIGINT because ids beyond 2^31 are legal; every column is nullable.
_DECLARED = (
    Dataset(
        "events",
        ("event_id",),
        "event_id BIGINT, session_id BIGINT, timestamp STRING, event_type STRING, product_id DOUBLE,"
        " qty DOUBLE, cart_size DOUBLE, payment STRING, discount_pct DOUBLE, amount_usd DOUBLE",
    ),
    Dataset(
        "customers",
        ("customer_id",),
        "customer_id BIGINT, name STRING, email STRING, country STRING, age INT, signup_date STRING,"
        " marketing_opt_in STRING",
    ),
    Dataset(
        "orders",
        ("order_id",),
        "order_id BIGINT, customer_id BIGINT, order_time STRING, payment_method STRING, discount_pct DOUBLE,"
        " subtotal_usd DOUBLE, total_usd DOUBLE, country STRING, device STRING, source STRING",
    ),
    Dataset(
        "order_items",
        ("order_id", "product_id"),
        "order_id BIGINT, product_id BIGINT, unit_price_usd DOUBLE, quantity INT, line_total_usd DOUBLE",
    ),
    Dataset(
        "products",
        ("product_id",),
        "product_id BIGINT, category STRING, name STRING, price_usd DOUBLE, cost_usd DOUBLE, margin_usd DOUBLE",
    ),
    Dataset(
        "reviews",
        ("review_id",),
        "review_id BIGINT, order_id BIGINT, product_id BIGINT, rating INT, review_text STRING, review_time STRING",
    ),
    Dataset(
        "sessions",
        ("session_id",),
        "session_id BIGINT, customer_id BIGINT, start_time STRING, device STRING, source STRING, country STRING",
    ),
)

DATASETS: dict[str, Dataset] = {dataset.name: dataset for dataset in _DECLARED}

# Columns bronze adds to the landing columns.
BRONZE_COLUMNS = (
    "record_id",
    "record_id_source",
    "dq_error",
    "is_valid_record_id",
    "ingest_date",
    "ingestion_timestamp",
    "source_file",
)


def declared_schema(dataset: str) -> StructType | None:
    """Schema of a declared dataset, or None for one nobody declared."""
    known = DATASETS.get(dataset)
    return known.schema if known else None
