"""Silver: typed, trimmed, deduplicated and checked rows.

Each dataset is a ``Recipe`` of SQL expressions; ``clean`` applies it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import blank_to_null, fold_rules
from tidemark.operators.dedup import aggregate_order_items, latest_per_key
from tidemark.sources.schemas import BRONZE_COLUMNS, DATASETS


@dataclass(frozen=True)
class Recipe:
    """How one dataset is cleaned. ``{process_date}`` in a rule stands for the run's date."""

    rules: Mapping[str, str]
    derive: Mapping[str, str]
    parse: Mapping[str, str] = field(default_factory=dict)
    trim: tuple[str, ...] = ()
    newest_first: tuple[str, ...] = ("ingestion_timestamp",)
    folds_lines: bool = False
    whole_history: bool = False


# Rule codes with their bounds, derived labels with their limits, accepted
# spellings of flags, the e-mail pattern.
RECIPES: dict[str, Recipe] = {
    "customers": Recipe(
        parse={
            "signup_date": "try_cast(signup_date AS DATE)",
            "marketing_opt_in": """CASE WHEN lower(trim(marketing_opt_in)) IN ('true', '1', 'yes') THEN true
                WHEN lower(trim(marketing_opt_in)) IN ('false', '0', 'no') THEN false END""",
        },
        trim=("name", "email", "country"),
        rules={
            "NULL_CUSTOMER_ID": "customer_id IS NULL",
            "NULL_EMAIL": "email IS NULL",
            "NULL_SIGNUP_DATE": "signup_date IS NULL",
            "INVALID_EMAIL_FORMAT": r"NOT email RLIKE '^[A-Za-z0-9+_.-]+@(.+)$'",
            "NULL_AGE": "age IS NULL",
            "INVALID_AGE": "age NOT BETWEEN 0 AND 150",
            "FUTURE_SIGNUP_DATE": "signup_date > DATE'{process_date}'",
        },
        derive={
            "signup_year": "year(signup_date)",
            "email_domain": "CASE WHEN contains(email, '@') THEN split_part(email, '@', 2) END",
            "age_group": """CASE WHEN age < 0 THEN NULL WHEN age < 18 THEN 'under_18' WHEN age <= 25 THEN '18-25'
                WHEN age <= 35 THEN '26-35' WHEN age <= 50 THEN '36-50' WHEN age <= 65 THEN '51-65'
                WHEN age > 65 THEN 'over_65' END""",
        },
    ),
    "orders": Recipe(
        parse={"order_time": "try_cast(order_time AS TIMESTAMP)"},
        trim=("payment_method", "country", "device", "source"),
        newest_first=("order_time", "ingestion_timestamp"),
        rules={
            "NULL_ORDER_ID": "order_id IS NULL",
            "NULL_CUSTOMER_ID": "customer_id IS NULL",
            "NULL_ORDER_TIME": "order_time IS NULL",
            "NULL_TOTAL": "total_usd IS NULL",
            "NEGATIVE_TOTAL": "total_usd < 0",
            "SUBTOTAL_LESS_THAN_TOTAL": "subtotal_usd < total_usd",
            "INVALID_DISCOUNT": "discount_pct NOT BETWEEN 0 AND 100",
        },
        derive={
            "order_date": "CAST(order_time AS DATE)",
            "order_year": "year(order_time)",
            "order_month": "month(order_time)",
            "order_hour": "hour(order_time)",
            "discount_amount": "subtotal_usd - total_usd",
        },
    ),
    "order_items": Recipe(
        folds_lines=True,
        rules={
            "NULL_ORDER_ID": "order_id IS NULL",
            "NULL_PRODUCT_ID": "product_id IS NULL",
            "NULL_QUANTITY": "quantity IS NULL",
            "NULL_UNIT_PRICE": "unit_price_usd IS NULL",
            "NULL_LINE_TOTAL": "line_total_usd IS NULL",
            "INVALID_QUANTITY": "quantity <= 0",
            "NEGATIVE_PRICE": "unit_price_usd < 0",
            "LINE_TOTAL_MISMATCH": "abs(line_total_usd - unit_price_usd * quantity) > 0.01D",
        },
        derive={"computed_line_total": "unit_price_usd * quantity"},
    ),
    "events": Recipe(
        parse={
            "timestamp": "try_cast(timestamp AS TIMESTAMP)",
            "product_id": "try_cast(product_id AS BIGINT)",
        },
        trim=("event_type", "payment"),
        newest_first=("timestamp", "ingestion_timestamp"),
        rules={
            "NULL_EVENT_ID": "event_id IS NULL",
            "NULL_SESSION_ID": "session_id IS NULL",
            "NULL_EVENT_TYPE": "event_type IS NULL",
            "NULL_TIMESTAMP": "timestamp IS NULL",
            "ADD_TO_CART_MISSING_QTY": "event_type = 'add_to_cart' AND qty IS NULL",
            "CHECKOUT_MISSING_CART_SIZE": "event_type = 'checkout' AND cart_size IS NULL",
            "PURCHASE_MISSING_AMOUNT": "event_type = 'purchase' AND amount_usd IS NULL",
            "PURCHASE_MISSING_PAYMENT": "event_type = 'purchase' AND payment IS NULL",
            "MISSING_PRODUCT_ID": "event_type IN ('page_view', 'add_to_cart') AND product_id IS NULL",
        },
        derive={"event_date": "CAST(timestamp AS DATE)", "event_hour": "hour(timestamp)"},
    ),
    "products": Recipe(
        whole_history=True,
        trim=("category", "name"),
        rules={
            "NULL_PRODUCT_ID": "product_id IS NULL",
            "NULL_NAME": "name IS NULL",
            "NULL_PRICE": "price_usd IS NULL",
            "NULL_COST": "cost_usd IS NULL",
            "NEGATIVE_PRICE": "price_usd < 0",
            "NEGATIVE_COST": "cost_usd < 0",
            "COST_EXCEEDS_PRICE": "cost_usd > price_usd",
            "NEGATIVE_MARGIN": "margin_usd < 0",
            "MARGIN_MISMATCH": "abs(margin_usd - (price_usd - cost_usd)) > 0.01D",
        },
        derive={
            "margin_pct": "CASE WHEN price_usd > 0 THEN round(margin_usd / price_usd * 100, 2) END",
            "price_tier": """CASE WHEN price_usd < 0 THEN NULL WHEN price_usd < 50 THEN 'budget'
                WHEN price_usd < 200 THEN 'mid_range' WHEN price_usd < 500 THEN 'premium'
                WHEN price_usd >= 500 THEN 'luxury' END""",
        },
    ),
    "reviews": Recipe(
        parse={"review_time": "try_cast(review_time AS TIMESTAMP)"},
        trim=("review_text",),
        newest_first=("review_time", "ingestion_timestamp"),
        rules={
            "NULL_REVIEW_ID": "review_id IS NULL",
            "NULL_ORDER_ID": "order_id IS NULL",
            "NULL_PRODUCT_ID": "product_id IS NULL",
            "NULL_REVIEW_TIME": "review_time IS NULL",
            "NULL_RATING": "rating IS NULL",
            "INVALID_RATING": "rating NOT BETWEEN 1 AND 5",
        },
        derive={
            "review_date": "CAST(review_time AS DATE)",
            "review_year": "year(review_time)",
            "sentiment": """CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral'
                WHEN rating >= 1 THEN 'negative' END""",
            "review_length": "length(review_text)",
        },
    ),
    "sessions": Recipe(
        parse={"start_time": "try_cast(start_time AS TIMESTAMP)"},
        trim=("device", "source", "country"),
        newest_first=("start_time", "ingestion_timestamp"),
        rules={
            "NULL_SESSION_ID": "session_id IS NULL",
            "NULL_CUSTOMER_ID": "customer_id IS NULL",
            "NULL_START_TIME": "start_time IS NULL",
            "FUTURE_SESSION": "CAST(start_time AS DATE) > DATE'{process_date}'",
        },
        derive={
            "session_date": "CAST(start_time AS DATE)",
            "session_year": "year(start_time)",
            "session_month": "month(start_time)",
            "session_hour": "hour(start_time)",
            "is_weekend": "dayofweek(start_time) IN (1, 7)",
        },
    ),
}


def usable_records(bronze: DataFrame) -> DataFrame:
    return bronze.where("is_valid_record_id")


def without_bronze_columns(df: DataFrame) -> DataFrame:
    return df.drop(*BRONZE_COLUMNS)


def with_processing_marks(df: DataFrame, process_date: str, processed_at: str) -> DataFrame:
    return df.withColumns(
        {
            "silver_processed_at": F.lit(processed_at).cast("timestamp"),
            "silver_process_date": F.lit(process_date),
        }
    )


def prepared(bronze: DataFrame, dataset: str) -> DataFrame:
    """Usable records, parsed and trimmed, one row per key."""
    recipe = RECIPES[dataset]
    rows = usable_records(bronze)
    if recipe.folds_lines:
        return aggregate_order_items(rows)
    # Only what survives bronze travels through the exchange on the key.
    own = [name for name in rows.columns if name not in BRONZE_COLUMNS]
    rows = rows.select(*own, "ingestion_timestamp")
    rows = rows.withColumns({name: F.expr(text) for name, text in recipe.parse.items()})
    rows = blank_to_null(rows, recipe.trim)
    return latest_per_key(rows, DATASETS[dataset].key, recipe.newest_first)


def with_validation(df: DataFrame, dataset: str, process_date: str) -> DataFrame:
    """Add ``validation_errors``; ``process_date`` must be an ISO date."""
    day = date.fromisoformat(process_date).isoformat()
    rules = {
        code: condition.replace("{process_date}", day)
        for code, condition in RECIPES[dataset].rules.items()
    }
    return df.withColumn("validation_errors", fold_rules(rules))


def with_derived(df: DataFrame, dataset: str) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in RECIPES[dataset].derive.items()})


def clean(bronze: DataFrame, dataset: str, process_date: str, processed_at: str) -> DataFrame:
    """Silver rows of one bronze frame."""
    rows = with_validation(prepared(bronze, dataset), dataset, process_date)
    rows = without_bronze_columns(with_derived(rows, dataset))
    return with_processing_marks(rows, process_date, processed_at)
