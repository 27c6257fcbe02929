"""Landing-shaped inputs derived from the given tables, in SQL that Spark and DuckDB both run.

``{name}`` stands for a given table: a DataFrame in Spark, a view in DuckDB.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import fit_shuffles
from tidemark.sources.schemas import DATASETS

# Process dates and stamps of the first and the second delivery.
FIRST_DATE, SECOND_DATE = "2024-01-15", "2024-01-31"
FIRST_TS, SECOND_TS = "2024-01-15 06:00:00", "2024-01-31 06:00:00"

GIVEN_TABLES = ("customer", "nation", "orders", "lineitem", "part", "events", "documents", "supplier")

_ORDER_MOMENT = "o_orderdate + CAST(o_orderkey % 86400 AS INT) * INTERVAL '1' SECOND"
# Ids stay unique whatever the keys: sessions of orders are even and those of a user's day odd; an event's lowest three
# bits name its kind, above them stand the order and the place of the product in it (four digits), or the given id.
_DAY_SESSION = "(user_id * 100000000 + year(ts) * 10000 + month(ts) * 100 + day(ts)) * 2 + 1"
_ITEM_EVENT = "(CAST(i.order_id AS BIGINT) * 10000 + row_number() OVER (PARTITION BY i.order_id ORDER BY i.product_id)) * 8"

RAW = {
    "raw_customers": """
  SELECT CAST(c_custkey AS BIGINT) AS customer_id,
    CASE WHEN c_custkey % 97 = 0 THEN '   ' ELSE concat(' ', c_name, ' ') END AS name,
    CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN 'no-at-sign'
      ELSE concat('user.', CAST(c_custkey AS STRING), '@', lower(c_mktsegment), '.example') END AS email,
    n_name AS country,
    CASE WHEN c_custkey % 61 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN 151
      ELSE CAST((c_custkey * 7) % 90 + 5 AS INT) END AS age,
    CASE WHEN c_custkey % 41 = 0 THEN 'not-a-date'
      ELSE CAST(DATE '2023-01-01' + CAST(c_custkey % 900 AS INT) AS STRING) END AS signup_date,
    CASE CAST(c_custkey % 7 AS INT) WHEN 0 THEN ' true ' WHEN 1 THEN 'FALSE' WHEN 2 THEN '1' WHEN 3 THEN 'no'
      WHEN 4 THEN 'YES' WHEN 5 THEN '0' ELSE 'maybe' END AS marketing_opt_in
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "raw_products": """
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_type AS category, concat(' ', p_name) AS name,
    CAST(p_partkey % 700 AS DOUBLE) + 0.5 AS price_usd,
    CAST(p_partkey % 700 AS DOUBLE) + 0.5 - p_size AS cost_usd,
    CAST(p_size AS DOUBLE) + CASE WHEN p_partkey % 53 = 0 THEN 1.0 ELSE 0.0 END AS margin_usd
  FROM {part}""",
    "raw_orders": f"""
  SELECT CAST(o_orderkey AS BIGINT) AS order_id,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS customer_id,
    CASE WHEN o_orderkey % 89 = 0 THEN 'bad-time' ELSE CAST({_ORDER_MOMENT} AS STRING) END AS order_time,
    CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'card' WHEN 1 THEN ' paypal ' WHEN 2 THEN ''
      ELSE 'bank' END AS payment_method,
    CASE WHEN o_orderkey % 73 = 0 THEN 120.0E0 ELSE CAST(o_orderkey % 4 AS DOUBLE) * 5.0E0 END AS discount_pct,
    o_totalprice AS subtotal_usd,
    o_totalprice - CAST(o_orderkey % 4 AS DOUBLE) * 25.0E0
      + CASE WHEN o_orderkey % 71 = 0 THEN 100.0E0 ELSE 0.0E0 END AS total_usd,
    n_name AS country, o_orderpriority AS device, o_orderstatus AS source
  FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "raw_order_items": """
  SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_partkey AS BIGINT) AS product_id,
    price_usd AS unit_price_usd, CAST(l_quantity AS INT) AS quantity,
    price_usd * l_quantity + CASE WHEN l_orderkey % 67 = 0 THEN 1.0E0 ELSE 0.0E0 END AS line_total_usd
  FROM {lineitem} JOIN raw_products ON l_partkey = product_id""",
    "raw_sessions": f"""
  SELECT CAST(o_orderkey AS BIGINT) * 2 AS session_id,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS customer_id,
    CAST({_ORDER_MOMENT} - INTERVAL '600' SECOND AS STRING) AS start_time,
    o_orderpriority AS device, o_orderstatus AS source, n_name AS country
  FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
  UNION ALL
  SELECT {_DAY_SESSION}, CAST(user_id AS BIGINT),
    CAST(min(date_trunc('second', ts)) AS STRING), 'mobile', 'stream', NULL
  FROM {{events}} GROUP BY user_id, {_DAY_SESSION}""",
    "raw_events": f"""
  SELECT {_ITEM_EVENT} + 1 AS event_id,
    CAST(i.order_id AS BIGINT) * 2 AS session_id,
    CAST({_ORDER_MOMENT} - INTERVAL '500' SECOND AS STRING) AS timestamp,
    'page_view' AS event_type, CAST(i.product_id AS DOUBLE) AS product_id, CAST(NULL AS DOUBLE) AS qty,
    CAST(NULL AS DOUBLE) AS cart_size, CAST(NULL AS STRING) AS payment,
    CAST(NULL AS DOUBLE) AS discount_pct, CAST(NULL AS DOUBLE) AS amount_usd
  FROM (SELECT DISTINCT order_id, product_id FROM raw_order_items) i JOIN {{orders}} ON i.order_id = o_orderkey
  UNION ALL
  SELECT {_ITEM_EVENT} + 2, CAST(i.order_id AS BIGINT) * 2,
    CAST(CASE WHEN i.product_id % 11 = 0 THEN {_ORDER_MOMENT} + INTERVAL '60' SECOND
      ELSE {_ORDER_MOMENT} - INTERVAL '300' SECOND END AS STRING),
    'add_to_cart', CASE WHEN i.product_id % 13 = 0 THEN NULL ELSE CAST(i.product_id AS DOUBLE) END,
    i.qty, NULL, NULL, NULL, NULL
  FROM (SELECT order_id, product_id, CAST(sum(quantity) AS DOUBLE) AS qty
        FROM raw_order_items GROUP BY order_id, product_id) i
  JOIN {{orders}} ON i.order_id = o_orderkey WHERE i.product_id % 5 <> 0
  UNION ALL
  SELECT CAST(o_orderkey AS BIGINT) * 80000 + 3, CAST(o_orderkey AS BIGINT) * 2, CAST({_ORDER_MOMENT} - INTERVAL '60' SECOND AS STRING),
    'checkout', NULL, NULL, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 3.0E0 END, NULL, NULL, NULL
  FROM {{orders}} WHERE o_orderkey % 3 <> 0
  UNION ALL
  SELECT CAST(o_orderkey AS BIGINT) * 80000 + 4, CAST(o_orderkey AS BIGINT) * 2, CAST({_ORDER_MOMENT} AS STRING),
    'purchase', NULL, NULL, NULL, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE ' card ' END, 5.0E0, o_totalprice
  FROM {{orders}} WHERE o_orderkey % 4 <> 0
  UNION ALL
  SELECT event_id * 8, {_DAY_SESSION}, CAST(date_trunc('second', ts) AS STRING),
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'checkout'
      ELSE event_type END,
    CASE WHEN event_type IN ('view', 'click') THEN CAST(event_id % (SELECT count(*) FROM {{part}}) AS DOUBLE) END,
    CASE WHEN event_type = 'click' THEN 1.0E0 END, CASE WHEN event_type = 'signup' THEN 1.0E0 END,
    CASE WHEN event_type = 'purchase' THEN 'card' END, NULL, CASE WHEN event_type = 'purchase' THEN value END
  FROM {{events}}""",
    "raw_reviews": """
  SELECT CAST(doc_id AS BIGINT) AS review_id, CAST(doc_id % (SELECT count(*) FROM {orders}) AS BIGINT) AS order_id,
    CAST(doc_id % (SELECT count(*) FROM {part}) AS BIGINT) AS product_id,
    CASE WHEN doc_id % 43 = 0 THEN NULL ELSE CAST(doc_id % 7 AS INT) END AS rating,
    text AS review_text,
    CAST(TIMESTAMP '2024-01-01 00:00:00' + CAST(doc_id % 500 AS INT) * INTERVAL '1' HOUR AS STRING) AS review_time
  FROM {documents}""",
}

# The same rows with faults in every column a rule looks at: a value in so many is missing, unreadable or out of bounds, and
# rows with a time come again with another one.
_FAULTS = {
    "customers": {
        "customer_id": {"customer_id % 31 = 0": "NULL"},
        "age": {"customer_id % 37 = 1": "-3"},
        "name": {"customer_id % 29 = 1": "NULL"},
    },
    "orders": {
        "order_id": {"order_id % 31 = 0": "NULL"},
        "customer_id": {"order_id % 29 = 1": "NULL"},
        "total_usd": {"order_id % 23 = 1": "NULL", "order_id % 23 = 2": "-1.0E0 - total_usd"},
        "discount_pct": {"order_id % 19 = 1": "-5.0E0"},
    },
    "order_items": {
        "order_id": {"(order_id + product_id) % 31 = 0": "NULL"},
        "product_id": {"(order_id + product_id) % 29 = 1 OR (order_id + product_id) % 62 = 0": "NULL"},
        "quantity": {"order_id % 23 = 1": "NULL", "order_id % 23 = 2": "-quantity", "order_id % 23 = 3": "0"},
        "unit_price_usd": {"product_id % 19 = 1": "NULL", "product_id % 19 = 2": "-unit_price_usd"},
        "line_total_usd": {"order_id % 17 = 1": "NULL", "order_id % 17 = 2": "line_total_usd + 0.5E0"},
    },
    "events": {
        "event_id": {"event_id % 31 = 0": "NULL"},
        "session_id": {"event_id % 29 = 1": "NULL"},
        "timestamp": {"event_id % 23 = 1": "'never'", "event_id % 23 = 2": "NULL"},
        "event_type": {"event_id % 19 = 1": "'  '", "event_id % 19 = 2": "NULL"},
        "product_id": {"event_id % 17 = 1": "NULL"},
        "qty": {"event_id % 13 = 1": "NULL"},
        "payment": {"event_id % 11 = 1": "' '"},
        "amount_usd": {"event_id % 7 = 1": "NULL"},
    },
    "products": {
        "product_id": {"product_id % 31 = 0": "NULL"},
        "name": {"product_id % 29 = 1": "'  '"},
        "price_usd": {"product_id % 23 = 1": "NULL", "product_id % 23 = 2": "-price_usd", "product_id % 23 = 3": "0.0E0"},
        "cost_usd": {"product_id % 19 = 1": "NULL", "product_id % 19 = 2": "-1.0E0", "product_id % 19 = 3": "cost_usd + 900.0E0"},
        "margin_usd": {"product_id % 17 = 1": "-margin_usd", "product_id % 17 = 2": "NULL"},
    },
    "reviews": {
        "review_id": {"review_id % 31 = 0": "NULL"},
        "order_id": {"review_id % 29 = 1": "NULL"},
        "product_id": {"review_id % 23 = 1": "NULL"},
        "review_time": {"review_id % 19 = 1": "'soon'"},
        "rating": {"review_id % 17 = 1": "6", "review_id % 17 = 2": "-1"},
    },
    "sessions": {
        "session_id": {"session_id % 31 = 0": "NULL"},
        "customer_id": {"session_id % 29 = 1": "NULL"},
        "start_time": {"session_id % 23 = 1": "'soon'", "session_id % 23 = 2": "'2031-05-06 07:08:09'"},
        "device": {"session_id % 19 = 1": "''"},
    },
}
_MOMENTS = {"orders": ("order_id", "order_time"), "events": ("event_id", "timestamp"), "reviews": ("review_id", "review_time"), "sessions": ("session_id", "start_time")}


def _faulty(dataset: str, columns: tuple[str, ...]) -> str:
    def chosen(column: str) -> str:
        cases = " ".join(f"WHEN {condition} THEN {value}" for condition, value in _FAULTS[dataset].get(column, {}).items())
        return f"CASE {cases} ELSE {column} END AS {column}" if cases else column

    rows = f"SELECT {', '.join(map(chosen, columns))} FROM raw_{dataset}"
    if dataset not in _MOMENTS:
        return rows
    key, moment = _MOMENTS[dataset]
    again = ", ".join(f"'1970-01-02 03:04:05' AS {c}" if c == moment else c for c in columns)
    return f"{rows} UNION ALL SELECT {again} FROM raw_{dataset} WHERE {key} % 5 = 0"


RAW |= {
    f"hard_{dataset}": _faulty(dataset, tuple(entry.split()[0] for entry in DATASETS[dataset].ddl.split(",")))
    for dataset in _FAULTS
}

# Two deliveries that together hold every row, split by business time as deliveries are. The
# second brings what is new since the first, and delivers some rows again, in part with
# changed values. Unreadable times sort behind all dates, so such rows come second.
NEW_LATER = {
    "customers": "signup_date >= '2024-06-01'",
    "products": "price_usd >= 500",
    "orders": "order_time >= '2000-01-01'",
    "order_items": "order_id IN (SELECT order_id FROM raw_orders WHERE order_time >= '2000-01-01')",
    "reviews": "review_time >= '2024-01-12'",
    "sessions": "start_time >= '2000-01-01'",
    "events": "timestamp >= '2000-01-01'",
}
SENT_AGAIN = {
    "customers": "marketing_opt_in = 'maybe'",
    "products": "price_usd < 100",
    "orders": "source = 'P'",
    "order_items": "order_id IN (SELECT order_id FROM raw_orders WHERE source = 'P')",
    "reviews": "rating = 5",
    "sessions": "source = 'P'",
    "events": "event_type = 'checkout'",
}
CHANGED_AGAIN = {
    "customers": {"email": "'new.' || email"},
    "products": {"price_usd": "price_usd + 10", "cost_usd": "cost_usd + 10"},
    "orders": {"total_usd": "total_usd - 1"},
}


def delivery_sql(dataset: str, number: int, columns: list[str]) -> str:
    """SELECT of the first or second delivery of a dataset from its raw view."""
    raw_name, new, again = f"raw_{dataset}", NEW_LATER[dataset], f"coalesce({SENT_AGAIN[dataset]}, false)"
    if number == 1:
        return f"SELECT {', '.join(columns)} FROM {raw_name} WHERE NOT ({new})"
    changes = CHANGED_AGAIN.get(dataset, {})
    chosen = [f"CASE WHEN {again} THEN {changes[c]} ELSE {c} END AS {c}" if c in changes else c for c in columns]
    return f"SELECT {', '.join(chosen)} FROM {raw_name} WHERE ({new}) OR {again}"


def needed_raw(statement: str, known: Mapping[str, str] | None = None) -> dict[str, str]:
    """Raw views a statement is built from, directly or not, with their text, in definition order; ``known`` replaces texts."""
    texts = {**RAW, **(known or {})}
    found: set[str] = set()
    pending = [statement]
    while pending:
        text = pending.pop()
        fresh = [name for name in texts if re.search(rf"\b{name}\b", text) and name not in found]
        found.update(fresh)
        pending += [texts[name] for name in fresh]
    return {entry: texts[entry] for entry in texts if entry in found}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw(
    spark: SparkSession,
    sf_dir: str,
    dataset: str,
    delivery: int | None = None,
    kind: str = "raw",
    stored: DataFrame | None = None,
) -> DataFrame:
    """A landing-shaped frame: all rows, or those of one delivery; with ``kind`` "hard" the ones with faults.

    ``stored`` may hold the rows of ``raw_<dataset>``, so that they are not derived again.
    """
    last = f"SELECT * FROM {kind}_{dataset}"
    if delivery is not None:
        last = delivery_sql(dataset, delivery, DATASETS[dataset].columns)
    known = {} if stored is None else {f"raw_{dataset}": "SELECT * FROM {stored}"}
    if dataset == "events" and stored is None:
        # Events group, join and number the lines of an order: dealt by order, they are shuffled once for all three. The number of
        # partitions is named, or adaptive execution would join them to shares that hold more rows than others, their columns being few.
        known["raw_order_items"] = RAW["raw_order_items"].replace("SELECT", "SELECT /*+ REPARTITION({partitions}, order_id) */", 1)
    views = needed_raw(last, known)
    text = f"WITH {', '.join(f'{entry} AS ({views[entry]})' for entry in views)} {last}"
    used = {table: given(spark, sf_dir, table) for table in GIVEN_TABLES if f"{{{table}}}" in text}
    fit_shuffles(spark, [f"{sf_dir}/{table}.parquet" for table in used])
    text = text.replace("{partitions}", spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.sql(text, **used, **({} if stored is None else {"stored": stored}))
