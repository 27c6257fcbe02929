"""DuckDB SQL for every registered query, written on its own and not generated from the library; the derived inputs
(``fixtures.py``) and the surrogate key formula are shared with it.

Named relations are collected in ``RELATIONS``; ``compose`` puts the ones a statement uses,
directly or not, in front of it as a WITH list.

Relation names: ``raw_*`` derived inputs; ``raw1_*``/``raw2_*`` the two deliveries; ``s_*`` silver of
the whole input; ``s1_*`` silver after the first delivery, ``d2_*`` the second delivery cleaned,
``s2_*`` silver after it; ``g_*``/``g1_*``/``g2_*`` dimensions and ``f1_*``/``f2_*`` facts of the same.
"""

from __future__ import annotations

import re
from collections import Counter

from tidemark.suite.fixtures import (
    FIRST_DATE,
    FIRST_TS,
    GIVEN_TABLES,
    RAW,
    SECOND_DATE,
    SECOND_TS,
    delivery_sql,
)

RELATIONS: dict[str, str] = {
    name: text.format(**{table: table for table in GIVEN_TABLES}) for name, text in RAW.items()
}

COLUMNS = {
    "events": "event_id session_id timestamp event_type product_id qty cart_size payment discount_pct amount_usd",
    "customers": "customer_id name email country age signup_date marketing_opt_in",
    "orders": "order_id customer_id order_time payment_method discount_pct subtotal_usd total_usd country"
    " device source",
    "order_items": "order_id product_id unit_price_usd quantity line_total_usd",
    "products": "product_id category name price_usd cost_usd margin_usd",
    "reviews": "review_id order_id product_id rating review_text review_time",
    "sessions": "session_id customer_id start_time device source country",
}
KEYS = {
    "events": ["event_id"],
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "product_id"],
    "products": ["product_id"],
    "reviews": ["review_id"],
    "sessions": ["session_id"],
}


def compose(statement: str) -> str:
    """``statement`` preceded by every relation it needs, in order of definition."""
    needed: set[str] = set()
    pending = [statement]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        fresh = [name for name in RELATIONS if name in words and name not in needed]
        needed.update(fresh)
        pending += [RELATIONS[name] for name in fresh]
    if not needed:
        return statement
    # What several parts of a statement use is worked out once.
    texts = {name: text for name, text in RELATIONS.items() if name in needed}
    uses = Counter(name for text in (*texts.values(), statement) for name in re.findall(r"[a-z_0-9]+", text) if name in needed)
    kinds = {name: "AS MATERIALIZED" if uses[name] > 1 else "AS" for name in texts}
    ctes = ",\n".join(f"{name} {kinds[name]} ({text})" for name, text in texts.items())
    return f"WITH {ctes}\n{statement}"


# ------------------------------------------------------------------ building blocks


def slot(cols: list[str]) -> str:
    text = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"(CAST(concat('0x', left(md5(concat_ws('|', {text})), 8)) AS BIGINT) % 65536)"


def surrogate(cols: list[str], start: str = "0", within: str = "") -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in cols)
    return (
        f"CAST({start} + (row_number() OVER (PARTITION BY {within}{slot(cols)} ORDER BY {order}) - 1) * 65536"
        f" + {slot(cols)} + 1 AS BIGINT)"
    )


def codes(*rules: str) -> str:
    """validation_errors from 'CODE: condition' texts."""
    cases = []
    for rule in rules:
        code, condition = rule.split(":", 1)
        cases.append(f"CASE WHEN {condition} THEN '{code}' END")
    return f"nullif(concat_ws(',', {', '.join(cases)}), '') AS validation_errors"


def tidy(column: str) -> str:
    return f"nullif(trim({column}), '') AS {column}"


def newest(rows: str, keys: list[str], order: str) -> str:
    return (
        f"SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)}"
        f" ORDER BY {order}) AS place FROM ({rows})) WHERE place = 1"
    )


def checks(dataset: str, day: str) -> str:
    """The rules of a dataset."""
    return {
        "customers": codes(
            "NULL_CUSTOMER_ID: customer_id IS NULL",
            "NULL_EMAIL: email IS NULL",
            "NULL_SIGNUP_DATE: signup_date IS NULL",
            "INVALID_EMAIL_FORMAT: NOT regexp_matches(email, '^[A-Za-z0-9+_.-]+@(.+)$')",
            "NULL_AGE: age IS NULL",
            "INVALID_AGE: age < 0 OR age > 150",
            f"FUTURE_SIGNUP_DATE: signup_date > DATE '{day}'",
        ),
        "orders": codes(
            "NULL_ORDER_ID: order_id IS NULL",
            "NULL_CUSTOMER_ID: customer_id IS NULL",
            "NULL_ORDER_TIME: order_time IS NULL",
            "NULL_TOTAL: total_usd IS NULL",
            "NEGATIVE_TOTAL: total_usd < 0",
            "SUBTOTAL_LESS_THAN_TOTAL: total_usd > subtotal_usd",
            "INVALID_DISCOUNT: discount_pct < 0 OR discount_pct > 100",
        ),
        "order_items": codes(
            "NULL_ORDER_ID: order_id IS NULL",
            "NULL_PRODUCT_ID: product_id IS NULL",
            "NULL_QUANTITY: quantity IS NULL",
            "NULL_UNIT_PRICE: unit_price_usd IS NULL",
            "NULL_LINE_TOTAL: line_total_usd IS NULL",
            "INVALID_QUANTITY: quantity <= 0",
            "NEGATIVE_PRICE: unit_price_usd < 0",
            "LINE_TOTAL_MISMATCH: abs(line_total_usd - quantity * unit_price_usd) > CAST(0.01 AS DOUBLE)",
        ),
        "events": codes(
            "NULL_EVENT_ID: event_id IS NULL",
            "NULL_SESSION_ID: session_id IS NULL",
            "NULL_EVENT_TYPE: event_type IS NULL",
            "NULL_TIMESTAMP: timestamp IS NULL",
            "ADD_TO_CART_MISSING_QTY: qty IS NULL AND event_type = 'add_to_cart'",
            "CHECKOUT_MISSING_CART_SIZE: cart_size IS NULL AND event_type = 'checkout'",
            "PURCHASE_MISSING_AMOUNT: amount_usd IS NULL AND event_type = 'purchase'",
            "PURCHASE_MISSING_PAYMENT: payment IS NULL AND event_type = 'purchase'",
            "MISSING_PRODUCT_ID: product_id IS NULL AND (event_type = 'page_view' OR event_type = 'add_to_cart')",
        ),
        "products": codes(
            "NULL_PRODUCT_ID: product_id IS NULL",
            "NULL_NAME: name IS NULL",
            "NULL_PRICE: price_usd IS NULL",
            "NULL_COST: cost_usd IS NULL",
            "NEGATIVE_PRICE: price_usd < 0",
            "NEGATIVE_COST: cost_usd < 0",
            "COST_EXCEEDS_PRICE: price_usd < cost_usd",
            "NEGATIVE_MARGIN: margin_usd < 0",
            "MARGIN_MISMATCH: abs(margin_usd - (price_usd - cost_usd)) > CAST(0.01 AS DOUBLE)",
        ),
        "reviews": codes(
            "NULL_REVIEW_ID: review_id IS NULL",
            "NULL_ORDER_ID: order_id IS NULL",
            "NULL_PRODUCT_ID: product_id IS NULL",
            "NULL_REVIEW_TIME: review_time IS NULL",
            "NULL_RATING: rating IS NULL",
            "INVALID_RATING: rating < 1 OR rating > 5",
        ),
        "sessions": codes(
            "NULL_SESSION_ID: session_id IS NULL",
            "NULL_CUSTOMER_ID: customer_id IS NULL",
            "NULL_START_TIME: start_time IS NULL",
            f"FUTURE_SESSION: CAST(start_time AS DATE) > DATE '{day}'",
        ),
    }[dataset]


DERIVED = {
    "customers": """CAST(year(signup_date) AS INTEGER) AS signup_year,
      CASE WHEN contains(email, '@') THEN string_split(email, '@')[2] END AS email_domain,
      CASE WHEN age IS NULL OR age < 0 THEN NULL WHEN age <= 17 THEN 'under_18' WHEN age <= 25 THEN '18-25'
        WHEN age <= 35 THEN '26-35' WHEN age <= 50 THEN '36-50' WHEN age <= 65 THEN '51-65'
        ELSE 'over_65' END AS age_group""",
    "orders": """CAST(order_time AS DATE) AS order_date, CAST(year(order_time) AS INTEGER) AS order_year,
      CAST(month(order_time) AS INTEGER) AS order_month, CAST(hour(order_time) AS INTEGER) AS order_hour,
      subtotal_usd - total_usd AS discount_amount""",
    "order_items": "unit_price_usd * quantity AS computed_line_total",
    "events": "CAST(timestamp AS DATE) AS event_date, CAST(hour(timestamp) AS INTEGER) AS event_hour",
    "products": """CASE WHEN price_usd IS NULL OR price_usd <= 0 THEN NULL
        ELSE round(margin_usd / price_usd * 100, 2) END AS margin_pct,
      CASE WHEN price_usd IS NULL OR price_usd < 0 THEN NULL WHEN price_usd < 50 THEN 'budget'
        WHEN price_usd < 200 THEN 'mid_range' WHEN price_usd < 500 THEN 'premium'
        ELSE 'luxury' END AS price_tier""",
    "reviews": """CAST(review_time AS DATE) AS review_date, CAST(year(review_time) AS INTEGER) AS review_year,
      CASE WHEN rating IS NULL THEN NULL WHEN rating > 3 THEN 'positive' WHEN rating = 3 THEN 'neutral'
        WHEN rating > 0 THEN 'negative' END AS sentiment,
      CAST(length(review_text) AS INTEGER) AS review_length""",
    "sessions": """CAST(start_time AS DATE) AS session_date, CAST(year(start_time) AS INTEGER) AS session_year,
      CAST(month(start_time) AS INTEGER) AS session_month, CAST(hour(start_time) AS INTEGER) AS session_hour,
      dayofweek(start_time) IN (0, 6) AS is_weekend""",
}


def parsed(dataset: str, source: str) -> str:
    """Typed and trimmed rows, one per key; ``source`` has an ``ingested`` column."""
    if dataset == "order_items":
        return f"""SELECT order_id, product_id, min(unit_price_usd) AS unit_price_usd,
          CAST(sum(quantity) AS BIGINT) AS quantity,
          CAST(sum(CAST(line_total_usd AS DECIMAL(28,6))) AS DOUBLE) AS line_total_usd
          FROM {source} GROUP BY order_id, product_id"""
    changes = {
        "customers": ["TRY_CAST(signup_date AS DATE) AS signup_date"]
        + [tidy(c) for c in ("name", "email", "country")]
        + [
            """CASE lower(trim(marketing_opt_in)) WHEN 'true' THEN true WHEN '1' THEN true WHEN 'yes' THEN true
            WHEN 'false' THEN false WHEN '0' THEN false WHEN 'no' THEN false END AS marketing_opt_in"""
        ],
        "orders": ["TRY_CAST(order_time AS TIMESTAMP) AS order_time"]
        + [tidy(c) for c in ("payment_method", "country", "device", "source")],
        "events": [
            "TRY_CAST(timestamp AS TIMESTAMP) AS timestamp",
            "TRY_CAST(trunc(product_id) AS BIGINT) AS product_id",
            tidy("event_type"),
            tidy("payment"),
        ],
        "products": [tidy("category"), tidy("name")],
        "reviews": ["TRY_CAST(review_time AS TIMESTAMP) AS review_time", tidy("review_text")],
        "sessions": ["TRY_CAST(start_time AS TIMESTAMP) AS start_time"]
        + [tidy(c) for c in ("device", "source", "country")],
    }[dataset]
    moment = {"orders": "order_time", "events": "timestamp", "reviews": "review_time", "sessions": "start_time"}
    order = f"{moment[dataset]} DESC NULLS LAST, " if dataset in moment else ""
    rows = f"SELECT * REPLACE ({', '.join(changes)}) FROM {source}"
    unique = newest(rows, KEYS[dataset], order + "ingested DESC NULLS LAST")
    return f"SELECT * EXCLUDE (ingested) FROM ({unique})"


def silver(dataset: str, source: str, day: str, stamp: str) -> str:
    return f"""SELECT *, {checks(dataset, day)}, {DERIVED[dataset]},
      TIMESTAMP '{stamp}' AS silver_processed_at, '{day}' AS silver_process_date
      FROM ({parsed(dataset, source)})"""


def upserted(target: str, source: str, keys: list[str]) -> str:
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"""SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {match})
      UNION ALL BY NAME SELECT * FROM {source}"""


def static_dim(values: str, value: str, key: str, existing: str | None = None) -> str:
    fresh = f"SELECT DISTINCT {value} FROM ({values}) WHERE {value} IS NOT NULL"
    if existing is None:
        return f"SELECT {surrogate([value])} AS {key}, {value} FROM ({fresh})"
    return f"""SELECT {key}, {value} FROM {existing} UNION ALL
      SELECT {surrogate([value], f"(SELECT coalesce(max({key}), 0) FROM {existing})")}, {value} FROM ({fresh})
      WHERE {value} NOT IN (SELECT {value} FROM {existing})"""


def scd2_changed(source: str, existing: str, nk: str, attrs: list[str]) -> str:
    other = " OR ".join(f"s.{a} IS DISTINCT FROM c.{a}" for a in attrs)
    return f"""SELECT s.{nk}, {', '.join('s.' + a for a in attrs)},
      CASE WHEN c.{nk} IS NULL THEN 'new' ELSE 'changed' END AS change_type
      FROM {source} s LEFT JOIN (SELECT * FROM {existing} WHERE is_current) c ON s.{nk} = c.{nk}
      WHERE c.{nk} IS NULL OR {other}"""


def scd2(source: str, nk: str, sk: str, attrs: list[str], stamp: str, existing: str | None = None) -> str:
    listed = ", ".join(attrs)
    if existing is None:
        return f"""SELECT {surrogate([nk])} AS {sk}, {nk}, {listed}, TIMESTAMP '{stamp}' AS effective_from,
          CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current FROM {source}"""
    changed = scd2_changed(source, existing, nk, attrs)
    start = f"(SELECT max({sk}) FROM {existing})"
    return f"""SELECT {sk}, {nk}, {listed}, effective_from,
        CASE WHEN closing THEN TIMESTAMP '{stamp}' ELSE effective_to END AS effective_to,
        is_current AND NOT closing AS is_current
      FROM (SELECT *, is_current AND {nk} IN (SELECT {nk} FROM ({changed}) WHERE change_type = 'changed') AS closing
            FROM {existing})
      UNION ALL SELECT {surrogate([nk], start)}, {nk}, {listed}, TIMESTAMP '{stamp}', NULL, true FROM ({changed})"""


CUSTOMER_ATTRS = ["name", "email", "country_name", "birth_year", "signup_date", "marketing_opt_in"]
PRODUCT_ATTRS = ["category_key", "product_name", "base_price_usd", "cost_usd"]
FEEDS = {
    "country": [("customers", "country"), ("orders", "country"), ("sessions", "country")],
    "source": [("orders", "source"), ("sessions", "source")],
    "device": [("orders", "device"), ("sessions", "device")],
    "payment_method": [("orders", "payment_method"), ("events", "payment")],
    "category": [("products", "category")],
}
DATES = [
    ("customers", "signup_date"),
    ("orders", "order_date"),
    ("reviews", "review_date"),
    ("sessions", "session_date"),
    ("events", "event_date"),
]


def feed(world: str, pairs: list[tuple[str, str]], name: str) -> str:
    return " UNION ALL ".join(f"SELECT {column} AS {name} FROM s{world}_{table}" for table, column in pairs)


def calendar(world: str) -> str:
    return f"""SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
      CAST(day(full_date) AS INTEGER) AS day, CAST(month(full_date) AS INTEGER) AS month,
      CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
      dayofweek(full_date) IN (0, 6) AS is_weekend
      FROM (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS full_date
            FROM ({feed(world, DATES, 'd')}))"""


def valid(relation: str) -> str:
    return f"(SELECT * FROM {relation} WHERE validation_errors IS NULL)"


def look(column: str, dimension: str, value: str, key: str) -> str:
    """A key by scalar lookup; it fails loudly should a value be listed twice."""
    return f"(SELECT d.{key} FROM {dimension} d WHERE d.{value} = {column})"


def named(world: str, stem: str, column: str) -> str:
    return f"{look(column, f'g{world}_{stem}', stem + '_name', stem + '_key')} AS {stem}_key"


def current(world: str, what: str) -> str:
    return f"(SELECT * FROM g{world}_{what} WHERE is_current)"


def costs(world: str, items: str) -> str:
    return f"""SELECT i.order_id,
      CAST(sum(CAST(coalesce(p.cost_usd, 0) * i.quantity AS DECIMAL(28,6))) AS DOUBLE) AS order_cost_usd
      FROM {items} i LEFT JOIN {current(world, 'products')} p ON i.product_id = p.product_id GROUP BY i.order_id"""


def order_rows(world: str, orders: str, items: str) -> str:
    return f"""SELECT o.order_id, c.customer_key,
      {look('o.order_date', f'g{world}_date', 'full_date', 'date_key')} AS date_key,
      {named(world, 'country', 'o.country')}, {named(world, 'source', 'o.source')},
      {named(world, 'device', 'o.device')}, o.order_time, {named(world, 'payment_method', 'o.payment_method')},
      o.discount_pct, o.subtotal_usd AS gross_revenue_usd,
      o.total_usd - coalesce(k.order_cost_usd, 0) AS net_margin_usd
      FROM {orders} o LEFT JOIN ({costs(world, items)}) k ON o.order_id = k.order_id
      LEFT JOIN {current(world, 'customers')} c ON o.customer_id = c.customer_id"""


def order_item_rows(world: str, orders: str, items: str) -> str:
    return f"""SELECT i.order_id, c.customer_key, p.product_key,
      {look('o.order_date', f'g{world}_date', 'full_date', 'date_key')} AS date_key,
      i.quantity, i.unit_price_usd, i.line_total_usd AS gross_revenue_usd,
      i.line_total_usd - coalesce(p.cost_usd, 0) * i.quantity AS gross_margin_usd, i.product_id
      FROM {items} i JOIN {orders} o ON i.order_id = o.order_id
      LEFT JOIN {current(world, 'customers')} c ON o.customer_id = c.customer_id
      LEFT JOIN {current(world, 'products')} p ON i.product_id = p.product_id"""


def durations(events: str) -> str:
    """Events with the whole seconds to the session's next event."""
    return f"""SELECT *, coalesce(greatest(
        CAST(floor(epoch(lead(timestamp) OVER (PARTITION BY session_id ORDER BY timestamp, event_id))) AS BIGINT)
        - CAST(floor(epoch(timestamp)) AS BIGINT), 0), 0)::DOUBLE AS duration FROM {events}"""


def web_event_rows(world: str, events: str, sessions: str) -> str:
    owned = f"(SELECT e.*, s.customer_id FROM {events} e JOIN {sessions} s ON e.session_id = s.session_id)"
    return f"""SELECT e.event_id, e.session_id, c.customer_key, p.product_key,
      {look('e.event_date', f'g{world}_date', 'full_date', 'date_key')} AS date_key, e.event_type, e.duration
      FROM ({durations(owned)}) e LEFT JOIN {current(world, 'customers')} c ON e.customer_id = c.customer_id
      LEFT JOIN {current(world, 'products')} p ON e.product_id = p.product_id"""


def review_rows(world: str, reviews: str) -> str:
    return f"""SELECT r.review_id, r.order_id, p.product_key, r.rating, r.review_text, r.review_date
      FROM {reviews} r LEFT JOIN {current(world, 'products')} p ON r.product_id = p.product_id"""


def session_rows(world: str, sessions: str) -> str:
    return f"""SELECT s.session_id, c.customer_key, strftime(s.start_time, '%H:%M:%S') AS start_time,
      {look('s.session_date', f'g{world}_date', 'full_date', 'date_key')} AS date_key,
      {named(world, 'device', 's.device')}, {named(world, 'source', 's.source')},
      {named(world, 'country', 's.country')}
      FROM {sessions} s LEFT JOIN {current(world, 'customers')} c ON s.customer_id = c.customer_id"""


def numbered(rows: str, key: str, business: list[str]) -> str:
    return f"SELECT {surrogate(business)} AS {key}, * FROM ({rows})"


def remembered(existing: str, rows: str, key: str, business: list[str]) -> str:
    """Incoming rows with known keys kept and new ones above the largest."""
    match = " AND ".join(f"i.{b} = x.{b}" for b in business)
    start = f"(SELECT coalesce(max({key}), 0) FROM {existing})"
    fresh = surrogate(business, start, within="known_key IS NULL, ")
    return f"""SELECT coalesce(known_key, {fresh}) AS {key}, * EXCLUDE (known_key)
      FROM (SELECT i.*, x.{key} AS known_key FROM ({rows}) i LEFT JOIN {existing} x ON {match})"""


# -------------------------------------------------------------------- relations

for _ds in COLUMNS:
    _cols = COLUMNS[_ds].split()
    RELATIONS[f"raw1_{_ds}"] = delivery_sql(_ds, 1, _cols)
    RELATIONS[f"raw2_{_ds}"] = delivery_sql(_ds, 2, _cols)
    for _world, _raw, _day, _ts in (
        ("s", "raw", FIRST_DATE, FIRST_TS),
        ("s1", "raw1", FIRST_DATE, FIRST_TS),
        ("d2", "raw2", SECOND_DATE, SECOND_TS),
    ):
        _source = f"(SELECT *, TIMESTAMP '{_ts}' AS ingested FROM {_raw}_{_ds})"
        RELATIONS[f"{_world}_{_ds}"] = silver(_ds, _source, _day, _ts)
    _named = " OR ".join(f"{k} IS NOT NULL" for k in KEYS[_ds])
    _source = f"(SELECT *, TIMESTAMP '{FIRST_TS}' AS ingested FROM hard_{_ds} WHERE {_named})"
    RELATIONS[f"h_{_ds}"] = silver(_ds, _source, FIRST_DATE, FIRST_TS)
    if _ds == "products":
        _both = f"""(SELECT *, TIMESTAMP '{FIRST_TS}' AS ingested FROM raw1_products
          UNION ALL SELECT *, TIMESTAMP '{SECOND_TS}' FROM raw2_products)"""
        RELATIONS["s2_products"] = silver(_ds, _both, SECOND_DATE, SECOND_TS)
    else:
        RELATIONS[f"s2_{_ds}"] = upserted(f"s1_{_ds}", f"d2_{_ds}", KEYS[_ds])

for _w, _prior, _day, _ts in (
    ("", None, FIRST_DATE, FIRST_TS),
    ("1", None, FIRST_DATE, FIRST_TS),
    ("2", "1", SECOND_DATE, SECOND_TS),
):
    for _stem, _pairs in FEEDS.items():
        RELATIONS[f"g{_w}_{_stem}"] = static_dim(
            feed(_w, _pairs, f"{_stem}_name"),
            f"{_stem}_name",
            f"{_stem}_key",
            f"g{_prior}_{_stem}" if _prior else None,
        )
    RELATIONS[f"g{_w}_date"] = calendar(_w)
    RELATIONS[f"customer_source{_w}"] = f"""SELECT customer_id, name, email, country AS country_name,
      CASE WHEN age >= 0 AND age <= 150 THEN CAST({_day[:4]} - age AS INTEGER) END AS birth_year,
      signup_date, marketing_opt_in FROM s{_w}_customers WHERE customer_id IS NOT NULL"""
    RELATIONS[f"product_source{_w}"] = f"""SELECT product_id,
      {look('category', f'g{_w}_category', 'category_name', 'category_key')} AS category_key,
      name AS product_name, price_usd AS base_price_usd, cost_usd
      FROM s{_w}_products WHERE product_id IS NOT NULL"""
    RELATIONS[f"g{_w}_customers"] = scd2(
        f"customer_source{_w}",
        "customer_id",
        "customer_key",
        CUSTOMER_ATTRS,
        _ts,
        f"g{_prior}_customers" if _prior else None,
    )
    RELATIONS[f"g{_w}_products"] = scd2(
        f"product_source{_w}",
        "product_id",
        "product_key",
        PRODUCT_ATTRS,
        _ts,
        f"g{_prior}_products" if _prior else None,
    )

for _w in ("", "1"):
    _v = {ds: valid(f"s{_w}_{ds}") for ds in COLUMNS}
    RELATIONS[f"f{_w}_order"] = numbered(
        order_rows(_w, _v["orders"], _v["order_items"]), "order_key", ["order_id"]
    )
    RELATIONS[f"f{_w}_order_item"] = numbered(
        order_item_rows(_w, _v["orders"], _v["order_items"]), "order_item_key", ["order_id", "product_id"]
    )
    RELATIONS[f"f{_w}_web_events"] = numbered(
        web_event_rows(_w, _v["events"], _v["sessions"]), "event_key", ["event_id"]
    )
    RELATIONS[f"f{_w}_review"] = numbered(review_rows(_w, _v["reviews"]), "review_key", ["review_id"])
    RELATIONS[f"f{_w}_session"] = numbered(session_rows(_w, _v["sessions"]), "session_key", ["session_id"])


def since(dataset: str) -> str:
    return f"(SELECT * FROM s2_{dataset} WHERE validation_errors IS NULL AND silver_process_date > '{FIRST_DATE}')"


_touched = f"(SELECT session_id FROM {since('events')})"
DELTAS = {
    "order": (
        order_rows(
            "2",
            since("orders"),
            f"(SELECT * FROM {valid('s2_order_items')} WHERE order_id IN (SELECT order_id FROM {since('orders')}))",
        ),
        "order_key",
        ["order_id"],
    ),
    "order_item": (
        order_item_rows("2", valid("s2_orders"), since("order_items")),
        "order_item_key",
        ["order_id", "product_id"],
    ),
    "web_events": (
        web_event_rows(
            "2",
            f"(SELECT * FROM {valid('s2_events')} WHERE session_id IN {_touched})",
            valid("s2_sessions"),
        ),
        "event_key",
        ["event_id"],
    ),
    "review": (review_rows("2", since("reviews")), "review_key", ["review_id"]),
    "session": (session_rows("2", since("sessions")), "session_key", ["session_id"]),
}
for _name, (_rows, _key, _business) in DELTAS.items():
    RELATIONS[f"delta_{_name}"] = _rows
    RELATIONS[f"incoming_{_name}"] = remembered(
        f"f1_{_name}", f"SELECT * FROM delta_{_name}", _key, _business
    )
    RELATIONS[f"f2_{_name}"] = upserted(f"f1_{_name}", f"incoming_{_name}", _business)

# The funnel of the whole input, and after the second delivery.
for _w in ("", "2"):
    RELATIONS[f"visits{_w}"] = f"""SELECT e.*, s.customer_id FROM {valid(f's{_w}_events')} e
      JOIN {valid(f's{_w}_sessions')} s ON e.session_id = s.session_id"""
    RELATIONS[f"view_dates{_w}"] = f"""SELECT customer_id, product_id, min(event_date) AS first_view_date FROM visits{_w}
      WHERE event_type = 'page_view' AND product_id IS NOT NULL GROUP BY customer_id, product_id"""
    RELATIONS[f"cart_dates{_w}"] = f"""SELECT customer_id, product_id, min(event_date) AS first_add_to_cart_date FROM visits{_w}
      WHERE event_type = 'add_to_cart' AND product_id IS NOT NULL GROUP BY customer_id, product_id"""
    RELATIONS[f"checkout_dates{_w}"] = f"""SELECT c.customer_id, c.product_id, min(k.event_date) AS first_checkout_date
      FROM (SELECT * FROM visits{_w} WHERE event_type = 'add_to_cart' AND product_id IS NOT NULL) c
      JOIN (SELECT * FROM visits{_w} WHERE event_type = 'checkout') k
        ON k.session_id = c.session_id AND k.customer_id = c.customer_id AND c.timestamp <= k.timestamp
      GROUP BY c.customer_id, c.product_id"""
    RELATIONS[f"order_map{_w}"] = f"""SELECT DISTINCT b.session_id, b.customer_id, o.order_id, o.order_date
      FROM visits{_w} b JOIN {valid(f's{_w}_orders')} o ON b.customer_id = o.customer_id AND b.timestamp = o.order_time
      WHERE b.event_type = 'purchase'"""
    RELATIONS[f"purchase_dates{_w}"] = f"""SELECT m.customer_id, i.product_id, min(m.order_date) AS first_purchase_date
      FROM order_map{_w} m JOIN {valid(f's{_w}_order_items')} i ON m.order_id = i.order_id
      GROUP BY m.customer_id, i.product_id"""
    RELATIONS[f"funnel_pairs{_w}"] = f"""SELECT customer_id, product_id FROM view_dates{_w}
      UNION SELECT customer_id, product_id FROM cart_dates{_w} UNION SELECT customer_id, product_id FROM checkout_dates{_w}
      UNION SELECT customer_id, product_id FROM purchase_dates{_w}"""
    _keys = ", ".join(
        f"{look(f'first_{stage}_date', f'g{_w}_date', 'full_date', 'date_key')} AS first_{stage}_date_key"
        for stage in ("view", "add_to_cart", "checkout", "purchase")
    )
    RELATIONS[f"funnel_rows{_w}"] = f"""SELECT c.customer_key, p.product_key, {_keys}
      FROM funnel_pairs{_w} b LEFT JOIN view_dates{_w} USING (customer_id, product_id)
      LEFT JOIN cart_dates{_w} USING (customer_id, product_id)
      LEFT JOIN checkout_dates{_w} USING (customer_id, product_id)
      LEFT JOIN purchase_dates{_w} USING (customer_id, product_id)
      JOIN {current(_w, 'customers')} c ON b.customer_id = c.customer_id
      JOIN {current(_w, 'products')} p ON b.product_id = p.product_id"""
    RELATIONS[f"f{_w}_customer_funnel"] = numbered(f"SELECT * FROM funnel_rows{_w}", "funnel_key", ["customer_key", "product_key"])

# Small stand-alone inputs of single queries.
# A CSV scan reads an empty cell, quoted or not, as NULL.
for _ds in COLUMNS:
    _texts = {"orders": ["payment_method"]}.get(_ds, [])
    _empty = ", ".join(f"nullif({c}, '') AS {c}" for c in _texts)
    RELATIONS[f"landed_{_ds}"] = f"SELECT *{f' REPLACE ({_empty})' if _empty else ''} FROM raw_{_ds}"
RELATIONS["all_names"] = "SELECT name FROM raw_customers"
RELATIONS["names1"] = static_dim("SELECT name FROM raw1_customers", "name", "name_key")
RELATIONS["order_totals1"] = numbered(
    "SELECT order_id, total_usd FROM raw1_orders", "total_key", ["order_id"]
)
RELATIONS["order_totals2"] = remembered(
    "order_totals1", "SELECT order_id, total_usd FROM raw2_orders", "total_key", ["order_id"]
)


def bronze(dataset: str, raw: str, day: str, stamp: str, source_file: str | None) -> str:
    """Bronze rows of a delivery."""
    keys = KEYS[dataset]
    if len(keys) == 1:
        record = f"trim(CAST({keys[0]} AS VARCHAR))"
    else:
        record = f"concat_ws('_', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})"
    lineage = f", '{source_file}' AS source_file" if source_file else ""
    return f"""SELECT *, CASE WHEN record_id IS NULL THEN 'NULL_RECORD_ID' WHEN record_id = '' THEN 'EMPTY_RECORD_ID'
        END AS dq_error, record_id IS NOT NULL AND record_id <> '' AS is_valid_record_id,
      '{day}' AS ingest_date, TIMESTAMP '{stamp}' AS ingestion_timestamp{lineage}
      FROM (SELECT *, {record} AS record_id, '{'_'.join(keys)}' AS record_id_source FROM {raw}_{dataset})"""
