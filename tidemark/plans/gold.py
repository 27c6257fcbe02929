"""Gold: the star schema as functions of silver frames and dimensions.

Fact functions return rows without their surrogate key; ``keyed`` numbers a full build,
and an incremental build gets its keys from the merge.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import money_sum
from tidemark.operators.dimensions import calendar, scd2_dimension, static_dimension, union_values
from tidemark.operators.keys import assign_surrogate_key
from tidemark.operators.lookup import (
    attach_current,
    attach_dimension_key,
    current_versions,
    restrict_to,
    valid_rows,
    with_session_customer,
)
from tidemark.operators.succession import first_at_or_after, seconds_to_next

Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class KeyDimension:
    """A (key, name) dimension fed by columns of silver datasets."""

    stem: str
    feeds: tuple[tuple[str, str], ...]

    @property
    def key(self) -> str:
        return f"{self.stem}_key"

    @property
    def value(self) -> str:
        return f"{self.stem}_name"


@dataclass(frozen=True)
class Fact:
    """A fact's surrogate key, business key, published columns and incremental source."""

    key: str
    business: tuple[str, ...]
    columns: tuple[str, ...]
    source: str | None = None
    month_of: str | None = None


# Table, key and column names of the star schema, and what feeds them.
KEY_DIMENSIONS = {
    "dim_country": KeyDimension(
        "country", (("customers", "country"), ("orders", "country"), ("sessions", "country"))
    ),
    "dim_source": KeyDimension("source", (("orders", "source"), ("sessions", "source"))),
    "dim_device": KeyDimension("device", (("orders", "device"), ("sessions", "device"))),
    "dim_payment_method": KeyDimension(
        "payment_method", (("orders", "payment_method"), ("events", "payment"))
    ),
    "dim_category": KeyDimension("category", (("products", "category"),)),
}
CALENDAR_FEEDS = (
    ("customers", "signup_date"),
    ("orders", "order_date"),
    ("reviews", "review_date"),
    ("sessions", "session_date"),
    ("events", "event_date"),
)
CUSTOMER_ATTRIBUTES = ("name", "email", "country_name", "birth_year", "signup_date", "marketing_opt_in")
PRODUCT_ATTRIBUTES = ("category_key", "product_name", "base_price_usd", "cost_usd")
FACTS = {
    "fact_order": Fact(
        "order_key",
        ("order_id",),
        (
            "order_id",
            "customer_key",
            "date_key",
            "country_key",
            "source_key",
            "device_key",
            "order_time",
            "payment_method_key",
            "discount_pct",
            "gross_revenue_usd",
            "net_margin_usd",
        ),
        "orders",
        "date_key",
    ),
    "fact_order_item": Fact(
        "order_item_key",
        ("order_id", "product_id"),
        (
            "order_id",
            "customer_key",
            "product_key",
            "date_key",
            "quantity",
            "unit_price_usd",
            "gross_revenue_usd",
            "gross_margin_usd",
        ),
        "order_items",
        "date_key",
    ),
    "fact_web_events": Fact(
        "event_key",
        ("event_id",),
        ("event_id", "session_id", "customer_key", "product_key", "date_key", "event_type", "duration"),
        "events",
        "date_key",
    ),
    "fact_review": Fact(
        "review_key",
        ("review_id",),
        ("review_id", "order_id", "product_key", "rating", "review_text", "review_date"),
        "reviews",
    ),
    "fact_session": Fact(
        "session_key",
        ("session_id",),
        (
            "session_id",
            "customer_key",
            "start_time",
            "date_key",
            "device_key",
            "source_key",
            "country_key",
        ),
        "sessions",
        "date_key",
    ),
    "fact_customer_funnel": Fact(
        "funnel_key",
        ("customer_key", "product_key"),
        (
            "customer_key",
            "product_key",
            "first_view_date_key",
            "first_add_to_cart_date_key",
            "first_checkout_date_key",
            "first_purchase_date_key",
        ),
    ),
}


def keyed(rows: DataFrame, table: str) -> DataFrame:
    """Number a fact and keep its published columns."""
    fact = FACTS[table]
    return assign_surrogate_key(rows, fact.key, fact.business).select(fact.key, *fact.columns)


# ---------------------------------------------------------------- dimensions


def key_dimension(
    silver: Frames,
    table: str,
    existing: DataFrame | None = None,
    since: str | None = None,
    start_at: int | None = None,
) -> DataFrame:
    """A key dimension. With ``since``, what was processed up to then is in ``existing`` and is not read again."""
    spec = KEY_DIMENSIONS[table]
    fresh = {name: silver[name] for name, _ in spec.feeds}
    if existing is not None and since is not None:
        fresh = {
            name: processed_since(frame, since) if "silver_process_date" in frame.columns else frame
            for name, frame in fresh.items()
        }
    values = union_values(spec.value, *[(fresh[name], column) for name, column in spec.feeds])
    return static_dimension(values, spec.value, spec.key, existing, start_at)


def calendar_dates(silver: Frames) -> DataFrame:
    return union_values("full_date", *[(silver[name], column) for name, column in CALENDAR_FEEDS])


def dim_date(spark: SparkSession, silver: Frames) -> DataFrame:
    return calendar(spark, calendar_dates(silver), "full_date")


def customer_source(customers: DataFrame, process_date: str) -> DataFrame:
    """Customer attributes; the birth year counts back from the year of ``process_date``."""
    year = int(process_date[:4])
    return customers.where("customer_id IS NOT NULL").select(
        "customer_id",
        "name",
        "email",
        F.col("country").alias("country_name"),
        F.expr(f"CASE WHEN age BETWEEN 0 AND 150 THEN {year} - age END").alias("birth_year"),
        "signup_date",
        "marketing_opt_in",
    )


def product_source(products: DataFrame, dim_category: DataFrame) -> DataFrame:
    known = products.where("product_id IS NOT NULL")
    return attach_dimension_key(
        known, "category", dim_category, "category_name", "category_key", "category_key"
    ).select(
        "product_id",
        "category_key",
        F.col("name").alias("product_name"),
        F.col("price_usd").alias("base_price_usd"),
        "cost_usd",
    )


def dim_customers(
    customers: DataFrame,
    process_date: str,
    process_ts: str,
    existing: DataFrame | None = None,
    start_at: int | None = None,
) -> DataFrame:
    source = customer_source(customers, process_date)
    return scd2_dimension(source, "customer_id", "customer_key", CUSTOMER_ATTRIBUTES, process_ts, existing, start_at)


def dim_products(
    products: DataFrame,
    dim_category: DataFrame,
    process_ts: str,
    existing: DataFrame | None = None,
    start_at: int | None = None,
) -> DataFrame:
    source = product_source(products, dim_category)
    return scd2_dimension(source, "product_id", "product_key", PRODUCT_ATTRIBUTES, process_ts, existing, start_at)


# --------------------------------------------------------------------- facts


def _date_key(df: DataFrame, dims: Frames, column: str, out: str = "date_key") -> DataFrame:
    return attach_dimension_key(df, column, dims["dim_date"], "full_date", "date_key", out)


def _named_key(df: DataFrame, dims: Frames, table: str, column: str) -> DataFrame:
    spec = KEY_DIMENSIONS[table]
    return attach_dimension_key(df, column, dims[table], spec.value, spec.key, spec.key)


def order_costs(items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Cost of goods per order; an unknown cost counts as zero."""
    priced = attach_current(items, dim_products, "product_id", "cost_usd")
    cost = F.coalesce("cost_usd", F.lit(0.0)) * F.col("quantity")
    return priced.groupBy("order_id").agg(money_sum(cost).alias("order_cost_usd"))


def fact_order(orders: DataFrame, items: DataFrame, dims: Frames) -> DataFrame:
    rows = orders.join(order_costs(items, dims["dim_products"]), "order_id", "left")
    rows = attach_current(rows, dims["dim_customers"], "customer_id", "customer_key")
    rows = _date_key(rows, dims, "order_date")
    for table in ("dim_country", "dim_source", "dim_device", "dim_payment_method"):
        rows = _named_key(rows, dims, table, dict(KEY_DIMENSIONS[table].feeds)["orders"])
    return rows.withColumns(
        {
            "gross_revenue_usd": F.col("subtotal_usd"),
            "net_margin_usd": F.col("total_usd") - F.coalesce("order_cost_usd", F.lit(0.0)),
        }
    ).select(*FACTS["fact_order"].columns)


def fact_order_item(orders: DataFrame, items: DataFrame, dims: Frames) -> DataFrame:
    """Lines of valid orders. ``product_id`` rides along as part of the business key."""
    rows = items.join(orders.select("order_id", "customer_id", "order_date"), "order_id")
    rows = attach_current(rows, dims["dim_customers"], "customer_id", "customer_key")
    rows = attach_current(rows, dims["dim_products"], "product_id", "product_key", "cost_usd")
    cost = F.coalesce("cost_usd", F.lit(0.0)) * F.col("quantity")
    return (
        _date_key(rows, dims, "order_date")
        .withColumns(
            {
                "gross_revenue_usd": F.col("line_total_usd"),
                "gross_margin_usd": F.col("line_total_usd") - cost,
            }
        )
        .select(*FACTS["fact_order_item"].columns, "product_id")
    )


def fact_web_events(events: DataFrame, sessions: DataFrame, dims: Frames) -> DataFrame:
    """Events of valid sessions with the time to the session's next event.

    A session is kept or lost as a whole, so durations are taken before sessions are joined,
    and customers are resolved on the sessions, which are far fewer than the events, and reach them with the summary that
    carries durations across slots.
    """
    owners = attach_current(
        sessions.select("session_id", "customer_id"),
        dims["dim_customers"],
        "customer_id",
        "customer_key",
    )
    rows = events.select("event_id", "session_id", "product_id", "event_date", "event_type", "timestamp")
    rows = seconds_to_next(rows, "session_id", "timestamp", "event_id", "duration", owners.select("session_id", "customer_key"))
    rows = attach_current(rows, dims["dim_products"], "product_id", "product_key")
    return _date_key(rows, dims, "event_date").select(*FACTS["fact_web_events"].columns)


def fact_review(reviews: DataFrame, dims: Frames) -> DataFrame:
    rows = attach_current(reviews, dims["dim_products"], "product_id", "product_key")
    return rows.select(*FACTS["fact_review"].columns)


def fact_session(sessions: DataFrame, dims: Frames) -> DataFrame:
    rows = attach_current(sessions, dims["dim_customers"], "customer_id", "customer_key")
    rows = _date_key(rows, dims, "session_date")
    for table in ("dim_device", "dim_source", "dim_country"):
        rows = _named_key(rows, dims, table, dict(KEY_DIMENSIONS[table].feeds)["sessions"])
    return rows.withColumn("start_time", F.date_format("start_time", "HH:mm:ss")).select(
        *FACTS["fact_session"].columns
    )


# -------------------------------------------------------------------- funnel


def first_event_dates(events_with_customer: DataFrame, event_type: str, out: str) -> DataFrame:
    """First date of one kind of product event per customer and product."""
    hits = product_events(events_with_customer, event_type)
    return hits.groupBy("customer_id", "product_id").agg(F.min("event_date").alias(out))


def product_events(events: DataFrame, event_type: str) -> DataFrame:
    return events.where((F.col("event_type") == event_type) & F.col("product_id").isNotNull())


def cart_steps(events: DataFrame) -> DataFrame:
    """Per session and product: when it first lay in the cart, and the first checkout from then on."""
    carts = (
        product_events(events, "add_to_cart")
        .groupBy("session_id", "product_id")
        .agg(F.min("timestamp").alias("cart_ts"))
        .where("cart_ts IS NOT NULL")
    )
    checkouts = events.where("event_type = 'checkout'").select(
        "session_id", F.col("timestamp").alias("checkout_ts")
    )
    return first_at_or_after(carts, checkouts, "session_id", "cart_ts", "checkout_ts")


def funnel_checkout_dates(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """First date a product went through a checkout of the session whose cart already held it."""
    passed = cart_steps(events).where("checkout_ts IS NOT NULL")
    return (
        with_session_customer(passed, sessions)
        .groupBy("customer_id", "product_id")
        .agg(F.min(F.to_date("checkout_ts")).alias("first_checkout_date"))
    )


def purchase_moments(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Distinct (session, customer, time) of purchases."""
    bought = events.where("event_type = 'purchase'").select("session_id", "timestamp").distinct()
    return with_session_customer(bought, sessions)


def session_order_map(events: DataFrame, sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """Sessions and the orders placed by their customer at the very time of a purchase event."""
    placed = orders.select(
        "order_id", "customer_id", F.col("order_time").alias("timestamp"), "order_date"
    )
    pairs = purchase_moments(events, sessions).join(placed, ["customer_id", "timestamp"])
    return pairs.select("session_id", "customer_id", "order_id", "order_date").distinct()


def funnel_purchase_dates(
    events: DataFrame, sessions: DataFrame, orders: DataFrame, items: DataFrame
) -> DataFrame:
    """First purchase date per customer and product.

    Which session bought is of no account here, so orders are only tested for a purchase
    event (semi join) and no session-order pairs are formed.
    """
    moments = purchase_moments(events, sessions).select(
        "customer_id", F.col("timestamp").alias("order_time")
    )
    bought = orders.join(moments, ["customer_id", "order_time"], "left_semi")
    return (
        items.select("order_id", "product_id")
        .join(bought.select("order_id", "customer_id", "order_date"), "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.min("order_date").alias("first_purchase_date"))
    )


def funnel_visits(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Dates of the stages up to the checkout, in rows that are not merged yet."""
    views = product_events(events, "page_view").select(
        "session_id", "product_id", F.col("event_date").alias("first_view_date")
    )
    carts = cart_steps(events).select(
        "session_id",
        "product_id",
        F.to_date("cart_ts").alias("first_add_to_cart_date"),
        F.to_date("checkout_ts").alias("first_checkout_date"),
    )
    steps = views.unionByName(carts, allowMissingColumns=True)
    return with_session_customer(steps, sessions).drop("session_id")


def funnel_dates(events: DataFrame, sessions: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per customer and product seen in any stage, with the first date of each stage."""
    purchases = funnel_purchase_dates(events, sessions, orders, items)
    return earliest(funnel_visits(events, sessions).unionByName(purchases, allowMissingColumns=True))


# What the funnel keeps of events and of its own rows from run to run. Both merge: steps by union, dates by the smaller one.
FUNNEL_STEPS, FUNNEL_STATE = "funnel_steps", "funnel_state"
FUNNEL_DATES = ("first_view_date", "first_add_to_cart_date", "first_checkout_date", "first_purchase_date")


def funnel_steps(events: DataFrame) -> DataFrame:
    """All the funnel needs of events, by process date: the first view and cart of each session and product, the moments of its
    checkouts and purchases. ``funnel_dates`` takes steps for events; steps of the same events delivered again change nothing."""
    seen = events.where("event_type IN ('page_view', 'add_to_cart') AND product_id IS NOT NULL")
    first = seen.groupBy("silver_process_date", "session_id", "event_type", "product_id").agg(F.min("timestamp").alias("timestamp"))
    moments = events.where("event_type IN ('checkout', 'purchase')")
    moments = moments.select("silver_process_date", "session_id", "event_type", "timestamp").distinct()
    return first.unionByName(moments, allowMissingColumns=True).withColumn("event_date", F.to_date("timestamp"))


def touched_sessions(steps: DataFrame, sessions: DataFrame, since: str) -> DataFrame:
    fresh = processed_since(steps, since).select("session_id")
    return fresh.union(processed_since(sessions, since).select("session_id")).distinct()


def funnel_delta_visits(steps: DataFrame, sessions: DataFrame, since: str) -> DataFrame:
    """Dates up to the checkout of every session that rows processed after ``since`` touch."""
    touched = touched_sessions(steps, sessions, since)
    visits = funnel_visits(restrict_to(steps, touched, "session_id"), restrict_to(sessions, touched, "session_id"))
    return earliest(visits.withColumn("first_purchase_date", F.lit(None).cast("date")))


def concerned_orders(
    steps: DataFrame, sessions: DataFrame, orders: DataFrame, items: DataFrame, since: str
) -> DataFrame:
    """Ids of orders that rows processed after ``since`` touch: the orders, their lines, or sessions that bought at their time."""
    touched = touched_sessions(steps, sessions, since)
    visited = restrict_to(steps.where("event_type = 'purchase'"), touched, "session_id")
    bought = purchase_moments(visited, restrict_to(sessions, touched, "session_id"))
    bought = bought.select("customer_id", F.col("timestamp").alias("order_time"))
    late = processed_since(orders, since).select("order_id").union(processed_since(items, since).select("order_id"))
    return orders.join(bought, ["customer_id", "order_time"], "left_semi").select("order_id").union(late).distinct()


def funnel_delta_purchases(
    steps: DataFrame, sessions: DataFrame, orders: DataFrame, items: DataFrame, concerned: DataFrame
) -> DataFrame:
    """Purchase dates that the orders of ``concerned`` bring."""
    their_orders, their_items = restrict_to(orders, concerned, "order_id"), restrict_to(items, concerned, "order_id")
    return funnel_purchase_dates(steps.where("event_type = 'purchase'"), sessions, their_orders, their_items)


def funnel_delta(
    steps: DataFrame, sessions: DataFrame, orders: DataFrame, items: DataFrame, since: str
) -> DataFrame:
    """Funnel dates that rows processed after ``since`` may bring or make earlier: those of every session, and of every order, they touch."""
    concerned = concerned_orders(steps, sessions, orders, items, since)
    purchases = funnel_delta_purchases(steps, sessions, orders, items, concerned)
    return earliest(funnel_delta_visits(steps, sessions, since).unionByName(purchases, allowMissingColumns=True))


def earliest(dates: DataFrame) -> DataFrame:
    return dates.groupBy("customer_id", "product_id").agg(*[F.min(stage).alias(stage) for stage in FUNNEL_DATES])


def funnel_fact(dates: DataFrame, dims: Frames) -> DataFrame:
    """Funnel rows whose customer and product are both current members of their dimensions."""
    customers = current_versions(dims["dim_customers"]).select("customer_id", "customer_key")
    products = current_versions(dims["dim_products"]).select("product_id", "product_key")
    rows = dates.join(customers, "customer_id").join(products, "product_id")
    for stage in ("view", "add_to_cart", "checkout", "purchase"):
        rows = _date_key(rows, dims, f"first_{stage}_date", f"first_{stage}_date_key")
    return rows.select(*FACTS["fact_customer_funnel"].columns)


def fact_customer_funnel(
    events: DataFrame, sessions: DataFrame, orders: DataFrame, items: DataFrame, dims: Frames
) -> DataFrame:
    return funnel_fact(funnel_dates(events, sessions, orders, items), dims)


# --------------------------------------------------------- full and delta rows


def fact_rows(table: str, silver: Frames, dims: Frames) -> DataFrame:
    """All rows of a fact, unnumbered, from valid silver rows."""
    ok = {name: valid_rows(frame) for name, frame in silver.items() if name not in ("customers", "products")}
    if table == "fact_order":
        return fact_order(ok["orders"], ok["order_items"], dims)
    if table == "fact_order_item":
        return fact_order_item(ok["orders"], ok["order_items"], dims)
    if table == "fact_web_events":
        return fact_web_events(ok["events"], ok["sessions"], dims)
    if table == "fact_review":
        return fact_review(ok["reviews"], dims)
    if table == "fact_session":
        return fact_session(ok["sessions"], dims)
    if table == "fact_customer_funnel":
        return fact_customer_funnel(ok["events"], ok["sessions"], ok["orders"], ok["order_items"], dims)
    raise ValueError(f"not a fact: {table}")


def delta_rows(table: str, silver: Frames, since: str, dims: Frames) -> DataFrame:
    """Rows of a fact that silver rows processed after ``since`` bring or change."""
    source = FACTS[table].source
    if source is None:
        raise ValueError(f"{table} is always rebuilt whole")
    fresh = valid_rows(processed_since(silver[source], since))
    if table == "fact_order":
        return fact_order(fresh, restrict_to(valid_rows(silver["order_items"]), fresh, "order_id"), dims)
    if table == "fact_order_item":
        return fact_order_item(valid_rows(silver["orders"]), fresh, dims)
    if table == "fact_web_events":
        # Durations depend on neighbours: sessions with a new event are computed anew as a whole.
        touched = restrict_to(valid_rows(silver["events"]), fresh, "session_id")
        sessions = restrict_to(valid_rows(silver["sessions"]), fresh, "session_id")
        return fact_web_events(touched, sessions, dims)
    if table == "fact_review":
        return fact_review(fresh, dims)
    return fact_session(fresh, dims)


def processed_on(silver: DataFrame, process_date: str | None) -> DataFrame:
    """Rows of one process date; all rows if none is given or the frame does not track it."""
    if process_date is None or "silver_process_date" not in silver.columns:
        return silver
    return silver.where(F.col("silver_process_date") == process_date)


def processed_since(silver: DataFrame, watermark: str) -> DataFrame:
    """Rows processed strictly after ``watermark``; none if the frame does not track it."""
    if "silver_process_date" not in silver.columns:
        return silver.where(F.lit(False))
    return silver.where(F.col("silver_process_date") > watermark)
