"""Running layers against a table store."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dimensions import calendar
from tidemark.plans import gold
from tidemark.plans.bronze import LoadReport, observed, report_of, to_bronze
from tidemark.plans.silver import RECIPES, clean
from tidemark.plans.watermark import (
    PIPELINE_NAME,
    Watermark,
    latest_process_date,
    latest_process_dates,
)
from tidemark.sources.catalog import GOLD_TABLES
from tidemark.sources.landing import read_landing
from tidemark.sources.schemas import DATASETS
from tidemark.sources.tables import TableStore, jobs_for, shares

log = logging.getLogger(__name__)

WATERMARK_STEP = "update_watermark"
MODES = ("full", "incremental")
MONTH_COLUMN = "part_month"


@dataclass(frozen=True)
class Gate:
    """What a gold run has to do: ``full``, ``incremental`` since a date, or ``skip``."""

    action: str
    since: str | None = None


@dataclass
class Summary:
    """Outcome of a layer run per item: ok, skipped, or the error text."""

    done: dict[str, str] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)

    @property
    def succeeded(self) -> bool:
        return not self.failed

    def add(self, other: Summary) -> None:
        self.done.update(other.done)
        self.failed.update(other.failed)


# ------------------------------------------------------------------- bronze


def load_bronze(
    store: TableStore,
    dataset: str,
    landing_path: str,
    ingest_date: str,
    ingested_at: str,
    mode: str = "replace",
    **csv_options: str,
) -> LoadReport:
    landing = read_landing(store.spark, landing_path, dataset, with_source_file=True, **csv_options)
    return add_with_report(store, dataset, to_bronze(landing, dataset, ingest_date, ingested_at), mode, ingest_date)


def add_with_report(store: TableStore, dataset: str, rows: DataFrame, mode: str, ingest_date: str) -> LoadReport:
    """Store bronze rows; the job that writes them counts them."""
    rows, seen = observed(rows)
    store.add_bronze(dataset, rows, mode, ingest_date)
    return report_of(seen)


# ------------------------------------------------------------------- silver


def refine_silver(store: TableStore, dataset: str, process_date: str, processed_at: str) -> None:
    """Clean one delivery into silver; datasets with whole history are rebuilt from all deliveries."""
    whole = RECIPES[dataset].whole_history
    bronze = store.bronze(dataset, None if whole else process_date)
    rows = clean(bronze, dataset, process_date, processed_at)
    if whole:
        store.overwrite("silver", dataset, rows)
    else:
        keys = DATASETS[dataset].key
        store.upsert("silver", dataset, rows, keys, partition_by="silver_process_date", few_partitions=True)


def read_silver(store: TableStore) -> dict[str, DataFrame]:
    return {name: store.read("silver", name) for name in DATASETS}


def _silver(store: TableStore, feeds: tuple[tuple[str, str], ...]) -> dict[str, DataFrame]:
    return {name: store.read("silver", name) for name, _ in feeds}


# --------------------------------------------------------------------- gold


def check_gold_arguments(table: str, mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of: {', '.join(MODES)}")
    supported = (*GOLD_TABLES, WATERMARK_STEP)
    if table not in supported:
        raise ValueError(f"unknown table {table!r}; supported: {', '.join(sorted(supported))}")


def decide(mode: str, latest: str | None, mark: str | None) -> Gate:
    """The gate: nothing cleaned yet or nothing new skips, no mark yet builds in full."""
    if mode == "full":
        return Gate("full")
    if latest is None:
        return Gate("skip")
    if mark is None:
        return Gate("full")
    return Gate("incremental", mark) if latest > mark else Gate("skip")


def gate(store: TableStore, mode: str) -> Gate:
    """What a run over all datasets together has to do."""
    if mode == "full":
        return Gate("full")
    return decide(mode, _latest(store), Watermark(store).get())


def gates(store: TableStore, mode: str) -> dict[str, Gate]:
    """The gate of each dataset, with one mark per dataset."""
    if mode == "full":
        return {name: Gate("full") for name in DATASETS}
    latest, marks = _latest_by_dataset(store), Watermark(store).get_all()
    return {name: decide(mode, latest.get(name), marks.get(_mark_name(name))) for name in DATASETS}


def _mark_name(dataset: str) -> str:
    return f"{PIPELINE_NAME}.{dataset}"


def _present_silver(store: TableStore) -> dict[str, DataFrame]:
    frames = {name: store.read_if_exists("silver", name) for name in DATASETS}
    return {name: frame for name, frame in frames.items() if frame is not None}


def _latest(store: TableStore) -> str | None:
    silver = _present_silver(store)
    return latest_process_date(silver).first()[0] if silver else None


def _latest_by_dataset(store: TableStore) -> dict[str, str]:
    silver = _present_silver(store)
    return dict(latest_process_dates(silver).collect()) if silver else {}


def advance_watermark(store: TableStore, process_ts: str, per_dataset: bool = False) -> str | None:
    """Set the mark, and with ``per_dataset`` also that of every dataset, to the latest process date."""
    by_dataset = {name: day for name, day in _latest_by_dataset(store).items() if day is not None}
    if not by_dataset:
        return None
    latest = max(by_dataset.values())
    marks = {PIPELINE_NAME: latest}
    if per_dataset:
        marks |= {_mark_name(name): day for name, day in by_dataset.items()}
    Watermark(store).set(marks, process_ts)
    return latest


def _dims(store: TableStore) -> dict[str, DataFrame]:
    return {table: store.read("gold", table) for table in GOLD_TABLES if table.startswith("dim_")}


def _by_month(rows: DataFrame, table: str) -> tuple[DataFrame, str | None]:
    """Facts with a date key are stored by month, so that a merge rewrites the months it touches."""
    month_of = gold.FACTS[table].month_of
    if month_of is None:
        return rows, None
    month = F.coalesce(F.floor(F.col(month_of) / 100).cast("int"), F.lit(0))
    return rows.withColumn(MONTH_COLUMN, month), MONTH_COLUMN


def _largest(store: TableStore, table: str, key: str, existing: DataFrame | None) -> int | None:
    """The largest surrogate key of a stored dimension, from file footers."""
    return None if existing is None else store.bounds("gold", table, [key])[key][1] or 0


def calendar_bounds(store: TableStore) -> DataFrame:
    """The first and last date of each feed of the calendar, from file footers: two rows a feed, no scan of events."""
    days = []
    for dataset, column in gold.CALENDAR_FEEDS:
        days += store.bounds("silver", dataset, [column])[column]
    return store.spark.createDataFrame([(day,) for day in days], "full_date DATE")


def build_gold(
    store: TableStore,
    table: str,
    process_date: str,
    process_ts: str,
    mode: str = "incremental",
    plan: Gate | None = None,
) -> str:
    """Build or update one gold table; returns full, incremental or skip.

    ``plan`` is the gate's answer if the caller asked already; all tables of a run share it.
    """
    check_gold_arguments(table, mode)
    if table == WATERMARK_STEP:
        return "full" if advance_watermark(store, process_ts) else "skip"
    plan = plan or gate(store, mode)
    if plan.action == "skip":
        return "skip"
    existing = store.read_if_exists("gold", table)
    if table in gold.KEY_DIMENSIONS:
        silver = _silver(store, gold.KEY_DIMENSIONS[table].feeds)
        since = plan.since if plan.action == "incremental" else None
        start = _largest(store, table, gold.KEY_DIMENSIONS[table].key, existing)
        store.overwrite("gold", table, gold.key_dimension(silver, table, existing, since, start))
    elif table == "dim_date":
        store.overwrite("gold", table, calendar(store.spark, calendar_bounds(store), "full_date"))
    elif table == "dim_customers":
        customers = store.read("silver", "customers")
        start = _largest(store, table, "customer_key", existing)
        rows = gold.dim_customers(customers, process_date, process_ts, existing, start)
        store.overwrite("gold", table, rows)
    elif table == "dim_products":
        products, category = store.read("silver", "products"), store.read("gold", "dim_category")
        start = _largest(store, table, "product_key", existing)
        store.overwrite("gold", table, gold.dim_products(products, category, process_ts, existing, start))
    else:
        if table == "fact_customer_funnel":
            return _build_funnel(store, plan.since if plan.action == "incremental" and existing is not None else None)
        # A fact that is missing is built whole even when a watermark exists.
        in_full = plan.action == "full" or existing is None or gold.FACTS[table].source is None
        return _build_fact(store, table, None if in_full else plan.since)
    return "full"


def _build_fact(store: TableStore, table: str, since: str | None) -> str:
    fact, silver, dims = gold.FACTS[table], read_silver(store), _dims(store)
    hidden = [name for name in fact.business if name not in fact.columns]
    if since is None:
        # Rows are staged: the shuffles that made them are gone before those that number and deal them out begin.
        with store.staged("gold", table, gold.fact_rows(table, silver, dims)) as rows:
            rows = gold.assign_surrogate_key(rows, fact.key, fact.business)
            rows, by = _by_month(rows.select(fact.key, *fact.columns, *hidden), table)
            store.overwrite("gold", table, rows, by)
        return "full"
    parts = [silver]
    if table == "fact_web_events":
        # Its rows depend on their own session only, and are computed for one share of the sessions after another.
        parts = [{**silver, **kept} for kept in _by_sessions(store, {name: silver[name] for name in ("events", "sessions")})]
    rows = [_by_month(gold.delta_rows(table, part, since, dims), table) for part in parts]
    store.upsert("gold", table, [part for part, _ in rows], fact.business, fact.key, rows[0][1])
    return "incremental"


def _by_sessions(store: TableStore, frames: dict[str, DataFrame]) -> list[dict[str, DataFrame]]:
    """``frames`` cut into shares of the sessions, as many as events as stored take jobs."""
    cut = shares(F.xxhash64("session_id"), jobs_for(store.bytes_under(store.path("silver", "events"))))
    return [{name: frame.where(share) for name, frame in frames.items()} for share in cut]


def _build_funnel(store: TableStore, since: str | None) -> str:
    """The funnel from its kept steps and dates; an increment reads new events only and merges what they change.

    A corrected event keeps the dates its first version gave until the next full build.
    """
    silver = {name: store.read("silver", name) for name in ("events", "sessions", "orders", "order_items")}
    ok = {name: gold.valid_rows(frame) for name, frame in silver.items()}
    others = [ok[name] for name in ("sessions", "orders", "order_items")]
    known = store.read_if_exists("gold", gold.FUNNEL_STATE)
    in_full = since is None or known is None or not store.exists("gold", gold.FUNNEL_STEPS)
    few = store.has_few_partitions("silver", "events")
    if in_full:
        store.overwrite("gold", gold.FUNNEL_STEPS, gold.funnel_steps(ok["events"]), "silver_process_date", few)
        dates = gold.funnel_dates(store.read("gold", gold.FUNNEL_STEPS), *others)
    else:
        fresh = gold.funnel_steps(gold.processed_since(ok["events"], since))
        store.replace_partitions("gold", gold.FUNNEL_STEPS, fresh, "silver_process_date", few)
        # Each part is staged: the shuffles that made it are gone before those of the next begin.
        steps = store.read("gold", gold.FUNNEL_STEPS)
        parts = {
            "visits": lambda: [
                gold.funnel_delta_visits(part["steps"], part["sessions"], since)
                for part in _by_sessions(store, {"steps": steps, "sessions": ok["sessions"]})
            ],
            "orders": lambda: gold.concerned_orders(steps, *others, since),
            "purchases": lambda: gold.funnel_delta_purchases(steps, *others, made["orders"]),
        }
        made = {}
        with ExitStack() as stack:
            for part, rows in parts.items():
                made[part] = stack.enter_context(store.staged("gold", f"{gold.FUNNEL_STATE}-{part}", rows()))
            dates = known.unionByName(made["visits"]).unionByName(made["purchases"], allowMissingColumns=True)
            store.overwrite("gold", gold.FUNNEL_STATE, gold.earliest(dates))
    if in_full:
        store.overwrite("gold", gold.FUNNEL_STATE, dates)
    rows = gold.funnel_fact(store.read("gold", gold.FUNNEL_STATE), _dims(store))
    with store.staged("gold", "fact_customer_funnel", rows) as rows:
        store.overwrite("gold", "fact_customer_funnel", gold.keyed(rows, "fact_customer_funnel"))
    return "full" if in_full else "incremental"


# ------------------------------------------------------------------- layers

# Independent items of a layer run side by side from this many threads, so that small
# tables do not leave the cluster idle while a large one is being written.
SIDE_BY_SIDE = 6
#: Bytes a layer reads, as stored, above which its items run one after another: each fills the cluster by itself, and the shuffle
#: files of several would lie on disk at once.
LARGE = 256 * 2**20

# Gold tables in dependency order; those of one group do not read each other. Facts that take longest begin first.
GOLD_GROUPS = (
    ("dim_country", "dim_source", "dim_device", "dim_payment_method", "dim_date", "dim_category"),
    ("dim_customers", "dim_products"),
    (
        "fact_customer_funnel",
        "fact_web_events",
        "fact_order_item",
        "fact_order",
        "fact_session",
        "fact_review",
    ),
)


def abreast(size: int) -> int:
    """How many items of a layer that reads ``size`` bytes run side by side."""
    return SIDE_BY_SIDE if size <= LARGE else 1


def run_all(items: dict[str, Callable[[], object]], side_by_side: int = SIDE_BY_SIDE) -> Summary:
    """Run independent items; a failed item does not stop the rest."""

    def attempt(name: str) -> tuple[bool, str]:
        try:
            outcome = items[name]()
            return True, outcome if isinstance(outcome, str) else "ok"
        except Exception as error:  # noqa: BLE001 - reported in the summary
            log.exception("%s failed", name)
            return False, f"{type(error).__name__}: {error}"

    summary = Summary()
    with ThreadPoolExecutor(max_workers=max(1, side_by_side)) as pool:
        for name, (succeeded, outcome) in zip(items, pool.map(attempt, items), strict=True):
            (summary.done if succeeded else summary.failed)[name] = outcome
    return summary


def run_bronze(
    store: TableStore,
    landing: dict[str, str],
    ingest_date: str,
    ingested_at: str,
    csv_options: dict[str, dict[str, str]] | None = None,
) -> Summary:
    """Load all declared datasets; ``landing`` maps a dataset to its CSV path."""

    def step(dataset: str) -> Callable[[], None]:
        options = (csv_options or {}).get(dataset, {})
        return lambda: load_bronze(
            store, dataset, landing[dataset], ingest_date, ingested_at, **options
        )

    return run_all({dataset: step(dataset) for dataset in DATASETS}, abreast(store.bytes_under(*landing.values())))


def run_silver(store: TableStore, process_date: str, processed_at: str) -> Summary:
    def step(dataset: str) -> Callable[[], None]:
        return lambda: refine_silver(store, dataset, process_date, processed_at)

    size = store.bytes_under(*[store.path("bronze", dataset) for dataset in DATASETS])
    return run_all({dataset: step(dataset) for dataset in DATASETS}, abreast(size))


def run_gold(
    store: TableStore,
    process_date: str,
    process_ts: str,
    mode: str = "incremental",
    per_dataset: bool = False,
) -> Summary:
    """Build all gold tables in dependency order, then move the watermark if all succeeded.

    With ``per_dataset`` each incremental fact follows the mark of its own source, so a dataset
    that arrives late with an older date is still picked up.
    """
    marks = gates(store, mode) if per_dataset else {}
    overall = gate(store, mode)
    if any(plan.action != "skip" for plan in marks.values()) and overall.action == "skip":
        overall = Gate("incremental", Watermark(store).get())

    def step(table: str) -> Callable[[], str]:
        source = gold.FACTS[table].source if table in gold.FACTS else None
        plan = marks.get(source, overall)
        if per_dataset and source is None and plan.action == "incremental" and table != "fact_customer_funnel":
            # a late dataset may bring values dated before the overall mark: look at all of them
            plan = Gate("incremental", "")
        elif per_dataset and table == "fact_customer_funnel" and plan.action == "incremental":
            plan = Gate("full")
        return lambda: build_gold(store, table, process_date, process_ts, mode, plan)

    summary = Summary()
    at_once = abreast(store.bytes_under(*[store.path("silver", dataset) for dataset in DATASETS]))
    for group in GOLD_GROUPS:
        summary.add(run_all({table: step(table) for table in group}, at_once))
    if summary.succeeded:
        moved = lambda: advance_watermark(store, process_ts, per_dataset) or "skip"
        summary.add(run_all({WATERMARK_STEP: moved}))
    return summary


def run_layer(
    store: TableStore,
    layer: str,
    process_date: str,
    process_ts: str,
    *,
    landing: dict[str, str] | None = None,
    csv_options: dict[str, dict[str, str]] | None = None,
    mode: str = "incremental",
    per_dataset: bool = False,
) -> Summary:
    """Run one layer by name; bronze needs ``landing`` paths and takes CSV options by dataset."""
    if layer == "bronze":
        return run_bronze(store, landing or {}, process_date, process_ts, csv_options)
    if layer == "silver":
        return run_silver(store, process_date, process_ts)
    if layer == "gold":
        return run_gold(store, process_date, process_ts, mode, per_dataset)
    raise ValueError("layer must be one of: bronze, gold, silver")
