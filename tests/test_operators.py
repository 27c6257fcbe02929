"""Operators against brute force, and the properties they promise."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from tidemark.operators import dedup, dimensions, keys, succession, upsert
from tidemark.plans.bronze import normalize_columns

START = datetime(2024, 1, 1)


# ------------------------------------------------------------------------ keys


def test_keys_are_unique_and_do_not_depend_on_partitioning(spark):
    rows = spark.range(20000).selectExpr("CAST(id AS INT) AS a", "CAST(id % 7 AS STRING) AS b")
    first = {tuple(r) for r in keys.assign_surrogate_key(rows, "k", ["a", "b"], 10).collect()}
    again = {tuple(r) for r in keys.assign_surrogate_key(rows.repartition(13), "k", ["a", "b"], 10).collect()}
    assert first == again
    assert len({k for k, _, _ in first}) == 20000
    assert min(k for k, _, _ in first) > 10


def test_keys_spread_rows_evenly(spark):
    """No slot collects a large share of the rows, whatever pattern the natural keys follow."""
    for step in (1, 65536, 1000000):
        rows = spark.range(0, 20000 * step, step).withColumn("slot", keys.key_slot(["id"]))
        assert rows.groupBy("slot").count().agg({"count": "max"}).first()[0] < 20


def test_null_parts_of_a_key_are_keys_too(spark):
    rows = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1)], "a INT, b INT")
    assert keys.assign_surrogate_key(rows, "k", ["a", "b"]).select("k").distinct().count() == 4


# ----------------------------------------------------------------------- dedup


def test_latest_per_key_against_brute_force(spark):
    rng = random.Random(1)
    # A third of the rows share one key.
    rows = [
        (0 if rng.random() < 0.33 else rng.randrange(1, 60), rng.choice([None, *range(5)]), rng.randrange(9))
        for _ in range(3000)
    ]
    frame = spark.createDataFrame(rows, "k INT, ts INT, v INT").repartition(7)
    got = {tuple(r) for r in dedup.latest_per_key(frame, ["k"], ["ts"]).collect()}
    best = {}
    for k, ts, v in rows:
        rank = (ts is not None, ts if ts is not None else 0, -v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, ts, v))
    assert got == {row for _, row in best.values()}


def test_latest_per_key_cuts_groups_before_the_exchange(spark):
    frame = spark.range(100).selectExpr("id % 3 AS k", "id AS ts")
    plan = dedup.latest_per_key(frame, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


# ------------------------------------------------------------------ succession


def random_events(seed, n=4000):
    """Sessions of very unequal length, ties in time, gaps across many slots."""
    rng = random.Random(seed)
    rows = []
    for event_id in range(n):
        session = 0 if rng.random() < 0.4 else rng.randrange(1, 40)
        ts = START + timedelta(seconds=rng.choice([rng.randrange(7200), rng.randrange(0, 900000, 600)]))
        ts += timedelta(milliseconds=rng.choice([0, 0, 250, 999]))
        rows.append((event_id, session, ts))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_seconds_to_next_against_brute_force(spark, seed):
    rows = random_events(seed)
    frame = spark.createDataFrame(rows, "event_id LONG, session_id LONG, timestamp TIMESTAMP")
    got = {
        r["event_id"]: r["d"]
        for r in succession.seconds_to_next(frame, "session_id", "timestamp", "event_id", "d").collect()
    }
    sessions = defaultdict(list)
    for event_id, session, ts in rows:
        sessions[session].append((ts, event_id))
    want = {}
    for events in sessions.values():
        events.sort()
        for (ts, event_id), following in zip(events, [*events[1:], None], strict=True):
            whole = lambda t: int((t - START).total_seconds())
            want[event_id] = float(whole(following[0]) - whole(ts)) if following else 0.0
    assert got == want


@pytest.mark.parametrize("seed", [4, 5])
def test_first_at_or_after_against_brute_force(spark, seed):
    points = [(s, i, ts) for i, s, ts in random_events(seed, 1500)]
    marks = [(s, ts) for _, s, ts in random_events(seed, 300)] + [(s, ts) for s, i, ts in points if i % 50 == 0]
    got = {
        (r["i"], r["mark_ts"])
        for r in succession.first_at_or_after(
            spark.createDataFrame(points, "s LONG, i LONG, point_ts TIMESTAMP"),
            spark.createDataFrame(marks, "s LONG, mark_ts TIMESTAMP"),
            "s",
            "point_ts",
            "mark_ts",
        ).collect()
    }
    assert got == {(i, min((m for g, m in marks if g == s and m >= ts), default=None)) for s, i, ts in points}


# ---------------------------------------------------------------------- merges


def test_merge_is_idempotent_and_null_keys_never_match(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k INT, v STRING")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k INT, v STRING")
    once = upsert.merge_rows(target, source, ["k"])
    twice = upsert.merge_rows(once, source, ["k"])
    want = [(1, "a"), (2, "B"), (3, "C"), (None, "c")]
    for frame in (once, twice):
        assert sorted(map(tuple, frame.collect()), key=str) == sorted(want, key=str)
    with_null = spark.createDataFrame([(None, "again")], "k INT, v STRING")
    assert upsert.merge_rows(target, with_null, ["k"]).where("k IS NULL").count() == 2


def test_merge_keeps_columns_only_the_target_has(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k INT, v STRING, old INT")
    source = spark.createDataFrame([(2, "B", True), (3, "C", True)], "k INT, v STRING, new BOOLEAN")
    got = sorted(map(tuple, upsert.merge_rows(target, source, ["k"]).collect()))
    assert got == [(1, "a", 10, None), (2, "B", 20, True), (3, "C", None, True)]


def test_ambiguous_keys_are_found_only_where_they_match(spark):
    target = spark.createDataFrame([(1,), (2,)], "k INT")
    source = spark.createDataFrame([(1,), (1,), (5,), (5,), (2,), (None,), (None,)], "k INT")
    assert [r[0] for r in upsert.ambiguous_keys(target, source, ["k"]).collect()] == [1]


def test_merge_keeps_surrogates(spark):
    target = keys.assign_surrogate_key(spark.range(100).selectExpr("id AS k", "0 AS v"), "s", ["k"])
    incoming = spark.range(50, 150).selectExpr("id AS k", "1 AS v")
    merged = upsert.merge_keep_surrogate(target, incoming, ["k"], "s").collect()
    before = {r["k"]: r["s"] for r in target.collect()}
    assert {r["k"]: r["s"] for r in merged if r["k"] < 100} == before
    fresh = [r["s"] for r in merged if r["k"] >= 100]
    assert len(merged) == 150 and len(set(fresh)) == 50 and min(fresh) > max(before.values())


# ------------------------------------------------------------------ dimensions


def test_static_dimension_keeps_keys_and_never_deletes(spark):
    first = dimensions.static_dimension(
        spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "x STRING"), "x", "x_key"
    )
    before = {r["x"]: r["x_key"] for r in first.collect()}
    assert set(before) == {"a", "b"}
    values = spark.createDataFrame([("b",), ("c",)], "x STRING")
    rows = dimensions.static_dimension(values, "x", "x_key", first).collect()
    after = {r["x"]: r["x_key"] for r in rows}
    assert len(rows) == 3 and {x: after[x] for x in before} == before
    assert after["c"] > max(before.values())


def test_scd2_history(spark):
    """Random changes over several runs: one open version per key, versions follow each other."""
    rng = random.Random(7)
    state, history, dimension = {}, defaultdict(list), None
    for run in range(4):
        for _ in range(40):
            state[rng.randrange(60)] = (rng.choice(["x", "y", None]), rng.choice([1, 2, None]))
        stamp = f"2024-01-0{run + 1} 00:00:00"
        for k, attributes in state.items():
            if not history[k] or history[k][-1] != attributes:
                history[k].append(attributes)
        source = spark.createDataFrame([(k, *v) for k, v in state.items()], "k INT, a STRING, b INT")
        built = dimensions.scd2_dimension(source, "k", "sk", ["a", "b"], stamp, dimension)
        dimension = spark.createDataFrame(built.collect(), built.schema)
    versions = defaultdict(list)
    for row in dimension.collect():
        versions[row["k"]].append(row)
    assert len({r["sk"] for rows in versions.values() for r in rows}) == dimension.count()
    for k, rows in versions.items():
        rows.sort(key=lambda r: r["effective_from"])
        assert [(r["a"], r["b"]) for r in rows] == history[k]
        assert [r["is_current"] for r in rows] == [False] * (len(rows) - 1) + [True]
        assert rows[-1]["effective_to"] is None
        for older, newer in zip(rows, rows[1:], strict=False):
            assert older["effective_to"] == newer["effective_from"]


def test_scd2_keys_missing_from_the_source_stay_current(spark):
    first = dimensions.scd2_dimension(
        spark.createDataFrame([(1, "a"), (2, "b")], "k INT, a STRING"), "k", "sk", ["a"], "2024-01-01 00:00:00"
    )
    second = dimensions.scd2_dimension(
        spark.createDataFrame([(1, "a")], "k INT, a STRING"), "k", "sk", ["a"], "2024-01-02 00:00:00", first
    )
    assert sorted(map(tuple, second.collect())) == sorted(map(tuple, first.collect()))


def test_calendar(spark):
    dates = spark.sql("SELECT explode(array(DATE'2024-02-27', DATE'2024-03-02', NULL)) AS d")
    rows = dimensions.calendar(spark, dates, "d").orderBy("date_key").collect()
    assert [r["date_key"] for r in rows] == [20240227, 20240228, 20240229, 20240301, 20240302]
    assert [r["is_weekend"] for r in rows] == [False] * 4 + [True]
    with pytest.raises(ValueError):
        dimensions.calendar(spark, dates.where("d IS NULL"), "d")


def test_column_names(spark):
    frame = spark.createDataFrame([(1, 2)], "`Order ID` INT, ` Total ` INT")
    assert normalize_columns(frame).columns == ["order_id", "total"]
    with pytest.raises(ValueError):
        normalize_columns(spark.createDataFrame([(1, 2)], "`a b` INT, `A B ` INT"))
