"""Each validation rule: a row that trips it, one that does not, one with a NULL operand."""

import pytest

from tidemark.plans.bronze import to_bronze
from tidemark.plans.silver import RECIPES, clean, with_validation
from tidemark.sources.schemas import DATASETS
from tidemark.suite import fixtures

DAY, STAMP = "2024-01-15", "2024-01-15 00:00:00"

GOOD = {
    "customers": (1, "Ann", "ann@shop.example", "NL", 30, "2023-05-01", "yes"),
    "orders": (1, 1, "2023-05-01 10:00:00", "card", 5.0, 100.0, 95.0, "NL", "mobile", "ads"),
    "order_items": (1, 1, 10.0, 2, 20.0),
    "events": (1, 1, "2023-05-01 10:00:00", "page_view", 7.0, None, None, None, None, None),
    "products": (1, "toys", "Top", 10.0, 4.0, 6.0),
    "reviews": (1, 1, 1, 5, "fine", "2023-05-01 10:00:00"),
    "sessions": (1, 1, "2023-05-01 10:00:00", "mobile", "ads", "NL"),
}

# code -> (changes that trip it, changes that leave its operand NULL, or None where NULL is the trip)
CASES = {
    "customers": {
        "NULL_CUSTOMER_ID": ({"customer_id": None}, None),
        "NULL_EMAIL": ({"email": "  "}, None),
        "NULL_SIGNUP_DATE": ({"signup_date": "soon"}, None),
        "INVALID_EMAIL_FORMAT": ({"email": "no at"}, {"email": None}),
        "NULL_AGE": ({"age": None}, None),
        "INVALID_AGE": ({"age": 151}, {"age": None}),
        "FUTURE_SIGNUP_DATE": ({"signup_date": "2024-01-16"}, {"signup_date": None}),
    },
    "orders": {
        "NULL_ORDER_ID": ({"order_id": None}, None),
        "NULL_CUSTOMER_ID": ({"customer_id": None}, None),
        "NULL_ORDER_TIME": ({"order_time": "later"}, None),
        "NULL_TOTAL": ({"total_usd": None}, None),
        "NEGATIVE_TOTAL": ({"total_usd": -0.01}, {"total_usd": None}),
        "SUBTOTAL_LESS_THAN_TOTAL": ({"subtotal_usd": 94.0}, {"subtotal_usd": None}),
        "INVALID_DISCOUNT": ({"discount_pct": 100.5}, {"discount_pct": None}),
    },
    "order_items": {
        "NULL_ORDER_ID": ({"order_id": None}, None),
        "NULL_PRODUCT_ID": ({"product_id": None}, None),
        "NULL_QUANTITY": ({"quantity": None}, None),
        "NULL_UNIT_PRICE": ({"unit_price_usd": None}, None),
        "NULL_LINE_TOTAL": ({"line_total_usd": None}, None),
        "INVALID_QUANTITY": ({"quantity": 0}, {"quantity": None}),
        "NEGATIVE_PRICE": ({"unit_price_usd": -1.0}, {"unit_price_usd": None}),
        "LINE_TOTAL_MISMATCH": ({"line_total_usd": 20.02}, {"line_total_usd": None}),
    },
    "events": {
        "NULL_EVENT_ID": ({"event_id": None}, None),
        "NULL_SESSION_ID": ({"session_id": None}, None),
        "NULL_EVENT_TYPE": ({"event_type": " "}, None),
        "NULL_TIMESTAMP": ({"timestamp": "x"}, None),
        "ADD_TO_CART_MISSING_QTY": ({"event_type": "add_to_cart"}, {"event_type": None}),
        "CHECKOUT_MISSING_CART_SIZE": ({"event_type": "checkout"}, {"event_type": None}),
        "PURCHASE_MISSING_AMOUNT": ({"event_type": "purchase"}, {"event_type": None}),
        "PURCHASE_MISSING_PAYMENT": ({"event_type": "purchase", "payment": " "}, {"event_type": None}),
        "MISSING_PRODUCT_ID": ({"product_id": None}, {"product_id": None, "event_type": None}),
    },
    "products": {
        "NULL_PRODUCT_ID": ({"product_id": None}, None),
        "NULL_NAME": ({"name": ""}, None),
        "NULL_PRICE": ({"price_usd": None}, None),
        "NULL_COST": ({"cost_usd": None}, None),
        "NEGATIVE_PRICE": ({"price_usd": -1.0}, {"price_usd": None}),
        "NEGATIVE_COST": ({"cost_usd": -1.0}, {"cost_usd": None}),
        "COST_EXCEEDS_PRICE": ({"cost_usd": 11.0}, {"cost_usd": None}),
        "NEGATIVE_MARGIN": ({"margin_usd": -0.5}, {"margin_usd": None}),
        "MARGIN_MISMATCH": ({"margin_usd": 6.02}, {"margin_usd": None}),
    },
    "reviews": {
        "NULL_REVIEW_ID": ({"review_id": None}, None),
        "NULL_ORDER_ID": ({"order_id": None}, None),
        "NULL_PRODUCT_ID": ({"product_id": None}, None),
        "NULL_REVIEW_TIME": ({"review_time": None}, None),
        "NULL_RATING": ({"rating": None}, None),
        "INVALID_RATING": ({"rating": 6}, {"rating": None}),
    },
    "sessions": {
        "NULL_SESSION_ID": ({"session_id": None}, None),
        "NULL_CUSTOMER_ID": ({"customer_id": None}, None),
        "NULL_START_TIME": ({"start_time": "never"}, None),
        "FUTURE_SESSION": ({"start_time": "2024-01-16 00:00:00"}, {"start_time": None}),
    },
}


def typed(spark, dataset, rows):
    """Parsed but not filtered or deduplicated rows, so that NULL keys reach the rules."""
    from pyspark.sql import functions as F

    from tidemark.functions.expressions import blank_to_null

    recipe = RECIPES[dataset]
    frame = spark.createDataFrame(rows, DATASETS[dataset].schema)
    frame = frame.withColumns({name: F.expr(text) for name, text in recipe.parse.items()})
    return blank_to_null(frame, recipe.trim)


@pytest.mark.parametrize("dataset", list(CASES))
def test_rules(spark, dataset):
    assert list(CASES[dataset]) == list(RECIPES[dataset].rules)
    columns = DATASETS[dataset].columns
    good = dict(zip(columns, GOOD[dataset], strict=True))
    rows, expected = [tuple(good.values())], [("good", None)]
    for code, (trip, null_operand) in CASES[dataset].items():
        rows.append(tuple({**good, **trip}.values()))
        expected.append((code, True))
        if null_operand is not None:
            rows.append(tuple({**good, **null_operand}.values()))
            expected.append((code, False))
    # One row at a time: frames keep their order only within a single partition.
    frame = typed(spark, dataset, rows).coalesce(1)
    got = [row[0] for row in with_validation(frame, dataset, DAY).select("validation_errors").collect()]
    assert got[0] is None
    for (code, trips), errors in zip(expected[1:], got[1:], strict=True):
        assert (code in (errors or "").split(",")) is trips, (code, trips, errors)


def test_codes_are_joined_in_order(spark):
    row = {**dict(zip(DATASETS["products"].columns, GOOD["products"], strict=True)), "name": "", "price_usd": None}
    frame = typed(spark, "products", [tuple(row.values())])
    assert with_validation(frame, "products", DAY).first()["validation_errors"] == "NULL_NAME,NULL_PRICE"


def test_process_date_must_be_a_date(spark):
    with pytest.raises(ValueError):
        with_validation(typed(spark, "products", [GOOD["products"]]), "products", "x' OR true")


def test_labels(spark):
    base = dict(zip(DATASETS["customers"].columns, GOOD["customers"], strict=True))
    ages = [None, -1, 0, 17, 18, 25, 26, 35, 36, 50, 51, 65, 66, 151]
    rows = [tuple({**base, "customer_id": i, "age": age}.values()) for i, age in enumerate(ages)]
    frame = clean(
        to_bronze(spark.createDataFrame(rows, DATASETS["customers"].schema), "customers", DAY, STAMP),
        "customers",
        DAY,
        STAMP,
    )
    got = [r["age_group"] for r in frame.orderBy("customer_id").collect()]
    assert got == [None, None, "under_18", "under_18", "18-25", "18-25", "26-35", "26-35", "36-50", "36-50",
                   "51-65", "51-65", "over_65", "over_65"]


def test_unusable_records_stay_in_bronze_and_leave_silver(spark):
    rows = [GOOD["sessions"], (None, 1, "2023-05-01 10:00:00", "m", "a", "NL")]
    bronze = to_bronze(spark.createDataFrame(rows, DATASETS["sessions"].schema), "sessions", DAY, STAMP)
    assert bronze.count() == 2
    assert [r["dq_error"] for r in bronze.where("session_id IS NULL").collect()] == ["NULL_RECORD_ID"]
    assert clean(bronze, "sessions", DAY, STAMP).count() == 1


def test_composite_record_id_skips_null_parts(spark):
    rows = [(1, None, 1.0, 1, 1.0), (None, None, 1.0, 1, 1.0), (1, 2, 1.0, 1, 1.0)]
    bronze = to_bronze(spark.createDataFrame(rows, DATASETS["order_items"].schema), "order_items", DAY, STAMP)
    got = {(r["record_id"], r["dq_error"]) for r in bronze.collect()}
    assert got == {("1", None), ("", "EMPTY_RECORD_ID"), ("1_2", None)}


def test_unknown_dataset_has_no_identity(spark):
    bronze = to_bronze(spark.createDataFrame([(1,)], "a INT"), "other", DAY, STAMP)
    row = bronze.first()
    assert (row["record_id"], row["record_id_source"], row["dq_error"]) == (None, "NOT_FOUND", "NULL_RECORD_ID")


def test_event_and_session_ids_stay_unique_for_large_keys(spark):
    orders = "SELECT explode(array(1, 999999, 1000000, 1000001, 1000000000, 1000000001, 100000000000)) AS order_id"
    items = f"SELECT order_id, explode(array(3, 999999, 1000003, 1000000007)) AS product_id FROM ({orders})"
    days = (
        "SELECT user_id, explode(array(TIMESTAMP '2024-01-31', TIMESTAMP '2024-03-31')) AS ts"
        " FROM (SELECT explode(array(0L, 1L, 12L, 1000000L, 100000000L)) AS user_id)"
    )
    ids = spark.sql(
        f"SELECT {fixtures._ITEM_EVENT} + 1 AS id FROM ({items}) i UNION ALL SELECT {fixtures._ITEM_EVENT} + 2 FROM ({items}) i"
        f" UNION ALL SELECT order_id * 80000 + 3 FROM ({orders}) UNION ALL SELECT order_id * 80000 + 4 FROM ({orders})"
        " UNION ALL SELECT explode(array(0L, 8L, 80000L, 800000000000L))"
    )
    assert ids.count() == ids.distinct().count() == 7 * 4 * 2 + 7 * 2 + 4
    sessions = spark.sql(f"SELECT order_id * 2 AS id FROM ({orders}) UNION ALL SELECT {fixtures._DAY_SESSION} FROM ({days})")
    assert sessions.count() == sessions.distinct().count() == 7 + 5 * 2


def test_ids_above_32_bits_reach_silver(spark, tmp_path):
    path = str(tmp_path / "orders.csv")
    with open(path, "w") as out:
        out.write("order_id,customer_id,order_time,payment_method,discount_pct,subtotal_usd,total_usd,country,device,source\n")
        out.write("3000000000,3000000001,2024-01-02 03:04:05,card,0,10,10,US,web,direct\n")
    raw = spark.read.csv(path, header=True, schema=DATASETS["orders"].schema)
    rows = clean(to_bronze(raw, "orders", DAY, STAMP), "orders", DAY, STAMP).collect()
    assert [(r["order_id"], r["customer_id"]) for r in rows] == [(3000000000, 3000000001)]
