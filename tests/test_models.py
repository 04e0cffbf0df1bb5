"""Business logic on small hand-made relations."""

from collections import defaultdict
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlane import contracts
from marketlane.functions.frames import number_within_key, upsert
from marketlane.operators import cards, dimensions, facts, intermediate, marts
from marketlane.settings import Settings

SETTINGS = Settings(now=datetime(2020, 1, 1, tzinfo=UTC))
BOUGHT = datetime(2017, 3, 1, 12)


@pytest.fixture(scope="module")
def orders(spark):
    """Orders late by the boundary days, and the odd cases."""
    due = datetime(2017, 3, 10)
    rows = [
        (f"late{n}", f"c{n}", "delivered", BOUGHT, due + timedelta(days=n, hours=20), due)
        for n in (0, 1, 3, 4, 7, 8, 14, 15)
    ]
    rows += [
        ("no_time", "x1", "delivered", BOUGHT, None, due),
        ("no_due", "x2", "delivered", BOUGHT, due, None),
        ("no_status", "x3", None, BOUGHT, due, due),
        ("cancelled", "x4", "canceled", BOUGHT, due + timedelta(days=9), due),
        ("shipped", "x5", "shipped", BOUGHT, None, due),
    ]
    return spark.createDataFrame(
        rows,
        "order_id string, customer_id string, order_status string, order_purchased_at_utc timestamp, "
        "order_delivered_to_customer_at_utc timestamp, order_estimated_delivery_at_utc timestamp",
    ).withColumns(
        {
            "order_approved_at_utc": F.lit(None).cast("timestamp"),
            "order_delivered_to_carrier_at_utc": F.lit(None).cast("timestamp"),
        }
    )


@pytest.fixture(scope="module")
def calendar(spark, orders):
    reviews = spark.createDataFrame([], "review_created_at_utc timestamp")
    holidays = spark.createDataFrame(
        [
            (date(2017, 3, 1), "BR", "Second"),
            (date(2017, 3, 1), "BR", "First"),
            (date(2017, 3, 2), "US", "Elsewhere"),
        ],
        "holiday_date date, country_code string, holiday_name string",
    )
    return dimensions.dim_date(orders, reviews, holidays, SETTINGS)


@pytest.fixture(scope="module")
def delivery(spark, orders, calendar):
    weather = spark.createDataFrame(
        [
            (date(2017, 3, 10), "sao_paulo", 30.0, 20.0, 0.0, 60.0),
            (date(2017, 3, 10), "elsewhere", 1.0, 1.0, 1.0, 1.0),
        ],
        "weather_date date, location_key string, temperature_max double, temperature_min double, "
        "precipitation_total double, humidity_afternoon double",
    )
    return intermediate.int_order_delivery(orders, calendar, weather, SETTINGS)


def test_calendar(calendar):
    rows = {r["calendar_date"]: r for r in calendar.collect()}
    assert min(rows) == date(2017, 3, 1) and max(rows) == date(2017, 3, 25)
    first = rows[date(2017, 3, 1)]
    assert first["is_holiday"] and first["holiday_name"] == "First,Second"
    assert not rows[date(2017, 3, 2)]["is_holiday"]
    sunday = rows[date(2017, 3, 5)]
    assert (sunday["day_of_week"], sunday["day_name"], sunday["is_weekend"]) == (1, "Sunday", True)
    assert sunday["iso_week"] == 9 and sunday["month_name"] == "March"
    assert sunday["first_day_of_quarter"] == date(2017, 1, 1)
    assert sunday["last_day_of_month"] == date(2017, 3, 31)


def test_calendar_without_data_is_today(spark):
    none = spark.createDataFrame(
        [],
        "order_purchased_at_utc timestamp, order_delivered_to_customer_at_utc timestamp, "
        "order_estimated_delivery_at_utc timestamp",
    )
    reviews = spark.createDataFrame([], "review_created_at_utc timestamp")
    holidays = spark.createDataFrame([], "holiday_date date, country_code string, holiday_name string")
    days = dimensions.dim_date(none, reviews, holidays, SETTINGS).collect()
    assert [r["calendar_date"] for r in days] == [date(2020, 1, 1)]


def test_delivery_flags(delivery):
    rows = {r["order_id"]: r for r in delivery.collect()}
    for days in (1, 3, 4, 7, 8, 14, 15):
        row = rows[f"late{days}"]
        assert (row["is_delivered"], row["is_late"], row["late_days"]) == (True, True, days)
    same_day = rows["late0"]
    assert (same_day["is_late"], same_day["late_days"]) == (False, None)
    assert same_day["delivery_temperature_max"] == 30.0
    assert same_day["delivery_weather_location_key"] == "sao_paulo"
    assert (rows["no_time"]["is_delivered"], rows["no_time"]["is_late"]) == (False, False)
    assert (rows["no_due"]["is_delivered"], rows["no_due"]["is_late"]) == (True, False)
    assert rows["no_status"]["is_delivered"] is None and rows["no_status"]["is_cancelled"] is None
    assert rows["cancelled"]["is_cancelled"] and not rows["cancelled"]["is_late"]
    assert all(r["is_purchase_on_holiday"] for r in rows.values())


def test_order_value_keeps_orders_without_children(spark, orders):
    items = spark.createDataFrame(
        [("late0", Decimal("1.50"), Decimal("0.25")), ("late0", Decimal("2"), None)],
        "order_id string, item_price decimal(28,9), freight_value decimal(28,9)",
    )
    payments = spark.createDataFrame(
        [("late0", "voucher", Decimal("1")), ("late0", "boleto", Decimal("2")), ("late1", None, None)],
        "order_id string, payment_type string, payment_value decimal(28,9)",
    )
    rows = {r["order_id"]: r for r in intermediate.int_order_value(orders, items, payments).collect()}
    assert len(rows) == 13
    full, bare = rows["late0"], rows["shipped"]
    assert (full["order_item_value"], full["order_items_count"]) == (Decimal("3.500000000"), 2)
    assert (full["order_freight_total"], full["payment_methods_count"]) == (Decimal("0.250000000"), 2)
    assert (bare["order_item_value"], bare["order_items_count"]) == (0, 0)
    assert bare["order_payment_total"] is None and bare["payment_methods_count"] is None
    assert rows["late1"]["payment_methods_count"] == 0


@pytest.mark.parametrize("unit", ["minute", "day", "year"])
def test_numbering_agrees_with_brute_force_whatever_is_hot(spark, unit):
    """One customer holds half of all rows; ties, a NULL customer and NULL times included."""
    rows = []
    for n in range(400):
        person = "hot" if n % 2 else None if n % 6 == 0 else f"p{n % 37}"
        stamp = None if n % 41 == 0 else datetime(2017, 1, 1 + (n * 7) % 20, n % 3)
        rows.append((f"o{n:03d}", person, stamp))
    frame = spark.createDataFrame(rows, "order_id string, person string, at timestamp").repartition(5)
    numbered = number_within_key(frame, "person", "at", ["order_id"], "number", unit=unit)
    expected = defaultdict(list)
    for order, person, stamp in rows:
        expected[person].append((stamp is not None, stamp or datetime.min, order))
    wanted = {
        order: place
        for entries in expected.values()
        for place, (_, _, order) in enumerate(sorted(entries), start=1)
    }
    assert {r["order_id"]: r["number"] for r in numbered.collect()} == wanted
    assert sorted(numbered.columns) == ["at", "number", "order_id", "person"]


def test_review_context(spark, delivery):
    reviews = spark.createDataFrame(
        [
            ("r1", "late4", 2, None, datetime(2017, 3, 12)),
            ("r2", "late4", 5, "  \t", datetime(2017, 3, 20)),
            ("r3", "unknown", 1, "text", datetime(2017, 3, 20)),
        ],
        "review_id string, order_id string, review_score bigint, review_comment_message string, "
        "review_created_at_utc timestamp",
    ).withColumns(
        {
            "review_comment_title": F.lit(None).cast("string"),
            "review_answered_at_utc": F.lit(None).cast("timestamp"),
        }
    )
    items = spark.createDataFrame(
        [("late4", Decimal("5"), "b"), ("late4", Decimal("5"), "a"), ("late4", Decimal("1"), "c")],
        "order_id string, item_price decimal(28,9), product_id string",
    )
    products = spark.createDataFrame(
        [("a", "toys"), ("b", "books")], "product_id string, product_category_name string"
    )
    enriched = intermediate.int_review_enriched(reviews, delivery, items, products)
    rows = {r["review_id"]: r for r in enriched.collect()}
    assert rows["r1"]["primary_product_category"] == "toys"
    assert rows["r1"]["time_to_review_days"] == -2
    assert not rows["r1"]["has_comment"] and not rows["r2"]["has_comment"]
    assert rows["r3"]["has_comment"] and rows["r3"]["time_to_review_days"] is None
    assert rows["r3"]["is_delivered"] is False
    assert rows["r3"]["delivery_delay_bucket"] == "not_delivered"
    assert rows["r1"]["delivery_delay_bucket"] == "4_to_7_days"


def test_seller_days_and_single_seller_orders(spark, delivery):
    items = spark.createDataFrame(
        [
            ("late1", "s1", Decimal("10"), Decimal("1")),
            ("late1", "s1", Decimal("10"), Decimal("1")),
            ("late1", "s2", Decimal("5"), Decimal("1")),
            ("cancelled", "s1", Decimal("7"), Decimal("1")),
            ("late0", "s1", Decimal("3"), Decimal("1")),
            ("nowhere", "s1", Decimal("3"), Decimal("1")),
        ],
        "order_id string, seller_id string, item_price decimal(28,9), freight_value decimal(28,9)",
    )
    days = intermediate.int_seller_daily_performance(items, delivery)
    rows = {r["seller_id"]: r for r in marts.mart_seller_performance(days).collect()}
    s1 = rows["s1"]
    assert (s1["orders_count"], s1["items_count"], s1["gmv"]) == (3, 4, Decimal("26.000000000"))
    assert (s1["cancelled_orders_count"], s1["late_orders_count"]) == (1, 1)
    assert s1["operational_defect_orders_count"] == 2
    assert s1["aov"] == Decimal("13.000000000")
    assert rows["s2"]["operational_defect_rate"] == 1.0

    metrics = spark.createDataFrame(
        [("cancelled", 1, 0, 2.0, None)],
        "order_id string, reviews_count bigint, commented_reviews_count bigint, "
        "avg_review_score_for_order double, avg_time_to_review_days_for_order double",
    )
    single = intermediate.int_seller_attributable_experience(items, delivery, metrics, SETTINGS)
    flags = {r["order_id"]: (r["is_reviewed_order"], r["is_low_review_order"]) for r in single.collect()}
    assert flags == {"cancelled": (True, True), "late0": (False, False)}
    (row,) = marts.mart_seller_experience(single).collect()
    assert row["review_coverage_rate"] == 0.5 and row["low_review_rate"] == 1.0


def test_upsert_replaces_adds_and_follows_the_new_columns(spark):
    existing = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, gone string")
    incoming = spark.createDataFrame([("b", 3, True), ("c", 4, False)], "k string, v int, added boolean")
    rows = upsert(existing, incoming, ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("a", 1, None), ("b", 3, True), ("c", 4, False)]


def test_replay_window(spark):
    stamps = [datetime(2017, 1, 1) + timedelta(days=n) for n in (0, 9, 10, 100)] + [None]
    frame = spark.createDataFrame([(s,) for s in stamps], "order_purchased_at_utc timestamp")
    known = frame.filter("order_purchased_at_utc IS NOT NULL")
    assert facts.replay_window(frame, known, SETTINGS).count() == 2
    assert facts.replay_window(frame, frame.limit(0), SETTINGS).count() == 4


def test_mart_contract_is_enforced(spark):
    schema = contracts.mart_schema("mart_customer_experience")
    good = spark.createDataFrame([], schema)
    assert contracts.enforce(good, "mart_customer_experience") is good
    with pytest.raises(contracts.ContractError, match="missing orders_count"):
        contracts.enforce(good.drop("orders_count"), "mart_customer_experience")
    wrong = good.withColumn("orders_count", F.col("orders_count").cast("int"))
    with pytest.raises(contracts.ContractError, match="orders_count is int"):
        contracts.enforce(wrong, "mart_customer_experience")
    assert {name: len(contracts.mart_schema(name)) for name in contracts.MART_COLUMNS} == {
        "mart_exec_daily": 25,
        "mart_seller_performance": 16,
        "mart_seller_experience": 11,
        "mart_fulfillment_ops": 25,
        "mart_customer_experience": 9,
    }


def test_card_filters_and_labels(spark):
    mart = spark.createDataFrame(
        [
            ("s1234567890", date(2020, 1, 1), Decimal("10"), 6, 6, 1),
            ("s1234567890", date(2020, 2, 1), Decimal("5"), 1, 1, 0),
            ("small", date(2020, 1, 1), Decimal("900"), 1, 1, 1),
        ],
        "seller_id string, calendar_date date, gmv decimal(38,9), orders_count bigint, "
        "non_cancelled_orders_count bigint, cancelled_orders_count bigint",
    )
    sellers = spark.createDataFrame(
        [("s1234567890", "town", "SP"), ("small", None, "RJ")],
        "seller_id string, seller_city string, seller_state string",
    )
    top = cards.seller_top_gmv(mart, sellers).collect()
    assert [r["seller_label"] for r in top] == ["small...", "town, SP (s1234567...)"]
    aov = cards.seller_top_aov(mart, sellers).collect()
    assert [r["seller_id"] for r in aov] == ["s1234567890", "small"]
    january = cards.seller_top_gmv(mart, sellers, date_range=("2020-01-01", "2020-01-31"))
    assert {r["gmv"] for r in january.collect()} == {Decimal("10"), Decimal("900")}
    assert cards.seller_top_gmv(mart, sellers, seller_state="SP").count() == 1
    assert cards.seller_cancellation_ranking(mart, sellers, seller_id=["small"]).count() == 1


def test_fulfillment_filters(spark):
    mart = spark.createDataFrame(
        [
            (date(2020, 1, 6), "SP", "on_time", 4, 4, 0, 0, True),
            (date(2020, 1, 8), "SP", "1_to_3_days", 2, 2, 2, 0, False),
            (date(2020, 1, 13), "RJ", "not_delivered", 1, 0, 0, 1, None),
        ],
        "purchase_date date, customer_state string, delivery_delay_bucket string, orders_count bigint, "
        "delivered_orders_count bigint, late_orders_count bigint, cancelled_orders_count bigint, "
        "is_purchase_on_holiday boolean",
    )
    states = cards.fulfillment_delay_rate_by_state(mart).collect()
    assert [(r["customer_state"], r["late_delivery_rate_pct"]) for r in states] == [
        ("SP", 33.33),
        ("RJ", None),
    ]
    assert cards.fulfillment_delay_rate_by_state(mart, customer_state="RJ").count() == 1
    impact = cards.fulfillment_holiday_impact(mart).collect()
    assert [(r["holiday_cohort"], r["orders_count"]) for r in impact] == [
        ("Holiday", 4),
        ("Non-Holiday", 3),
    ]
    assert cards.fulfillment_holiday_impact(mart, holiday_flag=True).count() == 1
    mix = cards.fulfillment_delay_bucket_distribution(mart).collect()
    assert [(r["distribution_view"], r["delay_bucket"]) for r in mix] == [
        ("All Orders Mix", "On Time"),
        ("All Orders Mix", "1-3 Days Late"),
        ("All Orders Mix", "Not Delivered"),
        ("Late / Failed Mix", "1-3 Days Late"),
        ("Late / Failed Mix", "Not Delivered"),
    ]
    weeks = cards.fulfillment_cancelled_order_trend(mart, delivery_delay_bucket="not_delivered")
    assert [tuple(r) for r in weeks.collect()] == [(date(2020, 1, 13), 1)]
