"""Named assertions over the built relations. Each returns the violating rows.

``w`` is anything that gives relations by name and carries ``settings`` and
``raw``: a Warehouse, or an Overlay of one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.functions import mismatch
from marketlane.functions.columns import (
    LATE_BANDS,
    NOT_DELIVERED,
    NUMERIC,
    ON_TIME,
    count_where,
    delay_bucket,
    money_or_zero,
    money_ratio,
    ratio,
)
from marketlane.operators.dimensions import PRODUCT_ATTRIBUTES, SELLER_ATTRIBUTES
from marketlane.operators.quality import reconcile
from marketlane.operators.snapshots import noop_versions

C = F.col
SLICE = ["purchase_date", "customer_state", "delivery_delay_bucket"]


def _any(tests: Sequence[Column]) -> Column:
    return reduce(Column.__or__, tests)


def _differs(left: Column, right: Column) -> Column:
    return ~left.eqNullSafe(right)


# --- Populations and keys ----------------------------------------------------


def experience_and_fulfillment_share_population(w) -> DataFrame:
    fulfillment = w["mart_fulfillment_ops"].select(*SLICE, "orders_count")
    experience = w["mart_customer_experience"].select(*SLICE, "orders_count")
    return (
        reconcile(
            fulfillment, experience, SLICE, w.settings, exact=["orders_count"], show=["orders_count"]
        )
        .withColumnRenamed("expected_orders_count", "fulfillment_orders_count")
        .withColumnRenamed("actual_orders_count", "customer_experience_orders_count")
    )


def customer_sequence_starts_at_one(w) -> DataFrame:
    number = C("customer_order_number")
    return (
        w["int_customer_order_sequence"]
        .groupBy("customer_unique_id")
        .agg(
            F.min(number).alias("first_customer_order_number"),
            F.max(number).alias("last_customer_order_number"),
            F.count(F.lit(1)).alias("customer_orders_count"),
            count_where(number == 1).alias("first_order_count"),
        )
        .filter(
            (C("first_customer_order_number") != 1)
            | (C("last_customer_order_number") != C("customer_orders_count"))
            | (C("first_order_count") != 1)
        )
    )


def calendar_covers_business_dates(w) -> DataFrame:
    orders, reviews = w["stg_orders"], w["stg_reviews"]
    stamps = F.array(
        "order_purchased_at_utc",
        "order_delivered_to_customer_at_utc",
        "order_estimated_delivery_at_utc",
    )
    order_days = orders.select(F.explode(F.array_compact(stamps)).alias("stamp")).select(
        F.to_date("stamp").alias("calendar_date")
    )
    review_days = reviews.select(F.to_date("review_created_at_utc").alias("calendar_date"))
    needed = order_days.unionByName(review_days).dropna().distinct()
    return needed.join(w["dim_date"].select("calendar_date"), "calendar_date", "left_anti")


def fact_orders_match_delivery(w) -> DataFrame:
    built, fact = w["int_order_delivery"].select("order_id"), w["fact_orders"].select("order_id")
    missing = built.join(fact, "order_id", "left_anti")
    extra = fact.join(built, "order_id", "left_anti")
    return missing.withColumn("mismatch_type", F.lit("missing_from_fact_orders")).unionByName(
        extra.withColumn("mismatch_type", F.lit("extra_in_fact_orders"))
    )


def order_value_preserves_orders(w) -> DataFrame:
    return (
        w["stg_orders"]
        .select("order_id")
        .join(w["int_order_value"].select("order_id"), "order_id", "left_anti")
    )


def exec_daily_covers_order_dates(w) -> DataFrame:
    bought = w["fact_orders"].select(C("purchase_date").alias("calendar_date")).distinct()
    return reconcile(bought, w["mart_exec_daily"].select("calendar_date"), ["calendar_date"], w.settings)


def raw_sources_nonempty(w) -> DataFrame:
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source_name"), "row_count"
        )
        for name, frame in sorted(w.raw.items())
    ]
    return reduce(DataFrame.unionByName, counts).filter("row_count = 0")


def weather_covers_delivery_dates(w) -> DataFrame:
    delivered = (
        w["stg_orders"]
        .filter("order_status = 'delivered' AND order_delivered_to_customer_at_utc IS NOT NULL")
        .select(F.to_date("order_delivered_to_customer_at_utc").alias("delivery_date"))
        .distinct()
    )
    observed = (
        w["stg_weather_daily"]
        .filter(C("location_key") == w.settings.weather_location.lower())
        .select(C("weather_date").alias("delivery_date"))
    )
    return delivered.join(observed, "delivery_date", "left_anti")


# --- Row logic ---------------------------------------------------------------


def delivered_means_status_and_timestamp(w) -> DataFrame:
    by_definition = (C("order_status") == "delivered") & C(
        "order_delivered_to_customer_at_utc"
    ).isNotNull()
    return (
        w["int_order_delivery"]
        .filter(C("is_delivered") != by_definition)
        .select("order_id", "order_status", "is_delivered", "order_delivered_to_customer_at_utc")
    )


def delivery_has_calendar_context(w) -> DataFrame:
    return (
        w["int_order_delivery"]
        .filter(C("purchase_date").isNotNull() & C("is_purchase_on_holiday").isNull())
        .select("order_id", "purchase_date")
    )


def late_orders_have_late_days(w) -> DataFrame:
    return (
        w["int_order_delivery"]
        .filter(C("is_late") & (C("late_days").isNull() | (C("late_days") < 1)))
        .select("order_id")
    )


def punctual_orders_have_no_late_days(w) -> DataFrame:
    return w["int_order_delivery"].filter(~C("is_late") & C("late_days").isNotNull()).select("order_id")


def review_bucket_purity(w) -> DataFrame:
    """The bucket must be the one the flags call for."""
    bucket, days = C("delivery_delay_bucket"), C("late_days")
    gone = C("is_cancelled") | ~C("is_delivered")
    late = C("is_delivered") & C("is_late")
    tests = [
        gone & (bucket != NOT_DELIVERED),
        ~gone & (bucket == NOT_DELIVERED),
        C("is_delivered") & ~C("is_late") & (bucket != ON_TIME),
    ]
    for first, last, name in LATE_BANDS:
        inside = days >= first if last is None else days.between(first, last)
        tests.append(late & inside & (bucket != name))
    return (
        w["int_review_enriched"]
        .filter(_any(tests))
        .select(
            "review_id",
            "order_id",
            "is_delivered",
            "is_late",
            "is_cancelled",
            "late_days",
            "delivery_delay_bucket",
        )
    )


def order_identity_matches_source(w) -> DataFrame:
    fields = {
        "customer_unique_id": "customer_unique_id",
        "zip_code_prefix": "customer_zip_code_prefix",
        "customer_city": "customer_city",
        "customer_state": "customer_state",
    }
    fact_names = {
        "customer_unique_id": "customer_unique_id",
        "zip_code_prefix": "customer_zip_code_prefix_at_order",
        "customer_city": "customer_city_at_order",
        "customer_state": "customer_state_at_order",
    }
    fact = w["fact_orders"].select(
        "order_id",
        C("customer_id").alias("fact_customer_id"),
        *[C(column).alias(f"fact_{name}") for name, column in fact_names.items()],
    )
    orders = w["stg_orders"].select(
        "order_id", C("customer_id").alias("source_customer_id"), F.lit(True).alias("_found")
    )
    customers = w["stg_customers"].select(
        C("customer_id").alias("source_customer_id"),
        *[C(column).alias(f"source_{name}") for name, column in fields.items()],
    )
    wrong = [C("_found").isNull(), C("fact_customer_id") != C("source_customer_id")]
    wrong += [_differs(C(f"fact_{name}"), C(f"source_{name}")) for name in fields]
    return (
        fact.join(orders, "order_id", "left")
        .join(customers, "source_customer_id", "left")
        .filter(_any(wrong))
        .select(
            "order_id",
            "fact_customer_id",
            "source_customer_id",
            *[f"{side}_{name}" for name in fields for side in ("fact", "source")],
        )
    )


def _holiday_alignment(frame: DataFrame, keys: list[str], w) -> DataFrame:
    days = w["dim_date"].select(
        C("calendar_date").alias("purchase_date"),
        "is_holiday",
        "holiday_name",
        F.lit(True).alias("_found"),
    )
    return (
        frame.select(*keys, "is_purchase_on_holiday", "holiday_name_at_purchase")
        .join(F.broadcast(days), "purchase_date", "left")
        .filter(
            C("_found").isNull()
            | (C("is_purchase_on_holiday") != C("is_holiday"))
            | _differs(C("holiday_name_at_purchase"), C("holiday_name"))
        )
        .drop("_found")
    )


def order_holidays_match_calendar(w) -> DataFrame:
    return _holiday_alignment(w["fact_orders"], ["order_id", "purchase_date"], w)


def fulfillment_holidays_match_calendar(w) -> DataFrame:
    return _holiday_alignment(w["mart_fulfillment_ops"], SLICE, w)


def attributable_orders_have_one_seller(w) -> DataFrame:
    sellers = (
        w["fact_order_items"]
        .groupBy("order_id")
        .agg(F.countDistinct("seller_id").alias("seller_count"))
    )
    return (
        w["int_seller_attributable_experience"]
        .select("seller_id", "order_id")
        .join(sellers, "order_id", "left")
        .filter("seller_count IS NULL OR seller_count != 1")
        .select("seller_id", "order_id", "seller_count")
    )


# --- Mart invariants ---------------------------------------------------------


def _rate_wrong(w, name: str, top: str, bottom: str, required: bool = False) -> Column:
    test = mismatch.within if required else mismatch.nullable_within
    return test(C(name), ratio(top, bottom), w.settings.rate_tolerance)


def _amount_wrong(w, name: str, top: str, bottom: str) -> Column:
    return mismatch.nullable_within(C(name), ratio(top, bottom), w.settings.amount_tolerance)


def exec_daily_invariants(w) -> DataFrame:
    wrong = [
        C("cancelled_orders_count") + C("non_cancelled_orders_count") != C("orders_count"),
        C("late_orders_count") > C("delivered_orders_count"),
        C("new_customers_count") > C("orders_count"),
        _rate_wrong(w, "cancellation_rate", "cancelled_orders_count", "orders_count", required=True),
        _rate_wrong(w, "late_delivery_rate", "late_orders_count", "delivered_orders_count"),
        _amount_wrong(w, "avg_review_score", "review_score_sum", "reviews_count"),
    ]
    return (
        w["mart_exec_daily"]
        .filter(_any(wrong))
        .select(
            "calendar_date",
            "orders_count",
            "non_cancelled_orders_count",
            "cancelled_orders_count",
            "delivered_orders_count",
            "late_orders_count",
            "new_customers_count",
            "cancellation_rate",
            "late_delivery_rate",
        )
    )


WEATHER_FIELDS = (
    "delivery_temperature_max",
    "delivery_temperature_min",
    "delivery_precipitation_total",
    "delivery_humidity_afternoon",
)


def fulfillment_invariants(w) -> DataFrame:
    undelivered = C("delivery_delay_bucket") == NOT_DELIVERED
    orders, delivered, cancelled = (
        C("orders_count"),
        C("delivered_orders_count"),
        C("cancelled_orders_count"),
    )
    wrong = [
        C("late_orders_count") > delivered,
        delivered > orders,
        cancelled > orders,
        undelivered & (delivered != 0),
        ~undelivered & (cancelled != 0),
        orders - delivered - cancelled < 0,
        C("late_days_sum") < 0,
        _amount_wrong(w, "avg_late_days", "late_days_sum", "late_orders_count"),
        _rate_wrong(w, "late_delivery_rate", "late_orders_count", "delivered_orders_count"),
    ]
    for field in WEATHER_FIELDS:
        observed = f"{field}_observation_count"
        wrong += [
            C(observed) > orders,
            _amount_wrong(w, f"avg_{field}", f"{field}_sum", observed),
        ]
    weather = [f"{field}_{part}" for field in WEATHER_FIELDS for part in ("observation_count", "sum")]
    return (
        w["mart_fulfillment_ops"]
        .filter(_any(wrong))
        .select(
            *SLICE,
            "orders_count",
            "delivered_orders_count",
            "late_orders_count",
            "cancelled_orders_count",
            "late_days_sum",
            *weather,
            "avg_late_days",
            *[f"avg_{field}" for field in WEATHER_FIELDS],
            "late_delivery_rate",
        )
    )


def customer_experience_invariants(w) -> DataFrame:
    unreviewed = C("reviewed_orders_count") == 0
    averaged = C("avg_review_score").isNotNull() | C("avg_time_to_review_days").isNotNull()
    wrong = [
        C("reviewed_orders_count") > C("orders_count"),
        C("reviews_count") < C("reviewed_orders_count"),
        C("commented_reviews_count") > C("reviews_count"),
        unreviewed & averaged,
    ]
    return w["mart_customer_experience"].filter(_any(wrong))


def seller_experience_invariants(w) -> DataFrame:
    reviewed = "reviewed_attributable_orders_count"
    wrong = [
        C(reviewed) > C("attributable_orders_count"),
        C("reviews_count") < C(reviewed),
        C("commented_reviews_count") > C("reviews_count"),
        C("low_review_orders_count") > C(reviewed),
        _rate_wrong(w, "review_coverage_rate", reviewed, "attributable_orders_count", required=True),
        _rate_wrong(w, "low_review_rate", "low_review_orders_count", reviewed),
        (C(reviewed) == 0) & C("avg_review_score").isNotNull(),
    ]
    return (
        w["mart_seller_experience"]
        .filter(_any(wrong))
        .select(
            "seller_id",
            "calendar_date",
            "attributable_orders_count",
            reviewed,
            "reviews_count",
            "commented_reviews_count",
            "low_review_orders_count",
            "review_coverage_rate",
            "low_review_rate",
            "avg_review_score",
        )
    )


def seller_performance_invariants(w) -> DataFrame:
    wrong = [
        C("cancelled_orders_count") + C("non_cancelled_orders_count") != C("orders_count"),
        C("late_orders_count") > C("delivered_orders_count"),
        C("operational_defect_orders_count") > C("orders_count"),
        _rate_wrong(w, "cancellation_rate", "cancelled_orders_count", "orders_count", required=True),
        _rate_wrong(w, "late_delivery_rate", "late_orders_count", "delivered_orders_count"),
        _rate_wrong(
            w,
            "operational_defect_rate",
            "operational_defect_orders_count",
            "orders_count",
            required=True,
        ),
    ]
    return (
        w["mart_seller_performance"]
        .filter(_any(wrong))
        .select(
            "seller_id",
            "calendar_date",
            "orders_count",
            "non_cancelled_orders_count",
            "cancelled_orders_count",
            "delivered_orders_count",
            "late_orders_count",
            "operational_defect_orders_count",
            "cancellation_rate",
            "late_delivery_rate",
            "operational_defect_rate",
        )
    )


# --- Recompute and reconcile -------------------------------------------------


def item_amounts_match_staging(w) -> DataFrame:
    amounts = ["item_price", "freight_value", "item_total_with_freight"]
    expected = w["stg_order_items"].withColumn(
        "item_total_with_freight", C("item_price") + C("freight_value")
    )
    return reconcile(
        expected,
        w["fact_order_items"],
        ["order_id", "order_item_id"],
        w.settings,
        amounts=amounts,
        show=amounts,
    )


def order_values_reconcile(w) -> DataFrame:
    """Independent totals: items and payments stacked into one grouped pass."""
    none = F.lit(None).cast(NUMERIC)
    entries = (
        w["stg_orders"]
        .select(
            "order_id",
            F.lit("order").alias("kind"),
            none.alias("price"),
            none.alias("freight"),
            none.alias("paid"),
            F.lit(None).cast("string").alias("method"),
        )
        .unionByName(
            w["stg_order_items"].select(
                "order_id",
                F.lit("item").alias("kind"),
                C("item_price").alias("price"),
                C("freight_value").alias("freight"),
                none.alias("paid"),
                F.lit(None).cast("string").alias("method"),
            )
        )
        .unionByName(
            w["stg_payments"].select(
                "order_id",
                F.lit("payment").alias("kind"),
                none.alias("price"),
                none.alias("freight"),
                C("payment_value").alias("paid"),
                C("payment_type").alias("method"),
            )
        )
    )
    expected = (
        entries.groupBy("order_id")
        .agg(
            count_where(C("kind") == "order").alias("_orders"),
            money_or_zero(F.sum("price")).alias("order_item_value"),
            money_or_zero(F.sum("freight")).alias("order_freight_total"),
            count_where(C("kind") == "item").alias("order_items_count"),
            F.sum("paid").alias("order_payment_total"),
            count_where(C("kind") == "payment").alias("_payments"),
            F.countDistinct("method").alias("_methods"),
        )
        .filter("_orders > 0")
        .withColumn("payment_methods_count", F.when(C("_payments") > 0, C("_methods")))
    )
    return reconcile(
        expected,
        w["int_order_value"],
        ["order_id"],
        w.settings,
        exact=["order_items_count"],
        nullable_exact=["payment_methods_count"],
        amounts=["order_item_value", "order_freight_total"],
        nullable_amounts=["order_payment_total"],
        show=["order_items_count", "order_item_value", "order_payment_total"],
    )


def seller_days_reconcile(w) -> DataFrame:
    """Seller days from item rows that carry the order flags themselves."""
    flags = w["int_order_delivery"].select(
        "order_id",
        C("purchase_date").alias("calendar_date"),
        "is_cancelled",
        "is_late",
        "is_delivered",
    )
    seller_orders = (
        w["stg_order_items"]
        .join(flags, "order_id")
        .groupBy("seller_id", "calendar_date", "order_id")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.sum("item_price").cast(NUMERIC).alias("price"),
            F.sum("freight_value").cast(NUMERIC).alias("freight"),
            *[F.bool_or(f).alias(f) for f in ("is_cancelled", "is_late", "is_delivered")],
        )
    )
    live = F.when(C("is_cancelled"), F.lit(0).cast(NUMERIC)).otherwise(C("price") + C("freight"))
    expected = seller_orders.groupBy("seller_id", "calendar_date").agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("items").alias("items_count"),
        F.sum("price").alias("items_value"),
        F.sum("freight").alias("freight_total"),
        F.sum(live).alias("gmv"),
        F.sum(F.when(C("is_cancelled"), 0).otherwise(1)).alias("non_cancelled_orders_count"),
        _ones("is_delivered").alias("delivered_orders_count"),
        _ones("is_cancelled").alias("cancelled_orders_count"),
        _ones("is_late").alias("late_orders_count"),
        F.sum(F.when(C("is_cancelled") | C("is_late"), 1).otherwise(0)).alias(
            "operational_defect_orders_count"
        ),
    )
    return reconcile(
        expected,
        w["int_seller_daily_performance"],
        ["seller_id", "calendar_date"],
        w.settings,
        exact=[
            "orders_count",
            "items_count",
            "non_cancelled_orders_count",
            "delivered_orders_count",
            "cancelled_orders_count",
            "late_orders_count",
            "operational_defect_orders_count",
        ],
        amounts=["items_value", "freight_total", "gmv"],
        show=[
            "orders_count",
            "items_value",
            "freight_total",
            "gmv",
            "non_cancelled_orders_count",
            "operational_defect_orders_count",
        ],
    )


def attributable_experience_reconciles(w) -> DataFrame:
    # Recomputed another way: distinct sellers are counted, and low scores follow from the
    # review rows themselves instead of their metrics.
    single = (
        w["fact_order_items"].groupBy("order_id")
        .agg(F.count_distinct("seller_id").alias("sellers"), F.max("seller_id").alias("seller_id"))
        .filter("sellers = 1")
        .select("order_id", "seller_id")
    )
    reviews = w["fact_reviews"].groupBy("order_id").agg(
        F.avg("review_score").alias("mean_score"), F.count(F.lit(1)).alias("review_rows")
    )
    dates = w["fact_orders"].select("order_id", F.col("purchase_date").alias("calendar_date"))
    metrics = w["int_order_review_metrics"].select(
        "order_id", "reviews_count", "commented_reviews_count",
        "avg_review_score_for_order", "avg_time_to_review_days_for_order",
    )
    expected = (
        single.join(dates, "order_id").join(reviews, "order_id", "left").join(metrics, "order_id", "left")
        .withColumn("is_reviewed_order", F.coalesce(F.col("review_rows") > 0, F.lit(False)))
        .withColumn(
            "is_low_review_order",
            F.when(F.col("mean_score") <= w.settings.low_review_score, True).otherwise(False),
        )
        .drop("mean_score", "review_rows")
    )
    return reconcile(
        expected,
        w["int_seller_attributable_experience"],
        ["seller_id", "order_id"],
        w.settings,
        exact=["calendar_date", "is_reviewed_order", "is_low_review_order"],
        nullable_amounts=["reviews_count", "commented_reviews_count"],
        nullable_rates=["avg_review_score_for_order", "avg_time_to_review_days_for_order"],
        show=[
            "calendar_date",
            "reviews_count",
            "commented_reviews_count",
            "avg_review_score_for_order",
            "avg_time_to_review_days_for_order",
            "is_reviewed_order",
            "is_low_review_order",
        ],
    )


def _ones(flag: str) -> Column:
    return F.sum(F.when(C(flag), 1).otherwise(0))


def exec_daily_reconciles(w) -> DataFrame:
    """Days by conditional sums over orders and reviews."""
    live_value = F.when(C("is_cancelled"), F.lit(0).cast(NUMERIC)).otherwise(
        money_or_zero("order_item_value")
    )
    live_freight = F.when(C("is_cancelled"), F.lit(0).cast(NUMERIC)).otherwise(
        money_or_zero("order_freight_total")
    )
    day = C("purchase_date").alias("calendar_date")
    order_days = (
        w["fact_orders"]
        .groupBy(day)
        .agg(
            F.count(F.lit(1)).alias("orders_count"),
            F.sum(F.when(C("is_cancelled"), 0).otherwise(1)).alias("non_cancelled_orders_count"),
            _ones("is_cancelled").alias("cancelled_orders_count"),
            _ones("is_delivered").alias("delivered_orders_count"),
            _ones("is_late").alias("late_orders_count"),
            _ones("is_first_order").alias("new_customers_count"),
            (F.sum(live_value).cast(NUMERIC) + F.sum(live_freight).cast(NUMERIC)).alias("gmv"),
            F.sum(money_or_zero("order_item_value")).alias("items_value"),
            F.sum(money_or_zero("order_freight_total")).alias("freight_total"),
            F.sum(money_or_zero("order_payment_total")).alias("payment_total"),
        )
    )
    score = C("review_score").cast("double")
    review_days = (
        w["fact_reviews"]
        .groupBy(day)
        .agg(
            F.count(F.lit(1)).alias("reviews_count"),
            F.sum(score).alias("review_score_sum"),
            F.avg(score).alias("avg_review_score"),
        )
    )
    expected = order_days.join(review_days, "calendar_date", "left").withColumns(
        {
            "reviews_count": F.coalesce("reviews_count", F.lit(0)),
            "review_score_sum": F.coalesce("review_score_sum", F.lit(0.0)),
        }
    )
    return reconcile(
        expected,
        w["mart_exec_daily"],
        ["calendar_date"],
        w.settings,
        exact=[
            "orders_count",
            "non_cancelled_orders_count",
            "cancelled_orders_count",
            "delivered_orders_count",
            "late_orders_count",
            "new_customers_count",
            "reviews_count",
        ],
        amounts=["gmv", "items_value", "freight_total", "payment_total", "review_score_sum"],
        nullable_rates=["avg_review_score"],
        show=["orders_count", "gmv"],
    )


def _slices(w) -> DataFrame:
    return w["fact_orders"].select(
        "*",
        C("customer_state_at_order").alias("customer_state"),
        delay_bucket().alias("delivery_delay_bucket"),
    )


def fulfillment_reconciles(w) -> DataFrame:
    late_days = F.when(C("is_late"), C("late_days").cast("double"))
    aggregates, exact, amounts = [], [], []
    for field in WEATHER_FIELDS:
        seen = C(field).isNotNull()
        aggregates += [
            F.sum(seen.cast("bigint")).alias(f"{field}_observation_count"),
            F.sum(F.when(seen, C(field)).otherwise(0.0)).alias(f"{field}_sum"),
        ]
        exact.append(f"{field}_observation_count")
        amounts.append(f"{field}_sum")
    expected = (
        _slices(w)
        .groupBy(*SLICE)
        .agg(
            F.count(F.lit(1)).alias("orders_count"),
            _ones("is_delivered").alias("delivered_orders_count"),
            _ones("is_late").alias("late_orders_count"),
            _ones("is_cancelled").alias("cancelled_orders_count"),
            F.coalesce(F.sum(late_days), F.lit(0.0)).alias("late_days_sum"),
            F.avg(late_days).alias("avg_late_days"),
            *aggregates,
        )
    )
    return reconcile(
        expected,
        w["mart_fulfillment_ops"],
        SLICE,
        w.settings,
        exact=[
            "orders_count",
            "delivered_orders_count",
            "late_orders_count",
            "cancelled_orders_count",
            *exact,
        ],
        amounts=["late_days_sum", *amounts],
        nullable_amounts=["avg_late_days"],
        show=["orders_count"],
    )


def _experience_slices(w) -> DataFrame:
    return _slices(w).select("order_id", *SLICE).join(w["int_order_review_metrics"], "order_id", "left")


def customer_experience_reconciles(w) -> DataFrame:
    counts = ["orders_count", "reviewed_orders_count", "reviews_count", "commented_reviews_count"]
    expected = (
        _experience_slices(w)
        .groupBy(*SLICE)
        .agg(
            F.count(F.lit(1)).alias("orders_count"),
            count_where(C("reviews_count").isNotNull()).alias("reviewed_orders_count"),
            F.coalesce(F.sum("reviews_count"), F.lit(0)).alias("reviews_count"),
            F.coalesce(F.sum("commented_reviews_count"), F.lit(0)).alias("commented_reviews_count"),
        )
    )
    return reconcile(
        expected,
        w["mart_customer_experience"],
        SLICE,
        w.settings,
        exact=counts,
        show=["orders_count"],
    )


def customer_experience_is_order_weighted(w) -> DataFrame:
    averages = ["avg_review_score", "avg_time_to_review_days"]
    expected = (
        _experience_slices(w)
        .groupBy(*SLICE)
        .agg(*[F.avg(f"{name}_for_order").alias(name) for name in averages])
    )
    return reconcile(
        expected, w["mart_customer_experience"], SLICE, w.settings, nullable_rates=averages
    )


def seller_experience_reconciles(w) -> DataFrame:
    reviewed = C("is_reviewed_order").cast("bigint")
    low = C("is_low_review_order").cast("bigint")
    expected = (
        w["int_seller_attributable_experience"]
        .groupBy("seller_id", "calendar_date")
        .agg(
            F.count(F.lit(1)).alias("attributable_orders_count"),
            F.sum(reviewed).alias("reviewed_attributable_orders_count"),
            F.avg(reviewed).alias("review_coverage_rate"),
            F.coalesce(F.sum("reviews_count"), F.lit(0)).alias("reviews_count"),
            F.coalesce(F.sum("commented_reviews_count"), F.lit(0)).alias("commented_reviews_count"),
            F.avg("avg_review_score_for_order").alias("avg_review_score"),
            F.avg("avg_time_to_review_days_for_order").alias("avg_time_to_review_days"),
            F.sum(low).alias("low_review_orders_count"),
            F.avg(F.when(C("is_reviewed_order"), low)).alias("low_review_rate"),
        )
    )
    return reconcile(
        expected,
        w["mart_seller_experience"],
        ["seller_id", "calendar_date"],
        w.settings,
        exact=[
            "attributable_orders_count",
            "reviewed_attributable_orders_count",
            "reviews_count",
            "commented_reviews_count",
            "low_review_orders_count",
        ],
        nullable_rates=[
            "review_coverage_rate",
            "avg_review_score",
            "avg_time_to_review_days",
            "low_review_rate",
        ],
        show=["attributable_orders_count"],
    )


def seller_performance_reconciles(w) -> DataFrame:
    expected = w["int_seller_daily_performance"].withColumns(
        {
            "aov": money_ratio("gmv", "non_cancelled_orders_count"),
            "cancellation_rate": ratio("cancelled_orders_count", "orders_count"),
            "late_delivery_rate": ratio("late_orders_count", "delivered_orders_count"),
            "operational_defect_rate": ratio("operational_defect_orders_count", "orders_count"),
        }
    )
    return reconcile(
        expected,
        w["mart_seller_performance"],
        ["seller_id", "calendar_date"],
        w.settings,
        exact=[
            "orders_count",
            "non_cancelled_orders_count",
            "items_count",
            "delivered_orders_count",
            "cancelled_orders_count",
            "late_orders_count",
            "operational_defect_orders_count",
        ],
        amounts=["items_value", "freight_total", "gmv"],
        rates=["cancellation_rate", "operational_defect_rate"],
        nullable_rates=["aov", "late_delivery_rate"],
        show=["orders_count", "operational_defect_rate"],
    )


def seller_experience_is_order_weighted(w) -> DataFrame:
    """Published averages weigh orders, not items and not review rows.

    Where weighing by items or by review rows would give another value than
    weighing by orders, the published value must not be that other one.
    """
    key = ["seller_id", "calendar_date"]
    items, metrics = w["fact_order_items"], w["int_order_review_metrics"]
    per_order = (
        items.groupBy("order_id")
        .agg(
            F.min("seller_id").alias("seller_id"),
            F.max("seller_id").alias("_last"),
            F.count("seller_id").alias("_items"),
        )
        .filter("seller_id = _last")
        .join(
            w["fact_orders"].select("order_id", C("purchase_date").alias("calendar_date")), "order_id"
        )
    )
    scores = metrics.select(
        "order_id",
        C("avg_review_score_for_order").alias("score"),
        C("avg_time_to_review_days_for_order").alias("days"),
    )
    review_rows = (
        w["fact_reviews"]
        .groupBy("order_id")
        .agg(
            F.sum(C("review_score").cast("double")).alias("score_sum"),
            F.count("review_score").alias("score_rows"),
            F.sum(C("time_to_review_days").cast("double")).alias("days_sum"),
            F.count("time_to_review_days").alias("days_rows"),
        )
    )
    weighted = {}
    for measure in ("score", "days"):
        known_items = F.when(C(measure).isNotNull(), C("_items"))
        weighted[f"order_{measure}"] = F.avg(measure)
        weighted[f"item_{measure}"] = F.try_divide(
            F.sum(C(measure) * C("_items")), F.sum(known_items)
        )
        weighted[f"row_{measure}"] = F.try_divide(
            F.sum(f"{measure}_sum"), F.sum(f"{measure}_rows").cast("double")
        )
    expected = (
        per_order.join(scores, "order_id", "left")
        .join(review_rows, "order_id", "left")
        .groupBy(*key)
        .agg(*[value.alias(name) for name, value in weighted.items()])
        .withColumn("_expected", F.lit(True))
    )
    actual = w["mart_seller_experience"].select(
        *key,
        C("avg_review_score").alias("published_score"),
        C("avg_time_to_review_days").alias("published_days"),
        F.lit(True).alias("_actual"),
    )

    def apart(left: str, right: str) -> Column:
        return mismatch.nullable_within(C(left), C(right), w.settings.rate_tolerance)

    wrong = [C("_expected").isNull(), C("_actual").isNull()]
    for measure in ("score", "days"):
        published, rightly = f"published_{measure}", f"order_{measure}"
        wrong.append(apart(rightly, published))
        for other in (f"item_{measure}", f"row_{measure}"):
            wrong.append(apart(other, rightly) & ~apart(other, published))
    return (
        expected.join(actual, key, "full_outer")
        .filter(_any(wrong))
        .select(
            *key,
            C("order_score").alias("expected_avg_review_score"),
            C("published_score").alias("avg_review_score"),
            C("item_score").alias("item_weighted_avg_review_score"),
            C("row_score").alias("review_row_weighted_avg_review_score"),
        )
    )


# --- Snapshots ---------------------------------------------------------------


def snap_products_without_noops(w) -> DataFrame:
    return noop_versions(w["snap_products"], "product_id", PRODUCT_ATTRIBUTES)


def snap_sellers_without_noops(w) -> DataFrame:
    return noop_versions(w["snap_sellers"], "seller_id", SELLER_ATTRIBUTES)


ASSERTIONS = {
    "h07": experience_and_fulfillment_share_population,
    "h08": customer_sequence_starts_at_one,
    "h09": delivered_means_status_and_timestamp,
    "h10": calendar_covers_business_dates,
    "h11": item_amounts_match_staging,
    "h12": order_identity_matches_source,
    "h13": order_holidays_match_calendar,
    "h14": fact_orders_match_delivery,
    "h15": delivery_has_calendar_context,
    "h16": order_value_preserves_orders,
    "h17": review_bucket_purity,
    "h18": attributable_experience_reconciles,
    "h19": attributable_orders_have_one_seller,
    "h20": seller_days_reconcile,
    "h21": late_orders_have_late_days,
    "h22": customer_experience_invariants,
    "h23": customer_experience_is_order_weighted,
    "h24": customer_experience_reconciles,
    "h25": exec_daily_covers_order_dates,
    "h26": exec_daily_invariants,
    "h27": exec_daily_reconciles,
    "h28": fulfillment_holidays_match_calendar,
    "h29": fulfillment_invariants,
    "h30": fulfillment_reconciles,
    "h31": seller_experience_invariants,
    "h32": seller_experience_is_order_weighted,
    "h33": seller_experience_reconciles,
    "h34": seller_performance_invariants,
    "h35": seller_performance_reconciles,
    "h36": punctual_orders_have_no_late_days,
    "h37": order_values_reconcile,
    "h38": snap_products_without_noops,
    "h39": snap_sellers_without_noops,
    "h40": raw_sources_nonempty,
    "h41": weather_covers_delivery_dates,
}
