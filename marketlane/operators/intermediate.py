"""Business logic between staging and the published facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.functions.columns import (
    NUMERIC,
    clean_text,
    count_where,
    delay_bucket,
    money_or_zero,
    money_sum,
)
from marketlane.functions.frames import first_per_key, number_within_key
from marketlane.settings import Settings


def int_order_value(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Item, freight and payment totals per order; both children reduced first."""
    item_totals = items.groupBy("order_id").agg(
        money_sum("item_price").alias("order_item_value"),
        money_sum("freight_value").alias("order_freight_total"),
        F.count(F.lit(1)).alias("order_items_count"),
    )
    payment_totals = payments.groupBy("order_id").agg(
        money_sum("payment_value").alias("order_payment_total"),
        F.countDistinct("payment_type").alias("payment_methods_count"),
    )
    return (
        orders.select("order_id")
        .join(item_totals, "order_id", "left")
        .join(payment_totals, "order_id", "left")
        .select(
            "order_id",
            money_or_zero("order_item_value").alias("order_item_value"),
            money_or_zero("order_freight_total").alias("order_freight_total"),
            F.coalesce("order_items_count", F.lit(0)).alias("order_items_count"),
            "order_payment_total",
            "payment_methods_count",
        )
    )


def order_flags(orders: DataFrame) -> DataFrame:
    """Orders with their days and their delivery and lateness flags: one row in, one row out."""
    delivered_at = F.col("order_delivered_to_customer_at_utc")
    due_at = F.col("order_estimated_delivery_at_utc")
    is_delivered = (F.col("order_status") == "delivered") & delivered_at.isNotNull()
    days_over = F.datediff(F.to_date(delivered_at), F.to_date(due_at))
    is_late = is_delivered & due_at.isNotNull() & F.coalesce(days_over > 0, F.lit(False))

    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchased_at_utc",
        "order_approved_at_utc",
        "order_delivered_to_carrier_at_utc",
        "order_delivered_to_customer_at_utc",
        "order_estimated_delivery_at_utc",
        F.to_date("order_purchased_at_utc").alias("purchase_date"),
        F.to_date(delivered_at).alias("delivery_date"),
        is_delivered.alias("is_delivered"),
        is_late.alias("is_late"),
        F.when(is_late, days_over.cast("bigint")).alias("late_days"),
        (F.col("order_status") == "canceled").alias("is_cancelled"),
    )


def int_order_delivery(
    orders: DataFrame, calendar: DataFrame, weather: DataFrame, settings: Settings
) -> DataFrame:
    """Delivery and lateness flags, holiday at purchase, weather at delivery.

    Calendar and one location's weather hold at most one row per day, so both are
    bounded by the range of the date type and may be broadcast.
    """
    flagged = order_flags(orders)
    holidays = calendar.select(
        F.col("calendar_date").alias("purchase_date"),
        F.col("is_holiday").alias("is_purchase_on_holiday"),
        F.col("holiday_name").alias("holiday_name_at_purchase"),
    )
    delivery_weather = weather.filter(
        F.col("location_key") == settings.weather_location.lower()
    ).select(
        F.col("weather_date").alias("delivery_date"),
        F.col("location_key").alias("delivery_weather_location_key"),
        F.col("temperature_max").alias("delivery_temperature_max"),
        F.col("temperature_min").alias("delivery_temperature_min"),
        F.col("precipitation_total").alias("delivery_precipitation_total"),
        F.col("humidity_afternoon").alias("delivery_humidity_afternoon"),
    )
    joined = flagged.join(F.broadcast(holidays), "purchase_date", "left").join(
        F.broadcast(delivery_weather), "delivery_date", "left"
    )
    return joined.select(*flagged.columns, *holidays.columns[1:], *delivery_weather.columns[1:])


def order_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of known customers, numbered per person, with order-time geography.

    Customer ids are issued per order, so the person is ``customer_unique_id``.
    """
    joined = orders.select(
        "order_id", "customer_id", "order_status", "order_purchased_at_utc"
    ).join(
        customers.select(
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ),
        "customer_id",
    )
    numbered = number_within_key(
        joined,
        key="customer_unique_id",
        instant="order_purchased_at_utc",
        order=["order_id"],
        output="customer_order_number",
    )
    return numbered.withColumn("is_first_order", F.col("customer_order_number") == 1)


def int_customer_order_sequence(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "order_status",
        "order_purchased_at_utc",
        "customer_order_number",
        "is_first_order",
    )


def int_review_enriched(
    reviews: DataFrame, delivery: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    """Reviews with delivery outcome and the category of the dearest item.

    The dearest item is picked before the product lookup, so the lookup sees one
    row per order. Equal price falls to the smaller product id.
    """
    dearest = first_per_key(
        items.select("order_id", "item_price", "product_id"),
        ["order_id"],
        [F.desc_nulls_last("item_price"), F.asc_nulls_first("product_id")],
    )
    category = dearest.join(
        products.select("product_id", "product_category_name"), "product_id", "left"
    ).select("order_id", F.col("product_category_name").alias("primary_product_category"))
    outcome = delivery.select(
        "order_id",
        "is_delivered",
        "is_late",
        "is_cancelled",
        "late_days",
        "order_delivered_to_customer_at_utc",
        "purchase_date",
    )

    def flag(name: str):
        return F.coalesce(name, F.lit(False)).alias(name)

    # Both sides hold an order once, so they meet first and reviews join a single time.
    context = outcome.join(category, "order_id", "full_outer")
    return (
        reviews.join(context, "order_id", "left")
        .select(
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_created_at_utc",
            "review_answered_at_utc",
            "primary_product_category",
            flag("is_delivered"),
            flag("is_late"),
            flag("is_cancelled"),
            "late_days",
            "order_delivered_to_customer_at_utc",
            "purchase_date",
            clean_text("review_comment_message").isNotNull().alias("has_comment"),
            F.datediff(
                F.to_date("review_created_at_utc"),
                F.to_date("order_delivered_to_customer_at_utc"),
            )
            .cast("bigint")
            .alias("time_to_review_days"),
            delay_bucket().alias("delivery_delay_bucket"),
        )
    )


def int_order_review_metrics(reviews: DataFrame) -> DataFrame:
    """Reviews reduced to order grain, so that each order weighs the same later."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews_count"),
        count_where("has_comment").alias("commented_reviews_count"),
        F.avg(F.col("review_score").cast("double")).alias("avg_review_score_for_order"),
        F.avg(F.col("time_to_review_days").cast("double")).alias(
            "avg_time_to_review_days_for_order"
        ),
    )


def int_seller_daily_performance(items: DataFrame, delivery: DataFrame) -> DataFrame:
    """Seller days, by way of seller orders.

    Items meet the order flags first: the join leaves an order's rows together, so seller
    orders need no exchange of their own, and an order is a row before and after it.
    """
    flags = ("calendar_date", "is_cancelled", "is_late", "is_delivered")
    lines = items.select("seller_id", "order_id", "item_price", "freight_value").join(
        delivery.select("order_id", F.col("purchase_date").alias("calendar_date"), *flags[1:]), "order_id"
    )
    flagged = lines.groupBy("order_id", "seller_id", *flags).agg(
        F.count(F.lit(1)).alias("items_count"),
        money_sum("item_price").alias("items_value"),
        money_sum("freight_value").alias("freight_total"),
        money_sum(F.col("item_price") + F.col("freight_value")).alias("gross_value"),
    )
    kept = ~F.col("is_cancelled")
    return flagged.groupBy("seller_id", "calendar_date").agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("items_count").alias("items_count"),
        money_sum("items_value").alias("items_value"),
        money_sum("freight_total").alias("freight_total"),
        money_sum(F.when(kept, F.col("gross_value")).otherwise(F.lit(0).cast(NUMERIC))).alias("gmv"),
        count_where(kept).alias("non_cancelled_orders_count"),
        count_where("is_delivered").alias("delivered_orders_count"),
        count_where("is_cancelled").alias("cancelled_orders_count"),
        count_where("is_late").alias("late_orders_count"),
        count_where(F.col("is_cancelled") | F.col("is_late")).alias(
            "operational_defect_orders_count"
        ),
    )


def int_seller_attributable_experience(
    order_items: DataFrame, orders: DataFrame, review_metrics: DataFrame, settings: Settings
) -> DataFrame:
    """Orders with exactly one seller, and how that seller's orders were reviewed.

    One distinct seller means smallest and largest id agree. That needs no
    distinct count, and lets Catalyst drop joins feeding only other columns.
    """
    sellers = order_items.groupBy("order_id").agg(
        F.min("seller_id").alias("seller_id"), F.max("seller_id").alias("_last_seller")
    )
    single = sellers.filter("seller_id = _last_seller").drop("_last_seller")
    score = F.col("avg_review_score_for_order")
    return (
        single.join(
            orders.select("order_id", F.col("purchase_date").alias("calendar_date")), "order_id"
        )
        .join(review_metrics, "order_id", "left")
        .select(
            "seller_id",
            "order_id",
            "calendar_date",
            "reviews_count",
            "commented_reviews_count",
            "avg_review_score_for_order",
            "avg_time_to_review_days_for_order",
            F.col("reviews_count").isNotNull().alias("is_reviewed_order"),
            F.coalesce(score <= settings.low_review_score, F.lit(False)).alias(
                "is_low_review_order"
            ),
        )
    )
