"""Conformed facts, and the incremental upsert of the order fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.functions.columns import NUMERIC, money_or_zero
from marketlane.settings import Settings


def fact_orders(
    delivery: DataFrame, value: DataFrame, numbered: DataFrame, settings: Settings
) -> DataFrame:
    """One row per order. All three inputs are one row per order, so nothing fans out.

    ``numbered`` (orders joined with their customers) carries both the sequence
    and the order-time geography: one join with customers serves both.
    """
    geography = numbered.select(
        "order_id",
        "customer_unique_id",
        "customer_order_number",
        "is_first_order",
        F.col("customer_zip_code_prefix").alias("customer_zip_code_prefix_at_order"),
        F.col("customer_city").alias("customer_city_at_order"),
        F.col("customer_state").alias("customer_state_at_order"),
    )
    total = money_or_zero("order_item_value") + money_or_zero("order_freight_total")
    return (
        delivery.join(value, "order_id", "left")
        .join(geography, "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix_at_order",
            "customer_city_at_order",
            "customer_state_at_order",
            "order_status",
            "order_purchased_at_utc",
            "order_approved_at_utc",
            "order_delivered_to_carrier_at_utc",
            "order_delivered_to_customer_at_utc",
            "order_estimated_delivery_at_utc",
            "purchase_date",
            "delivery_date",
            "is_delivered",
            "is_late",
            "late_days",
            "is_cancelled",
            "customer_order_number",
            "is_first_order",
            "order_item_value",
            "order_freight_total",
            "order_items_count",
            "order_payment_total",
            "payment_methods_count",
            total.cast(NUMERIC).alias("order_total_with_freight"),
            "is_purchase_on_holiday",
            "holiday_name_at_purchase",
            "delivery_weather_location_key",
            "delivery_temperature_max",
            "delivery_temperature_min",
            "delivery_precipitation_total",
            "delivery_humidity_afternoon",
            settings.now_column().alias("dbt_updated_at"),
        )
    )


ORDER_CONTEXT = (
    "customer_id customer_unique_id customer_zip_code_prefix_at_order "
    "customer_city_at_order customer_state_at_order"
).split()


def fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Items with order context; items without an order header are left out."""
    header = orders.select(
        "order_id",
        *ORDER_CONTEXT,
        "order_status",
        "purchase_date",
        "delivery_date",
        "is_delivered",
        "is_late",
        "late_days",
        "is_cancelled",
    )
    lines = items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_at_utc",
        "item_price",
        "freight_value",
    )
    total = F.col("item_price") + F.col("freight_value")
    return (
        lines.join(header, "order_id")
        .join(products.select("product_id", "product_category_name"), "product_id", "left")
        .select(
            "order_id",
            "order_item_id",
            *ORDER_CONTEXT,
            "seller_id",
            "product_id",
            "product_category_name",
            "order_status",
            "purchase_date",
            "delivery_date",
            "shipping_limit_at_utc",
            "item_price",
            "freight_value",
            total.cast(NUMERIC).alias("item_total_with_freight"),
            "is_delivered",
            "is_late",
            "late_days",
            "is_cancelled",
        )
    )


def fact_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Reviews with order context; the order's purchase date wins."""
    header = orders.select(
        "order_id", *ORDER_CONTEXT, F.col("purchase_date").alias("order_purchase_date")
    )
    return reviews.join(header, "order_id", "left").select(
        "review_id",
        "order_id",
        *ORDER_CONTEXT,
        "review_score",
        "has_comment",
        "review_created_at_utc",
        "review_answered_at_utc",
        "review_comment_title",
        "review_comment_message",
        F.coalesce("order_purchase_date", "purchase_date").alias("purchase_date"),
        F.col("order_delivered_to_customer_at_utc").alias("delivered_at_utc"),
        "primary_product_category",
        "is_delivered",
        "is_late",
        "is_cancelled",
        "late_days",
        "time_to_review_days",
        "delivery_delay_bucket",
    )


def replay_window(delivery: DataFrame, existing: DataFrame, settings: Settings) -> DataFrame:
    """Orders an incremental run rebuilds: the lookback behind the newest known order.

    Orders without a purchase timestamp never qualify; a full refresh takes them in.
    """
    newest = existing.agg(F.max("order_purchased_at_utc").alias("newest")).select(
        F.coalesce("newest", F.lit("1900-01-01 00:00:00").cast("timestamp"))
        - F.expr(f"INTERVAL {int(settings.order_lookback_days)} DAYS")
    )
    return delivery.filter(F.col("order_purchased_at_utc") >= newest.scalar())
