"""Published marts. Rates come with their numerators and denominators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.contracts import shape
from marketlane.functions.columns import (
    NUMERIC,
    count_where,
    delay_bucket,
    money_or_zero,
    money_ratio,
    money_sum,
    ratio,
)


def mart_exec_daily(orders: DataFrame, reviews: DataFrame, calendar: DataFrame) -> DataFrame:
    """Executive day by purchase date; reviews count on their order's day."""
    value = money_or_zero("order_item_value") + money_or_zero("order_freight_total")
    kept = ~F.col("is_cancelled")
    order_days = orders.groupBy("purchase_date").agg(
        F.count(F.lit(1)).alias("orders_count"),
        count_where(kept).alias("non_cancelled_orders_count"),
        count_where("is_cancelled").alias("cancelled_orders_count"),
        count_where("is_delivered").alias("delivered_orders_count"),
        count_where("is_late").alias("late_orders_count"),
        count_where("is_first_order").alias("new_customers_count"),
        money_sum(F.when(kept, value.cast(NUMERIC)).otherwise(F.lit(0).cast(NUMERIC))).alias("gmv"),
        money_sum("order_item_value").alias("items_value"),
        money_sum("order_freight_total").alias("freight_total"),
        money_sum(money_or_zero("order_payment_total")).alias("payment_total"),
    )
    review_days = reviews.groupBy("purchase_date").agg(
        F.count(F.lit(1)).alias("reviews_count"),
        F.sum(F.col("review_score").cast("double")).alias("review_score_sum"),
    )
    joined = (
        order_days.join(
            F.broadcast(calendar.withColumnRenamed("calendar_date", "purchase_date")),
            "purchase_date",
        )
        .join(review_days, "purchase_date", "left")
        .withColumnRenamed("purchase_date", "calendar_date")
        .withColumns(
            {
                "aov": money_ratio("gmv", "non_cancelled_orders_count"),
                "cancellation_rate": ratio("cancelled_orders_count", "orders_count"),
                "late_delivery_rate": ratio("late_orders_count", "delivered_orders_count"),
                "avg_review_score": ratio("review_score_sum", "reviews_count"),
                "reviews_count": F.coalesce("reviews_count", F.lit(0)),
                "review_score_sum": F.coalesce("review_score_sum", F.lit(0.0)),
            }
        )
    )
    return shape(joined, "mart_exec_daily")


WEATHER_FIELDS = ("temperature_max", "temperature_min", "precipitation_total", "humidity_afternoon")


def mart_fulfillment_ops(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fulfilment slices. The calendar joins the slices, not the orders."""
    aggregates = [
        F.count(F.lit(1)).alias("orders_count"),
        count_where("is_delivered").alias("delivered_orders_count"),
        count_where("is_late").alias("late_orders_count"),
        count_where("is_cancelled").alias("cancelled_orders_count"),
        F.sum(
            F.when(F.col("is_late"), F.col("late_days").cast("double")).otherwise(F.lit(0.0))
        ).alias("late_days_sum"),
        F.max("delivery_weather_location_key").alias("delivery_weather_location_key"),
    ]
    for field in WEATHER_FIELDS:
        observed = F.col(f"delivery_{field}")
        aggregates += [
            F.count(observed).alias(f"delivery_{field}_observation_count"),
            F.sum(F.coalesce(observed.cast("double"), F.lit(0.0))).alias(f"delivery_{field}_sum"),
        ]
    slices = (
        orders.withColumn("delivery_delay_bucket", delay_bucket())
        .withColumnRenamed("customer_state_at_order", "customer_state")
        .groupBy("purchase_date", "customer_state", "delivery_delay_bucket")
        .agg(*aggregates)
    )
    days = calendar.select(
        F.col("calendar_date").alias("purchase_date"),
        F.col("is_holiday").alias("is_purchase_on_holiday"),
        F.col("holiday_name").alias("holiday_name_at_purchase"),
    )
    averages = {
        f"avg_delivery_{field}": ratio(
            f"delivery_{field}_sum", f"delivery_{field}_observation_count"
        )
        for field in WEATHER_FIELDS
    }
    joined = slices.join(F.broadcast(days), "purchase_date").withColumns(
        {
            "avg_late_days": ratio("late_days_sum", "late_orders_count"),
            "late_delivery_rate": ratio("late_orders_count", "delivered_orders_count"),
            **averages,
        }
    )
    return shape(joined, "mart_fulfillment_ops")


def mart_customer_experience(orders: DataFrame, review_metrics: DataFrame) -> DataFrame:
    """Experience slices; averages weigh each order once."""
    slices = (
        orders.select(
            "order_id",
            "purchase_date",
            F.col("customer_state_at_order").alias("customer_state"),
            delay_bucket().alias("delivery_delay_bucket"),
        )
        .join(review_metrics, "order_id", "left")
        .groupBy("purchase_date", "customer_state", "delivery_delay_bucket")
        .agg(F.count(F.lit(1)).alias("orders_count"), *_review_aggregates("reviewed_orders_count"))
    )
    return shape(slices, "mart_customer_experience")


def _review_aggregates(reviewed_name: str) -> list:
    return [
        F.count("reviews_count").alias(reviewed_name),
        F.sum(F.coalesce("reviews_count", F.lit(0))).alias("reviews_count"),
        F.sum(F.coalesce("commented_reviews_count", F.lit(0))).alias("commented_reviews_count"),
        F.avg("avg_review_score_for_order").alias("avg_review_score"),
        F.avg("avg_time_to_review_days_for_order").alias("avg_time_to_review_days"),
    ]


def mart_seller_performance(seller_days: DataFrame) -> DataFrame:
    rated = seller_days.withColumns(
        {
            "aov": money_ratio("gmv", "non_cancelled_orders_count"),
            "cancellation_rate": ratio("cancelled_orders_count", "orders_count"),
            "late_delivery_rate": ratio("late_orders_count", "delivered_orders_count"),
            "operational_defect_rate": ratio("operational_defect_orders_count", "orders_count"),
        }
    )
    return shape(rated, "mart_seller_performance")


def mart_seller_experience(attributable: DataFrame) -> DataFrame:
    days = attributable.groupBy("seller_id", "calendar_date").agg(
        F.count(F.lit(1)).alias("attributable_orders_count"),
        *_review_aggregates("reviewed_attributable_orders_count"),
        count_where("is_low_review_order").alias("low_review_orders_count"),
    )
    rated = days.withColumns(
        {
            "review_coverage_rate": ratio(
                "reviewed_attributable_orders_count", "attributable_orders_count"
            ),
            "low_review_rate": ratio(
                "low_review_orders_count", "reviewed_attributable_orders_count"
            ),
        }
    )
    return shape(rated, "mart_seller_experience")
