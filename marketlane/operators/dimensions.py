"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.functions.columns import greatest_or_null
from marketlane.functions.frames import first_per_key
from marketlane.settings import Settings


def calendar_bounds(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: first and last day any fact can refer to.

    Both sources feed one min/max, which skips NULLs; an empty source therefore
    leaves the other's bounds, and two empty ones leave NULL.
    """
    bought = F.to_date("order_purchased_at_utc")
    due = F.coalesce(F.to_date("order_estimated_delivery_at_utc"), bought)
    arrived = F.coalesce(F.to_date("order_delivered_to_customer_at_utc"), due)
    order_days = orders.select(
        bought.alias("first_day"), greatest_or_null(arrived, due, bought).alias("last_day")
    )
    created = F.to_date("review_created_at_utc")
    review_days = reviews.select(created.alias("first_day"), created.alias("last_day"))
    return order_days.unionByName(review_days).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )


def dim_date(
    orders: DataFrame, reviews: DataFrame, holidays: DataFrame, settings: Settings
) -> DataFrame:
    """Calendar over the observed days, with the configured country's holidays."""
    today = settings.now_column().cast("date")
    first = F.coalesce("first_day", today)
    last = F.coalesce("last_day", "first_day", today)
    days = calendar_bounds(orders, reviews).select(
        F.explode(F.sequence(first, last)).alias("calendar_date")
    )
    names = (
        holidays.filter(F.col("country_code") == settings.holiday_country.strip().upper())
        .groupBy(F.col("holiday_date").alias("calendar_date"))
        .agg(F.expr("listagg(holiday_name, ',') within group (order by holiday_name)").alias("holiday_name"))
        .withColumn("_found", F.lit(True))
    )
    day = F.col("calendar_date")

    def number(value):
        return value.cast("bigint")

    return days.join(F.broadcast(names), "calendar_date", "left").select(
        day,
        number(F.year(day)).alias("year"),
        number(F.quarter(day)).alias("quarter"),
        number(F.month(day)).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        number(F.weekofyear(day)).alias("iso_week"),
        number(F.dayofmonth(day)).alias("day_of_month"),
        number(F.dayofweek(day)).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.coalesce("_found", F.lit(False)).alias("is_holiday"),
        "holiday_name",
        F.trunc(day, "month").alias("first_day_of_month"),
        F.trunc(day, "quarter").alias("first_day_of_quarter"),
        F.trunc(day, "year").alias("first_day_of_year"),
        F.last_day(day).alias("last_day_of_month"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    """Current record of each person."""
    order = [F.desc_nulls_last(c) for c in ("ingested_at_utc", "batch_id", "customer_id")]
    return first_per_key(customers, ["customer_unique_id"], order).select(
        "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    )


PRODUCT_ATTRIBUTES = (
    "product_category_name product_name_length product_description_length "
    "product_photos_count product_weight_g product_length_cm product_height_cm product_width_cm"
).split()
SELLER_ATTRIBUTES = "seller_zip_code_prefix seller_city seller_state".split()


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", *PRODUCT_ATTRIBUTES)


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", *SELLER_ATTRIBUTES)
