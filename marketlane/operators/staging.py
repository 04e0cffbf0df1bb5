"""Staging: clean and type the raw text, keep the newest record per natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.functions.columns import (
    clean_text,
    lower_text,
    measure_to_long,
    to_bool,
    to_date,
    to_double,
    to_long,
    to_numeric,
    to_timestamp,
    upper_text,
)
from marketlane.functions.frames import newest_per_key


def _newest(raw: DataFrame, key: dict[str, Column], **columns: Column) -> DataFrame:
    """Newest raw row per cleaned key, typed afterwards.

    Only the key and the lineage are cleaned before the shuffle. The other columns
    travel as text and are parsed once per surviving row.
    """
    keyed = raw.withColumns(
        {
            **{f"_key_{name}": value for name, value in key.items()},
            "batch_id": clean_text("batch_id"),
            "ingested_at_utc": F.col("ingested_at_utc").try_cast("timestamp"),
        }
    ).drop(*key)
    kept = newest_per_key(keyed, [f"_key_{name}" for name in key])
    return kept.select(
        *[F.col(f"_key_{name}").alias(name) for name in key],
        *[value.alias(name) for name, value in columns.items()],
        "batch_id",
        "ingested_at_utc",
        clean_text("source_file_name").alias("source_file_name"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return _newest(
        raw,
        {"order_id": clean_text("order_id")},
        customer_id=clean_text("customer_id"),
        order_status=lower_text("order_status"),
        order_purchased_at_utc=to_timestamp("order_purchase_timestamp"),
        order_approved_at_utc=to_timestamp("order_approved_at"),
        order_delivered_to_carrier_at_utc=to_timestamp("order_delivered_carrier_date"),
        order_delivered_to_customer_at_utc=to_timestamp("order_delivered_customer_date"),
        order_estimated_delivery_at_utc=to_timestamp("order_estimated_delivery_date"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return _newest(
        raw,
        {"order_id": clean_text("order_id"), "order_item_id": to_long("order_item_id")},
        product_id=clean_text("product_id"),
        seller_id=clean_text("seller_id"),
        shipping_limit_at_utc=to_timestamp("shipping_limit_date"),
        item_price=to_numeric("price"),
        freight_value=to_numeric("freight_value"),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    return _newest(
        raw,
        {"order_id": clean_text("order_id"), "payment_sequence": to_long("payment_sequential")},
        payment_type=lower_text("payment_type"),
        payment_installments_count=to_long("payment_installments"),
        payment_value=to_numeric("payment_value"),
    )


def stg_reviews(raw: DataFrame) -> DataFrame:
    return _newest(
        raw,
        {"review_id": clean_text("review_id"), "order_id": clean_text("order_id")},
        review_score=to_long("review_score"),
        review_comment_title=clean_text("review_comment_title"),
        review_comment_message=clean_text("review_comment_message"),
        review_created_at_utc=to_timestamp("review_creation_date"),
        review_answered_at_utc=to_timestamp("review_answer_timestamp"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return _newest(
        raw,
        {"customer_id": clean_text("customer_id")},
        customer_unique_id=clean_text("customer_unique_id"),
        customer_zip_code_prefix=to_long("customer_zip_code_prefix"),
        customer_city=lower_text("customer_city"),
        customer_state=upper_text("customer_state"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return _newest(
        raw,
        {"seller_id": clean_text("seller_id")},
        seller_zip_code_prefix=to_long("seller_zip_code_prefix"),
        seller_city=lower_text("seller_city"),
        seller_state=upper_text("seller_state"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """Raw product measures are floats, hence the rounding to whole numbers."""
    return _newest(
        raw,
        {"product_id": clean_text("product_id")},
        product_category_name=lower_text("product_category_name"),
        product_name_length=measure_to_long("product_name_lenght"),
        product_description_length=measure_to_long("product_description_lenght"),
        product_photos_count=measure_to_long("product_photos_qty"),
        product_weight_g=to_numeric("product_weight_g"),
        product_length_cm=to_numeric("product_length_cm"),
        product_height_cm=to_numeric("product_height_cm"),
        product_width_cm=to_numeric("product_width_cm"),
    )


# Fixed value: stands for a NULL part inside the observation key.
MISSING_PART = "__null__"


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """One row per observation; the key is an md5 of place and rounded position."""
    zip_code = to_long("geolocation_zip_code_prefix")
    latitude, longitude = to_double("geolocation_lat"), to_double("geolocation_lng")
    city, state = lower_text("geolocation_city"), upper_text("geolocation_state")

    def six_decimals(value: Column) -> Column:
        return F.when(value.isNotNull(), F.format_string("%.6f", value))

    parts = [
        zip_code.cast("string"),
        six_decimals(latitude),
        six_decimals(longitude),
        city,
        state,
    ]
    key = F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit(MISSING_PART)) for p in parts]))
    return _newest(
        raw,
        {"geolocation_observation_key": key},
        geolocation_zip_code_prefix=zip_code,
        geolocation_lat=latitude,
        geolocation_lng=longitude,
        geolocation_city=city,
        geolocation_state=state,
    )


def stg_holidays(raw: DataFrame) -> DataFrame:
    return _newest(
        raw,
        {"holiday_date": to_date("holiday_date"), "country_code": upper_text("country_code"), "holiday_name": clean_text("holiday_name")},
        local_name=clean_text("local_name"),
        is_global=to_bool("is_global"),
        counties_json=clean_text("counties_json"),
        holiday_types_json=clean_text("holiday_types_json"),
        launch_year=to_long("launch_year"),
    )


WEATHER_MEASURES = (
    "cloud_cover_afternoon humidity_afternoon precipitation_total temperature_min "
    "temperature_max temperature_afternoon temperature_night temperature_evening "
    "temperature_morning pressure_afternoon wind_max_speed wind_max_direction"
).split()


def stg_weather_daily(raw: DataFrame) -> DataFrame:
    return _newest(
        raw,
        {"weather_date": to_date("weather_date"), "location_key": lower_text("location_key")},
        latitude=to_double("latitude"),
        longitude=to_double("longitude"),
        timezone=clean_text("timezone"),
        units=lower_text("units"),
        **{name: to_double(name) for name in WEATHER_MEASURES},
    )
