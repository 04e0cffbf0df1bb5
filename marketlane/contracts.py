"""Published schemas. A mart is written only when it matches its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names, order and types of the published columns.
MART_COLUMNS = {
    "mart_exec_daily": (
        ("date", "calendar_date"),
        ("bigint", "year quarter month iso_week day_of_week"),
        ("boolean", "is_weekend is_holiday"),
        ("string", "holiday_name"),
        ("bigint", "orders_count non_cancelled_orders_count cancelled_orders_count delivered_orders_count late_orders_count new_customers_count"),
        ("decimal(38,9)", "gmv items_value freight_total payment_total aov"),
        ("double", "cancellation_rate late_delivery_rate"),
        ("bigint", "reviews_count"),
        ("double", "review_score_sum avg_review_score"),
    ),
    "mart_seller_performance": (
        ("string", "seller_id"),
        ("date", "calendar_date"),
        ("bigint", "orders_count non_cancelled_orders_count items_count"),
        ("decimal(38,9)", "items_value freight_total gmv"),
        ("bigint", "delivered_orders_count cancelled_orders_count late_orders_count operational_defect_orders_count"),
        ("decimal(38,9)", "aov"),
        ("double", "cancellation_rate late_delivery_rate operational_defect_rate"),
    ),
    "mart_seller_experience": (
        ("string", "seller_id"),
        ("date", "calendar_date"),
        ("bigint", "attributable_orders_count reviewed_attributable_orders_count"),
        ("double", "review_coverage_rate"),
        ("bigint", "reviews_count commented_reviews_count"),
        ("double", "avg_review_score avg_time_to_review_days"),
        ("bigint", "low_review_orders_count"),
        ("double", "low_review_rate"),
    ),
    "mart_fulfillment_ops": (
        ("date", "purchase_date"),
        ("string", "customer_state delivery_delay_bucket"),
        ("bigint", "orders_count delivered_orders_count late_orders_count cancelled_orders_count"),
        ("double", "late_days_sum avg_late_days late_delivery_rate"),
        ("boolean", "is_purchase_on_holiday"),
        ("string", "holiday_name_at_purchase delivery_weather_location_key"),
        ("bigint", "delivery_temperature_max_observation_count"),
        ("double", "delivery_temperature_max_sum avg_delivery_temperature_max"),
        ("bigint", "delivery_temperature_min_observation_count"),
        ("double", "delivery_temperature_min_sum avg_delivery_temperature_min"),
        ("bigint", "delivery_precipitation_total_observation_count"),
        ("double", "delivery_precipitation_total_sum avg_delivery_precipitation_total"),
        ("bigint", "delivery_humidity_afternoon_observation_count"),
        ("double", "delivery_humidity_afternoon_sum avg_delivery_humidity_afternoon"),
    ),
    "mart_customer_experience": (
        ("date", "purchase_date"),
        ("string", "customer_state delivery_delay_bucket"),
        ("bigint", "orders_count reviewed_orders_count reviews_count commented_reviews_count"),
        ("double", "avg_review_score avg_time_to_review_days"),
    ),
}

# The other relations, by type; the order of their columns is not part of it.
RELATION_COLUMNS = {
    "stg_orders": (
        ("string", "order_id customer_id order_status batch_id source_file_name"),
        (
            "timestamp",
            "order_purchased_at_utc order_approved_at_utc order_delivered_to_carrier_at_utc "
            "order_delivered_to_customer_at_utc order_estimated_delivery_at_utc "
            "ingested_at_utc"
        ),
    ),
    "stg_order_items": (
        ("string", "order_id product_id seller_id batch_id source_file_name"),
        ("bigint", "order_item_id"),
        ("timestamp", "shipping_limit_at_utc ingested_at_utc"),
        ("decimal(28,9)", "item_price freight_value"),
    ),
    "stg_payments": (
        ("string", "order_id payment_type batch_id source_file_name"),
        ("bigint", "payment_sequence payment_installments_count"),
        ("decimal(28,9)", "payment_value"),
        ("timestamp", "ingested_at_utc"),
    ),
    "stg_reviews": (
        (
            "string",
            "review_id order_id review_comment_title review_comment_message batch_id "
            "source_file_name"
        ),
        ("bigint", "review_score"),
        ("timestamp", "review_created_at_utc review_answered_at_utc ingested_at_utc"),
    ),
    "stg_customers": (
        (
            "string",
            "customer_id customer_unique_id customer_city customer_state batch_id "
            "source_file_name"
        ),
        ("bigint", "customer_zip_code_prefix"),
        ("timestamp", "ingested_at_utc"),
    ),
    "stg_sellers": (
        ("string", "seller_id seller_city seller_state batch_id source_file_name"),
        ("bigint", "seller_zip_code_prefix"),
        ("timestamp", "ingested_at_utc"),
    ),
    "stg_products": (
        ("string", "product_id product_category_name batch_id source_file_name"),
        ("bigint", "product_name_length product_description_length product_photos_count"),
        (
            "decimal(28,9)",
            "product_weight_g product_length_cm product_height_cm product_width_cm"
        ),
        ("timestamp", "ingested_at_utc"),
    ),
    "stg_geolocation": (
        ("bigint", "geolocation_zip_code_prefix"),
        ("double", "geolocation_lat geolocation_lng"),
        (
            "string",
            "geolocation_city geolocation_state batch_id source_file_name "
            "geolocation_observation_key"
        ),
        ("timestamp", "ingested_at_utc"),
    ),
    "stg_holidays": (
        ("date", "holiday_date"),
        (
            "string",
            "local_name holiday_name country_code counties_json holiday_types_json batch_id "
            "source_file_name"
        ),
        ("boolean", "is_global"),
        ("bigint", "launch_year"),
        ("timestamp", "ingested_at_utc"),
    ),
    "stg_weather_daily": (
        ("date", "weather_date"),
        ("string", "location_key timezone units batch_id source_file_name"),
        (
            "double",
            "latitude longitude cloud_cover_afternoon humidity_afternoon "
            "precipitation_total temperature_min temperature_max temperature_afternoon "
            "temperature_night temperature_evening temperature_morning pressure_afternoon "
            "wind_max_speed wind_max_direction"
        ),
        ("timestamp", "ingested_at_utc"),
    ),
    "dim_date": (
        (
            "date",
            "calendar_date first_day_of_month first_day_of_quarter first_day_of_year "
            "last_day_of_month"
        ),
        ("bigint", "year quarter month iso_week day_of_month day_of_week"),
        ("string", "month_name day_name holiday_name"),
        ("boolean", "is_weekend is_holiday"),
    ),
    "dim_customer": (
        ("string", "customer_unique_id customer_city customer_state"),
        ("bigint", "customer_zip_code_prefix"),
    ),
    "dim_product": (
        ("string", "product_id product_category_name"),
        ("bigint", "product_name_length product_description_length product_photos_count"),
        (
            "decimal(28,9)",
            "product_weight_g product_length_cm product_height_cm product_width_cm"
        ),
    ),
    "dim_seller": (
        ("string", "seller_id seller_city seller_state"),
        ("bigint", "seller_zip_code_prefix"),
    ),
    "int_order_value": (
        ("string", "order_id"),
        ("decimal(28,9)", "order_item_value order_freight_total order_payment_total"),
        ("bigint", "order_items_count payment_methods_count"),
    ),
    "order_flags": (
        ("string", "order_id customer_id order_status"),
        (
            "timestamp",
            "order_purchased_at_utc order_approved_at_utc order_delivered_to_carrier_at_utc "
            "order_delivered_to_customer_at_utc order_estimated_delivery_at_utc"
        ),
        ("date", "purchase_date delivery_date"),
        ("boolean", "is_delivered is_late is_cancelled"),
        ("bigint", "late_days"),
    ),
    "int_order_delivery": (
        (
            "string",
            "order_id customer_id order_status holiday_name_at_purchase "
            "delivery_weather_location_key"
        ),
        (
            "timestamp",
            "order_purchased_at_utc order_approved_at_utc order_delivered_to_carrier_at_utc "
            "order_delivered_to_customer_at_utc order_estimated_delivery_at_utc"
        ),
        ("date", "purchase_date delivery_date"),
        ("boolean", "is_delivered is_late is_cancelled is_purchase_on_holiday"),
        ("bigint", "late_days"),
        (
            "double",
            "delivery_temperature_max delivery_temperature_min delivery_precipitation_total "
            "delivery_humidity_afternoon"
        ),
    ),
    "int_customer_order_sequence": (
        (
            "string",
            "order_id customer_id customer_unique_id customer_city customer_state "
            "order_status"
        ),
        ("timestamp", "order_purchased_at_utc"),
        ("bigint", "customer_order_number"),
        ("boolean", "is_first_order"),
    ),
    "fact_orders": (
        (
            "string",
            "order_id customer_id customer_unique_id customer_city_at_order "
            "customer_state_at_order order_status holiday_name_at_purchase "
            "delivery_weather_location_key"
        ),
        (
            "bigint",
            "customer_zip_code_prefix_at_order late_days customer_order_number "
            "order_items_count payment_methods_count"
        ),
        (
            "timestamp",
            "order_purchased_at_utc order_approved_at_utc order_delivered_to_carrier_at_utc "
            "order_delivered_to_customer_at_utc order_estimated_delivery_at_utc "
            "dbt_updated_at"
        ),
        ("date", "purchase_date delivery_date"),
        ("boolean", "is_delivered is_late is_cancelled is_first_order is_purchase_on_holiday"),
        (
            "decimal(28,9)",
            "order_item_value order_freight_total order_payment_total "
            "order_total_with_freight"
        ),
        (
            "double",
            "delivery_temperature_max delivery_temperature_min delivery_precipitation_total "
            "delivery_humidity_afternoon"
        ),
    ),
    "fact_order_items": (
        (
            "string",
            "order_id customer_id customer_unique_id customer_city_at_order "
            "customer_state_at_order seller_id product_id product_category_name "
            "order_status"
        ),
        ("bigint", "order_item_id customer_zip_code_prefix_at_order late_days"),
        ("date", "purchase_date delivery_date"),
        ("timestamp", "shipping_limit_at_utc"),
        ("decimal(28,9)", "item_price freight_value item_total_with_freight"),
        ("boolean", "is_delivered is_late is_cancelled"),
    ),
    "int_review_enriched": (
        (
            "string",
            "review_id order_id review_comment_title review_comment_message "
            "primary_product_category delivery_delay_bucket"
        ),
        ("bigint", "review_score late_days time_to_review_days"),
        (
            "timestamp",
            "review_created_at_utc review_answered_at_utc "
            "order_delivered_to_customer_at_utc"
        ),
        ("boolean", "is_delivered is_late is_cancelled has_comment"),
        ("date", "purchase_date"),
    ),
    "fact_reviews": (
        (
            "string",
            "review_id order_id customer_id customer_unique_id customer_city_at_order "
            "customer_state_at_order review_comment_title review_comment_message "
            "primary_product_category delivery_delay_bucket"
        ),
        (
            "bigint",
            "customer_zip_code_prefix_at_order review_score late_days time_to_review_days"
        ),
        ("boolean", "has_comment is_delivered is_late is_cancelled"),
        ("timestamp", "review_created_at_utc review_answered_at_utc delivered_at_utc"),
        ("date", "purchase_date"),
    ),
    "int_order_review_metrics": (
        ("string", "order_id"),
        ("bigint", "reviews_count commented_reviews_count"),
        ("double", "avg_review_score_for_order avg_time_to_review_days_for_order"),
    ),
    "int_seller_daily_performance": (
        ("string", "seller_id"),
        ("date", "calendar_date"),
        (
            "bigint",
            "orders_count items_count non_cancelled_orders_count delivered_orders_count "
            "cancelled_orders_count late_orders_count operational_defect_orders_count"
        ),
        ("decimal(28,9)", "items_value freight_total gmv"),
    ),
    "int_seller_attributable_experience": (
        ("string", "seller_id order_id"),
        ("date", "calendar_date"),
        ("bigint", "reviews_count commented_reviews_count"),
        ("double", "avg_review_score_for_order avg_time_to_review_days_for_order"),
        ("boolean", "is_reviewed_order is_low_review_order"),
    ),
}


TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(28,9)": T.DecimalType(28, 9),
    "decimal(38,9)": T.DecimalType(38, 9),
}


def struct_of(columns: dict[str, str], required: tuple[str, ...] = ()) -> T.StructType:
    """Schema from column -> type name; needs no running session."""
    return T.StructType(
        [T.StructField(name, TYPES[kind], name not in required) for name, kind in columns.items()]
    )


def columns_of(name: str) -> dict[str, str]:
    """Column -> type of any relation."""
    groups = MART_COLUMNS[name] if name in MART_COLUMNS else RELATION_COLUMNS[name]
    return {column: kind for kind, columns in groups for column in columns.split()}


def mart_schema(name: str) -> T.StructType:
    return struct_of(columns_of(name))


class ContractError(ValueError):
    """A relation differs from its published schema."""


def differences(frame: DataFrame, schema: T.StructType) -> list[str]:
    """What keeps a frame from matching a schema: missing, extra, type or order."""
    actual = {f.name: f.dataType for f in frame.schema}
    wanted = {f.name: f.dataType for f in schema}
    found = [f"missing {n}" for n in wanted if n not in actual]
    found += [f"extra {n}" for n in actual if n not in wanted]
    found += [
        f"{n} is {actual[n].simpleString()}, not {kind.simpleString()}"
        for n, kind in wanted.items()
        if n in actual and actual[n] != kind
    ]
    if not found and list(actual) != list(wanted):
        found.append("columns are in another order")
    return found


def enforce(frame: DataFrame, name: str) -> DataFrame:
    """Return the frame unchanged, or fail before anything is written."""
    found = differences(frame, mart_schema(name))
    if found:
        raise ContractError(f"{name}: {'; '.join(found)}")
    return frame


def shape(frame: DataFrame, name: str) -> DataFrame:
    """Project a computed mart onto its contract."""
    return frame.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in mart_schema(name)])
