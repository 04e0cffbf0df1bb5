"""Declared rules of every relation (fixed values of the data contract)."""

from __future__ import annotations

from marketlane.functions.columns import DELAY_BUCKETS
from marketlane.operators.quality import Range, Rules

METADATA = "batch_id ingested_at_utc source_file_name"
ORDER_STATUSES = (
    "created", "approved", "invoiced", "processing", "shipped", "delivered", "canceled",
    "unavailable",
)
PAYMENT_TYPES = ("boleto", "credit_card", "debit_card", "not_defined", "voucher")
UNITS = ("metric", "imperial", "standard")
STATUS = {"order_status": ORDER_STATUSES}
BUCKET = {"delivery_delay_bucket": DELAY_BUCKETS}

_RAW_PRODUCT_MEASURES = (
    "product_name_lenght product_description_lenght product_photos_qty product_weight_g "
    "product_length_cm product_height_cm product_width_cm"
)
_PRODUCT_MEASURES = (
    "product_name_length product_description_length product_photos_count product_weight_g "
    "product_length_cm product_height_cm product_width_cm"
)
_WEATHER_RANGES = (
    Range("cloud_cover_afternoon humidity_afternoon", 0, 100),
    Range("precipitation_total wind_max_speed"),
    Range("wind_max_direction", 0, 360),
)
SELLER_DAY_COUNTS = (
    "items_value freight_total gmv non_cancelled_orders_count delivered_orders_count "
    "cancelled_orders_count late_orders_count operational_defect_orders_count"
)
_FULFILLMENT_COUNTS = (
    "delivered_orders_count late_orders_count cancelled_orders_count late_days_sum "
    "delivery_temperature_max_observation_count delivery_temperature_min_observation_count "
    "delivery_precipitation_total_observation_count delivery_precipitation_total_sum "
    "delivery_humidity_afternoon_observation_count delivery_humidity_afternoon_sum"
)

# Raw relations carry text; range rules compare numbers, so they are cast in the
# raw view the checks read (see queries.raw_view).
RAW_RULES = {
    "raw.customers": Rules(("customer_id",), required=f"customer_unique_id {METADATA}"),
    "raw.geolocation": Rules(required=f"geolocation_zip_code_prefix {METADATA}"),
    "raw.order_items": Rules(
        ("order_id", "order_item_id"),
        required=f"product_id seller_id price freight_value {METADATA}",
        references=(
            ("order_id", "raw.orders", "order_id"),
            ("product_id", "raw.products", "product_id"),
            ("seller_id", "raw.sellers", "seller_id"),
        ),
        ranges=(Range("price freight_value"),),
    ),
    "raw.order_payments": Rules(
        ("order_id", "payment_sequential"),
        required=f"payment_type payment_installments payment_value {METADATA}",
        references=(("order_id", "raw.orders", "order_id"),),
        allowed={"payment_type": PAYMENT_TYPES},
        ranges=(Range("payment_installments payment_value"),),
    ),
    "raw.order_reviews": Rules(
        ("review_id", "order_id"),
        required=f"review_score {METADATA}",
        references=(("order_id", "raw.orders", "order_id"),),
        ranges=(Range("review_score", 1, 5),),
    ),
    "raw.orders": Rules(
        ("order_id",),
        required=f"customer_id order_status order_purchase_timestamp {METADATA}",
        references=(("customer_id", "raw.customers", "customer_id"),),
        allowed=STATUS,
    ),
    "raw.products": Rules(
        ("product_id",), required=METADATA, ranges=(Range(_RAW_PRODUCT_MEASURES),)
    ),
    "raw.sellers": Rules(("seller_id",), required=METADATA),
    "raw.holidays": Rules(("holiday_date", "country_code", "holiday_name"), required=METADATA),
    "raw.weather_daily": Rules(
        ("weather_date", "location_key"),
        required=f"latitude longitude units {METADATA}",
        allowed={"units": UNITS},
        ranges=_WEATHER_RANGES,
    ),
}

STAGING_RULES = {
    "stg_orders": Rules(
        ("order_id",),
        required=f"customer_id order_status order_purchased_at_utc {METADATA}",
        references=(("customer_id", "stg_customers", "customer_id"),),
        allowed=STATUS,
    ),
    "stg_order_items": Rules(
        ("order_id", "order_item_id"),
        required=f"product_id seller_id item_price freight_value {METADATA}",
        references=(
            ("order_id", "stg_orders", "order_id"),
            ("product_id", "stg_products", "product_id"),
            ("seller_id", "stg_sellers", "seller_id"),
        ),
        ranges=(Range("item_price", 0, inclusive=False), Range("freight_value")),
    ),
    "stg_payments": Rules(
        ("order_id", "payment_sequence"),
        required=f"payment_type payment_installments_count payment_value {METADATA}",
        references=(("order_id", "stg_orders", "order_id"),),
        allowed={"payment_type": PAYMENT_TYPES},
        ranges=(Range("payment_installments_count payment_value"),),
    ),
    "stg_reviews": Rules(
        ("review_id", "order_id"),
        required=f"review_score review_created_at_utc {METADATA}",
        references=(("order_id", "stg_orders", "order_id"),),
        ranges=(Range("review_score", 1, 5),),
    ),
    "stg_customers": Rules(
        ("customer_id",),
        required=f"customer_unique_id customer_state {METADATA}",
        ranges=(Range("customer_zip_code_prefix"),),
    ),
    "stg_sellers": Rules(
        ("seller_id",),
        required=f"seller_state {METADATA}",
        ranges=(Range("seller_zip_code_prefix"),),
    ),
    "stg_products": Rules(("product_id",), required=METADATA, ranges=(Range(_PRODUCT_MEASURES),)),
    "stg_geolocation": Rules(
        ("geolocation_observation_key",),
        required=(
            "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city "
            f"geolocation_state {METADATA}"
        ),
        ranges=(
            Range("geolocation_zip_code_prefix"),
            Range("geolocation_lat", -90, 90),
            Range("geolocation_lng", -180, 180),
        ),
    ),
    "stg_holidays": Rules(("holiday_date", "country_code", "holiday_name"), required=METADATA),
    "stg_weather_daily": Rules(
        ("weather_date", "location_key"),
        required=f"latitude longitude units {METADATA}",
        allowed={"units": UNITS},
        ranges=(Range("latitude", -90, 90), Range("longitude", -180, 180), *_WEATHER_RANGES),
    ),
}

INTERMEDIATE_RULES = {
    "int_order_value": Rules(
        ("order_id",),
        required="order_item_value order_freight_total order_items_count",
        ranges=(
            Range("order_item_value order_freight_total order_items_count order_payment_total"),
            Range("payment_methods_count", 1),
        ),
    ),
    "int_order_delivery": Rules(
        ("order_id",),
        required=(
            "customer_id order_status order_purchased_at_utc purchase_date is_delivered is_late "
            "is_cancelled is_purchase_on_holiday"
        ),
        ranges=(Range("late_days", 1),),
    ),
    "int_order_review_metrics": Rules(
        ("order_id",),
        required="reviews_count commented_reviews_count",
        ranges=(
            Range("reviews_count", 1),
            Range("commented_reviews_count"),
            Range("avg_review_score_for_order", 1, 5),
        ),
    ),
    "int_customer_order_sequence": Rules(
        ("customer_id", "order_id"),
        required=(
            "customer_unique_id order_purchased_at_utc customer_order_number is_first_order "
            "customer_state"
        ),
        more_keys=(("customer_unique_id", "customer_order_number"),),
        ranges=(Range("customer_order_number", 1),),
    ),
    "int_review_enriched": Rules(
        ("review_id", "order_id"),
        required=(
            "review_score review_created_at_utc has_comment delivery_delay_bucket is_delivered "
            "is_late is_cancelled"
        ),
        allowed=BUCKET,
        ranges=(Range("review_score", 1, 5),),
    ),
    "int_seller_daily_performance": Rules(
        ("seller_id", "calendar_date"),
        required=f"orders_count items_count {SELLER_DAY_COUNTS}",
        ranges=(Range("orders_count items_count", 1), Range(SELLER_DAY_COUNTS)),
    ),
    "int_seller_attributable_experience": Rules(
        ("seller_id", "order_id"),
        required="calendar_date is_reviewed_order is_low_review_order",
        ranges=(
            Range("reviews_count commented_reviews_count"),
            Range("avg_review_score_for_order", 1, 5),
        ),
    ),
}

DIMENSION_RULES = {
    "dim_date": Rules(
        ("calendar_date",),
        required=(
            "year quarter month month_name iso_week day_of_month day_of_week day_name is_weekend "
            "is_holiday first_day_of_month first_day_of_quarter first_day_of_year "
            "last_day_of_month"
        ),
        ranges=(
            Range("quarter", 1, 4),
            Range("month", 1, 12),
            Range("iso_week", 1, 53),
            Range("day_of_month", 1, 31),
            Range("day_of_week", 1, 7),
        ),
    ),
    "dim_customer": Rules(
        ("customer_unique_id",),
        required="customer_state",
        ranges=(Range("customer_zip_code_prefix"),),
    ),
    "dim_seller": Rules(
        ("seller_id",), required="seller_state", ranges=(Range("seller_zip_code_prefix"),)
    ),
    "dim_product": Rules(("product_id",), ranges=(Range(_PRODUCT_MEASURES),)),
}

FACT_RULES = {
    "fact_orders": Rules(
        ("order_id",),
        required=(
            "customer_id customer_unique_id customer_state_at_order order_status "
            "order_purchased_at_utc purchase_date is_delivered is_late is_cancelled "
            "customer_order_number is_first_order order_item_value order_freight_total "
            "order_items_count order_total_with_freight is_purchase_on_holiday dbt_updated_at"
        ),
        references=(
            ("customer_unique_id", "dim_customer", "customer_unique_id"),
            ("purchase_date", "dim_date", "calendar_date"),
            ("delivery_date", "dim_date", "calendar_date"),
        ),
        allowed=STATUS,
        ranges=(
            Range(
                "customer_zip_code_prefix_at_order order_item_value order_freight_total "
                "order_items_count order_payment_total order_total_with_freight"
            ),
            Range("late_days customer_order_number payment_methods_count", 1),
        ),
    ),
    "fact_order_items": Rules(
        ("order_id", "order_item_id"),
        required=(
            "customer_id customer_unique_id customer_state_at_order seller_id product_id "
            "order_status purchase_date item_price freight_value item_total_with_freight "
            "is_delivered is_late is_cancelled"
        ),
        references=(
            ("order_id", "fact_orders", "order_id"),
            ("customer_unique_id", "dim_customer", "customer_unique_id"),
            ("seller_id", "dim_seller", "seller_id"),
            ("product_id", "dim_product", "product_id"),
            ("purchase_date", "dim_date", "calendar_date"),
            ("delivery_date", "dim_date", "calendar_date"),
        ),
        allowed=STATUS,
        ranges=(
            Range("order_item_id late_days", 1),
            Range("customer_zip_code_prefix_at_order freight_value"),
            Range("item_price item_total_with_freight", 0, inclusive=False),
        ),
    ),
    "fact_reviews": Rules(
        ("review_id", "order_id"),
        required=(
            "customer_id customer_unique_id customer_state_at_order review_score has_comment "
            "review_created_at_utc purchase_date is_delivered is_late is_cancelled "
            "delivery_delay_bucket"
        ),
        references=(
            ("order_id", "fact_orders", "order_id"),
            ("customer_unique_id", "dim_customer", "customer_unique_id"),
            ("purchase_date", "dim_date", "calendar_date"),
        ),
        allowed=BUCKET,
        ranges=(
            Range("customer_zip_code_prefix_at_order"),
            Range("review_score", 1, 5),
            Range("late_days", 1),
        ),
    ),
}

_EXEC_COUNTS = (
    "non_cancelled_orders_count cancelled_orders_count delivered_orders_count late_orders_count "
    "new_customers_count gmv items_value freight_total payment_total"
)
MART_RULES = {
    "mart_exec_daily": Rules(
        ("calendar_date",),
        required=(
            "year quarter month iso_week day_of_week is_weekend is_holiday orders_count "
            f"{_EXEC_COUNTS} cancellation_rate reviews_count review_score_sum"
        ),
        references=(("calendar_date", "dim_date", "calendar_date"),),
        ranges=(
            Range("orders_count", 1),
            Range(f"{_EXEC_COUNTS} aov reviews_count review_score_sum"),
            Range("cancellation_rate late_delivery_rate", 0, 1),
            Range("avg_review_score", 1, 5),
        ),
    ),
    "mart_seller_performance": Rules(
        ("seller_id", "calendar_date"),
        required=(
            f"orders_count items_count {SELLER_DAY_COUNTS} cancellation_rate "
            "operational_defect_rate"
        ),
        references=(
            ("seller_id", "dim_seller", "seller_id"),
            ("calendar_date", "dim_date", "calendar_date"),
        ),
        ranges=(
            Range("orders_count items_count", 1),
            Range(f"{SELLER_DAY_COUNTS} aov"),
            Range("cancellation_rate late_delivery_rate operational_defect_rate", 0, 1),
        ),
    ),
    "mart_seller_experience": Rules(
        ("seller_id", "calendar_date"),
        required=(
            "attributable_orders_count reviewed_attributable_orders_count review_coverage_rate "
            "reviews_count commented_reviews_count low_review_orders_count"
        ),
        references=(
            ("seller_id", "dim_seller", "seller_id"),
            ("calendar_date", "dim_date", "calendar_date"),
        ),
        ranges=(
            Range("attributable_orders_count", 1),
            Range(
                "reviewed_attributable_orders_count reviews_count commented_reviews_count "
                "low_review_orders_count"
            ),
            Range("review_coverage_rate low_review_rate", 0, 1),
            Range("avg_review_score", 1, 5),
        ),
    ),
    "mart_fulfillment_ops": Rules(
        ("purchase_date", "customer_state", "delivery_delay_bucket"),
        required=(
            f"orders_count is_purchase_on_holiday {_FULFILLMENT_COUNTS} "
            "delivery_temperature_max_sum delivery_temperature_min_sum"
        ),
        references=(("purchase_date", "dim_date", "calendar_date"),),
        allowed=BUCKET,
        ranges=(
            Range("orders_count avg_late_days", 1),
            Range(_FULFILLMENT_COUNTS),
            Range("late_delivery_rate", 0, 1),
        ),
    ),
    "mart_customer_experience": Rules(
        ("purchase_date", "customer_state", "delivery_delay_bucket"),
        required="orders_count reviewed_orders_count reviews_count commented_reviews_count",
        references=(("purchase_date", "dim_date", "calendar_date"),),
        allowed=BUCKET,
        ranges=(
            Range("orders_count", 1),
            Range("reviewed_orders_count reviews_count commented_reviews_count"),
            Range("avg_review_score", 1, 5),
        ),
    ),
}

SNAPSHOT_RULES = {
    name: Rules(
        (key,),
        key_where="dbt_valid_to IS NULL",
        required="dbt_scd_id dbt_valid_from",
        more_keys=((key, "dbt_valid_from"), ("dbt_scd_id",)),
    )
    for name, key in (("snap_sellers", "seller_id"), ("snap_products", "product_id"))
}

ALL_RULES = {
    **RAW_RULES,
    **STAGING_RULES,
    **INTERMEDIATE_RULES,
    **DIMENSION_RULES,
    **FACT_RULES,
    **MART_RULES,
    **SNAPSHOT_RULES,
}
