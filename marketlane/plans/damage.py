"""Deliberate damage, to show that each assertion reports what it should.

Expressions are plain enough to mean the same in Spark SQL and DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Damage:
    relation: str
    change: dict[str, str] = field(default_factory=dict)
    keep: str | None = None

    def apply(self, frame: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in frame.schema}
        if self.keep:
            frame = frame.filter(self.keep)
        return frame.withColumns(
            {name: F.expr(text).cast(types[name]) for name, text in self.change.items()}
        )

    def sql(self) -> str:
        replaced = ", ".join(f"{text} AS {name}" for name, text in self.change.items())
        columns = f"* REPLACE ({replaced})" if replaced else "*"
        return f"SELECT {columns} FROM {self.relation}" + (f" WHERE {self.keep}" if self.keep else "")


def _bump(column: str, when: str, by: str = "1") -> dict[str, str]:
    return {column: f"{column} + CASE WHEN {when} THEN {by} ELSE 0 END"}


DAMAGE = {
    "h07": Damage(
        "mart_customer_experience", _bump("orders_count", "delivery_delay_bucket = 'on_time'")
    ),
    "h08": Damage(
        "int_customer_order_sequence", keep="NOT (is_first_order AND customer_state = 'NATION_3')"
    ),
    "h09": Damage(
        "int_order_delivery", {"is_delivered": "is_delivered OR order_status = 'shipped'"}
    ),
    "h10": Damage("dim_date", keep="day_of_week <> 1"),
    "h11": Damage("fact_order_items", _bump("item_price", "is_late")),
    "h12": Damage(
        "fact_orders",
        {
            "customer_city_at_order": (
                "CASE WHEN is_late THEN 'elsewhere' ELSE customer_city_at_order END"
            )
        },
    ),
    "h13": Damage("fact_orders", {"is_purchase_on_holiday": "is_purchase_on_holiday OR is_late"}),
    "h14": Damage("fact_orders", keep="order_status <> 'canceled'"),
    "h15": Damage(
        "int_order_delivery",
        {
            "is_purchase_on_holiday": (
                "CASE WHEN is_cancelled THEN NULL ELSE is_purchase_on_holiday END"
            )
        },
    ),
    "h16": Damage("int_order_value", keep="order_items_count > 0"),
    "h17": Damage(
        "int_review_enriched",
        {
            "delivery_delay_bucket": (
                "CASE WHEN late_days = 8 THEN '4_to_7_days' WHEN is_cancelled THEN 'on_time' "
                "ELSE delivery_delay_bucket END"
            )
        },
    ),
    "h18": Damage(
        "int_seller_attributable_experience",
        {"is_low_review_order": "is_low_review_order OR NOT is_reviewed_order"},
    ),
    "h19": Damage(
        "fact_order_items",
        {"seller_id": "CASE WHEN order_item_id > 3 THEN 'other' ELSE seller_id END"},
    ),
    "h20": Damage("int_seller_daily_performance", _bump("gmv", "late_orders_count > 0", "5")),
    "h21": Damage(
        "int_order_delivery", {"late_days": "CASE WHEN late_days = 3 THEN 0 ELSE late_days END"}
    ),
    "h22": Damage(
        "mart_customer_experience",
        {
            "reviewed_orders_count": (
                "CASE WHEN delivery_delay_bucket = 'on_time' THEN orders_count + 1 "
                "ELSE reviewed_orders_count END"
            )
        },
    ),
    "h23": Damage(
        "mart_customer_experience",
        _bump("avg_review_score", "reviews_count > reviewed_orders_count", "0.5"),
    ),
    "h24": Damage(
        "mart_customer_experience",
        _bump("reviews_count", "delivery_delay_bucket = 'not_delivered'"),
    ),
    "h25": Damage("mart_exec_daily", keep="NOT is_holiday"),
    "h26": Damage("mart_exec_daily", _bump("late_orders_count", "is_weekend")),
    "h27": Damage("mart_exec_daily", _bump("gmv", "is_holiday", "10")),
    "h28": Damage(
        "mart_fulfillment_ops",
        {
            "holiday_name_at_purchase": (
                "CASE WHEN customer_state = 'NATION_5' THEN NULL ELSE holiday_name_at_purchase END"
            )
        },
    ),
    "h29": Damage(
        "mart_fulfillment_ops", _bump("avg_late_days", "delivery_delay_bucket = '8_to_14_days'")
    ),
    "h30": Damage("mart_fulfillment_ops", _bump("late_days_sum", "is_purchase_on_holiday")),
    "h31": Damage(
        "mart_seller_experience",
        {"low_review_rate": "CASE WHEN low_review_orders_count > 0 THEN NULL ELSE low_review_rate END"},
    ),
    "h32": Damage(
        "mart_seller_experience",
        _bump("avg_review_score", "reviews_count > reviewed_attributable_orders_count"),
    ),
    "h33": Damage("mart_seller_experience", _bump("commented_reviews_count", "reviews_count > 0")),
    "h34": Damage(
        "mart_seller_performance",
        {
            "operational_defect_rate": (
                "CASE WHEN cancelled_orders_count > 0 THEN 0 ELSE operational_defect_rate END"
            )
        },
    ),
    "h35": Damage("mart_seller_performance", _bump("aov", "late_orders_count > 0")),
    "h36": Damage(
        "int_order_delivery",
        {"late_days": "CASE WHEN is_delivered AND NOT is_late THEN 0 ELSE late_days END"},
    ),
    "h37": Damage("int_order_value", _bump("order_payment_total", "payment_methods_count = 2")),
    "h41": Damage("stg_weather_daily", keep="temperature_max > 20"),
}
