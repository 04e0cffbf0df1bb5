"""Dashboard cards: one question each, over a published mart, with optional filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.functions.columns import LATE_BANDS, NOT_DELIVERED, ON_TIME, money_ratio, ratio, week_start

DateRange = tuple[date | str | None, date | str | None]

# Ranking lists show this many sellers, and prefer those with at
# least this many orders behind the rate.
TOP_SELLERS = 15
MIN_SUPPORT = 5


def _in_range(frame: DataFrame, column: str, date_range: DateRange | None) -> DataFrame:
    if date_range is None:
        return frame
    first, last = date_range
    if first is not None:
        frame = frame.filter(F.col(column) >= F.lit(first).cast("date"))
    if last is not None:
        frame = frame.filter(F.col(column) <= F.lit(last).cast("date"))
    return frame


def _equals(frame: DataFrame, **wanted: object) -> DataFrame:
    """Keep rows equal to each given value; a list means any of its values."""
    for column, value in wanted.items():
        if value is None:
            continue
        values = list(value) if isinstance(value, (list, tuple, set)) else [value]
        frame = frame.filter(F.col(column).isin(values))
    return frame


def _total(name: str) -> Column:
    return F.sum(name).alias(name)


# --- Executive -------------------------------------------------------------


def _exec(mart: DataFrame, date_range: DateRange | None) -> DataFrame:
    return _in_range(mart, "calendar_date", date_range)


def _exec_weeks(mart: DataFrame, date_range: DateRange | None, *aggregates: Column) -> DataFrame:
    return (
        _exec(mart, date_range)
        .groupBy(week_start("calendar_date").alias("calendar_date"))
        .agg(*aggregates)
        .orderBy("calendar_date")
    )


def exec_gmv_kpi(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec(mart, date_range).agg(_total("gmv"))


def exec_orders_kpi(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec(mart, date_range).agg(_total("orders_count"))


def exec_new_customers_kpi(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec(mart, date_range).agg(_total("new_customers_count"))


def exec_aov_kpi(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec(mart, date_range).agg(
        money_ratio(F.sum("gmv"), F.sum("non_cancelled_orders_count")).alias("aov")
    )


def _ratio_of_sums(numerator: str, denominator: str, name: str) -> Column:
    return ratio(F.sum(numerator), F.sum(denominator)).alias(name)


CANCELLATION = ("cancelled_orders_count", "orders_count", "cancellation_rate")
LATENESS = ("late_orders_count", "delivered_orders_count", "late_delivery_rate")
SENTIMENT = ("review_score_sum", "reviews_count", "avg_review_score")


def exec_cancellation_rate_kpi(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec(mart, date_range).agg(_ratio_of_sums(*CANCELLATION))


def exec_late_delivery_rate_kpi(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec(mart, date_range).agg(_ratio_of_sums(*LATENESS))


def exec_avg_review_score_kpi(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec(mart, date_range).agg(_ratio_of_sums(*SENTIMENT))


def exec_gmv_orders_trend(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec_weeks(mart, date_range, _total("gmv"), _total("orders_count"))


def exec_cancellation_vs_late_trend(
    mart: DataFrame, date_range: DateRange | None = None
) -> DataFrame:
    return _exec_weeks(
        mart, date_range, _ratio_of_sums(*CANCELLATION), _ratio_of_sums(*LATENESS)
    )


def exec_new_customers_trend(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec_weeks(mart, date_range, _total("new_customers_count"))


def exec_review_score_trend(mart: DataFrame, date_range: DateRange | None = None) -> DataFrame:
    return _exec_weeks(mart, date_range, _ratio_of_sums(*SENTIMENT), _total("reviews_count"))


# --- Fulfilment ------------------------------------------------------------


def _fulfillment(
    mart: DataFrame,
    date_range: DateRange | None = None,
    customer_state: object = None,
    delivery_delay_bucket: object = None,
    holiday_flag: bool | None = None,
) -> DataFrame:
    return _equals(
        _in_range(mart, "purchase_date", date_range),
        customer_state=customer_state,
        delivery_delay_bucket=delivery_delay_bucket,
        is_purchase_on_holiday=holiday_flag,
    )


def fulfillment_delay_rate_by_state(mart: DataFrame, **filters) -> DataFrame:
    percent = F.round(ratio("late_orders_count", "delivered_orders_count") * 100, 2)
    return (
        _fulfillment(mart, **filters)
        .groupBy("customer_state")
        .agg(_total("orders_count"), _total("late_orders_count"), _total("delivered_orders_count"))
        .withColumn("late_delivery_rate_pct", percent)
        .orderBy(
            F.desc_nulls_last("late_delivery_rate_pct"),
            F.desc("orders_count"),
            F.asc_nulls_first("customer_state"),
        )
    )


def fulfillment_avg_late_days_by_state(mart: DataFrame, **filters) -> DataFrame:
    return (
        _fulfillment(mart, **filters)
        .groupBy("customer_state")
        .agg(
            _ratio_of_sums("late_days_sum", "late_orders_count", "avg_late_days"),
            _total("late_orders_count"),
        )
        .orderBy(
            F.desc_nulls_last("avg_late_days"),
            F.desc("late_orders_count"),
            F.asc_nulls_first("customer_state"),
        )
    )


def fulfillment_cancelled_order_trend(mart: DataFrame, **filters) -> DataFrame:
    return (
        _fulfillment(mart, **filters)
        .groupBy(week_start("purchase_date").alias("purchase_date"))
        .agg(_total("cancelled_orders_count"))
        .orderBy("purchase_date")
    )


# Labels of the delay buckets in display order, and the two mixes.
BUCKET_LABELS = {
    ON_TIME: "On Time",
    LATE_BANDS[0][2]: "1-3 Days Late",
    LATE_BANDS[1][2]: "4-7 Days Late",
    LATE_BANDS[2][2]: "8-14 Days Late",
    LATE_BANDS[3][2]: "15+ Days Late",
    NOT_DELIVERED: "Not Delivered",
}
ALL_ORDERS_MIX = "All Orders Mix"
LATE_OR_FAILED_MIX = "Late / Failed Mix"


def fulfillment_delay_bucket_distribution(mart: DataFrame, **filters) -> DataFrame:
    """Bucket mix of all orders and of those not on time; the mart is read once."""
    bucket = F.col("delivery_delay_bucket")
    views = F.when(bucket == ON_TIME, F.array(F.lit(ALL_ORDERS_MIX))).otherwise(
        F.array(F.lit(ALL_ORDERS_MIX), F.lit(LATE_OR_FAILED_MIX))
    )
    label, place = bucket, F.lit(len(BUCKET_LABELS) + 1)
    for position, (name, text) in enumerate(BUCKET_LABELS.items(), start=1):
        label = F.when(bucket == name, text).otherwise(label)
        place = F.when(bucket == name, position).otherwise(place)
    return (
        _fulfillment(mart, **filters)
        .groupBy("delivery_delay_bucket")
        .agg(_total("orders_count"))
        .select(
            F.explode(views).alias("distribution_view"),
            label.alias("delay_bucket"),
            "orders_count",
            place.alias("_place"),
        )
        .orderBy("distribution_view", "_place")
        .drop("_place")
    )


def fulfillment_holiday_impact(mart: DataFrame, **filters) -> DataFrame:
    cohort = F.when(F.col("is_purchase_on_holiday"), "Holiday").otherwise("Non-Holiday")
    return (
        _fulfillment(mart, **filters)
        .groupBy(cohort.alias("holiday_cohort"))
        .agg(_total("orders_count"), _ratio_of_sums(*LATENESS))
        .orderBy("holiday_cohort")
    )


# Upper limits (exclusive) and labels of the weather bands. Rain
# has a band of its own for exactly zero.
RAIN_BANDS = (
    (1, ">0 to <1 mm"),
    (2, "1 to <2 mm"),
    (4, "2 to <4 mm"),
    (6, "4 to <6 mm"),
    (None, "6+ mm"),
)
NO_RAIN = "0 mm"
HEAT_BANDS = (
    (22, "<22 C"),
    (24, "22 to <24 C"),
    (26, "24 to <26 C"),
    (28, "26 to <28 C"),
    (30, "28 to <30 C"),
    (None, "30+ C"),
)


def _late_rate_by_band(
    mart: DataFrame, measure: str, name: str, bands: list[tuple[Column, str]], filters: dict
) -> DataFrame:
    label = F.coalesce(*[F.when(test, text) for test, text in bands])
    place = F.coalesce(*[F.when(test, F.lit(n)) for n, (test, _) in enumerate(bands, start=1)])
    return (
        _fulfillment(mart, **filters)
        .filter(F.col(measure).isNotNull())
        .groupBy(label.alias(name), place.cast("bigint").alias("bucket_sort"))
        .agg(
            _total("delivered_orders_count"),
            _total("late_orders_count"),
            _ratio_of_sums(*LATENESS),
            _total("orders_count"),
        )
        .orderBy("bucket_sort")
    )


def _below(measure: str, bands: tuple) -> list[tuple[Column, str]]:
    return [
        (F.lit(True) if limit is None else F.col(measure) < limit, text) for limit, text in bands
    ]


def fulfillment_late_rate_by_precipitation_bucket(mart: DataFrame, **filters) -> DataFrame:
    measure = "avg_delivery_precipitation_total"
    bands = [(F.col(measure) == 0, NO_RAIN), *_below(measure, RAIN_BANDS)]
    return _late_rate_by_band(mart, measure, "precipitation_bucket", bands, filters)


def fulfillment_late_rate_by_temperature_bucket(mart: DataFrame, **filters) -> DataFrame:
    measure = "avg_delivery_temperature_max"
    bands = _below(measure, HEAT_BANDS)
    return _late_rate_by_band(mart, measure, "temperature_bucket", bands, filters)


# --- Sellers ---------------------------------------------------------------


def _sellers(
    mart: DataFrame,
    sellers: DataFrame,
    sums: list[str],
    date_range: DateRange | None = None,
    seller_id: object = None,
    seller_state: object = None,
) -> DataFrame:
    """Totals per seller with label and state.

    The mart shrinks to one row per seller before it meets the dimension. State
    depends on the seller alone, so its filter gives the same rows afterwards.
    """
    totals = (
        _equals(_in_range(mart, "calendar_date", date_range), seller_id=seller_id)
        .groupBy("seller_id")
        .agg(*[_total(name) for name in sums])
    )
    short = F.concat(F.left("seller_id", F.lit(8)), F.lit("..."))
    place = F.concat("seller_city", F.lit(", "), "seller_state", F.lit(" ("), short, F.lit(")"))
    joined = totals.join(
        sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "left"
    )
    return _equals(joined, seller_state=seller_state).withColumn(
        "seller_label", F.coalesce(place, short)
    )


def seller_top_gmv(mart: DataFrame, sellers: DataFrame, **filters) -> DataFrame:
    return (
        _sellers(mart, sellers, ["gmv"], **filters)
        .select("seller_id", "seller_label", "seller_state", "gmv")
        .orderBy(F.desc_nulls_last("gmv"), "seller_id")
        .limit(TOP_SELLERS)
    )


def seller_top_aov(mart: DataFrame, sellers: DataFrame, **filters) -> DataFrame:
    orders = "non_cancelled_orders_count"
    return (
        _sellers(mart, sellers, ["gmv", orders], **filters)
        .select(
            "seller_id",
            "seller_label",
            "seller_state",
            money_ratio("gmv", orders).alias("aov"),
            "gmv",
            orders,
        )
        .orderBy(
            F.desc(F.col(orders) >= MIN_SUPPORT),
            F.desc_nulls_last("aov"),
            F.desc_nulls_last("gmv"),
            F.desc(orders),
            "seller_id",
        )
        .limit(TOP_SELLERS)
    )


def _burden_ranking(
    mart: DataFrame, sellers: DataFrame, burden: str, support: str, rate: str, filters: dict
) -> DataFrame:
    """Well-supported sellers first, then the largest burden, then the highest rate."""
    return (
        _sellers(mart, sellers, [burden, support], **filters)
        .select(
            "seller_id",
            "seller_label",
            "seller_state",
            ratio(burden, support).alias(rate),
            burden,
            support,
        )
        .orderBy(
            F.desc(F.col(support) >= MIN_SUPPORT),
            F.col(rate).isNull(),
            F.desc(burden),
            F.desc_nulls_last(rate),
            F.desc(support),
            "seller_id",
        )
        .limit(TOP_SELLERS)
    )


def seller_late_delivery_ranking(mart: DataFrame, sellers: DataFrame, **filters) -> DataFrame:
    return _burden_ranking(mart, sellers, *LATENESS, filters)


def seller_cancellation_ranking(mart: DataFrame, sellers: DataFrame, **filters) -> DataFrame:
    return _burden_ranking(mart, sellers, *CANCELLATION, filters)


def seller_operational_defect_view(mart: DataFrame, sellers: DataFrame, **filters) -> DataFrame:
    return _burden_ranking(
        mart,
        sellers,
        "operational_defect_orders_count",
        "orders_count",
        "operational_defect_rate",
        filters,
    ).select(
        "seller_id",
        "seller_label",
        "seller_state",
        "operational_defect_orders_count",
        "orders_count",
        "operational_defect_rate",
    )


EXECUTIVE_CARDS = (
    exec_gmv_kpi,
    exec_orders_kpi,
    exec_new_customers_kpi,
    exec_aov_kpi,
    exec_cancellation_rate_kpi,
    exec_late_delivery_rate_kpi,
    exec_avg_review_score_kpi,
    exec_gmv_orders_trend,
    exec_cancellation_vs_late_trend,
    exec_new_customers_trend,
    exec_review_score_trend,
)
FULFILLMENT_CARDS = (
    fulfillment_delay_rate_by_state,
    fulfillment_avg_late_days_by_state,
    fulfillment_cancelled_order_trend,
    fulfillment_delay_bucket_distribution,
    fulfillment_holiday_impact,
    fulfillment_late_rate_by_precipitation_bucket,
    fulfillment_late_rate_by_temperature_bucket,
)
SELLER_CARDS = (
    seller_top_gmv,
    seller_top_aov,
    seller_late_delivery_ranking,
    seller_cancellation_ranking,
    seller_operational_defect_view,
)
