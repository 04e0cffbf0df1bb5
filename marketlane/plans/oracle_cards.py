"""Dashboard cards and checks as plain SQL (DuckDB), for comparison."""

from __future__ import annotations

from marketlane.plans.oracle_models import checked, with_models

WEEK = "CAST(date_trunc('week', {}) AS DATE)"


def _card(mart: str, columns: str, query: str, *more: str) -> str:
    """``columns`` lists ``name:kind`` pairs of the result."""
    pairs = [tuple(item.split(":")) for item in columns.split()]
    kinds = {"d": "double", "n": "BIGINT", "s": "VARCHAR", "t": "DATE"}
    typed = [(name, kinds[kind]) for name, kind in pairs]
    return with_models([mart, *more], checked(typed, "answer"), ("answer", query))


def _exec(columns: str, select: str) -> str:
    return _card("mart_exec_daily", columns, f"SELECT {select} FROM mart_exec_daily")


def _exec_week(columns: str, select: str) -> str:
    week = WEEK.format("d.calendar_date")
    return _card(
        "mart_exec_daily",
        f"calendar_date:t {columns}",
        f"SELECT {week} AS calendar_date, {select} FROM mart_exec_daily d GROUP BY 1",
    )


AOV = "sum(gmv) / sum(non_cancelled_orders_count) AS aov"
CANCELLED = "sum(cancelled_orders_count) / sum(orders_count) AS cancellation_rate"
LATE = "sum(late_orders_count) / nullif(sum(delivered_orders_count), 0) AS late_delivery_rate"
SCORE = "sum(review_score_sum) / nullif(sum(reviews_count), 0) AS avg_review_score"
OPS = "mart_fulfillment_ops"


def _bands(measure: str, name: str, cases: list[tuple[str, str]]) -> str:
    label = " ".join(f"WHEN {test} THEN '{text}'" for test, text in cases)
    place = " ".join(f"WHEN {test} THEN {n}" for n, (test, _) in enumerate(cases, start=1))
    return _card(
        OPS,
        f"{name}:s bucket_sort:n delivered_orders_count:n late_orders_count:n "
        "late_delivery_rate:d orders_count:n",
        f"""SELECT CASE {label} END AS {name}, CASE {place} END AS bucket_sort,
        sum(delivered_orders_count) AS delivered_orders_count,
        sum(late_orders_count) AS late_orders_count, {LATE}, sum(orders_count) AS orders_count
        FROM (SELECT *, {measure} AS m FROM {OPS}) WHERE m IS NOT NULL GROUP BY 1, 2""",
    )


def _seller(columns: str, select: str, order: str) -> str:
    return _card(
        "mart_seller_performance",
        f"seller_id:s seller_label:s seller_state:s {columns}",
        f"""SELECT seller_id, seller_state, {select},
        coalesce(seller_city || ', ' || seller_state || ' (' || left(seller_id, 8) || '...)',
                 left(seller_id, 8) || '...') AS seller_label
        FROM mart_seller_performance LEFT JOIN dim_seller USING (seller_id)
        GROUP BY seller_id, seller_city, seller_state
        ORDER BY {order}, seller_id LIMIT 15""",
        "dim_seller",
    )


def _burden(rate: str, burden: str, support: str) -> str:
    return _seller(
        f"{rate}:d {burden}:n {support}:n",
        f"sum({burden}) / nullif(sum({support}), 0) AS {rate}, sum({burden}) AS {burden}, "
        f"sum({support}) AS {support}",
        f"sum({support}) < 5, sum({support}) = 0, sum({burden}) DESC, {rate} DESC NULLS LAST, "
        f"sum({support}) DESC",
    )


CARDS = {
    "exec_gmv_kpi": _exec("gmv:d", "sum(gmv) AS gmv"),
    "exec_orders_kpi": _exec("orders_count:n", "sum(orders_count) AS orders_count"),
    "exec_new_customers_kpi": _exec(
        "new_customers_count:n", "sum(new_customers_count) AS new_customers_count"
    ),
    "exec_aov_kpi": _exec("aov:d", AOV),
    "exec_cancellation_rate_kpi": _exec("cancellation_rate:d", CANCELLED),
    "exec_late_delivery_rate_kpi": _exec("late_delivery_rate:d", LATE),
    "exec_avg_review_score_kpi": _exec("avg_review_score:d", SCORE),
    "exec_gmv_orders_trend": _exec_week(
        "gmv:d orders_count:n", "sum(gmv) AS gmv, sum(orders_count) AS orders_count"
    ),
    "exec_cancellation_vs_late_trend": _exec_week(
        "cancellation_rate:d late_delivery_rate:d", f"{CANCELLED}, {LATE}"
    ),
    "exec_new_customers_trend": _exec_week(
        "new_customers_count:n", "sum(new_customers_count) AS new_customers_count"
    ),
    "exec_review_score_trend": _exec_week(
        "avg_review_score:d reviews_count:n", f"{SCORE}, sum(reviews_count) AS reviews_count"
    ),
    "fulfillment_delay_rate_by_state": _card(
        OPS,
        "customer_state:s orders_count:n late_orders_count:n delivered_orders_count:n "
        "late_delivery_rate_pct:d",
        f"""SELECT customer_state, sum(orders_count) AS orders_count,
        sum(late_orders_count) AS late_orders_count,
        sum(delivered_orders_count) AS delivered_orders_count,
        round(100 * sum(late_orders_count) / nullif(sum(delivered_orders_count), 0), 2)
            AS late_delivery_rate_pct FROM {OPS} GROUP BY 1""",
    ),
    "fulfillment_avg_late_days_by_state": _card(
        OPS,
        "customer_state:s avg_late_days:d late_orders_count:n",
        f"""SELECT customer_state, sum(late_orders_count) AS late_orders_count,
        sum(late_days_sum) / nullif(sum(late_orders_count), 0) AS avg_late_days
        FROM {OPS} GROUP BY 1""",
    ),
    "fulfillment_cancelled_order_trend": _card(
        OPS,
        "purchase_date:t cancelled_orders_count:n",
        f"""SELECT {WEEK.format("f.purchase_date")} AS purchase_date,
        sum(cancelled_orders_count) AS cancelled_orders_count FROM {OPS} f GROUP BY 1""",
    ),
    "fulfillment_delay_bucket_distribution": _card(
        OPS,
        "distribution_view:s delay_bucket:s orders_count:n",
        f"""SELECT distribution_view, label AS delay_bucket, sum(orders_count) AS orders_count
        FROM {OPS} JOIN (VALUES ('on_time', 'On Time'), ('1_to_3_days', '1-3 Days Late'),
            ('4_to_7_days', '4-7 Days Late'), ('8_to_14_days', '8-14 Days Late'),
            ('15_plus_days', '15+ Days Late'), ('not_delivered', 'Not Delivered'))
            AS names(delivery_delay_bucket, label) USING (delivery_delay_bucket)
        JOIN (VALUES ('All Orders Mix'), ('Late / Failed Mix')) AS views(distribution_view)
            ON distribution_view LIKE 'All%' OR label <> 'On Time' GROUP BY 1, 2""",
    ),
    "fulfillment_holiday_impact": _card(
        OPS,
        "holiday_cohort:s orders_count:n late_delivery_rate:d",
        f"""SELECT if(is_purchase_on_holiday, 'Holiday', 'Non-Holiday') AS holiday_cohort,
        sum(orders_count) AS orders_count, {LATE} FROM {OPS} GROUP BY 1""",
    ),
    "fulfillment_late_rate_by_precipitation_bucket": _bands(
        "avg_delivery_precipitation_total",
        "precipitation_bucket",
        [
            ("m = 0", "0 mm"),
            ("m < 1", ">0 to <1 mm"),
            ("m < 2", "1 to <2 mm"),
            ("m < 4", "2 to <4 mm"),
            ("m < 6", "4 to <6 mm"),
            ("m >= 6", "6+ mm"),
        ],
    ),
    "fulfillment_late_rate_by_temperature_bucket": _bands(
        "avg_delivery_temperature_max",
        "temperature_bucket",
        [
            ("m < 22", "<22 C"),
            ("m < 24", "22 to <24 C"),
            ("m < 26", "24 to <26 C"),
            ("m < 28", "26 to <28 C"),
            ("m < 30", "28 to <30 C"),
            ("m >= 30", "30+ C"),
        ],
    ),
    "seller_top_gmv": _seller("gmv:d", "sum(gmv) AS gmv", "sum(gmv) DESC"),
    "seller_top_aov": _seller(
        "aov:d gmv:d non_cancelled_orders_count:n",
        "sum(gmv) / nullif(sum(non_cancelled_orders_count), 0) AS aov, sum(gmv) AS gmv, "
        "sum(non_cancelled_orders_count) AS non_cancelled_orders_count",
        "sum(non_cancelled_orders_count) < 5, aov DESC NULLS LAST, sum(gmv) DESC",
    ),
    "seller_late_delivery_ranking": _burden(
        "late_delivery_rate", "late_orders_count", "delivered_orders_count"
    ),
    "seller_cancellation_ranking": _burden(
        "cancellation_rate", "cancelled_orders_count", "orders_count"
    ),
    "seller_operational_defect_view": _burden(
        "operational_defect_rate", "operational_defect_orders_count", "orders_count"
    ),
}


# The cards once more with the filters a dashboard sets: arguments, and the same as SQL
# over the card's mart.
DATES = ("2000-02-10", "2001-04-20")
_WITHIN = "{} BETWEEN DATE '2000-02-10' AND DATE '2001-04-20'"
STATES = ["NATION_3", "NATION_7", "NATION_11"]
_STATES = "customer_state IN ('NATION_3', 'NATION_7', 'NATION_11')"
BUCKETS = ["on_time", "1_to_3_days", "8_to_14_days"]
_FACETS = {
    "fulfillment_delay_bucket_distribution": (
        {"delivery_delay_bucket": BUCKETS},
        "delivery_delay_bucket IN ('on_time', '1_to_3_days', '8_to_14_days')",
    ),
    "fulfillment_cancelled_order_trend": ({"holiday_flag": False}, "NOT is_purchase_on_holiday"),
    "fulfillment_late_rate_by_temperature_bucket": ({"holiday_flag": False}, "NOT is_purchase_on_holiday"),
}
SELLER_STATES = [f"NATION_{n}" for n in range(15)]
_OF_STATE = "seller_id IN (SELECT seller_id FROM dim_seller WHERE seller_state IN ({}))".format(
    ", ".join(f"'{s}'" for s in SELLER_STATES)
)


def filtered(name: str) -> tuple[dict, str]:
    """Filter arguments of a card, and its SQL under them."""
    if name.startswith("exec_"):
        mart, arguments, tests = "mart_exec_daily", {}, [_WITHIN.format("calendar_date")]
    elif name.startswith("fulfillment_"):
        more, test = _FACETS.get(name, ({"customer_state": STATES}, _STATES))
        mart, arguments, tests = OPS, more, [_WITHIN.format("purchase_date"), test]
    else:
        mart, arguments, tests = "mart_seller_performance", {"seller_state": SELLER_STATES}, [_WITHIN.format("calendar_date"), _OF_STATE]
    plain = CARDS[name]
    sql = plain.replace(f"FROM {mart}", f"FROM (SELECT * FROM {mart} WHERE {' AND '.join(tests)})")
    if sql == plain:
        raise ValueError(f"{name}: its SQL does not read {mart}")
    return {"date_range": DATES, **arguments}, sql
