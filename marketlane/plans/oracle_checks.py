"""Assertions as plain SQL (DuckDB), run on the built and on the damaged relation."""

from __future__ import annotations

from marketlane.plans.damage import DAMAGE
from marketlane.plans.oracle_models import checked, with_models

KINDS = {"d": "double", "n": "BIGINT", "s": "VARCHAR", "t": "DATE", "ts": "TIMESTAMP", "b": "BOOLEAN"}


def typed(columns: str) -> list[tuple[str, str]]:
    pairs = [item.split(":") for item in columns.split()]
    return [(name, KINDS[kind]) for name, kind in pairs]


def both(key: str, columns: str, query: str, *needed: str) -> str:
    """``{T}`` in the query is the relation as built, then the damaged one."""
    damage = DAMAGE[key]
    answer = (
        f"SELECT 'as built' AS dataset, * FROM ({query.format(T=damage.relation)}) "
        f"UNION ALL BY NAME SELECT 'damaged' AS dataset, * FROM ({query.format(T='damaged')})"
    )
    return with_models(
        [damage.relation, *needed],
        checked([("dataset", "VARCHAR"), *typed(columns)], "answer"),
        ("damaged", damage.sql()),
        ("answer", answer),
    )


def compared(key: str, keys: str, test: str, show: str = "") -> str:
    """The built relation is what a recomputation should give."""
    relation = DAMAGE[key].relation
    names = [name for name, _ in typed(keys)]
    on = " AND ".join(f"e.{n} IS NOT DISTINCT FROM a.{n}" for n in names)
    shown = typed(show) if show else []
    select = [f"coalesce(e.{n}, a.{n}) AS {n}" for n in names]
    select += [f"{s[0]}.{n} AS {s}_{n}" for n, _ in shown for s in ("expected", "actual")]
    columns = keys
    if show:
        kinds = [item.split(":") for item in show.split()]
        columns += "".join(f" expected_{n}:{k} actual_{n}:{k}" for n, k in kinds)
    query = f"SELECT {', '.join(select)} FROM {relation} e FULL JOIN {{T}} a ON {on} WHERE {test}"
    return both(key, columns, query)


SLICE = "purchase_date:t customer_state:s delivery_delay_bucket:s"
SELLER_DAY = "seller_id:s calendar_date:t"
NEARLY = "abs(coalesce({a}, -1) - coalesce({b}, -1)) > {tolerance}"


def off(a: str, b: str, tolerance: str = "0.000001") -> str:
    return f"({NEARLY.format(a=a, b=b, tolerance=tolerance)})"


_WEATHER = (
    "delivery_temperature_max",
    "delivery_temperature_min",
    "delivery_precipitation_total",
    "delivery_humidity_afternoon",
)
_FULFILLMENT_COLUMNS = (
    f"{SLICE} orders_count:n delivered_orders_count:n late_orders_count:n cancelled_orders_count:n "
    "late_days_sum:d avg_late_days:d late_delivery_rate:d "
    + " ".join(f"{f}_observation_count:n {f}_sum:d avg_{f}:d" for f in _WEATHER)
)


def _names(columns: str) -> str:
    return ", ".join(name for name, _ in typed(columns))


def plain(key: str, columns: str, where: str) -> str:
    return both(key, columns, f"SELECT {_names(columns)} FROM {{T}} WHERE {where}")


ASSERTIONS = {
    "h07": both(
        "h07",
        f"{SLICE} fulfillment_orders_count:n customer_experience_orders_count:n",
        """SELECT f.purchase_date, f.customer_state, f.delivery_delay_bucket,
        f.orders_count AS fulfillment_orders_count, c.orders_count AS customer_experience_orders_count
        FROM mart_fulfillment_ops f JOIN {T} c USING (purchase_date, customer_state, delivery_delay_bucket)
        WHERE f.orders_count <> c.orders_count""",
        "mart_fulfillment_ops",
    ),
    "h08": both(
        "h08",
        "customer_unique_id:s first_customer_order_number:n last_customer_order_number:n "
        "customer_orders_count:n first_order_count:n",
        """SELECT customer_unique_id, min(customer_order_number) AS first_customer_order_number,
        max(customer_order_number) AS last_customer_order_number, count(*) AS customer_orders_count,
        count(*) FILTER (customer_order_number = 1) AS first_order_count
        FROM {T} GROUP BY 1 HAVING min(customer_order_number) > 1""",
    ),
    "h09": plain(
        "h09",
        "order_id:s order_status:s is_delivered:b order_delivered_to_customer_at_utc:ts",
        "is_delivered <> (order_delivered_to_customer_at_utc IS NOT NULL)",
    ),
    "h10": both(
        "h10",
        "calendar_date:t",
        """SELECT DISTINCT x AS calendar_date FROM (
            SELECT unnest([order_purchased_at_utc, order_delivered_to_customer_at_utc,
                order_estimated_delivery_at_utc])::DATE AS x FROM stg_orders
            UNION ALL SELECT review_created_at_utc::DATE FROM stg_reviews)
        WHERE x IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {T} c WHERE c.calendar_date = x)""",
        "stg_orders",
        "stg_reviews",
    ),
    "h11": compared(
        "h11",
        "order_id:s order_item_id:n",
        off("e.item_price", "a.item_price", "0.01"),
        "item_price:d freight_value:d item_total_with_freight:d",
    ),
    "h12": both(
        "h12",
        "order_id:s fact_customer_id:s source_customer_id:s fact_customer_unique_id:s "
        "source_customer_unique_id:s fact_zip_code_prefix:n source_zip_code_prefix:n "
        "fact_customer_city:s source_customer_city:s fact_customer_state:s source_customer_state:s",
        """SELECT order_id, a.customer_id AS fact_customer_id, c.customer_id AS source_customer_id,
        a.customer_unique_id AS fact_customer_unique_id, c.customer_unique_id AS source_customer_unique_id,
        customer_zip_code_prefix_at_order AS fact_zip_code_prefix,
        customer_zip_code_prefix AS source_zip_code_prefix,
        customer_city_at_order AS fact_customer_city, customer_city AS source_customer_city,
        customer_state_at_order AS fact_customer_state, customer_state AS source_customer_state
        FROM {T} a JOIN stg_customers c ON c.customer_id = a.customer_id
        WHERE customer_city_at_order <> customer_city""",
        "stg_customers",
    ),
    "h13": both(
        "h13",
        "order_id:s purchase_date:t is_purchase_on_holiday:b is_holiday:b "
        "holiday_name_at_purchase:s holiday_name:s",
        """SELECT order_id, purchase_date, is_purchase_on_holiday, is_holiday,
        holiday_name_at_purchase, holiday_name FROM {T} JOIN dim_date ON calendar_date = purchase_date
        WHERE is_purchase_on_holiday <> is_holiday""",
        "dim_date",
    ),
    "h14": both(
        "h14",
        "order_id:s mismatch_type:s",
        """SELECT order_id, 'missing_from_fact_orders' AS mismatch_type FROM int_order_delivery
        WHERE order_id NOT IN (SELECT order_id FROM {T})""",
        "int_order_delivery",
    ),
    "h15": plain(
        "h15", "order_id:s purchase_date:t", "purchase_date IS NOT NULL AND is_purchase_on_holiday IS NULL"
    ),
    "h16": both(
        "h16",
        "order_id:s",
        "SELECT order_id FROM stg_orders WHERE order_id NOT IN (SELECT order_id FROM {T})",
        "stg_orders",
    ),
    "h17": plain(
        "h17",
        "review_id:s order_id:s is_delivered:b is_late:b is_cancelled:b late_days:n "
        "delivery_delay_bucket:s",
        """delivery_delay_bucket <> CASE WHEN is_cancelled OR NOT is_delivered THEN 'not_delivered'
        WHEN NOT is_late THEN 'on_time' WHEN late_days <= 3 THEN '1_to_3_days'
        WHEN late_days <= 7 THEN '4_to_7_days' WHEN late_days <= 14 THEN '8_to_14_days'
        ELSE '15_plus_days' END""",
    ),
    "h18": compared(
        "h18",
        "seller_id:s order_id:s",
        "e.is_low_review_order <> a.is_low_review_order",
        "calendar_date:t reviews_count:n commented_reviews_count:n avg_review_score_for_order:d "
        "avg_time_to_review_days_for_order:d is_reviewed_order:b is_low_review_order:b",
    ),
    "h19": both(
        "h19",
        "seller_id:s order_id:s seller_count:n",
        """SELECT s.seller_id, s.order_id, count(DISTINCT i.seller_id) AS seller_count
        FROM int_seller_attributable_experience s JOIN {T} i ON i.order_id = s.order_id
        GROUP BY 1, 2 HAVING count(DISTINCT i.seller_id) > 1""",
        "int_seller_attributable_experience",
    ),
    "h20": compared(
        "h20",
        SELLER_DAY,
        off("e.gmv", "a.gmv", "0.01"),
        "orders_count:n items_value:d freight_total:d gmv:d non_cancelled_orders_count:n "
        "operational_defect_orders_count:n",
    ),
    "h21": plain("h21", "order_id:s", "is_late AND coalesce(late_days, 0) < 1"),
    "h22": plain(
        "h22",
        f"{SLICE} orders_count:n reviewed_orders_count:n reviews_count:n commented_reviews_count:n "
        "avg_review_score:d avg_time_to_review_days:d",
        "reviewed_orders_count > orders_count OR reviews_count < reviewed_orders_count",
    ),
    "h23": compared("h23", SLICE, off("e.avg_review_score", "a.avg_review_score")),
    "h24": compared("h24", SLICE, "e.reviews_count <> a.reviews_count", "orders_count:n"),
    "h25": both(
        "h25",
        "calendar_date:t",
        """SELECT DISTINCT purchase_date AS calendar_date FROM fact_orders
        WHERE purchase_date NOT IN (SELECT calendar_date FROM {T})""",
        "fact_orders",
    ),
    "h26": plain(
        "h26",
        "calendar_date:t orders_count:n non_cancelled_orders_count:n cancelled_orders_count:n "
        "delivered_orders_count:n late_orders_count:n new_customers_count:n cancellation_rate:d "
        "late_delivery_rate:d",
        "late_orders_count > delivered_orders_count OR "
        + off("late_delivery_rate", "late_orders_count / nullif(delivered_orders_count, 0)"),
    ),
    "h27": compared("h27", "calendar_date:t", off("e.gmv", "a.gmv", "0.01"), "orders_count:n gmv:d"),
    "h28": both(
        "h28",
        f"{SLICE} is_purchase_on_holiday:b is_holiday:b holiday_name_at_purchase:s holiday_name:s",
        """SELECT purchase_date, customer_state, delivery_delay_bucket, is_purchase_on_holiday,
        is_holiday, holiday_name_at_purchase, holiday_name
        FROM {T} JOIN dim_date ON calendar_date = purchase_date
        WHERE holiday_name_at_purchase IS DISTINCT FROM holiday_name""",
        "dim_date",
    ),
    "h29": plain(
        "h29",
        _FULFILLMENT_COLUMNS,
        off("avg_late_days", "late_days_sum / nullif(late_orders_count, 0)", "0.01"),
    ),
    "h30": compared("h30", SLICE, off("e.late_days_sum", "a.late_days_sum", "0.01"), "orders_count:n"),
    "h31": plain(
        "h31",
        f"{SELLER_DAY} attributable_orders_count:n reviewed_attributable_orders_count:n "
        "reviews_count:n commented_reviews_count:n low_review_orders_count:n "
        "review_coverage_rate:d low_review_rate:d avg_review_score:d",
        off(
            "low_review_rate",
            "low_review_orders_count / nullif(reviewed_attributable_orders_count, 0)",
        ),
    ),
    "h32": both(
        "h32",
        f"{SELLER_DAY} expected_avg_review_score:d avg_review_score:d "
        "item_weighted_avg_review_score:d review_row_weighted_avg_review_score:d",
        """SELECT e.seller_id, e.calendar_date, e.avg_review_score AS expected_avg_review_score,
        a.avg_review_score, by_item AS item_weighted_avg_review_score,
        by_row AS review_row_weighted_avg_review_score
        FROM mart_seller_experience e JOIN {T} a USING (seller_id, calendar_date)
        LEFT JOIN (SELECT s.seller_id, s.calendar_date, avg(avg_review_score_for_order) AS by_item
                   FROM int_seller_attributable_experience s JOIN fact_order_items USING (order_id)
                   GROUP BY 1, 2) USING (seller_id, calendar_date)
        LEFT JOIN (SELECT s.seller_id, s.calendar_date, avg(review_score) AS by_row
                   FROM int_seller_attributable_experience s JOIN fact_reviews USING (order_id)
                   GROUP BY 1, 2) USING (seller_id, calendar_date)
        WHERE abs(coalesce(e.avg_review_score, -1) - coalesce(a.avg_review_score, -1)) > 0.000001""",
        "fact_order_items",
        "fact_reviews",
        "int_seller_attributable_experience",
    ),
    "h33": compared(
        "h33",
        SELLER_DAY,
        "e.commented_reviews_count <> a.commented_reviews_count",
        "attributable_orders_count:n",
    ),
    "h34": plain(
        "h34",
        f"{SELLER_DAY} orders_count:n non_cancelled_orders_count:n cancelled_orders_count:n "
        "delivered_orders_count:n late_orders_count:n operational_defect_orders_count:n "
        "cancellation_rate:d late_delivery_rate:d operational_defect_rate:d",
        off("operational_defect_rate", "operational_defect_orders_count / orders_count"),
    ),
    "h35": compared(
        "h35",
        SELLER_DAY,
        off("e.aov", "a.aov"),
        "orders_count:n operational_defect_rate:d",
    ),
    "h36": plain("h36", "order_id:s", "NOT is_late AND late_days IS NOT NULL"),
    "h37": compared(
        "h37",
        "order_id:s",
        off("e.order_payment_total", "a.order_payment_total", "0.01"),
        "order_items_count:n order_item_value:d order_payment_total:d",
    ),
    "h41": both(
        "h41",
        "delivery_date:t",
        """SELECT DISTINCT order_delivered_to_customer_at_utc::DATE AS delivery_date FROM stg_orders
        WHERE order_delivered_to_customer_at_utc IS NOT NULL AND order_status = 'delivered'
        AND order_delivered_to_customer_at_utc::DATE NOT IN (
            SELECT weather_date FROM {T} WHERE location_key = 'sao_paulo')""",
        "stg_orders",
    ),
}
