"""Landing, ledger, snapshots, generic rules and write paths as plain SQL (DuckDB)."""

from __future__ import annotations

from marketlane.plans import rules
from marketlane.plans.oracle_checks import typed
from marketlane.plans.oracle_models import MODELS, checked, with_models
from marketlane.sources.registry import SOURCES

NOW, LATER = "TIMESTAMP '2002-01-01'", "TIMESTAMP '2002-01-02'"


def query(columns: str, sql: str, *needed: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    return with_models(needed, checked(typed(columns), "answer"), *extra, ("answer", sql))


# --- Raw rows ----------------------------------------------------------------

LINEAGE = "batch_id, ingested_at_utc, source_file_name"
RAW = {
    "orders": (
        ("o",),
        """SELECT ' ' || CAST(k AS VARCHAR) AS order_id, CAST(k AS VARCHAR) AS customer_id,
        chr(9) || upper(status) || ' ' AS order_status, d AS order_purchase_timestamp,
        strftime(d, '%Y-%m') || 'b' AS batch_id, d + 60 AS ingested_at_utc, 'f' AS source_file_name
        FROM o
        UNION ALL SELECT CAST(k AS VARCHAR), CAST(k AS VARCHAR), 'created', d,
        strftime(d, '%Y-%m') || 'a', d + 1, 'f' FROM o WHERE left(priority, 1) IN ('1', '2')""",
    ),
    "order_items": (
        (),
        """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
        CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
        l_extendedprice AS price, l_quantity AS freight_value, 'b' AS batch_id,
        CAST(l_shipdate AS DATE) AS ingested_at_utc, 'f' AS source_file_name FROM lineitem""",
    ),
    "order_payments": (
        ("stg_payments",),
        f"""SELECT order_id, payment_sequence AS payment_sequential,
        upper(payment_type) || '  ' AS payment_type, payment_installments_count AS payment_installments,
        payment_value, {LINEAGE} FROM stg_payments""",
    ),
    "order_reviews": (("stg_reviews",), "SELECT * FROM stg_reviews"),
    "customers": (("stg_customers",), "SELECT * FROM stg_customers"),
    "sellers": (("stg_sellers",), "SELECT * FROM stg_sellers"),
    "products": (
        ("stg_products",),
        """SELECT *, product_name_length AS product_name_lenght, product_photos_count AS product_photos_qty,
        product_description_length AS product_description_lenght FROM stg_products""",
    ),
    "geolocation": (
        (),
        """SELECT c_custkey % 500 AS geolocation_zip_code_prefix, 'b' AS batch_id,
        DATE '1999-01-01' AS ingested_at_utc, 'f' AS source_file_name
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    ),
    "holidays": (("stg_holidays",), "SELECT * FROM stg_holidays"),
    "weather_daily": (
        ("stg_weather_daily",),
        "SELECT * REPLACE ('METRIC' AS units) FROM stg_weather_daily",
    ),
}


def raw_needs(names) -> list[str]:
    return [model for name in names for model in RAW[name][0]]


def raw_ctes(names) -> tuple[tuple[str, str], ...]:
    return tuple((f"raw_{name}", RAW[name][1]) for name in names)


RAW_NONEMPTY = query(
    "dataset:s source_name:s row_count:n",
    "SELECT 'damaged' AS dataset, 'geolocation' AS source_name, 0 AS row_count",
)
REQUIRED_COLUMNS = query(
    "source_name:s required_columns:n row_count:n",
    " UNION ALL ".join(
        f"SELECT '{name}' AS source_name, {len(spec.columns)} AS required_columns, "
        f"count(*) AS row_count FROM raw_{name}"
        for name, spec in SOURCES.items()
    ),
    *raw_needs(SOURCES),
    extra=raw_ctes(SOURCES),
)

# --- Snapshots ---------------------------------------------------------------

T1, T2, T3 = "2001-01-01", "2001-02-01", "2001-03-01"


def _history(key: str, tracked: list[str], dim: str, changed: str, close_deletes: bool) -> str:
    number = f"CAST({key} AS BIGINT)"
    gone = f"{number} % 7 = 0"
    moved = f"({number} % 5 = 0 AND NOT {gone})"
    closing = f"({gone} AND {str(close_deletes).lower()})"

    def version(start: str, end: str, where: str, name: str = key, values: str | None = None) -> str:
        states = ", ".join(values if c == changed and values else c for c in tracked)
        return (
            f"SELECT {name} AS {key}, {states.replace(chr(39) + 'changed' + chr(39), chr(39) + 'changed' + chr(39) + ' AS ' + changed)}, "
            f"md5({name} || '|{start} 00:00:00.000000') AS dbt_scd_id, "
            f"TIMESTAMP '{start}' AS dbt_updated_at, TIMESTAMP '{start}' AS dbt_valid_from, "
            f"{end} AS dbt_valid_to FROM {dim} WHERE {where}"
        )

    return " UNION ALL ".join(
        [
            version(T1, f"CASE WHEN {closing} OR {moved} THEN TIMESTAMP '{T2}' END", "true"),
            version(T2, f"TIMESTAMP '{T3}'", moved, values="'changed'"),
            version(T3, "CAST(NULL AS TIMESTAMP)", f"{closing} OR {moved}"),
            version(
                T2,
                f"CASE WHEN {str(close_deletes).lower()} THEN TIMESTAMP '{T3}' END",
                f"{number} % 9 = 0",
                name=f"('n' || {key})",
            ),
        ]
    )


def _history_columns(key: str, tracked: list[str]) -> str:
    kinds = {"_prefix": "n", "_length": "n", "_count": "n", "_g": "d", "_cm": "d"}

    def kind(column: str) -> str:
        return next((k for suffix, k in kinds.items() if column.endswith(suffix)), "s")

    return " ".join([f"{key}:s", *[f"{c}:{kind(c)}" for c in tracked]])


VERSION_COLUMNS = "dbt_scd_id:s dbt_updated_at:ts dbt_valid_from:ts dbt_valid_to:ts"


def snapshot(
    key: str, tracked: list[str], dim: str, changed: str, close_deletes: bool = True
) -> str:
    return query(
        f"{_history_columns(key, tracked)} {VERSION_COLUMNS}",
        _history(key, tracked, dim, changed, close_deletes),
        dim,
    )


def noops(key: str, tracked: list[str], dim: str, changed: str) -> str:
    """A key that vanished and came back unchanged counts, and so do the repeats."""
    again = (
        f"SELECT {key}, dbt_scd_id, dbt_valid_from, dbt_valid_to FROM history "
        f"WHERE CAST(replace({key}, 'n', '') AS BIGINT) % 7 = 0 AND {key} NOT LIKE 'n%' "
        f"AND dbt_valid_from = TIMESTAMP '{T3}'"
    )
    repeats = (
        f"SELECT {key}, md5(dbt_scd_id || 'again') AS dbt_scd_id, "
        "dbt_valid_from + INTERVAL 30 DAY AS dbt_valid_from, dbt_valid_to FROM history "
        "WHERE dbt_valid_to IS NULL"
    )
    return query(
        f"dataset:s {key}:s dbt_scd_id:s dbt_valid_from:ts dbt_valid_to:ts",
        f"SELECT 'as built' AS dataset, * FROM ({again}) UNION ALL BY NAME "
        f"SELECT 'damaged' AS dataset, * FROM ({again} UNION ALL BY NAME {repeats})",
        dim,
        extra=(("history", _history(key, tracked, dim, changed, True)),),
    )


# --- Generic rules -----------------------------------------------------------

SNAPSHOTS = {
    "snap_sellers": (
        "seller_id", "seller_zip_code_prefix seller_city seller_state", "dim_seller", "seller_city",
    ),
    "snap_products": ("product_id", "product_category_name", "dim_product", "product_category_name"),
}


def _sql_name(relation: str) -> str:
    return relation.replace("raw.", "raw_")


def _limit(column: str, r: rules.Range) -> str:
    low, high = ("<", ">") if r.inclusive else ("<=", ">=")
    tests = [f"{column} {low} {r.low}"] if r.low is not None else []
    tests += [f"{column} {high} {r.high}"] if r.high is not None else []
    return " OR ".join(tests)


def _rule_rows(relation: str, kind: str) -> list[tuple[str, str, str]]:
    """(relation, columns, scalar query counting violations)."""
    declared, source = rules.ALL_RULES[relation], _sql_name(relation)
    if kind == "not_null":
        # Load times are not part of the compared relations; they are never NULL.
        return [
            (
                relation,
                c,
                "SELECT 0"
                if c == "dbt_updated_at"
                else f"SELECT count(*) FROM {source} WHERE {c} IS NULL",
            )
            for c in declared.required_columns
        ]
    if kind == "accepted_values":
        return [
            (relation, c, f"SELECT count(*) FROM {source} WHERE {c} NOT IN ({', '.join(map(repr, values))})")
            for c, values in declared.allowed.items()
        ]
    if kind == "accepted_range":
        return [
            (relation, c, f"SELECT count(*) FROM {source} WHERE {_limit(c, r)}")
            for r in declared.ranges
            for c in r.columns.split()
        ]
    if kind == "relationships":
        return [
            (
                relation,
                c,
                f"SELECT count(*) FROM {source} x WHERE {c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {_sql_name(parent)} p WHERE p.{target} = x.{c})",
            )
            for c, parent, target in declared.references
        ]
    found = []
    for key in (declared.key, *declared.more_keys):
        single = len(key) == 1 and not declared.key_where
        if key and single == (kind == "unique"):
            where = declared.key_where if key == declared.key else None
            where = where or "true"
            if len(key) == 1:
                where += f" AND {key[0]} IS NOT NULL"
            keys = ", ".join(key)
            found.append(
                (
                    relation,
                    ",".join(key),
                    f"SELECT count(*) FROM (SELECT {keys} FROM {source} WHERE {where} "
                    f"GROUP BY {keys} HAVING count(*) > 1)",
                )
            )
    return found


def rule_sql(kind: str) -> str:
    rows = [row for relation in rules.ALL_RULES for row in _rule_rows(relation, kind)]
    answer = " UNION ALL ".join(
        f"SELECT '{relation}' AS relation, '{kind}' AS rule, '{columns}' AS columns, "
        f"({count}) AS violations"
        for relation, columns, count in rows
    )
    raw = [name for name in RAW]
    snaps = tuple(
        (name, _history(key, tracked.split(), dim, changed, True))
        for name, (key, tracked, dim, changed) in SNAPSHOTS.items()
    )
    needed = [n for n in rules.ALL_RULES if n in MODELS] + raw_needs(raw)
    return query(
        "relation:s rule:s columns:s violations:n",
        answer,
        *dict.fromkeys(needed),
        extra=raw_ctes(raw) + snaps,
    )


CALENDARS = query(
    "country:s year:n days:n holidays:n last_name:s",
    """SELECT country, year, count(*) AS days, count(names) AS holidays, max(names) AS last_name
    FROM dim_date CROSS JOIN (VALUES ('BR'), ('US'), ('ZZ')) AS asked(country)
    LEFT JOIN (SELECT country_code, holiday_date,
                      string_agg(holiday_name, ',' ORDER BY holiday_name) AS names
               FROM stg_holidays GROUP BY 1, 2)
        ON country_code = country AND holiday_date = calendar_date
    GROUP BY 1, 2""",
    "dim_date",
    "stg_holidays",
)

MISMATCHES = query(
    "customer_state_at_order:s exact:n nullable_exact:n nullable_exact_sql:n within:n "
    "nullable_within:n nullable_within_sql:n",
    """SELECT customer_state_at_order,
    count(*) FILTER (paid IS NULL OR due IS NULL OR paid <> due) AS exact,
    count(*) FILTER (paid IS DISTINCT FROM due) AS nullable_exact,
    count(*) FILTER (paid <> due) AS nullable_exact_sql,
    count(*) FILTER (paid IS NULL OR due IS NULL OR abs(paid - due) > 1000) AS within,
    count(*) FILTER (paid IS NULL OR due IS NULL OR abs(paid - due) > 1000) AS nullable_within,
    count(*) FILTER (abs(paid - due) > 1000) AS nullable_within_sql
    FROM (SELECT customer_state_at_order, order_payment_total AS paid,
                 order_total_with_freight AS due FROM fact_orders) GROUP BY 1""",
    "fact_orders",
)

# --- Incremental fact and layout ---------------------------------------------

FACT = (
    "order_id:s order_status:s purchase_date:t customer_order_number:n order_total_with_freight:d"
)
INCREMENTAL_FACT = query(
    FACT,
    """SELECT * REPLACE (CASE WHEN bought < newest - INTERVAL 90 DAY
            AND purchase_date >= DATE '2001-03-01' - 120 THEN 'processing' ELSE order_status END
        AS order_status)
    FROM (SELECT *, order_purchased_at_utc AS bought, max(order_purchased_at_utc)
            FILTER (purchase_date < DATE '2001-03-01') OVER () AS newest FROM fact_orders)""",
    "fact_orders",
)
FULL_FACT = query(FACT, "SELECT * FROM fact_orders", "fact_orders")
LAYOUT = query(
    "purchase_date:t slices:n orders_count:n",
    """SELECT purchase_date, count(*) AS slices, sum(orders_count) AS orders_count
    FROM mart_customer_experience WHERE year(purchase_date) = 2000 AND quarter(purchase_date) = 1
    GROUP BY 1""",
    "mart_customer_experience",
)


def marts_by_day(measures: dict[str, tuple[str, str, str]]) -> str:
    return query(
        "mart:s day:t slices:n orders:n amount:d",
        " UNION ALL ".join(
            f"SELECT '{mart}' AS mart, {day} AS day, count(*) AS slices, sum({orders}) AS orders, "
            f"sum(CAST({amount} AS DOUBLE)) AS amount FROM {mart} GROUP BY {day}"
            for mart, (day, orders, amount) in measures.items()
        ),
        *measures,
    )


_MART_WIDTHS = {
    "mart_exec_daily": (25, "orders_count"),
    "mart_seller_performance": (16, "orders_count"),
    "mart_seller_experience": (11, "attributable_orders_count"),
    "mart_fulfillment_ops": (25, "orders_count"),
    "mart_customer_experience": (9, "orders_count"),
}
CONTRACT = query(
    "mart:s mart_rows:n mart_columns:n narrowed_lacks:s",
    " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS mart_rows, {width} AS mart_columns, "
        f"'missing {lacks}' AS narrowed_lacks FROM {mart}"
        for mart, (width, lacks) in _MART_WIDTHS.items()
    ),
    *_MART_WIDTHS,
)

# --- Landing -----------------------------------------------------------------

CREATED = "coalesce(arrived + CAST(k % 9 - 2 AS INTEGER), d + 30)"
RAW_REVIEWS = query(
    "review_id:s order_id:s review_score:s review_comment_message:s review_creation_date:s",
    """SELECT review_id, order_id, review_score,
    CASE WHEN k % 2 = 0 THEN NULL WHEN k % 7 = 0 THEN ' ' || chr(9) || ' '
         ELSE ' about order ' || order_id || chr(10) END AS review_comment_message,
    strftime(review_created_at_utc, '%Y-%m-%d %H:%M:%S') AS review_creation_date
    FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM stg_reviews)""",
    "stg_reviews",
)
STANDARD_NAMES = query(
    "order_id:n customer_id:n order_status:s total_price:d ordered_at:ts priority:s",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
    o_totalprice AS total_price, o_orderdate AS ordered_at, o_orderpriority AS priority FROM orders""",
)
BATCH_METADATA = query(
    "o_orderkey:n batch_id:s ingested_at_utc:ts source_file_name:s",
    f"""SELECT o_orderkey, 'shop_orders_20020101T000000000000Z' AS batch_id, {NOW} AS ingested_at_utc,
    'Shop Orders.csv' AS source_file_name FROM orders""",
)
PREPARED_SELLERS = query(
    "seller_id:s seller_zip_code_prefix:s seller_city:s seller_state:s batch_id:s "
    "ingested_at_utc:ts source_file_name:s",
    f"""SELECT s_suppkey AS seller_id, 10000 + s_suppkey AS seller_zip_code_prefix,
    CASE WHEN s_suppkey % 10 = 0 THEN ' ' ELSE r_name END AS seller_city, lower(n_name) AS seller_state,
    'b1' AS batch_id, {NOW} AS ingested_at_utc, 'sellers_dataset.csv' AS source_file_name
    FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
APPENDED = query(
    "batch_id:s row_count:n written_rows:n",
    """SELECT batch_id, count(*) AS row_count, sum(count(*)) OVER () AS written_rows
    FROM raw_orders GROUP BY 1""",
    *raw_needs(["orders"]),
    extra=raw_ctes(["orders"]),
)
REPLACED = query(
    "batch_id:s row_count:n",
    "SELECT batch_id, count(*) AS row_count FROM raw_orders WHERE batch_id LIKE '%b' GROUP BY 1",
    *raw_needs(["orders"]),
    extra=raw_ctes(["orders"]),
)
_LANDED = """SELECT source_name, batch_id, count(*) AS row_count FROM (
        SELECT 'orders' AS source_name, CAST(year(order_purchase_timestamp) AS VARCHAR) AS batch_id FROM raw_orders
        UNION ALL SELECT 'customers', CAST(year(d) AS VARCHAR) FROM o
        UNION ALL SELECT 'order_reviews', CAST(year(review_created_at_utc) AS VARCHAR) FROM stg_reviews
        UNION ALL SELECT 'order_items', CAST(CAST(order_id AS BIGINT) % 3 + 1992 AS VARCHAR) FROM raw_order_items
        UNION ALL SELECT 'order_payments', CAST(CAST(order_id AS BIGINT) % 3 + 1992 AS VARCHAR) FROM raw_order_payments
        UNION ALL SELECT 'sellers', CAST(CAST(seller_id AS BIGINT) % 3 + 1992 AS VARCHAR) FROM raw_sellers
        UNION ALL SELECT 'products', CAST(CAST(product_id AS BIGINT) % 3 + 1992 AS VARCHAR) FROM raw_products
        UNION ALL SELECT 'geolocation', CAST(CAST(geolocation_zip_code_prefix AS BIGINT) % 3 + 1992 AS VARCHAR)
            FROM raw_geolocation)
    GROUP BY source_name, batch_id"""
_FILES = "SELECT batch_id, source_name, 'shop_' || source_name || '_dataset.csv' AS source_file_name FROM landed"


def landed_query(columns: str, sql: str, *extra: tuple[str, str]) -> str:
    """SQL over ``landed``: rows of each source and batch in the landing folder."""
    needed = raw_needs(SOURCES)
    return query(columns, sql, "o", *needed, extra=(*raw_ctes(SOURCES), ("landed", _LANDED), *extra))


DISCOVERED = landed_query("batch_id:s source_name:s source_file_name:s", _FILES)
UNSEEN = landed_query(
    "batch_id:s source_name:s source_file_name:s",
    f"SELECT * FROM ({_FILES}) WHERE CAST(batch_id AS BIGINT) % 2 = 0",
)

# --- Ledger ------------------------------------------------------------------

_BATCH = "source_name:s batch_id:s source_file_name:s"
_WINDOW = (
    "holiday_window_start_date:t holiday_window_end_date:t weather_window_start_date:t "
    "weather_window_end_date:t"
)
LEDGER = (
    f"{_BATCH} raw_loaded_rows:n raw_status:s holiday_status:s weather_status:s publish_status:s "
    f"{_WINDOW} last_error_class:s last_error_message:s created_at_utc:ts updated_at_utc:ts "
    "raw_loaded_at_utc:ts published_at_utc:ts"
)
_LOADED = f"""SELECT 'orders' AS source_name, strftime(d, '%Y-%m') || letter AS batch_id,
    'orders_dataset.csv' AS source_file_name, count(*) AS raw_loaded_rows, 'loaded' AS raw_status,
    'pending' AS holiday_status,
    CASE WHEN letter = 'b' AND max(arrived) IS NOT NULL THEN 'pending' ELSE 'not_required' END
        AS weather_status, 'pending' AS publish_status,
    min(d) AS holiday_window_start_date, max(d) AS holiday_window_end_date,
    CASE WHEN letter = 'b' THEN min(arrived) - 7 END AS weather_window_start_date,
    CASE WHEN letter = 'b' THEN max(arrived) END AS weather_window_end_date,
    CAST(NULL AS VARCHAR) AS last_error_class, CAST(NULL AS VARCHAR) AS last_error_message,
    {NOW} AS created_at_utc, {NOW} AS updated_at_utc, {NOW} AS raw_loaded_at_utc,
    CAST(NULL AS TIMESTAMP) AS published_at_utc
    FROM o CROSS JOIN (SELECT unnest(['a', 'b']) AS letter)
    WHERE letter = 'b' OR left(priority, 1) IN ('1', '2')
    GROUP BY letter, strftime(d, '%Y-%m')"""


def ledger(columns: str, sql: str, *needed: str) -> str:
    return query(columns, sql, "o", *needed, extra=(("loaded", _LOADED),))


WINDOWS = ledger(
    f"{_BATCH} raw_loaded_rows:n {_WINDOW} malformed_order_purchase_timestamp:n "
    "malformed_order_delivered_customer_date:n",
    """SELECT *, 0 AS malformed_order_purchase_timestamp, 0 AS malformed_order_delivered_customer_date
    FROM loaded""",
)
MERGED_WINDOWS = ledger(
    _WINDOW,
    """SELECT min(holiday_window_start_date) AS holiday_window_start_date,
    max(holiday_window_end_date) AS holiday_window_end_date,
    min(weather_window_start_date) AS weather_window_start_date,
    max(weather_window_end_date) AS weather_window_end_date FROM loaded""",
)
DATE_RANGE = query(
    "first_day:t last_day:t days:n",
    "SELECT min(d) AS first_day, max(d) AS last_day, max(d) - min(d) + 1 AS days FROM o",
    "o",
)
REQUESTS = ledger(
    "weather_date:t location_key:s",
    """SELECT DISTINCT day AS weather_date, place AS location_key FROM (
        SELECT CAST(unnest(generate_series(weather_window_start_date, weather_window_end_date,
            INTERVAL 1 DAY)) AS DATE) AS day FROM loaded WHERE weather_status = 'pending')
    CROSS JOIN (SELECT unnest(['sao_paulo', 'curitiba']) AS place)
    WHERE place = 'curitiba' OR day NOT IN (SELECT weather_date FROM stg_weather_daily)""",
    "stg_weather_daily",
)
HOLIDAYS = query(
    "holiday_date:t local_name:s holiday_name:s country_code:s is_global:b counties_json:s "
    "holiday_types_json:s launch_year:n",
    """SELECT * REPLACE (holiday_name <> 'State Day' AS is_global,
        CASE WHEN holiday_name = 'State Day' THEN '["BR-SP", "BR-RJ"]' END AS counties_json,
        '["Public", "Bank"]' AS holiday_types_json, year(holiday_date) AS launch_year)
    FROM stg_holidays WHERE holiday_date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'""",
    "stg_holidays",
)
_WEATHER_MEASURES = (
    "cloud_cover_afternoon humidity_afternoon precipitation_total temperature_min temperature_max "
    "temperature_afternoon temperature_night temperature_evening temperature_morning "
    "pressure_afternoon wind_max_speed wind_max_direction"
).split()
WEATHER = query(
    "weather_date:t location_key:s latitude:d longitude:d timezone:s units:s "
    + " ".join(f"{m}:d" for m in _WEATHER_MEASURES),
    """SELECT * REPLACE (CASE WHEN bare THEN -23.0 ELSE latitude END AS latitude,
        CASE WHEN bare THEN -46.0 ELSE longitude END AS longitude,
        CASE WHEN bare THEN '+00:00' ELSE timezone END AS timezone,
        CASE WHEN bare THEN 'standard' ELSE units END AS units)
    FROM (SELECT *, dayofyear(weather_date) % 10 = 0 AS bare FROM stg_weather_daily)
    WHERE location_key = 'sao_paulo'""",
    "stg_weather_daily",
)
LEDGER_LOADED = ledger(LEDGER, "SELECT * FROM loaded")
LEDGER_UPSERTED = ledger(
    LEDGER,
    f"SELECT * REPLACE ('succeeded' AS holiday_status, {LATER} AS updated_at_utc) FROM loaded",
)
LEDGER_VIOLATIONS = ledger(
    f"{_BATCH} violation:s",
    """SELECT *, unnest(['loaded_without_time', 'half_holiday_window']) AS violation FROM loaded
    WHERE batch_id LIKE '%a'""",
)
LEDGER_FAILED = ledger(
    LEDGER,
    f"""SELECT * REPLACE (0 AS raw_loaded_rows, 'failed' AS raw_status,
        'not_required' AS holiday_status, 'not_required' AS weather_status,
        NULL AS holiday_window_start_date, NULL AS holiday_window_end_date,
        NULL AS weather_window_start_date, NULL AS weather_window_end_date,
        'ValueError' AS last_error_class, 'bad file' AS last_error_message,
        {LATER} AS updated_at_utc, NULL AS raw_loaded_at_utc) FROM loaded""",
)
LEDGER_RECOVERY = ledger(
    f"{_BATCH} missing_window:s",
    "SELECT *, 'weather' AS missing_window FROM loaded WHERE weather_status = 'pending'",
)
LEDGER_ENRICHED = ledger(
    f"{_BATCH} weather_status:s last_error_class:s last_error_message:s updated_at_utc:ts attempt:n",
    f"""SELECT * REPLACE ('failed' AS weather_status, 'RuntimeError' AS last_error_class,
        'no answer' AS last_error_message), 1 AS attempt FROM loaded WHERE weather_status = 'pending'
    UNION ALL SELECT * REPLACE ('succeeded' AS weather_status, {LATER} AS updated_at_utc), 2
    FROM loaded WHERE weather_status = 'pending'""",
)
LEDGER_PUBLISHED = ledger(
    LEDGER,
    f"""SELECT * REPLACE ('succeeded' AS holiday_status, 'published' AS publish_status,
        {LATER} AS updated_at_utc, {LATER} AS published_at_utc)
    FROM loaded WHERE weather_status = 'not_required'""",
)
RUN_SUMMARY = ledger(
    "mode:s no_op:b publish_complete:b raw_batches_loaded:n raw_rows_loaded:n "
    "batches_marked_published:n",
    """SELECT 'incremental' AS mode, false AS no_op,
    count(*) FILTER (weather_status = 'pending') = 0 AS publish_complete, 0 AS raw_batches_loaded,
    0 AS raw_rows_loaded,
    count(*) FILTER (weather_status = 'not_required') AS batches_marked_published FROM loaded""",
)

# --- Workflows ---------------------------------------------------------------

_SPAN = "BETWEEN (SELECT min(d) FROM o) AND (SELECT max(d) FROM o)"
BOOTSTRAP = query(
    "source_name:s row_count:n",
    " UNION ALL ".join(
        [f"SELECT '{name}' AS source_name, count(*) AS row_count FROM raw_{name}" for name in SOURCES]
        + [
            f"SELECT 'holidays', count(*) FROM stg_holidays WHERE holiday_date {_SPAN}",
            f"SELECT 'weather_daily', count(*) FROM stg_weather_daily "
            f"WHERE location_key = 'sao_paulo' AND weather_date {_SPAN}",
        ]
    ),
    "o",
    "stg_holidays",
    "stg_weather_daily",
    *raw_needs(SOURCES),
    extra=raw_ctes(SOURCES),
)
_YEARS = """SELECT CAST(year(d) AS VARCHAR) AS batch_id,
    count(*) + count(*) FILTER (left(priority, 1) IN ('1', '2')) AS order_rows,
    count(*) AS customer_rows, count(arrived) > 0 AS has_deliveries FROM o GROUP BY 1"""
_LOADED_FILES = """SELECT l.source_name, l.batch_id, l.row_count,
    CASE WHEN l.source_name = 'orders' THEN 'succeeded' ELSE 'not_required' END AS holiday_status,
    CASE WHEN has_deliveries THEN 'succeeded' ELSE 'not_required' END AS weather_status
    FROM landed l LEFT JOIN years y ON l.source_name = 'orders' AND l.batch_id = y.batch_id"""
INCREMENTAL = landed_query(
    "source_name:s publish_status:s holiday_status:s weather_status:s batches:n row_count:n "
    "first_run_batches:n second_run_no_op:b",
    f"""SELECT *, sum(batches) OVER () AS first_run_batches, true AS second_run_no_op FROM (
        SELECT source_name, 'published' AS publish_status, holiday_status, weather_status, count(*) AS batches,
            sum(row_count) AS row_count FROM ({_LOADED_FILES}) GROUP BY ALL)""",
    ("years", _YEARS),
)
STREAMED = landed_query(
    f"{_BATCH} raw_loaded_rows:n holiday_status:s weather_status:s publish_status:s",
    f"""SELECT source_name, batch_id, 'shop_' || source_name || '_dataset.csv' AS source_file_name,
    row_count AS raw_loaded_rows, holiday_status, weather_status, 'published' AS publish_status
    FROM ({_LOADED_FILES})""",
    ("years", _YEARS),
)
FRESHNESS = query(
    "source_name:s newest_at_utc:ts warn_hours:n error_hours:n age_hours:d status:s",
    """SELECT *, CASE WHEN age_hours > error_hours THEN 'error' WHEN age_hours > warn_hours THEN 'warn'
        ELSE 'pass' END AS status
    FROM (SELECT *, date_diff('second', CAST(newest_at_utc AS TIMESTAMP), TIMESTAMP '2001-09-15') / 3600.0
            AS age_hours FROM (
        SELECT 'orders' AS source_name, max(d + 60) AS newest_at_utc, 24 AS warn_hours,
            48 AS error_hours FROM o
        UNION ALL SELECT 'order_items', max(l_shipdate)::DATE, 24, 48 FROM lineitem
        UNION ALL SELECT 'order_payments', max(d), 24, 48 FROM o WHERE k % 50 <> 0
        UNION ALL SELECT 'order_reviews', max(review_created_at_utc)::DATE, 48, 96 FROM stg_reviews
        UNION ALL SELECT 'weather_daily', max(weather_date), 48, 96 FROM stg_weather_daily
        UNION ALL SELECT 'holidays', make_date(max(year(d)), 1, 1), 720, 1440 FROM o))""",
    "o",
    "stg_reviews",
    "stg_weather_daily",
)
