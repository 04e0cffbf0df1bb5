"""Registered queries against their SQL in DuckDB, and the plans of the main ones.

MARKETLANE_ALL=1 compares every query; by default a selection over all layers.
"""

import decimal
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from marketlane import contracts  # noqa: E402
from marketlane.plans import context, queries  # noqa: E402
from marketlane.plans.warehouse import RELATIONS  # noqa: E402
from marketlane.sources.sample_tables import raw_relations  # noqa: E402

FOLDER = os.environ.get("MARKETLANE_TABLES", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()
SELECTION = (
    "a10_unseen_files",
    "a18_ledger_upsert",
    "a28_source_freshness",
    "b01_stg_orders",
    "b02_stg_order_items",
    "b08_stg_geolocation",
    "c4_int_review_enriched",
    "d5_fact_orders",
    "f1_mart_exec_daily",
    "f4_mart_seller_performance",
    "g08_exec_gmv_orders_trend",
    "g20_seller_top_aov",
    "h02_unique",
    "h06_accepted_range",
    "h27_exec_daily_reconciles",
    "h32_seller_experience_is_order_weighted",
    "i1_incremental_partitions",
)
NAMES = sorted(queries.oracle_sql()) if os.environ.get("MARKETLANE_ALL") else SELECTION

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4)
    return value


def ordered(rows):
    return sorted(
        (tuple(map(comparable, row)) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    frame = queries.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    result = duck.execute(queries.oracle_sql()[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == columns
    picks = [found.index(c) for c in columns]
    expected = ordered([row[i] for i in picks] for row in result.fetchall())
    assert expected, "a comparison of nothing shows nothing"
    assert ordered(tuple(row[c] for c in columns) for row in frame.collect()) == expected


def test_every_query_has_sql():
    assert set(queries.queries()) == set(queries.oracle_sql())


def test_relations_have_their_declared_columns(spark):
    w = context.lazy(spark, FOLDER)
    for name in RELATIONS:
        if name == "order_customers":
            continue
        actual = {f.name: f.dataType.simpleString() for f in w[name].schema}
        assert actual == contracts.columns_of(name), name


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scans_read_needed_columns_only(spark):
    orders = raw_relations(spark, FOLDER)["orders"].select("order_id")
    text = plan(orders)
    assert "o_totalprice" not in text and "In(o_orderpriority" in text


def test_calendar_and_weather_are_broadcast_and_sellers_are_not_forced(spark):
    text = plan(context.lazy(spark, FOLDER)["int_order_delivery"])
    assert text.count("BroadcastHashJoin") >= 2
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["fact_orders", "mart_fulfillment_ops", "mart_seller_experience"])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(context.lazy(spark, FOLDER)[name])
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "Python" not in text and "Arrow" not in text
