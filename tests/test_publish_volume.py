"""What a publish and its checks shuffle, write and compute, at most once each."""

import glob
from contextlib import contextmanager

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketlane.functions import columns as col
from marketlane.functions.frames import number_within_key
from marketlane.operators import intermediate
from marketlane.plans import context, queries
from marketlane.plans.warehouse import LAYOUT, Plans, Warehouse
from marketlane.sources import tables

SMALL = "/root/testdata/sf0.001"


@contextmanager
def sort_merge_joins(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_numbering_moves_whole_rows_once(spark):
    frame = spark.range(100).select(
        F.col("id").cast("string").alias("o"), (F.col("id") % 7).cast("string").alias("who"),
        F.timestamp_seconds("id").alias("at"),
    )
    with sort_merge_joins(spark):
        # Rows, their counts by slice, those by person, and the shifts for the join.
        assert exchanges(number_within_key(frame, "who", "at", ["o"], "n")) == 4


def test_numbering_of_other_key_types_and_missing_leads(spark):
    rows = [(1, None, None), (1, None, ""), (1, None, "b"), (1, 0, "a"), (None, 0, "d"), (None, 5, "c"), (0, 1, "e")]
    frame = spark.createDataFrame(rows, "who bigint, s bigint, o string").select(
        "*", F.timestamp_seconds("s").alias("at"), F.date_from_unix_date(F.col("who").cast("int")).alias("day")
    )
    for key in ("who", "day"):
        numbered = number_within_key(frame, key, "at", ["o"], "n")
        found = {(r["who"], r["s"], r["o"]): r["n"] for r in numbered.collect()}
        assert [found[row] for row in rows] == [1, 2, 3, 4, 1, 2, 1]


def test_seller_days_move_items_twice_at_most(spark):
    w = context.lazy(spark, SMALL)
    # Files stand for stored tables, so that only this step's exchanges count.
    items = spark.createDataFrame([], w["stg_order_items"].schema)
    delivery = spark.createDataFrame([], w["int_order_delivery"].schema)
    with sort_merge_joins(spark):
        # Items and flags for the join, seller orders by seller and day.
        assert exchanges(intermediate.int_seller_daily_performance(items, delivery)) == 3


ODD = [
    "2017-05-01 10:20:30", "2017-05-01 ", " 2017-05-01", "2017-05-01T", "2017-5-1", "2017-05-", "2017-05-x",
    "20170501", "2017-05-01 10:20:30  ", "+017-05-01", "-017-05-01", "12017-05-01", "2017-13-01", "2017-05-1",
    "2017-05-01 25:00:00", "é2017-05-01", "a", " a", "a ", " a ", "é", "", " ", "\x7f", "~", None,
    "abc1-23-01", "2017-05-01 10:20:30\t\n", "2017-05-01\x00", "\U0001f600 ", "2017-05-01   ",
]


@pytest.mark.parametrize("kind", ["text", "instant"])
def test_short_ways_clean_and_type_as_the_long_ones(spark, kind):
    trimmed = F.nullif(F.btrim("t", F.lit(col.WHITESPACE)), F.lit(""))
    plain = F.when(trimmed.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), trimmed).try_cast("timestamp")
    pair = (col.clean_text("t"), trimmed) if kind == "text" else (col.to_timestamp("t"), plain)
    frame = spark.createDataFrame([(t,) for t in ODD], "t string")
    wrong = frame.select("t", pair[0].alias("short"), pair[1].alias("long")).filter("NOT short <=> long")
    assert wrong.collect() == []


def test_stored_tables_are_compressed_well(spark, tmp_path):
    table = str(tmp_path / "t")
    tables.replace_table(spark.range(100), table)
    file = glob.glob(f"{table}/v=*/part-*.parquet")[0]
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_relations_that_checks_read_are_stored_when_asked_for(spark, tmp_path):
    name = "int_order_value"
    w = Warehouse(context.lazy(spark, SMALL).raw, context.settings(), str(tmp_path / "w"))
    before = w[name]
    w.keep(name, "stg_orders")
    assert name not in LAYOUT and not tables.table_exists(spark, w.table(name))
    assert w[name].exceptAll(before).isEmpty() and w[name].count() == before.count()
    assert tables.table_exists(spark, w.table(name))


def test_row_rules_are_counted_while_their_relations_are_written(spark):
    queries.queries()["h01_not_null"](spark, SMALL)
    measured = context.published(spark, SMALL).measured
    assert queries.STORED_FOR_CHECKS <= set(measured) and "stg_orders" in measured


def test_a_lone_mart_is_the_same_and_stores_no_facts(spark, tmp_path):
    w = context.lazy(spark, SMALL)
    lone, whole = (Warehouse(w.raw, w.settings, f"{tmp_path}/{name}", False) for name in ("lone", "whole"))
    for name in ("mart_seller_performance", "mart_exec_daily"):
        mart, expected = lone.mart(name), whole[name]
        assert mart.columns == expected.columns and expected.count() > 0
        assert mart.exceptAll(expected).count() == expected.exceptAll(mart).count() == 0
        assert lone[name] is mart and whole.mart(name) is expected
        if name == "mart_seller_performance":
            assert {p.name for p in (tmp_path / "lone").iterdir()} == {name}
    stored = {p.name for p in (tmp_path / "lone").iterdir()}
    assert not stored & {"fact_orders", "fact_reviews", "int_order_delivery", "order_customers", "stg_order_items"}
    # What is built already is read: a mart asked for after a publish adds nothing.
    assert whole.mart("mart_fulfillment_ops") is whole["mart_fulfillment_ops"]


def test_partitions_are_upserted_without_storing_the_whole_fact(spark, monkeypatch):
    monkeypatch.setattr(context, "_CACHE", {})
    found = queries.QUERIES["i1_incremental_partitions"][0](spark, SMALL)
    w = context.published(spark, SMALL)
    assert "int_order_delivery" in w._built and "fact_orders" not in w._built
    assert found.exceptAll(queries.QUERIES["i1_incremental_upsert"][0](spark, SMALL)).count() == 0


@pytest.mark.parametrize("name", ["h02_unique", "h03_unique_combination"])
def test_keys_are_checked_without_storing_facts_or_marts(spark, monkeypatch, name):
    monkeypatch.setattr(context, "_CACHE", {})
    assert queries.QUERIES[name][0](spark, SMALL).count() > 10
    w = context.published(spark, SMALL)
    assert "stg_orders" in w._built and not [n for n in w._built if n.startswith(("fact_", "mart_", "int_"))]
    # What has been built by then is what is checked.
    twice = w["stg_orders"].unionAll(w["stg_orders"])
    w.adopt("stg_orders", twice)
    assert queries.CheckedTables(Plans(w))["stg_orders"] is twice


@pytest.mark.parametrize("key", ["h11", "h14"])
def test_checks_of_few_columns_store_those_and_read_what_is_published(spark, monkeypatch, key):
    monkeypatch.setattr(context, "_CACHE", {})
    relation = queries.DAMAGE[key].relation
    check = next(query for name, (query, _) in queries.QUERIES.items() if name.startswith(f"{key}_"))
    assert check(spark, SMALL).select("dataset").distinct().collect() == [("damaged",)]
    w = context.published(spark, SMALL)
    assert "stg_orders" in w._built and relation not in w._built
    w.adopt(relation, w["stg_orders"])
    assert queries._narrow(spark, w, key, relation) is w
