"""Row-level rules counted in the pass that writes a relation."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from marketlane.operators import quality
from marketlane.plans import context, incremental, rules
from marketlane.plans.warehouse import LAYOUT, Warehouse
from marketlane.settings import Settings
from marketlane.sources import tables

SETTINGS = Settings(now=datetime(2020, 1, 1, tzinfo=UTC))
KINDS = set(quality.ROW_RULES)


def counts(frame):
    return sorted(tuple(r) for r in frame.collect())


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scanned(w):
    """Every row-level rule by a scan of its relation."""
    declared = {n: rules.ALL_RULES[n] for n in LAYOUT if n in rules.ALL_RULES}
    return quality.rule_counts({n: w[n] for n in declared}, declared, KINDS)


def test_measures_of_a_write(spark, tmp_path):
    declared = quality.Rules(
        ("id",), required="kind", allowed={"kind": ("a", "b")}, ranges=(quality.Range("v", 0, 9),)
    )
    frame = spark.createDataFrame(
        [(1, "a", 5.0), (2, "x", -1.0), (None, None, None), (3, "b", 10.0), (3, "b", 10.0)],
        "id int, kind string, v double",
    )
    for n, by in enumerate(((), ("kind",))):
        for rows in (frame, frame.limit(0)):
            target = str(tmp_path / f"t{n}")
            measures = quality.row_measures(declared)
            written = tables.replace_table(rows, target, by, ("v",), allow_empty=True, measures=measures)
            found = quality.measured_counts(spark, "t", declared, written.measured, KINDS)
            assert counts(found) == counts(quality.row_rule_counts(rows, "t", declared, KINDS))
            assert written.loaded_rows == rows.count()
    assert tables.replace_table(frame, str(tmp_path / "plain")).measured == {}


def test_a_relation_without_row_rules(spark):
    frame = spark.createDataFrame([(1,), (1,)], "id int")
    only_key = {"t": quality.Rules(more_keys=(("id",),))}
    assert quality.row_measures(only_key["t"]) == {}
    found = quality.rule_counts({"t": frame}, only_key, measured={"t": {}})
    assert counts(found) == [("t", "unique", "id", 1)]


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """The orders of the last weeks, some with a status and items with a price that rules forbid."""
    raw = context.lazy(spark, "/root/testdata/sf0.001").raw
    bought = F.to_date(F.substring(F.trim("order_purchase_timestamp"), 1, 10))
    orders = raw["orders"].filter(bought >= "1998-05-01")
    third = F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0
    orders = orders.withColumn("order_status", F.when(third, "lost").otherwise(F.col("order_status")))
    items = raw["order_items"].withColumn("price", F.when(third, "-1").otherwise(F.col("price")))
    damaged = {**raw, "orders": orders, "order_items": items}
    target = str(tmp_path_factory.mktemp("measured"))
    w = Warehouse(damaged, SETTINGS, target, day_partitions=False, rules=rules.ALL_RULES)
    w.publish()
    return w


def test_published_relations_are_checked_without_another_scan(warehouse):
    found = warehouse.rule_counts(KINDS)
    assert "FileScan" not in plan(found) and "FileScan" in plan(scanned(warehouse))
    assert set(warehouse.measured) == {n for n in LAYOUT if n in rules.ALL_RULES}
    assert counts(found) == counts(scanned(warehouse))
    bad = {(r["relation"], r["rule"], r["columns"]): r["violations"] for r in found.collect()}
    assert bad["stg_orders", "accepted_values", "order_status"] > 0
    assert bad["stg_order_items", "accepted_range", "item_price"] > 0


def test_a_second_publish_counts_again(spark, warehouse):
    raw = {**warehouse.raw}
    raw["orders"] = raw["orders"].withColumn("order_status", F.lit("delivered"))
    w = Warehouse.open(spark, warehouse.folder, SETTINGS, raw, day_partitions=False)
    w.rules = rules.ALL_RULES
    incremental.publish_again(spark, w)
    assert "fact_orders" not in w.measured and "stg_orders" in w.measured
    found = counts(w.rule_counts(KINDS))
    assert found == counts(scanned(w))
    assert ("stg_orders", "accepted_values", "order_status", 0) in found
