"""Checks of few columns: no more is stored than they read, and they count the same."""

import pytest
from pyspark.sql import functions as F

from marketlane.operators import quality
from marketlane.plans import context, queries, rules
from marketlane.plans.warehouse import NARROW_STEPS, Narrow, Warehouse
from marketlane.sources import tables

SMALL = "/root/testdata/sf0.001"
KINDS = sorted(queries.STORED_FOR_RULES)


@pytest.fixture(scope="module")
def untidy(spark):
    """Raw rows that break rules of every kind, in the facts and marts too."""
    w = context.lazy(spark, SMALL)
    number = F.col("order_id").cast("bigint")
    some = lambda n, value, column: F.when(number % n == 0, value).otherwise(F.col(column))
    items = w.raw["order_items"].withColumns(
        {
            "product_id": some(7, F.lit("nothing"), "product_id"),
            "seller_id": some(9, F.lit(None).cast("string"), "seller_id"),
            "price": some(5, F.lit("-3.5"), "price"),
        }
    )
    orders = w.raw["orders"].withColumns(
        {
            "customer_id": some(11, F.lit("nobody"), "customer_id"),
            "order_status": some(13, F.lit("lost"), "order_status"),
        }
    )
    reviews = w.raw["order_reviews"].withColumn("review_score", some(4, F.lit("9"), "review_score"))
    return {**w.raw, "order_items": items, "orders": orders, "order_reviews": reviews}


def counts(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("kind", KINDS)
def test_rules_count_the_same_over_few_columns(spark, untidy, tmp_path, kind):
    whole = Warehouse(untidy, context.settings(), str(tmp_path / "whole"), False)
    expected = counts(quality.rule_counts(queries.CheckedTables(whole), rules.ALL_RULES, {kind}))
    assert kind.startswith("unique") or any(row[3] for row in expected if row[0].startswith("fact_"))
    w = Warehouse(untidy, context.settings(), str(tmp_path / "w"), False, rules=rules.ALL_RULES)
    w.build(names=queries.STORED_FOR_RULES[kind].split())
    narrow = Narrow(w, str(tmp_path / "n"), queries.NARROW_FOR_RULES[kind], rules.ALL_RULES, {kind}).build()
    assert counts(queries._counted_by_relation(spark, narrow, kind)) == expected


@pytest.mark.parametrize("key", ["h03", "h04", "h05", "h06", "h18"])
def test_checks_store_few_columns_only(spark, monkeypatch, key):
    monkeypatch.setattr(context, "_CACHE", {})
    check = next(query for name, (query, _) in queries.QUERIES.items() if name.startswith(f"{key}_"))
    assert check(spark, SMALL).count() > 5
    w = context.published(spark, SMALL)
    assert "stg_orders" in w._built and not [n for n in w._built if n.startswith(("fact_", "mart_", "int_"))]


def test_rules_leave_nothing_beside_the_published_tables(spark, monkeypatch):
    monkeypatch.setattr(context, "_CACHE", {})
    path = []
    monkeypatch.setattr(queries.session, "fresh_folder", lambda s, label, make=queries.session.fresh_folder: (
        path.append(make(s, label)) or path[-1]
    ))
    queries.QUERIES["h05_accepted_values"][0](spark, SMALL)
    stored = [p for p in path if "narrow" in p]
    assert stored and not any(tables.path_exists(spark, p) for p in stored)


def test_a_column_that_is_not_stored_fails_and_built_relations_are_read(spark, tmp_path):
    w = Warehouse(context.lazy(spark, SMALL).raw, context.settings(), str(tmp_path / "w"), False)
    w.build(names=["stg_orders", "stg_order_items", "stg_products"])
    narrow = Narrow(w, str(tmp_path / "n"), {"int_order_value": "order_id order_items_count"}).build()
    value = narrow["int_order_value"]
    whole = context.lazy(spark, SMALL)["int_order_value"]
    assert value.dtypes == whole.dtypes
    assert value.select("order_id", "order_items_count").exceptAll(
        whole.select("order_id", "order_items_count")
    ).isEmpty()
    with pytest.raises(Exception, match="int_order_value.order_item_value is not stored"):
        value.select("order_item_value").collect()
    w.adopt("int_order_value", whole)
    assert narrow["int_order_value"] is whole


def test_every_narrow_relation_has_a_step():
    named = {n for columns in queries.NARROW_FOR_RULES.values() for n in columns} | {*queries.NARROW_FOR_EXPERIENCE}
    assert named <= {n for step in NARROW_STEPS for n in step}


@pytest.mark.parametrize("kind", ["not_null", *KINDS])
def test_kinds_of_rules_are_told_from_counts(spark, kind):
    frame = spark.createDataFrame([], "a int, b int")
    for declared in (
        quality.Rules(),
        quality.Rules(("a",), key_where="b > 0"),
        quality.Rules(("a",), more_keys=(("a", "b"),)),
        quality.Rules(("a", "b"), references=(("a", "t", "a"),)),
        quality.Rules(allowed={"a": ("1",)}, ranges=(quality.Range("a"),)),
        quality.Rules(required="b", ranges=(quality.Range(""),)),
    ):
        try:
            found = quality.rule_counts({"t": frame}, {"t": declared}, {kind}).count() > 0
        except TypeError:  # nothing to count
            found = False
        assert found == quality.has_rules(declared, kind)
