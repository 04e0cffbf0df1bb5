"""Staging of untidy input."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from marketlane.operators import staging
from marketlane.sources.registry import SOURCES

EARLY, LATE = datetime(2020, 1, 1), datetime(2020, 1, 2)


def raw(spark, source, *rows):
    """Rows are (values..., batch, ingested)."""
    names = list(SOURCES[source].columns)
    schema = ", ".join(f"{n} string" for n in names) + ", batch_id string, ingested_at_utc timestamp"
    return spark.createDataFrame(list(rows), schema).withColumn("source_file_name", F.lit(" f.csv "))


def test_orders_keep_the_newest_record_and_clean_it(spark):
    frame = raw(
        spark,
        "orders",
        (" o1", "c1", "created", "2017-01-01 10:00:00", "", "", "", "", "b1", EARLY),
        ("o1\t", "c1", " DELIVERED\n", "2017-01-01 10:00:00", "x", "2017", "2017-01-05", "2017-01-09", "b1", LATE),
        ("o2", " ", "", "bad", None, None, None, None, "b1", EARLY),
    )
    rows = {r["order_id"]: r for r in staging.stg_orders(frame).collect()}
    assert set(rows) == {"o1", "o2"}
    assert rows["o1"]["order_status"] == "delivered"
    assert rows["o1"]["order_approved_at_utc"] is None
    assert rows["o1"]["order_delivered_to_carrier_at_utc"] is None
    assert rows["o1"]["order_delivered_to_customer_at_utc"] is not None
    assert rows["o1"]["source_file_name"] == "f.csv"
    assert rows["o2"]["order_status"] is None and rows["o2"]["customer_id"] is None
    assert rows["o2"]["order_purchased_at_utc"] is None


def test_equal_ingest_time_falls_to_the_larger_batch(spark):
    frame = raw(
        spark,
        "sellers",
        ("s1", "10", "old", "sp", "b1", EARLY),
        ("s1", "11", "new", "sp", "b2", EARLY),
        ("s1", "12", "none", "sp", "b9", None),
    )
    (row,) = staging.stg_sellers(frame).collect()
    assert (row["seller_city"], row["seller_zip_code_prefix"], row["seller_state"]) == ("new", 11, "SP")


def test_exact_duplicates_and_ties_are_settled(spark):
    rows = [("o1", str(n % 2), "p", "s", "2017-01-01", f"{n}.5", "1", "b", EARLY) for n in range(6)]
    frame = raw(spark, "order_items", *rows, *rows)
    first = staging.stg_order_items(frame).orderBy("order_item_id").collect()
    again = staging.stg_order_items(frame.repartition(3)).orderBy("order_item_id").collect()
    assert first == again
    assert [r["item_price"] for r in first] == [Decimal("4.500000000"), Decimal("5.500000000")]


def test_products_measures_are_rounded(spark):
    frame = raw(
        spark, "products", ("p", " Toys ", "40.0", "2.5", "", "1.25", "x", None, "7", "b", EARLY)
    )
    (row,) = staging.stg_products(frame).collect()
    assert (row["product_name_length"], row["product_description_length"]) == (40, 3)
    assert row["product_photos_count"] is None and row["product_length_cm"] is None
    assert row["product_weight_g"] == Decimal("1.250000000")
    assert row["product_category_name"] == "toys"


def test_geolocation_key_marks_missing_parts(spark):
    frame = raw(
        spark,
        "geolocation",
        ("1", "-23.54562128115268", "-46.6", "City ", "sp", "b1", EARLY),
        ("1", "-23.5456212", "-46.60000004", "city", "SP", "b2", EARLY),
        (None, None, "bad", None, None, "b1", EARLY),
    )
    rows = staging.stg_geolocation(frame).collect()
    expected = frame.sparkSession.range(1).select(
        F.md5(F.lit("1|-23.545621|-46.600000|city|SP")).alias("a"),
        F.md5(F.lit("__null__|__null__|__null__|__null__|__null__")).alias("b"),
    ).first()
    assert {r["geolocation_observation_key"] for r in rows} == {expected["a"], expected["b"]}
    assert {r["batch_id"] for r in rows} == {"b1", "b2"}


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    """The plan limits each key on the map side, so hot duplicates do not travel."""
    frame = raw(spark, "sellers", ("s1", "10", "a", "sp", "b1", EARLY))
    plan = staging.stg_sellers(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
