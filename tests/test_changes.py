"""Second publishes that rebuild changed days of the marts only."""

import glob
import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from marketlane.plans import changes, context, incremental
from marketlane.plans.warehouse import Warehouse
from marketlane.settings import Settings
from marketlane.sources import tables

NOW = Settings(now=datetime(2020, 1, 1, tzinfo=UTC))
LATER = Settings(now=datetime(2020, 2, 1, tzinfo=UTC))


def numbered(spark, values):
    return spark.createDataFrame(values, "d date, k string, v double")


def test_digests_tell_rows_nulls_and_repeats_apart(spark):
    day, other = datetime(2020, 1, 1).date(), datetime(2020, 1, 2).date()
    base = [(day, "a", None), (day, None, 1.0), (None, "a", 1.0), (other, "x", 2.0)]

    def state(values):
        return changes.day_digests(numbered(spark, values), "d").select(F.lit("t").alias("input"), "*")

    def differing(values):
        found = changes.changed_days(state(base), state(values)).collect()
        return {r[changes.DAY] for r in found}

    assert differing(base[::-1]) == set()
    assert differing([*base, *base[:1], *base[:1]]) == {day}
    assert differing([(day, None, None), (day, "a", 1.0), *base[2:]]) == {day}
    assert differing(base[:2] + base[3:]) == {None}
    assert differing(base[:3]) == {other}
    assert differing([]) == {day, other, None}


def folders(folder, name):
    """Day folder -> its files."""
    table = sorted(glob.glob(f"{folder}/{name}/v=*"))[-1]
    return {
        os.path.basename(d): sorted(os.path.basename(f) for f in glob.glob(f"{d}/*.parquet"))
        for d in glob.glob(f"{table}/*=*")
    }


def content(frame):
    rows = frame.select(*sorted(frame.columns)).collect()
    return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows], key=repr)


@pytest.fixture(scope="module")
def raw(spark):
    """The orders of the last weeks."""
    whole = context.lazy(spark, "/root/testdata/sf0.001").raw
    bought = F.to_date(F.substring(F.trim("order_purchase_timestamp"), 1, 10))
    newest = whole["orders"].agg(F.max(bought)).first()[0]
    orders = whole["orders"].filter(F.datediff(F.lit(newest), bought) < 60)
    return {**whole, "orders": orders}


def test_only_changed_days_are_written_again(spark, tmp_path, raw, monkeypatch):
    folder = str(tmp_path / "w")
    Warehouse(raw, NOW, folder).publish()
    before = {name: folders(folder, name) for name in changes.DAY_MARTS}
    day = F.substring(F.trim("order_purchase_timestamp"), 1, 10)
    days = sorted(r[0] for r in raw["orders"].select(day).distinct().collect())
    moved, cancelled = days[3], days[10]
    orders = raw["orders"].withColumn(
        "order_purchase_timestamp",
        F.when(day == moved, F.lit(f"{days[4]} 10:00:00")).otherwise(F.col("order_purchase_timestamp")),
    ).withColumn("order_status", F.when(day == cancelled, "canceled").otherwise(F.col("order_status")))
    after = {**raw, "orders": orders}
    expected = Warehouse(after, LATER)

    # The run breaks off after the first mart; the next one takes up its days.
    replace = tables.replace_days

    def broken(frame, table, *more):
        if table.endswith("mart_customer_experience"):
            raise RuntimeError("lost")
        return replace(frame, table, *more)

    with monkeypatch.context() as lost:
        lost.setattr(tables, "replace_days", broken)
        with pytest.raises(RuntimeError):
            incremental.publish_again(spark, Warehouse(after, LATER, folder))
    incremental.publish_again(spark, Warehouse(after, LATER, folder))
    stored = Warehouse.open(spark, folder, LATER)
    for name, mart in changes.DAY_MARTS.items():
        assert content(stored[name]) == content(expected[name]), name
        now = folders(folder, name)
        kept = {d for d in before[name] if d.split("=")[1] not in {moved, days[4], cancelled}}
        assert {d: now.get(d) for d in kept} == {d: before[name][d] for d in kept}, name
        assert f"{mart.day}={moved}" not in now


def test_a_date_filter_prunes_folders(spark, tmp_path, raw):
    folder = str(tmp_path / "w")
    w = Warehouse(raw, NOW, folder)
    mart = w["mart_seller_performance"]
    day = mart.agg(F.max("calendar_date")).first()[0]
    one = mart.filter(F.col("calendar_date") == F.lit(day))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(calendar_date" in plan
    path = tables.current_path(spark, w.table("mart_seller_performance"))
    files = spark.read.parquet(f"{path}/calendar_date={day}").groupBy(F.input_file_name())
    for row in files.agg(F.collect_list("seller_id").alias("sellers")).collect():
        assert row["sellers"] == sorted(row["sellers"])
