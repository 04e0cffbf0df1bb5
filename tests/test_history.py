"""Stored histories and a second publish."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from marketlane.operators import snapshots
from marketlane.plans import context, incremental
from marketlane.plans.history import RUN, History, run_id
from marketlane.plans.warehouse import Warehouse
from marketlane.settings import Settings
from marketlane.sources import tables

T = [datetime(2020, month, 1, tzinfo=UTC) for month in (1, 2, 3, 4, 5)]
TRACKED = ["city", "zip"]


def state(spark, rows):
    return spark.createDataFrame(rows, "seller_id string, city string, zip bigint")


STATES = [
    [("a", "x", 1), ("b", "x", None), ("c", None, 3)],
    [("a", "y", 1), ("b", "x", None), ("d", "z", 4)],
    [("a", "y", 1), ("b", "x", 2), ("c", None, 3)],
]


def rows(frame):
    return sorted(map(tuple, frame.select("seller_id", *TRACKED, *snapshots.VERSION_COLUMNS).collect()), key=repr)


def closed_files(spark, history):
    return {f for f in tables.read_table(spark, history.closed_table).inputFiles()}


def test_runs_leave_what_merges_in_memory_give(spark, tmp_path):
    history = History(str(tmp_path / "h"), "seller_id", TRACKED)
    with pytest.raises(FileNotFoundError):
        history.read(spark)
    expected, files = None, set()
    for now, told in zip(T, STATES, strict=False):
        source = state(spark, told)
        expected = (
            snapshots.first_versions(source, "seller_id", TRACKED, now) if expected is None
            else snapshots.scd2_merge(expected, source, "seller_id", TRACKED, now)
        )
        history.take(source, now)
        assert rows(history.read(spark)) == rows(expected)
        if now > T[0]:
            assert files < closed_files(spark, history)
            files = closed_files(spark, history)
    assert history.take(state(spark, STATES[0]), T[2]).state == tables.NO_OP
    with pytest.raises(ValueError):
        history.take(state(spark, STATES[0]), T[0])
    assert rows(history.read(spark)) == rows(expected) and closed_files(spark, history) == files


def test_a_run_that_broke_off_shows_nowhere(spark, tmp_path, monkeypatch):
    history = History(str(tmp_path / "h"), "seller_id", TRACKED)
    history.take(state(spark, STATES[0]), T[0])
    before = rows(history.read(spark))
    with monkeypatch.context() as broken:
        broken.setattr(tables, "replace_table", _only_partitioned(tables.replace_table))
        with pytest.raises(RuntimeError):
            history.take(state(spark, STATES[1]), T[1])
    assert tables.read_table(spark, history.closed_table).count() == 2
    assert rows(history.read(spark)) == before
    history.take(state(spark, STATES[1]), T[2])
    merged = snapshots.first_versions(state(spark, STATES[0]), "seller_id", TRACKED, T[0])
    assert rows(history.read(spark)) == rows(snapshots.scd2_merge(merged, state(spark, STATES[1]), "seller_id", TRACKED, T[2]))
    runs = {r[0] for r in tables.read_table(spark, history.closed_table).select(RUN).distinct().collect()}
    assert runs == {run_id(T[2])}


def _only_partitioned(replace):
    def broken(frame, table, partition_by=(), *more, **options):
        if not partition_by:
            raise RuntimeError("lost")
        return replace(frame, table, partition_by, *more, **options)

    return broken


def test_all_keys_gone_and_back(spark, tmp_path):
    history = History(str(tmp_path / "h"), "seller_id", TRACKED)
    nobody = state(spark, STATES[0]).limit(0)
    history.take(nobody, T[0])
    assert history.read(spark).count() == 0
    history.take(state(spark, STATES[0]), T[1])
    history.take(nobody, T[2])
    assert history.last_run(spark) == run_id(T[2])
    history.take(state(spark, STATES[0]), T[3])
    found = history.read(spark)
    assert found.count() == 6 and found.filter("dbt_valid_to IS NULL").count() == 3


@pytest.mark.parametrize("opened", [False, True])
def test_publish_again_takes_new_raw_rows(spark, tmp_path, opened):
    whole = context.lazy(spark, "/root/testdata/sf0.001")
    folder, now = str(tmp_path / "w"), Settings(now=T[3])
    number = F.trim("order_id").cast("bigint")
    some = {**whole.raw, "orders": whole.raw["orders"].filter(number % 5 != 0), "sellers": whole.raw["sellers"].limit(5)}
    first = Warehouse(some, Settings(now=T[2]), folder, day_partitions=False)
    first["fact_orders"], first["mart_exec_daily"]
    first.take_histories()
    if opened:
        again = Warehouse.open(spark, folder, now, whole.raw, day_partitions=False)
        again["stg_orders"]
    else:
        again = Warehouse(whole.raw, now, folder, day_partitions=False)
    # The month folders of the fact are rewritten in place: what is compared is read before.
    before, newest = first["fact_orders"].agg(F.count(F.lit(1)), F.date_sub(F.max("purchase_date"), 90)).first()
    known = first["stg_orders"].count()
    incremental.publish_again(spark, again)
    assert again["stg_orders"].count() == whole["stg_orders"].count() > known
    window = whole["fact_orders"].filter(F.col("purchase_date") > F.lit(newest))
    columns = ["order_id", "order_status", "customer_order_number", "order_total_with_freight"]
    stored = Warehouse.open(spark, folder, now)
    fresh = stored["fact_orders"].join(window.select("order_id"), "order_id", "left_semi")
    assert sorted(map(tuple, fresh.select(*columns).collect())) == sorted(map(tuple, window.select(*columns).collect()))
    assert stored["fact_orders"].count() > before
    orders = stored["fact_orders"].filter("purchase_date IS NOT NULL").count()
    assert stored["mart_exec_daily"].agg(F.sum("orders_count")).first()[0] == orders
    history = again.history("snap_sellers").read(spark)
    assert history.filter(F.col("dbt_valid_from") == F.lit(T[3])).count() == whole["dim_seller"].count() - 5
