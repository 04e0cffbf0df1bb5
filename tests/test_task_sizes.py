"""How much a task takes in, and how much of a publish runs at a time."""

import glob
import threading

from pyspark.sql import functions as F

from marketlane import session
from marketlane.plans import context, incremental
from marketlane.plans.warehouse import Warehouse
from marketlane.sources import tables

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_a_small_table_in_day_folders_is_written_by_several_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        days = F.expr("date_add(DATE'2020-01-01', cast(id % 300 as int))")
        rows = spark.range(9000).select(days.alias("day"), F.md5(F.col("id").cast("string")).alias("k"))
        table = str(tmp_path / "t")
        tables.replace_table(rows, table, ["day"], ["k"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = glob.glob(f"{table}/v=*/day=*/part-*.parquet")
    tasks = {f.rsplit("/", 1)[1].split("-")[1] for f in files}
    assert len(files) == 300 and len(tasks) > 1
    assert tables.read_table(spark, table).select("day", "k").exceptAll(rows).isEmpty()


def test_shuffle_partitions_follow_the_input_and_a_set_number_stays(spark):
    start = spark.conf.get(INITIAL, None)
    try:
        spark.conf.unset(INITIAL)
        session.size_shuffles(spark, 6 << 30)
        large = int(spark.conf.get(INITIAL))
        session.size_shuffles(spark, 1 << 30)
        assert large == 6 * int(spark.conf.get(INITIAL)) == (6 << 30) // session.INPUT_PER_PARTITION
        session.size_shuffles(spark, 1000)
        assert spark.conf.get(INITIAL) == spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set(INITIAL, "77")
        session.size_shuffles(spark, 6 << 30)
        assert spark.conf.get(INITIAL) == "77"
    finally:
        spark.conf.unset(INITIAL)
        if start is not None:
            spark.conf.set(INITIAL, start)


def test_marts_of_a_second_publish_are_built_at_a_time(spark, tmp_path, monkeypatch):
    w = context.lazy(spark, "/root/testdata/sf0.001")
    day = F.substring(F.trim("order_purchase_timestamp"), 1, 10)
    few = w.raw["orders"].filter(day.between("1998-03-01", "1998-03-05"))
    folder = str(tmp_path / "w")
    Warehouse({**w.raw, "orders": few}, w.settings, folder).publish()
    together, replace = threading.Barrier(2, timeout=120), tables.replace_days

    def meeting(frame, table, *more):
        if table.endswith(("mart_exec_daily", "mart_fulfillment_ops")):
            together.wait()  # breaks when the second mart waits for the first to end
        return replace(frame, table, *more)

    monkeypatch.setattr(tables, "replace_days", meeting)
    status = F.when(day == "1998-03-03", "canceled").otherwise(F.col("order_status"))
    raw = {**w.raw, "orders": few.withColumn("order_status", status)}
    incremental.publish_again(spark, Warehouse(raw, w.settings, folder))
    stored = Warehouse.open(spark, folder, w.settings)
    day = stored["mart_exec_daily"].filter("calendar_date = DATE'1998-03-03'").first()
    assert day is None or day["cancelled_orders_count"] == day["orders_count"]


def test_customers_of_many_orders_are_not_made_in_one_task(spark):
    customers = context.lazy(spark, "/root/testdata/sf0.001").raw["customers"]
    plan = customers._jdf.queryExecution().executedPlan().toString()
    orders = plan[: plan.index("o_orderkey")]
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in orders
