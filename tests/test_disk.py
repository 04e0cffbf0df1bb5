"""What a publish and its checks leave on the executors' disks."""

from pyspark.sql import functions as F

from marketlane.operators import intermediate
from marketlane.plans import context, incremental, queries
from marketlane.plans.warehouse import Warehouse
from marketlane.sources import tables


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (str(files.apply(n)) for n in range(files.size())) if "shuffle_" in name}


def counted(spark):
    return spark.range(2000).groupBy((F.col("id") % 500).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    table, before = str(tmp_path / "t"), shuffle_files(spark)
    tables.replace_table(counted(spark), table, ["n"], ["k"])
    tables.overwrite_partitions(counted(spark), table, ["n"])
    tables.upsert_partitions(counted(spark), table, ["k"], "n", ["k"])
    tables.replace_days(counted(spark), table, "n", spark.range(0).select("id"), ["k"])
    read = tables.write_files(counted(spark), str(tmp_path / "files"))
    assert shuffle_files(spark) <= before
    assert read.count() == tables.read_table(spark, table).count() == 500


def test_the_sessions_own_queries_keep_their_shuffles(spark):
    with tables.shuffles_given_back(spark), tables.shuffles_given_back(spark):
        assert spark.conf.get(tables.GIVE_BACK) == "true"
    assert spark.conf.get(tables.GIVE_BACK) == "false"
    spark.conf.set(tables.GIVE_BACK, "true")
    try:
        with tables.shuffles_given_back(spark):
            pass
        assert spark.conf.get(tables.GIVE_BACK) == "true"
    finally:
        spark.conf.unset(tables.GIVE_BACK)


def test_a_day_publish_computes_seller_days_once_and_leaves_none(spark, tmp_path, monkeypatch):
    w, made = context.lazy(spark, "/root/testdata/sf0.001"), []
    build = intermediate.int_seller_daily_performance
    monkeypatch.setattr(intermediate, "int_seller_daily_performance", lambda *a: made.append(1) or build(*a))
    day = F.substring(F.trim("order_purchase_timestamp"), 1, 10)
    few = {**w.raw, "orders": w.raw["orders"].filter(day.between("1998-03-01", "1998-03-04"))}
    folder = tmp_path / "w"
    first = Warehouse(few, w.settings, str(folder))
    first.publish()
    assert len(made) == 1 and not (folder / "int_seller_daily_performance").exists()
    incremental.publish_again(spark, Warehouse.open(spark, str(folder), w.settings, few))
    assert len(made) == 2 and not (folder / "int_seller_daily_performance").exists()
    stored = Warehouse.open(spark, str(folder), w.settings)["mart_seller_performance"]
    plain = Warehouse(few, w.settings)["mart_seller_performance"].select(stored.columns)
    assert stored.count() == plain.count() > 0 and stored.exceptAll(plain).isEmpty()
    # Still a relation like any other.
    assert first["int_seller_daily_performance"].count() == plain.count()


def test_the_first_fact_of_two_publishes_takes_several_jobs_at_a_time(spark, monkeypatch):
    # All that the fact follows from is named, so that nothing is left to be built one by one.
    asked = []
    monkeypatch.setattr(Warehouse, "_store", lambda self, name, frame: asked.append(name) or frame)
    w = context.lazy(spark, "/root/testdata/sf0.001")
    Warehouse(w.raw, w.settings, "/nowhere", False)["fact_orders"]
    assert set(asked) == queries.FACT_NEEDS
