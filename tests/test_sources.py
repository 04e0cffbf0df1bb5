"""Landing files, stored tables and enrichment payloads."""

import json
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlane.sources import enrichment, landing, raw_files, tables
from marketlane.sources.registry import SOURCES, source_of_file

MOMENT = datetime(2024, 1, 2, 3, 4, 5, 6, tzinfo=UTC)


def test_header_cleanup(spark):
    frame = spark.createDataFrame([(1, 2)], "`Order ID` int, `Customer-ID ` int")
    assert raw_files.standardize_columns(frame).columns == ["order_id", "customer_id"]
    with pytest.raises(ValueError, match="duplicate.*order_id"):
        raw_files.standardize_columns(spark.createDataFrame([(1, 2)], "`Order ID` int, order_id int"))
    with pytest.raises(ValueError, match="empty"):
        raw_files.standard_name(" -- ")


def test_required_columns(spark):
    spec = SOURCES["sellers"]
    frame = spark.createDataFrame([], spec.schema).withColumn("extra", F.lit(1))
    assert raw_files.require_columns(frame, spec) is frame
    with pytest.raises(ValueError, match="seller_city"):
        raw_files.require_columns(frame.drop("seller_city"), spec)


def test_batch_metadata(spark):
    frame = spark.range(1)
    row = raw_files.add_batch_metadata(frame, "/in/My File.csv", ingested_at=MOMENT).first()
    assert row["batch_id"] == "my_file_20240102T030405000006Z"
    assert row["source_file_name"] == "My File.csv"
    with pytest.raises(ValueError, match="already exist"):
        raw_files.add_batch_metadata(frame.withColumn("batch_id", F.lit("x")), "f.csv")
    with pytest.raises(ValueError, match="timezone"):
        raw_files.add_batch_metadata(frame, "f.csv", ingested_at=datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="empty"):
        raw_files.add_batch_metadata(frame, "f.csv", batch_id=" ")


@pytest.mark.parametrize(
    "name, source",
    [
        ("orders_dataset.csv", "orders"),
        ("shop_orders_dataset.csv", "orders"),
        ("shop_order_items_dataset.csv", "order_items"),
        ("orders_dataset.csv.bak", None),
        ("a_b_orders_dataset.csv", None),
        ("notes.txt", None),
    ],
)
def test_file_names(spark, name, source):
    assert source_of_file(name) == source
    assert spark.range(1).select(landing.source_name(F.lit(name))).first()[0] == source


def test_discovery_lists_known_files_per_batch(spark, tmp_path):
    for batch, name in (
        ("b2", "x_orders_dataset.csv"),
        ("b1", "x_customers_dataset.csv"),
        ("b1", "readme.txt"),
    ):
        (tmp_path / batch).mkdir(exist_ok=True)
        (tmp_path / batch / name).write_text("a\n1\n")
    (tmp_path / "x_orders_dataset.csv").write_text("a\n")
    found = landing.discover_batch_files(spark, str(tmp_path)).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["source_name"]) for r in found] == [("b1", "customers"), ("b2", "orders")]
    assert spark.read.option("header", True).csv(found[0]["path"]).count() == 1


def test_prepare_raw_reads_quoted_lines(spark, tmp_path):
    path = tmp_path / "order_reviews_dataset.csv"
    path.write_text(
        "Review ID,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines, and ""quotes""",2020-01-01,2020-01-02\n'
    )
    frame = raw_files.prepare_raw(spark, str(path), SOURCES["order_reviews"], "b", MOMENT)
    (row,) = frame.collect()
    assert row["review_comment_message"] == 'two\nlines, and "quotes"'
    assert row["review_comment_title"] is None and row["batch_id"] == "b"


def test_replace_is_all_or_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    frame = spark.range(5)
    result = tables.replace_table(frame, table)
    assert (result.loaded_rows, result.columns, result.state) == (5, 1, "completed")
    before = tables.read_table(spark, table)
    tables.replace_table(spark.range(2), table)
    assert tables.read_table(spark, table).count() == 2
    assert before.count() == 5
    with pytest.raises(tables.EmptyInputError):
        tables.replace_table(spark.range(0), table)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, table)
    assert tables.read_table(spark, table).count() == 2
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v=")]) == 2


def test_append(spark, tmp_path):
    table = str(tmp_path / "t")
    tables.append_table(spark.range(2), table)
    assert tables.append_table(spark.range(3), table).loaded_rows == 3
    assert tables.read_table(spark, table).count() == 5
    assert tables.append_table(spark.range(0), table, allow_empty=True).state == "no_op"
    with pytest.raises(tables.EmptyInputError):
        tables.append_table(spark.range(0), table)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_upsert_touches_only_the_partitions_it_must(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = "k string, day string, v int"
    old = [("a", "d1", 1), ("b", "d1", 2), ("c", "d2", 3), ("e", "d3", 4), ("n", None, 5)]
    tables.replace_table(spark.createDataFrame(old, schema), table, ["day"])
    untouched = {p.name for p in (tmp_path / "t").glob("v=*/day=d3/*.parquet")}
    # b changes, c moves from d2 (which empties) to d1, n moves out of the NULL day, x is new.
    new = spark.createDataFrame([("b", "d1", 20), ("c", "d1", 30), ("n", "d4", 50), ("x", "d4", 6)], schema)
    for _ in range(2):
        tables.upsert_partitions(new, table, ["k"], "day", ["k"])
        rows = tables.read_table(spark, table).select("k", "day", "v").orderBy("k").collect()
        assert [tuple(r) for r in rows] == [
            ("a", "d1", 1),
            ("b", "d1", 20),
            ("c", "d1", 30),
            ("e", "d3", 4),
            ("n", "d4", 50),
            ("x", "d4", 6),
        ]
    assert {p.name for p in (tmp_path / "t").glob("v=*/day=d3/*.parquet")} == untouched
    assert not list((tmp_path / "t").glob("_staged*"))


def test_upsert_with_other_columns_rewrites_the_table(spark, tmp_path):
    table = str(tmp_path / "t")
    old = spark.createDataFrame([("a", "d1", 1), ("b", "d2", 2)], "k string, day string, gone int")
    tables.replace_table(old, table, ["day"])
    new = spark.createDataFrame([("b", "d3", True)], "k string, day string, added boolean")
    tables.upsert_partitions(new, table, ["k"], "day")
    rows = tables.read_table(spark, table).select("k", "day", "added").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("a", "d1", None), ("b", "d3", True)]
    assert "gone" not in tables.read_table(spark, table).columns


def test_holidays(spark, tmp_path):
    records = [
        {
            "date": "2024-01-01",
            "localName": "Ano",
            "name": "New Year",
            "countryCode": "BR",
            "global": False,
            "counties": ["BR-SP", 'a"b'],
            "launchYear": None,
            "types": ["Public"],
        },
        {"date": "2025-01-01", "name": "Next", "countryCode": "BR", "global": True, "counties": None, "types": []},
    ]
    path = tmp_path / "h.json"
    path.write_text("\n".join(json.dumps(r) for r in records))
    frame = enrichment.read_json(spark, str(path), enrichment.HOLIDAY_JSON)
    rows = enrichment.normalize_holidays(frame, date(2024, 1, 1), date(2025, 12, 31)).collect()
    first, second = sorted(rows, key=lambda r: r["holiday_date"])
    assert first["counties_json"] == json.dumps(records[0]["counties"])
    assert first["holiday_types_json"] == '["Public"]' and first["launch_year"] is None
    assert second["counties_json"] is None and second["holiday_types_json"] == "[]"
    assert enrichment.normalize_holidays(frame, date(2024, 1, 1), date(2024, 1, 1)).count() == 1
    assert enrichment.country_code(" br ") == "BR"
    with pytest.raises(ValueError):
        enrichment.country_code("BRA")


def test_weather_defaults(spark, tmp_path):
    path = tmp_path / "w.json"
    path.write_text(
        json.dumps({"date": "2024-01-01", "lat": 1.5, "temperature": {"max": 30}, "wind": {"max": {"speed": 2}}})
    )
    place = enrichment.WeatherLocation("here", 9.0, 8.0, "-03:00", "metric")
    frame = enrichment.read_json(spark, str(path), enrichment.WEATHER_JSON)
    (row,) = enrichment.normalize_weather(frame, place).collect()
    assert (row["latitude"], row["longitude"], row["timezone"]) == (1.5, 8.0, "-03:00")
    assert (row["temperature_max"], row["temperature_min"], row["wind_max_speed"]) == (30.0, None, 2.0)
    assert row["humidity_afternoon"] is None and len(row) == 18


def test_weather_budget():
    assert enrichment.require_budget(date(2016, 9, 4), date(2018, 10, 17), 900) == 774
    with pytest.raises(ValueError, match="budget"):
        enrichment.require_budget(date(2024, 1, 1), date(2024, 1, 3), 2)
    with pytest.raises(ValueError):
        enrichment.call_count(date(2024, 1, 2), date(2024, 1, 1))


def test_empty_partitioned_table_keeps_its_schema(spark, tmp_path):
    table = str(tmp_path / "t")
    empty = spark.createDataFrame([], "id bigint, day date")
    tables.replace_table(empty, table, ["day"], allow_empty=True)
    stored = tables.read_table(spark, table)
    assert stored.count() == 0 and dict(stored.dtypes) == {"id": "bigint", "day": "date"}


def test_another_layout_is_refused_and_new_columns_are_seen(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "0007")], "id bigint, batch string")
    tables.replace_table(rows, table, ["batch"])
    with pytest.raises(tables.LayoutError):
        tables.append_table(rows, table)
    wider = spark.createDataFrame([(2, "0008", "hi")], "id bigint, batch string, note string")
    tables.overwrite_partitions(wider, table, ["batch"])
    found = {(r["id"], r["batch"], r["note"]) for r in tables.read_table(spark, table).collect()}
    assert found == {(1, "0007", None), (2, "0008", "hi")}


def test_two_writers_take_different_versions_and_a_late_one_conflicts(spark, tmp_path):
    table = str(tmp_path / "t")
    tables.replace_table(spark.range(1), table)
    base = tables.current_path(spark, table)
    claimed = tables._claim(spark, table)
    tables.replace_table(spark.range(2), table, based_on=base)
    assert tables.current_path(spark, table) != claimed
    with pytest.raises(tables.ConflictError):
        tables.replace_table(spark.range(3), table, based_on=base)
    assert tables.read_table(spark, table).count() == 2


def test_versions_stay_by_age(spark, tmp_path):
    table = str(tmp_path / "t")
    for n in range(4):
        tables.replace_table(spark.range(n + 1), table)
    assert len(tables._versions(spark, table)) == 4
    tables.replace_table(spark.range(9), table, keep_for=timedelta(0))
    assert len(tables._versions(spark, table)) <= 2
    assert tables.read_table(spark, table).count() == 9


def test_batches_land_in_one_pass_as_they_do_one_by_one(spark, tmp_path):
    rows = [("1", " a,\"b", "1992"), ("2", None, "1993"), ("3", "", "1992"), ("4", "x\ny ", "é 7")]
    frame = spark.createDataFrame(rows, "k string, v string, _batch string")
    seen = spark.sparkContext.accumulator(0)
    counted = spark.createDataFrame(frame.rdd.map(lambda r: (seen.add(1), r)[1]), frame.schema)
    name = SOURCES["sellers"].file_suffix
    paths = landing.land_batches(counted, "_batch", f"{tmp_path}/l", name)
    assert len(paths) == 3 and seen.value == len(rows)
    for batch in ("1992", "1993", "é 7"):
        one = landing.land_csv(frame.filter(F.col("_batch") == batch).drop("_batch"), f"{tmp_path}/one", batch, name)
        frames = [raw_files.read_csv(spark, p, ["k", "v"]) for p in (one, f"{tmp_path}/l/{batch}/{name}")]
        assert frames[0].exceptAll(frames[1]).isEmpty() and frames[0].count() == frames[1].count() > 0
    found = {r["batch_id"] for r in landing.discover_batch_files(spark, f"{tmp_path}/l").collect()}
    assert found == {"1992", "1993", "é 7"}
    with pytest.raises(Exception, match="no batch|could not be landed"):
        landing.land_batches(frame.withColumn("_batch", F.lit(None).cast("string")), "_batch", f"{tmp_path}/n", name)
    with pytest.raises(FileExistsError, match="could not be landed"):
        landing.land_batches(frame, "_batch", f"{tmp_path}/l", name)
