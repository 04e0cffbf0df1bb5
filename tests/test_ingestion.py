"""Ledger, incremental load, recovery and streaming on a small landing folder."""

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from marketlane.operators import ledger as L
from marketlane.plans import workflows
from marketlane.settings import Settings
from marketlane.sources import tables
from marketlane.sources.registry import SOURCES
from marketlane.streaming import landing_stream

RUN = Settings(now=datetime(2026, 2, 1, tzinfo=UTC), weather_lookback_days=2)


def land(root, batch, source, *rows, header=None):
    folder = root / batch
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(header or SOURCES[source].columns), *rows]
    (folder / f"shop_{SOURCES[source].file_suffix}").write_text("\n".join(lines) + "\n")


ORDERS = (
    "o1,c1,delivered,2026-01-03 10:00:00,,,2026-01-07 10:00:00,2026-01-20",
    "o2,c2,delivered,2026-01-05 10:00:00,,,2026-01-09 10:00:00,2026-01-20",
)


@pytest.fixture
def store(tmp_path):
    return workflows.Store(str(tmp_path / "store"))


@pytest.fixture
def extras(tmp_path):
    holidays, weather = tmp_path / "h.json", tmp_path / "w.json"
    holidays.write_text(json.dumps({"date": "2026-01-04", "name": "Day", "countryCode": "BR"}))
    weather.write_text(
        "\n".join(json.dumps({"date": f"2026-01-0{n}", "temperature": {"max": n}}) for n in range(4, 10))
    )
    return workflows.Enrichment(str(holidays), str(weather))


def ledger_rows(spark, store):
    return {(r["source_name"], r["batch_id"]): r for r in L.read_ledger(spark, store.ledger).collect()}


def test_incremental_run_loads_enriches_and_publishes(spark, tmp_path, store, extras):
    landing = tmp_path / "in"
    land(landing, "0007", "orders", *ORDERS)
    land(landing, "0007", "customers", "c1,u1,1000,x,sp")
    first = workflows.incremental_load(spark, str(landing), store, RUN, extras)
    assert (first.raw_batches_loaded, first.batches_marked_published) == (2, 2)
    assert first.publish_complete and not first.no_op
    assert first.holiday_date_window == (date(2026, 1, 3), date(2026, 1, 5))
    assert first.weather_date_window == (date(2026, 1, 5), date(2026, 1, 9))
    orders = ledger_rows(spark, store)["orders", "0007"]
    assert (orders["holiday_status"], orders["weather_status"]) == ("succeeded", "succeeded")
    assert orders["raw_loaded_rows"] == 2 and orders["published_at_utc"] is not None
    assert tables.read_table(spark, store.raw("weather_daily")).count() == 5
    assert tables.read_table(spark, store.raw("holidays")).count() == 1

    again = workflows.incremental_load(spark, str(landing), store, RUN, extras)
    assert again.no_op and again.publish_complete and again.raw_batches_loaded == 0

    # A later batch, with its columns in another order and one more of them.
    header = [*reversed(SOURCES["orders"].columns), "note"]
    land(landing, "0008", "orders", "2026-02-20,,,,2026-02-01 09:00:00,created,c3,o3,hi", header=header)
    later = workflows.incremental_load(spark, str(landing), store, RUN, extras)
    assert later.raw_batches_loaded == 1 and later.weather_date_window is None
    stored = tables.read_table(spark, store.raw("orders"))
    assert {(r["order_id"], r["batch_id"]) for r in stored.collect()} == {
        ("o1", "0007"),
        ("o2", "0007"),
        ("o3", "0008"),
    }


def test_without_enrichment_orders_wait_and_resume_later(spark, tmp_path, store, extras):
    landing = tmp_path / "in"
    land(landing, "b1", "orders", *ORDERS)
    waiting = workflows.incremental_load(spark, str(landing), store, RUN)
    assert not waiting.publish_complete and waiting.batches_marked_published == 0
    assert ledger_rows(spark, store)["orders", "b1"]["publish_status"] == "pending"
    (tmp_path / "empty").mkdir()
    resumed = workflows.incremental_load(spark, str(tmp_path / "empty"), store, RUN, extras)
    assert resumed.publish_complete and resumed.batches_marked_published == 1
    assert resumed.raw_batches_loaded == 0


def test_failed_load_is_recorded_raised_and_retried(spark, tmp_path, store):
    landing = tmp_path / "in"
    land(landing, "b1", "orders", "o1,c1,delivered,not a time,,,,")
    with pytest.raises(ValueError, match="not a time"):
        workflows.incremental_load(spark, str(landing), store, RUN)
    row = ledger_rows(spark, store)["orders", "b1"]
    assert (row["raw_status"], row["raw_loaded_rows"], row["last_error_class"]) == ("failed", 0, "ValueError")
    land(landing, "b1", "orders", *ORDERS)
    workflows.incremental_load(spark, str(landing), store, RUN)
    row = ledger_rows(spark, store)["orders", "b1"]
    assert (row["raw_status"], row["last_error_class"], row["raw_loaded_rows"]) == ("loaded", None, 2)


def test_missing_column_fails_the_source(spark, tmp_path, store):
    landing = tmp_path / "in"
    land(landing, "b1", "sellers", "s1,1", header=["seller_id", "seller_zip_code_prefix"])
    with pytest.raises(ValueError, match="seller_city"):
        workflows.incremental_load(spark, str(landing), store, RUN)
    assert ledger_rows(spark, store)["sellers", "b1"]["raw_status"] == "failed"


def test_enrichment_failure_is_recorded(spark, tmp_path, store, extras):
    landing = tmp_path / "in"
    land(landing, "b1", "orders", *ORDERS)
    broken = workflows.Enrichment(str(tmp_path / "none.json"), None)
    with pytest.raises(Exception):
        workflows.incremental_load(spark, str(landing), store, RUN, broken)
    row = ledger_rows(spark, store)["orders", "b1"]
    assert row["holiday_status"] == "failed" and row["last_error_message"]
    done = workflows.incremental_load(spark, str(landing), store, RUN, extras)
    row = ledger_rows(spark, store)["orders", "b1"]
    assert done.publish_complete and row["last_error_message"] is None


def test_lost_window_cannot_be_resumed(spark, tmp_path, store):
    landing = tmp_path / "in"
    land(landing, "b1", "orders", *ORDERS)
    workflows.incremental_load(spark, str(landing), store, RUN)
    lost = L.read_ledger(spark, store.ledger).withColumns(
        {c: F.lit(None).cast("date") for c in L.WINDOW_COLUMNS}
    )
    workflows.save_ledger(spark, store, lost)
    with pytest.raises(L.LedgerError, match="holiday window"):
        workflows.incremental_load(spark, str(landing), store, RUN)


def test_windows(spark):
    columns = SOURCES["orders"].schema
    rows = [tuple(line.split(",")) for line in ORDERS] + [("o3", "c", "x", " ", "", "", None, "")]
    frame = spark.createDataFrame(rows, columns)
    (row,) = L.order_windows(frame.withColumn("g", F.lit(1)), 2, ["g"]).collect()
    assert [row[c] for c in L.WINDOW_COLUMNS] == [
        date(2026, 1, 3),
        date(2026, 1, 5),
        date(2026, 1, 5),
        date(2026, 1, 9),
    ]
    assert row["malformed_order_purchase_timestamp"] == 0
    assert L.resolve_order_date_range(frame) == (date(2026, 1, 3), date(2026, 1, 5))
    blank = frame.filter("order_id = 'o3'")
    (row,) = L.order_windows(blank.withColumn("g", F.lit(1)), 2, ["g"]).collect()
    assert [row[c] for c in L.WINDOW_COLUMNS] == [None] * 4
    with pytest.raises(ValueError, match="no purchase"):
        L.resolve_order_date_range(blank)


def test_bootstrap(spark, tmp_path, store, extras):
    land(tmp_path, "full", "orders", *ORDERS)
    land(tmp_path, "full", "sellers", "s1,1,x,sp")
    files = {n: str(tmp_path / "full" / f"shop_{SOURCES[n].file_suffix}") for n in ("orders", "sellers")}
    for _ in range(2):
        summary = workflows.bootstrap_load(spark, files, store, RUN, extras)
        assert (summary.raw_batches_loaded, summary.raw_rows_loaded) == (2, 3)
        assert summary.weather_date_window == (date(2026, 1, 3), date(2026, 1, 5))
        assert tables.read_table(spark, store.raw("orders")).count() == 2
    tight = Settings(now=RUN.now, weather_call_budget=2)
    with pytest.raises(ValueError, match="budget"):
        workflows.bootstrap_load(spark, files, store, tight, extras)
    assert workflows.bootstrap_load(spark, {}, store, RUN).no_op


def test_stream_drains_and_restarts_without_doubles(spark, tmp_path, store):
    landing, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")

    def drain():
        query = landing_stream.start_load(spark, str(landing), "orders", store, RUN, checkpoint)
        query.awaitTermination()

    land(landing, "0001", "orders", *ORDERS)
    drain()
    drain()
    assert tables.read_table(spark, store.raw("orders")).count() == 2
    land(landing, "0002", "orders", "o3,c3,created,2026-01-11 09:00:00,,,,2026-02-20")
    drain()
    rows = ledger_rows(spark, store)
    assert {k: r["raw_loaded_rows"] for k, r in rows.items()} == {
        ("orders", "0001"): 2,
        ("orders", "0002"): 1,
    }
    assert rows["orders", "0002"]["weather_status"] == "not_required"
    assert rows["orders", "0001"]["weather_window_start_date"] == date(2026, 1, 5)


def sellers(spark, store):
    return sorted(r["seller_id"] for r in tables.read_table(spark, store.raw("sellers")).collect())


def loaded(spark, store):
    rows = L.read_ledger(spark, store.ledger).filter("raw_status = 'loaded'").collect()
    return sum(r["raw_loaded_rows"] for r in rows)


def test_bootstrap_then_incremental_keeps_all_rows(spark, tmp_path, store):
    full = tmp_path / "sellers.csv"
    full.write_text(",".join(SOURCES["sellers"].columns) + "\ns1,1,a,SP\ns2,2,b,RJ\ns3,3,c,MG\n")
    workflows.bootstrap_load(spark, {"sellers": str(full)}, store, RUN)
    land(tmp_path / "in", "0001", "sellers", "s4,4,d,SP")
    workflows.incremental_load(spark, str(tmp_path / "in"), store, RUN)
    assert sellers(spark, store) == ["s1", "s2", "s3", "s4"]


def test_late_file_in_a_loaded_batch_removes_nothing(spark, tmp_path, store):
    landing = tmp_path / "in"
    land(landing, "0001", "sellers", "s1,1,a,SP", "s2,2,b,RJ")
    workflows.incremental_load(spark, str(landing), store, RUN)
    late = landing / "0001" / "late_sellers_dataset.csv"
    late.write_text(",".join(SOURCES["sellers"].columns) + "\ns3,3,c,MG\n")
    workflows.incremental_load(spark, str(landing), store, RUN)
    assert sellers(spark, store) == ["s1", "s2", "s3"]
    assert loaded(spark, store) == 3


def test_retry_next_to_a_loaded_file(spark, tmp_path, store):
    landing = tmp_path / "in"
    land(landing, "0001", "sellers", "s1,1,a,SP")
    workflows.incremental_load(spark, str(landing), store, RUN)
    bad = landing / "0001" / "more_sellers_dataset.csv"
    bad.write_text("seller_id,other\ns2,x\n")
    with pytest.raises(ValueError, match="missing"):
        workflows.incremental_load(spark, str(landing), store, RUN)
    bad.write_text(",".join(SOURCES["sellers"].columns) + "\ns2,2,b,RJ\n")
    workflows.incremental_load(spark, str(landing), store, RUN)
    assert sellers(spark, store) == ["s1", "s2"]
    assert loaded(spark, store) == 2


def test_streams_with_new_checkpoints_and_batch_loads_share_a_store(spark, tmp_path, store):
    def drain(landing, checkpoint):
        landing_stream.start_load(
            spark, str(landing), "sellers", store, RUN, str(tmp_path / checkpoint)
        ).awaitTermination()

    one, two = tmp_path / "one", tmp_path / "two"
    land(one, "0001", "sellers", "s1,1,a,SP", "s2,2,b,RJ")
    land(two, "0002", "sellers", "s3,3,c,MG")
    drain(one, "c1")
    drain(two, "c2")
    drain(one, "c3")  # the same files by a stream that does not know them
    assert sellers(spark, store) == ["s1", "s2", "s3"]
    land(one, "0004", "sellers", "s4,4,d,SP")
    workflows.incremental_load(spark, str(one), store, RUN)
    assert sellers(spark, store) == ["s1", "s2", "s3", "s4"]
    assert loaded(spark, store) == 4


def test_stream_marks_a_malformed_order_file_as_failed(spark, tmp_path, store):
    landing = tmp_path / "in"
    land(landing, "0001", "orders", ORDERS[0])
    land(landing, "0002", "orders", "o9,c9,delivered,yesterday,,,,2026-01-20")
    landing_stream.start_load(
        spark, str(landing), "orders", store, RUN, str(tmp_path / "c")
    ).awaitTermination()
    states = {batch: row["raw_status"] for (_, batch), row in ledger_rows(spark, store).items()}
    assert states == {"0001": "loaded", "0002": "failed"}
    assert [r["order_id"] for r in tables.read_table(spark, store.raw("orders")).collect()] == ["o1"]


def test_many_files_are_planned_in_a_fixed_number_of_jobs(spark, tmp_path):
    def jobs_of(folder, group):
        spark.sparkContext.setJobGroup(group, group)
        plan = workflows.plan_load(spark, str(folder), L.read_ledger(spark, str(tmp_path / "no-ledger")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return plan, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    for name, batches in (("few", 3), ("many", 1000)):
        for n in range(batches):
            batch = tmp_path / name / f"b{n}"
            batch.mkdir(parents=True)
            header = "seller_id,seller_zip_code_prefix,seller_city,seller_state"
            other = '\ufeffSeller State,seller_city,"seller_zip_code_prefix",Seller-ID'
            (batch / "sellers_dataset.csv").write_text(f"{header if n % 2 else other}\n{n},1,x,y\n", encoding="utf-8")
            (batch / "shop_customers_dataset.csv").write_text("customer_id\n1\n", encoding="utf-8")
    few, few_jobs = jobs_of(tmp_path / "few", "few-files")
    many, many_jobs = jobs_of(tmp_path / "many", "many-files")
    assert many.files.count() == 2000 and few.files.count() == 6
    assert [len(many.paths[s]) for s in ("sellers", "customers")] == [2, 1]
    assert sum(len(p) for p in many.paths["sellers"].values()) == 1000
    assert ("Seller State", "seller_city", "seller_zip_code_prefix", "Seller-ID") in many.paths["sellers"]
    # Listing many folders is a job of its own, once for each read.
    assert many_jobs <= few_jobs + 3 < 20


def test_a_file_without_a_header_fails_its_source(spark, tmp_path):
    landing = tmp_path / "landing"
    for n, text in enumerate(["seller_id,seller_zip_code_prefix,seller_city,seller_state\n1,2,x,y\n", "\n"]):
        (landing / f"b{n}").mkdir(parents=True)
        (landing / f"b{n}" / "sellers_dataset.csv").write_text(text)
    store = workflows.Store(str(tmp_path / "store"))
    with pytest.raises(ValueError, match="required"):
        workflows.incremental_load(spark, str(landing), store, RUN)
    states = {(r["batch_id"], r["raw_status"]) for r in L.read_ledger(spark, store.ledger).collect()}
    assert states == {("b0", "failed"), ("b1", "failed")}
