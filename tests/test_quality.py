"""Rule kinds, reconciliation, snapshots and freshness."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlane.operators import quality, snapshots
from marketlane.settings import Settings

SETTINGS = Settings(now=datetime(2024, 1, 10, tzinfo=UTC))


def test_rule_kinds(spark):
    frame = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", -1.0), (2, None, None), (None, "a", 9.0), (None, "a", 9.0)],
        "id int, kind string, v double",
    )
    parent = spark.createDataFrame([(1,)], "id int")
    assert quality.not_null(frame, "kind").count() == 1
    assert [tuple(r) for r in quality.unique(frame, ["id"]).collect()] == [(1, 2)]
    assert quality.unique(frame, ["id", "kind"]).count() == 1
    assert quality.unique(frame, ["id"], where="kind = 'a'").count() == 0
    assert [tuple(r) for r in quality.relationship(frame, "id", parent, "id").collect()] == [(2, 1)]
    assert quality.accepted_values(frame, "kind", ["a"]).count() == 1
    assert quality.accepted_range(frame, "v", 0, 9).count() == 1
    assert quality.accepted_range(frame, "v", 0, 9, inclusive=False).count() == 3

    rules = {
        "t": quality.Rules(
            ("id",),
            required="kind",
            references=(("id", "p", "id"),),
            allowed={"kind": ("a",)},
            ranges=(quality.Range("v", 0, 9),),
        )
    }
    counts = quality.rule_counts({"t": frame, "p": parent}, rules).collect()
    assert {(r["rule"], r["columns"]): r["violations"] for r in counts} == {
        ("not_null", "id"): 2,
        ("not_null", "kind"): 1,
        ("accepted_values", "kind"): 1,
        ("accepted_range", "v"): 1,
        ("unique", "id"): 1,
        ("relationships", "id"): 1,
    }


def test_reconcile(spark):
    schema = "k string, n int, amount double, rate double"
    expected = spark.createDataFrame(
        [("same", 1, 1.0, 0.5), ("off", 1, 1.0, 0.5), ("gone", 1, 1.0, 0.5), (None, 1, 1.0, None)], schema
    )
    actual = spark.createDataFrame(
        [("same", 1, 1.005, 0.5), ("off", 1, 1.02, 0.5), ("new", 1, 1.0, 0.5), (None, 1, 1.0, 0.5)], schema
    )

    def keys(**options):
        rows = quality.reconcile(
            expected,
            actual,
            ["k"],
            SETTINGS,
            exact=["n"],
            amounts=["amount"],
            nullable_rates=["rate"],
            show=["amount"],
            **options,
        )
        assert rows.columns == ["k", "expected_amount", "actual_amount"]
        return sorted(str(r["k"]) for r in rows.collect())

    assert keys() == ["None", "gone", "new", "off"]
    assert keys(sql_null_logic=True) == ["gone", "new", "off"]
    assert keys(null_safe_keys=False) == ["None", "None", "gone", "new", "off"]


def test_versions_over_three_runs(spark):
    runs = [datetime(2024, 1, d, tzinfo=UTC) for d in (1, 2, 3, 4)]
    states = [
        [("keep", "x"), ("change", "x"), ("leave", "x"), ("null", None)],
        [("keep", "x"), ("change", "y"), ("null", None), ("new", "z")],
        [("keep", "x"), ("change", "y"), ("leave", "x"), ("null", "v"), ("new", "z")],
    ]
    frames = [spark.createDataFrame(s, "k string, v string") for s in states]
    history = snapshots.first_versions(frames[0], "k", ["v"], runs[0])
    for frame, now in ((frames[1], runs[1]), (frames[2], runs[2]), (frames[2], runs[3])):
        history = snapshots.scd2_merge(history, frame, "k", ["v"], now)
    day = [r.day for r in runs]
    rows = history.select(
        "k", "v", F.dayofmonth("dbt_valid_from").alias("a"), F.dayofmonth("dbt_valid_to").alias("b")
    )
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [
            ("keep", "x", day[0], None),
            ("change", "x", day[0], day[1]),
            ("change", "y", day[1], None),
            ("leave", "x", day[0], day[1]),
            ("leave", "x", day[2], None),
            ("null", None, day[0], day[2]),
            ("null", "v", day[2], None),
            ("new", "z", day[1], None),
        ],
        key=str,
    )
    assert history.select("dbt_scd_id").distinct().count() == 8
    noops = snapshots.noop_versions(history, "k", ["v"]).collect()
    assert [r["k"] for r in noops] == ["leave"]
    kept = snapshots.scd2_merge(
        snapshots.first_versions(frames[0], "k", ["v"], runs[0]), frames[1], "k", ["v"], runs[1],
        close_deletes=False,
    )
    assert kept.filter("k = 'leave' AND dbt_valid_to IS NULL").count() == 1


@pytest.mark.parametrize("hours, status", [(24, "pass"), (25, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    stamp = SETTINGS.now - timedelta(hours=hours)
    frame = spark.createDataFrame([(stamp,)], "ingested_at_utc timestamp")
    only = Settings(now=SETTINGS.now, freshness={"orders": SETTINGS.freshness["orders"]})
    (row,) = quality.source_freshness({"orders": frame}, only).collect()
    assert (row["status"], row["age_hours"]) == (status, float(hours))
    (row,) = quality.source_freshness({"orders": frame.limit(0)}, only).collect()
    assert row["status"] == "error"
    assert quality.source_freshness({"orders": frame}, only, static=True).count() == 0
