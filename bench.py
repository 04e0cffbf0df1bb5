"""Wall time of the headline queries over one folder of test tables.

Marts are timed from the raw tables to the last row, in one plan each. Publishing
is timed as one run that stores all dimensions, facts and marts, and the cards
and checks are then timed over the stored tables, as they are used.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_REPEATS may be set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlane import session  # noqa: E402
from marketlane.plans import context, queries  # noqa: E402
from marketlane.plans.warehouse import Warehouse  # noqa: E402
from marketlane.sources.sample_tables import raw_relations  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "1"))

HEADLINE = (
    "b01_stg_orders",
    "b02_stg_order_items",
    "c3_int_customer_order_sequence",
    "d5_fact_orders",
    "f1_mart_exec_daily",
    "f2_mart_fulfillment_ops",
    "f3_mart_customer_experience",
    "f4_mart_seller_performance",
    "f5_mart_seller_experience",
    "e2_snap_products",
    "a18_ledger_upsert",
)
OVER_PUBLISHED = (
    "i1_incremental_upsert",
    "g08_exec_gmv_orders_trend",
    "g12_fulfillment_delay_rate_by_state",
    "g17_fulfillment_late_rate_by_precipitation_bucket",
    "g20_seller_top_aov",
    "h20_seller_days_reconcile",
    "h27_exec_daily_reconciles",
    "h30_fulfillment_reconciles",
    "h32_seller_experience_is_order_weighted",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def drain(frame) -> None:
    """Compute every column of every row without collecting anything."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session.local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    # One small run first, so that the first query does not pay for starting up.
    drain(queries.queries()["f1_mart_exec_daily"](spark, FOLDER))

    seconds: dict[str, float] = {}

    def measure(name: str) -> None:
        query = queries.queries()[name]
        seconds[name] = round(min(timed(lambda: drain(query(spark, FOLDER))) for _ in range(REPEATS)), 3)

    for name in HEADLINE:
        measure(name)

    def publish() -> None:
        target = session.fresh_folder(spark, "bench")
        raw = raw_relations(spark, FOLDER)
        Warehouse(raw, context.settings(), target, day_partitions=False).publish()

    seconds["publish_all_tables"] = round(timed(publish), 3)
    context.published(spark, FOLDER).publish()
    for name in OVER_PUBLISHED:
        measure(name)

    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "marketplace_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": CPUS,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
