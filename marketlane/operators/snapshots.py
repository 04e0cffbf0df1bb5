"""Version history of master data (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane.operators.dimensions import PRODUCT_ATTRIBUTES, SELLER_ATTRIBUTES

VERSION_COLUMNS = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def _version_id(key: Column, moment: Column) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", text, F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def first_versions(source: DataFrame, key: str, tracked: Sequence[str], now: datetime) -> DataFrame:
    """History of a source seen for the first time: one open version per key."""
    moment = F.lit(now).cast("timestamp")
    return source.select(
        key,
        *tracked,
        _version_id(F.col(key), moment).alias("dbt_scd_id"),
        moment.alias("dbt_updated_at"),
        moment.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    )


def scd2_merge(
    history: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    now: datetime,
    close_deletes: bool = True,
) -> DataFrame:
    """Next history from the last one and the current source.

    Unchanged keys keep their open version; a changed key closes it and opens
    another; a new or reappearing key opens one; a vanished key closes its own.
    Only open versions are joined with the source, closed ones pass by untouched.
    Each joined row yields its one or two versions in a single pass.
    """
    moment = F.lit(now).cast("timestamp")
    is_open = F.col("dbt_valid_to").isNull()
    before = history.filter(is_open).select(
        key, F.struct(*[F.col(c) for c in (key, *tracked, *VERSION_COLUMNS)]).alias("old")
    )
    after = source.select(
        key,
        F.struct(
            F.col(key),
            *[F.col(c) for c in tracked],
            _version_id(F.col(key), moment).alias("dbt_scd_id"),
            moment.alias("dbt_updated_at"),
            moment.alias("dbt_valid_from"),
            F.lit(None).cast("timestamp").alias("dbt_valid_to"),
        ).alias("new"),
    )
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    changed = has_old & has_new & ~same
    closes = changed | (has_old & ~has_new & F.lit(close_deletes))
    old_version = F.when(
        has_old,
        F.when(closes, F.col("old").withField("dbt_valid_to", moment)).otherwise(F.col("old")),
    )
    new_version = F.when(changed | (has_new & ~has_old), F.col("new"))
    current = before.join(after, key, "full_outer").select(
        F.inline(F.array_compact(F.array(old_version, new_version)))
    )
    return history.filter(~is_open).select(*current.columns).unionByName(current)


def snap_sellers(history: DataFrame, sellers: DataFrame, now: datetime) -> DataFrame:
    return scd2_merge(history, sellers, "seller_id", SELLER_ATTRIBUTES, now)


def snap_products(history: DataFrame, products: DataFrame, now: datetime) -> DataFrame:
    return scd2_merge(history, products, "product_id", PRODUCT_ATTRIBUTES, now)


def noop_versions(history: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Versions whose tracked state equals the version before."""
    state = F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"})
    by_key = Window.partitionBy(key).orderBy("dbt_valid_from", "dbt_scd_id")
    return (
        history.withColumn("tracked_state_json", state)
        .withColumn("previous_tracked_state_json", F.lag("tracked_state_json").over(by_key))
        .filter("previous_tracked_state_json = tracked_state_json")
        .select(
            key,
            "dbt_scd_id",
            "dbt_valid_from",
            "dbt_valid_to",
            "previous_tracked_state_json",
            "tracked_state_json",
        )
    )
