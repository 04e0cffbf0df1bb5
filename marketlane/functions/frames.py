"""Frame-level building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

RECENCY = ("ingested_at_utc", "batch_id")


def first_per_key(frame: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    Spark plans ``row_number() = 1`` with a group limit below the exchange, so a
    key that holds a large share of the rows leaves one row per map task before
    anything is shuffled.
    """
    name = "_rank"
    while name in {c.lower() for c in frame.columns}:
        name += "_"
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return frame.withColumn(name, rank).filter(F.col(name) == 1).drop(name)


def newest_per_key(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Newest record per key; remaining columns break ties so reruns agree."""
    rest = [c for c in frame.columns if c not in key and c not in RECENCY]
    order = [F.desc_nulls_last(c) for c in (*RECENCY, *rest)]
    return first_per_key(frame, key, order)


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keyed upsert: incoming rows replace or join the existing ones.

    Columns new in ``incoming`` are added (NULL in rows that stay); columns it no
    longer has are dropped.
    """
    kept = existing.join(incoming.select(*key), list(key), "left_anti")
    kept = kept.select(*[c for c in incoming.columns if c in kept.columns])
    return incoming.unionByName(kept, allowMissingColumns=True)


def number_within_key(
    frame: DataFrame,
    key: str,
    instant: str,
    order: Sequence[str],
    output: str,
    unit: str = "minute",
) -> DataFrame:
    """Number the rows of each key by ``instant`` then ``order``, hot keys included.

    A plain window puts all rows of a key into one task. Here every key, NULL included, is
    cut into slices: a time unit each, and where the instant is NULL (those rows come
    first) the leading characters of a first ordering column that is text. Each slice is
    numbered on its own and shifted by the rows of the earlier ones, so a task holds a
    slice, and the running counts of a key are one row per slice.
    """
    lead = frame.schema[order[0]].dataType if order else None
    prefix = F.substring(F.col(order[0]), 1, 4) if isinstance(lead, StringType) else F.lit("")
    # None of these is NULL, so that the window and the join below share one exchange; a
    # NULL prefix and an empty one share a slice, whose inner order tells them apart.
    cut = frame.withColumns(
        {
            "_keyed": F.col(key).isNotNull(),
            "_key": F.coalesce(F.col(key), _any_value(frame.schema[key].dataType)),
            "_timed": F.col(instant).isNotNull(),
            "_slice": F.coalesce(F.date_trunc(unit, instant), F.timestamp_seconds(F.lit(0))),
            "_lead": F.when(F.col(instant).isNull(), F.coalesce(prefix, F.lit(""))).otherwise(F.lit("")),
        }
    )
    who, when = ["_key", "_keyed"], ["_timed", "_slice", "_lead"]
    sizes = cut.groupBy(*who, *when).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*who).orderBy(*when).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*who, *when, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*who, *when).orderBy(
        F.asc_nulls_first(instant), *[F.asc_nulls_first(c) for c in order]
    )
    return (
        cut.withColumn("_number", F.row_number().over(inside).cast("bigint"))
        .join(shifts, [*who, *when])
        .withColumn(output, F.col("_number") + F.col("_shift"))
        .select(*frame.columns, output)
    )


def _any_value(kind: DataType) -> Column:
    """Some value of a key's type, to stand beside a flag that says NULL."""
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.timestamp_seconds(F.lit(0)).cast(kind)
    return F.lit("0").cast(kind)
