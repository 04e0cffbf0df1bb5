"""Second publishes of the marts: only days whose inputs changed are built again.

Every input of a mart is digested by day, without regard to order. The digests of the
last publish are stored beside the marts; a day that differs from them on any input of a
mart is recomputed and its folder overwritten, all other folders stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane import contracts
from marketlane.operators import intermediate, marts
from marketlane.sources import tables

STATE = "mart_input_days"
DAY = "input_day"
VALUES = ("input_rows", "hash_sum", "hash_xor")

# Input -> its day column and columns that no mart reads.
INPUTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "fact_orders": ("purchase_date", ("dbt_updated_at",)),
    "fact_order_items": ("purchase_date", ()),
    "fact_reviews": ("purchase_date", ("review_comment_title", "review_comment_message")),
    "dim_date": ("calendar_date", ()),
    "int_seller_daily_performance": ("calendar_date", ()),
}

# Of these, what no table holds: it is stored while a publish works, for the digests, all of
# whose rows they read, and for the mart that follows from it.
UNSTORED = ("int_seller_daily_performance",)

Cut = Callable[[str, str], DataFrame]


@dataclass(frozen=True)
class DayMart:
    """How a mart follows from its inputs when these are cut to some days."""

    day: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


DAY_MARTS: dict[str, DayMart] = {
    "mart_exec_daily": DayMart(
        "calendar_date",
        ("fact_orders", "fact_reviews", "dim_date"),
        lambda w, cut: marts.mart_exec_daily(
            cut("fact_orders", "purchase_date"), cut("fact_reviews", "purchase_date"), w["dim_date"]
        ),
    ),
    "mart_fulfillment_ops": DayMart(
        "purchase_date",
        ("fact_orders", "dim_date"),
        lambda w, cut: marts.mart_fulfillment_ops(cut("fact_orders", "purchase_date"), w["dim_date"]),
    ),
    "mart_customer_experience": DayMart(
        "purchase_date",
        ("fact_orders", "fact_reviews"),
        lambda w, cut: marts.mart_customer_experience(
            cut("fact_orders", "purchase_date"), w["int_order_review_metrics"]
        ),
    ),
    "mart_seller_performance": DayMart(
        "calendar_date",
        ("int_seller_daily_performance",),
        lambda w, cut: marts.mart_seller_performance(cut("int_seller_daily_performance", "calendar_date")),
    ),
    "mart_seller_experience": DayMart(
        "calendar_date",
        ("fact_orders", "fact_order_items", "fact_reviews"),
        lambda w, cut: marts.mart_seller_experience(
            intermediate.int_seller_attributable_experience(
                cut("fact_order_items", "purchase_date"),
                cut("fact_orders", "purchase_date"),
                w["int_order_review_metrics"],
                w.settings,
            )
        ),
    ),
}


def day_digests(frame: DataFrame, day: str, without: tuple[str, ...] = ()) -> DataFrame:
    """Rows, sum and xor of row hashes by day; partial aggregates leave a row a day and task.

    A NULL counts as a value of its own. The sum tells repeated rows apart, which an xor
    alone would cancel.
    """
    columns = sorted(c for c in frame.columns if c not in without)
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    return (
        frame.select(F.col(day).alias(DAY), row.alias("_row"))
        .groupBy(DAY)
        .agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.sum(F.col("_row").cast("decimal(20,0)")).alias("hash_sum"),
            F.bit_xor("_row").alias("hash_xor"),
        )
    )


def digests(w) -> DataFrame:
    """Digests of all inputs of the marts: input, day, rows, sum, xor."""
    parts = [
        day_digests(w[name], day, without).select(F.lit(name).alias("input"), "*")
        for name, (day, without) in INPUTS.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """(input, day) that came, went or differ between two states."""
    old, new = before.alias("old"), after.alias("new")
    same = (F.col("old.input") == F.col("new.input")) & F.col(f"old.{DAY}").eqNullSafe(F.col(f"new.{DAY}"))
    differs = F.lit(False)
    for value in VALUES:
        differs = differs | ~F.col(f"old.{value}").eqNullSafe(F.col(f"new.{value}"))
    found = F.col("new.input").isNotNull()
    return old.join(new, same, "full_outer").filter(differs).select(
        F.coalesce("old.input", "new.input").alias("input"),
        F.when(found, F.col(f"new.{DAY}")).otherwise(F.col(f"old.{DAY}")).alias(DAY),
    )


def forget(w, spark) -> None:
    """Before the marts are written as a whole: no stored digest speaks for them."""
    table = w.table(STATE)
    if tables.table_exists(spark, table):
        tables.replace_table(tables.read_table(spark, table).limit(0), table, allow_empty=True)


def keep(w) -> None:
    """After all marts are written: store what they were built from."""
    tables.replace_table(digests(w), w.table(STATE), allow_empty=True)


def refresh_marts(w, spark, layout, at_once: int = 4) -> dict[str, int] | None:
    """Build the stored marts again for changed days and overwrite those days' folders.

    ``w`` holds the refreshed inputs; ``layout`` names each mart's sort columns. Returns
    how many days of each mart were built, or None when there is no stored state or a
    mart has another layout; then the marts are to be built as a whole.

    Days without a date are always built: an order without one may have reviews that
    count elsewhere. A run that breaks off repeats its days: in the stored state they are
    marked as unknown before the first folder is touched. While a run works, readers may see old and new
    days side by side.
    """
    if not tables.table_exists(spark, w.table(STATE)):
        return None
    for name, mart in DAY_MARTS.items():
        columns = tables.column_names(spark, w.table(name)) or ()
        by = tables.partition_columns(spark, w.table(name))
        if by != (mart.day,) or set(columns) != set(contracts.columns_of(name)):
            return None
    before = tables.read_table(spark, w.table(STATE))
    fresh, touched = w.table(f"_{STATE}_new"), w.table(f"_{STATE}_changed")
    tables.replace_table(digests(w), fresh, allow_empty=True)
    after = tables.read_table(spark, fresh)
    tables.replace_table(changed_days(before, after), touched, allow_empty=True)
    changed = tables.read_table(spark, touched)
    same = (F.col("s.input") == F.col("c.input")) & F.col(f"s.{DAY}").eqNullSafe(F.col(f"c.{DAY}"))
    unknown = changed.withColumns(
        {c: F.lit(-1 if c == "input_rows" else None).cast(before.schema[c].dataType) for c in VALUES}
    )
    unsure = before.alias("s").join(changed.alias("c"), same, "left_anti").unionByName(unknown)
    tables.replace_table(unsure, w.table(STATE), allow_empty=True)

    def build(name: str) -> int:
        mart = DAY_MARTS[name]
        nothing = spark.range(1).select(F.lit(None).cast("date").alias(DAY))
        days = changed.filter(F.col("input").isin(*mart.inputs)).select(DAY).union(nothing).distinct()
        # At most a row per day of the date type, whatever the facts hold.
        days = F.broadcast(days)

        def cut(relation: str, column: str, days: DataFrame = days) -> DataFrame:
            frame = w[relation]
            return frame.join(days, frame[column].eqNullSafe(days[DAY]), "left_semi")

        frame = contracts.enforce(mart.build(w, cut), name)
        return tables.replace_days(frame, w.table(name), mart.day, days, layout[name][1])

    with ThreadPoolExecutor(at_once) as pool:
        built = dict(zip(DAY_MARTS, pool.map(build, DAY_MARTS), strict=True))
    tables.replace_table(after, w.table(STATE), allow_empty=True)
    return built
