"""Control ledger: one row per landed file, and the gate that publishes it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane.contracts import struct_of
from marketlane.functions.columns import clean_text, to_timestamp
from marketlane.functions.frames import upsert
from marketlane.sources import tables

KEY = ["source_name", "batch_id", "source_file_name"]

# Field names, types and states of the ledger.
_REQUIRED = (
    "source_name batch_id source_file_name raw_table_id raw_loaded_rows raw_status holiday_status "
    "weather_status publish_status created_at_utc updated_at_utc"
).split()
LEDGER_SCHEMA = struct_of(
    {
        "source_name": "string",
        "batch_id": "string",
        "source_file_name": "string",
        "raw_table_id": "string",
        "raw_loaded_rows": "bigint",
        "raw_job_id": "string",
        "raw_status": "string",
        "holiday_status": "string",
        "weather_status": "string",
        "publish_status": "string",
        "holiday_window_start_date": "date",
        "holiday_window_end_date": "date",
        "weather_window_start_date": "date",
        "weather_window_end_date": "date",
        "last_error_class": "string",
        "last_error_message": "string",
        "created_at_utc": "timestamp",
        "updated_at_utc": "timestamp",
        "raw_loaded_at_utc": "timestamp",
        "published_at_utc": "timestamp",
    },
    required=tuple(_REQUIRED),
)
FIELDS = LEDGER_SCHEMA.names
LOADED, FAILED, PENDING = "loaded", "failed", "pending"
NOT_REQUIRED, SUCCEEDED, PUBLISHED = "not_required", "succeeded", "published"
HOLIDAY, WEATHER = "holiday", "weather"
ORDERS = "orders"


class LedgerError(ValueError):
    """The ledger holds, or would hold, a state that cannot be worked with."""


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """Ledger rows; a ledger that does not exist yet is empty."""
    return tables.read_table(spark, table, LEDGER_SCHEMA)


def upsert_ledger(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Replace the rows with the same key, add the others."""
    return upsert(base.select(*FIELDS), updates.select(*FIELDS), KEY)


def unseen_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not loaded yet; failed ones come again."""
    done = ledger.filter(F.col("raw_status") == LOADED).select(*KEY)
    return files.join(done, KEY, "left_anti")


# --- Enrichment windows ------------------------------------------------------

WINDOW_COLUMNS = (
    "holiday_window_start_date holiday_window_end_date "
    "weather_window_start_date weather_window_end_date"
).split()
WINDOW_SOURCES = ("order_purchase_timestamp", "order_delivered_customer_date")


def _malformed(column: str) -> Column:
    return clean_text(column).isNotNull() & to_timestamp(column).isNull()


def order_windows(raw_orders: DataFrame, lookback_days: int, by: list[str]) -> DataFrame:
    """Rows, holiday window (purchases) and weather window (deliveries) per group.

    The weather window starts ``lookback_days`` early. Text that is neither blank
    nor a timestamp is counted per column; callers decide (``require_well_formed``).
    """
    bought, delivered = (F.to_date(to_timestamp(c)) for c in WINDOW_SOURCES)
    return raw_orders.groupBy(*by).agg(
        F.count(F.lit(1)).alias("raw_loaded_rows"),
        F.min(bought).alias(WINDOW_COLUMNS[0]),
        F.max(bought).alias(WINDOW_COLUMNS[1]),
        F.date_sub(F.min(delivered), lookback_days).alias(WINDOW_COLUMNS[2]),
        F.max(delivered).alias(WINDOW_COLUMNS[3]),
        *[F.count_if(_malformed(c)).alias(f"malformed_{c}") for c in WINDOW_SOURCES],
    )


def require_well_formed(raw_orders: DataFrame, columns: tuple[str, ...] = WINDOW_SOURCES) -> None:
    """Fail with up to three examples when a timestamp cannot be read."""
    for column in columns:
        bad = raw_orders.filter(_malformed(column)).select(clean_text(column)).limit(3).collect()
        if bad:
            examples = ", ".join(row[0] for row in bad)
            raise ValueError(f"orders contain invalid timestamps: {column}: {examples}")


def resolve_order_date_range(raw_orders: DataFrame) -> tuple[date, date]:
    """First and last purchase day of all orders."""
    require_well_formed(raw_orders, WINDOW_SOURCES[:1])
    bought = F.to_date(to_timestamp(WINDOW_SOURCES[0]))
    first, last = raw_orders.agg(F.min(bought), F.max(bought)).first()
    if first is None:
        raise ValueError("orders contain no purchase timestamps")
    return first, last


def _needs(kind: str) -> Column:
    return F.col(f"{kind}_status").isin(PENDING, FAILED)


def merged_windows(pending: DataFrame) -> DataFrame:
    """One row: the window over all orders still waiting, per enrichment."""

    def edge(kind: str, part: str, pick) -> Column:
        column = f"{kind}_window_{part}_date"
        return pick(F.when(_needs(kind), F.col(column))).alias(column)

    return pending.agg(
        *[
            edge(kind, part, pick)
            for kind in (HOLIDAY, WEATHER)
            for part, pick in (("start", F.min), ("end", F.max))
        ]
    )


# --- Rows --------------------------------------------------------------------


def loaded_rows(
    loads: DataFrame, prior: DataFrame, now: Column, job_id: str | None = None
) -> DataFrame:
    """Ledger rows of files just loaded.

    ``loads`` has the key, ``raw_table_id`` and ``raw_loaded_rows``, and for orders
    the window columns. An order file waits for each enrichment it has a window
    for; anything else is published at once. The first creation time is kept.
    """
    absent = [c for c in WINDOW_COLUMNS if c not in loads.columns]
    loads = loads.withColumns({c: F.lit(None).cast("date") for c in absent})
    is_order = F.col("source_name") == ORDERS

    def status(kind: str) -> Column:
        waits = is_order & F.col(f"{kind}_window_start_date").isNotNull()
        return F.when(waits, PENDING).otherwise(NOT_REQUIRED)

    created = prior.select(*KEY, F.col("created_at_utc").alias("_created"))
    waiting = (F.col("holiday_status") == PENDING) | (F.col("weather_status") == PENDING)
    return (
        loads.join(created, KEY, "left")
        .withColumns({"holiday_status": status(HOLIDAY), "weather_status": status(WEATHER)})
        .withColumns(
            {
                "raw_job_id": F.lit(job_id).cast("string"),
                "raw_status": F.lit(LOADED),
                "publish_status": F.when(waiting, PENDING).otherwise(PUBLISHED),
                "last_error_class": F.lit(None).cast("string"),
                "last_error_message": F.lit(None).cast("string"),
                "created_at_utc": F.coalesce("_created", now),
                "updated_at_utc": now,
                "raw_loaded_at_utc": now,
                "published_at_utc": F.when(~waiting, now),
            }
        )
        .select(*FIELDS)
    )


def failed_rows(
    files: DataFrame, prior: DataFrame, error: Exception, now: Column
) -> DataFrame:
    """Ledger rows of files whose load failed; ``files`` has key and raw_table_id."""
    created = prior.select(*KEY, F.col("created_at_utc").alias("_created"))
    nothing = {name: F.lit(None).cast("date") for name in WINDOW_COLUMNS}
    return (
        files.join(created, KEY, "left")
        .withColumns(
            {
                **nothing,
                "raw_loaded_rows": F.lit(0).cast("bigint"),
                "raw_job_id": F.lit(None).cast("string"),
                "raw_status": F.lit(FAILED),
                "holiday_status": F.lit(NOT_REQUIRED),
                "weather_status": F.lit(NOT_REQUIRED),
                "publish_status": F.lit(PENDING),
                "last_error_class": F.lit(type(error).__name__),
                "last_error_message": F.lit(str(error)),
                "created_at_utc": F.coalesce("_created", now),
                "updated_at_utc": now,
                "raw_loaded_at_utc": F.lit(None).cast("timestamp"),
                "published_at_utc": F.lit(None).cast("timestamp"),
            }
        )
        .select(*FIELDS)
    )


# --- Lifecycle ---------------------------------------------------------------


def pending_orders(ledger: DataFrame) -> DataFrame:
    """Loaded order files that are not published yet."""
    return ledger.filter(
        (F.col("source_name") == ORDERS)
        & (F.col("raw_status") == LOADED)
        & (F.col("publish_status") != PUBLISHED)
    )


def recovery_violations(pending: DataFrame) -> DataFrame:
    """Pending orders whose required window was not kept: they cannot be resumed."""

    def lacks(kind: str) -> Column:
        start, end = F.col(f"{kind}_window_start_date"), F.col(f"{kind}_window_end_date")
        return (F.col(f"{kind}_status") != NOT_REQUIRED) & (start.isNull() | end.isNull())

    return pending.filter(lacks(HOLIDAY) | lacks(WEATHER)).select(
        *KEY,
        F.when(lacks(HOLIDAY), HOLIDAY).otherwise(WEATHER).alias("missing_window"),
    )


def require_recoverable(pending: DataFrame) -> None:
    bad = recovery_violations(pending).first()
    if bad is not None:
        raise LedgerError(
            f"persisted {bad['missing_window']} window is required for recovery: "
            f"{bad['source_name']}, {bad['batch_id']}, {bad['source_file_name']}"
        )


def mark_enriched(pending: DataFrame, kind: str, now: Column) -> DataFrame:
    """Rows that waited for an enrichment which has now succeeded; errors clear."""
    return (
        pending.filter(_needs(kind))
        .withColumns(
            {
                f"{kind}_status": F.lit(SUCCEEDED),
                "updated_at_utc": now,
                "last_error_class": F.lit(None).cast("string"),
                "last_error_message": F.lit(None).cast("string"),
            }
        )
        .select(*FIELDS)
    )


def mark_enrichment_failed(
    pending: DataFrame, kind: str, error: Exception, now: Column
) -> DataFrame:
    return (
        pending.filter(_needs(kind))
        .withColumns(
            {
                f"{kind}_status": F.lit(FAILED),
                "updated_at_utc": now,
                "last_error_class": F.lit(type(error).__name__),
                "last_error_message": F.lit(str(error)),
            }
        )
        .select(*FIELDS)
    )


def publish_ready() -> Column:
    """Loaded, enriched as far as required, and not published."""

    def settled(kind: str) -> Column:
        return F.col(f"{kind}_status").isin(NOT_REQUIRED, SUCCEEDED)

    return (
        (F.col("raw_status") == LOADED)
        & settled(HOLIDAY)
        & settled(WEATHER)
        & (F.col("publish_status") != PUBLISHED)
    )


def mark_published(ledger: DataFrame, now: Column) -> DataFrame:
    """Rows the gate lets through."""
    return (
        ledger.filter(publish_ready())
        .withColumns(
            {
                "publish_status": F.lit(PUBLISHED),
                "updated_at_utc": now,
                "published_at_utc": now,
                "last_error_class": F.lit(None).cast("string"),
                "last_error_message": F.lit(None).cast("string"),
            }
        )
        .select(*FIELDS)
    )


def ledger_violations(ledger: DataFrame) -> DataFrame:
    """Rows breaking a ledger invariant, with its name."""

    def half(kind: str) -> Column:
        start, end = F.col(f"{kind}_window_start_date"), F.col(f"{kind}_window_end_date")
        return start.isNull() != end.isNull()

    tests = {
        "negative_rows": F.col("raw_loaded_rows") < 0,
        "loaded_without_time": (F.col("raw_status") == LOADED) & F.col("raw_loaded_at_utc").isNull(),
        "published_without_time": (F.col("publish_status") == PUBLISHED)
        & F.col("published_at_utc").isNull(),
        "half_holiday_window": half(HOLIDAY),
        "half_weather_window": half(WEATHER),
    }
    found = F.array_compact(F.array(*[F.when(test, F.lit(n)) for n, test in tests.items()]))
    return ledger.select(*KEY, F.explode(found).alias("violation"))


def require_valid(ledger: DataFrame) -> DataFrame:
    bad = ledger_violations(ledger).first()
    if bad is not None:
        raise LedgerError(f"{bad['violation']}: {bad['source_name']}, {bad['batch_id']}")
    return ledger


def run_summary(before: DataFrame, after: DataFrame, mode: str = "incremental") -> DataFrame:
    """What a run changed: one row from the ledger before and after it."""
    old = before.select(
        *KEY,
        F.col("raw_loaded_at_utc").alias("_loaded"),
        F.col("publish_status").alias("_published"),
        F.col("updated_at_utc").alias("_updated"),
    )
    is_loaded = F.col("raw_status") == LOADED
    is_published = F.col("publish_status") == PUBLISHED
    loaded = is_loaded & ~F.col("raw_loaded_at_utc").eqNullSafe(F.col("_loaded"))
    published = is_published & ~F.col("_published").eqNullSafe(F.lit(PUBLISHED))
    progress = ~F.col("updated_at_utc").eqNullSafe(F.col("_updated")) & (
        F.col("raw_status") != FAILED
    )
    return (
        after.join(old, KEY, "left")
        .agg(
            F.count_if(progress).alias("changed"),
            F.count_if(is_loaded & ~is_published).alias("open"),
            F.count_if(loaded).alias("raw_batches_loaded"),
            F.coalesce(F.sum(F.when(loaded, F.col("raw_loaded_rows"))), F.lit(0)).alias(
                "raw_rows_loaded"
            ),
            F.count_if(published).alias("batches_marked_published"),
        )
        .select(
            F.lit(mode).alias("mode"),
            (F.col("changed") == 0).alias("no_op"),
            (F.col("open") == 0).alias("publish_complete"),
            "raw_batches_loaded",
            "raw_rows_loaded",
            "batches_marked_published",
        )
    )
