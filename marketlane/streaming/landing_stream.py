"""Incremental load as a stream over the landing folder.

The stream's checkpoint remembers which files were read; the ledger remembers
what became of them, because a batch is published long after it was loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlane.operators import ledger as L
from marketlane.plans.workflows import (
    BATCH_PARTITION,
    LOAD,
    Enrichment,
    RunSummary,
    Store,
    finish_load,
    save_ledger,
    with_load,
)
from marketlane.session import fresh_folder
from marketlane.settings import Settings
from marketlane.sources import tables
from marketlane.sources.raw_files import as_utc
from marketlane.sources.registry import SOURCES, SourceSpec

PART = "_part"


def landing_stream(spark: SparkSession, landing: str, spec: SourceSpec) -> DataFrame:
    """New rows of one source with their lineage columns. Headers must follow the contract."""
    parts = F.split(F.substring_index("_path", landing.rstrip("/") + "/", -1), "/")
    return (
        spark.readStream.schema(spec.schema)
        .option("header", True)
        .option("multiLine", spec.multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(f"{landing}/*/*{spec.file_suffix}")
        .select("*", F.col("_metadata.file_path").alias("_path"))
        .select(
            *spec.columns,
            F.trim(F.url_decode(F.get(parts, F.lit(0)))).alias("batch_id"),
            F.get(parts, F.lit(1)).alias("source_file_name"),
            F.substring_index("_path", "/", -1).alias(PART),
        )
    )


def start_load(
    spark: SparkSession, landing: str, source: str, store: Store, settings: Settings, checkpoint: str
) -> StreamingQuery:
    """Load everything that has landed since the last run, then stop.

    Rows go to the partitions of their own physical files, as in the batch load. A file is
    read by one micro-batch, so a restart, or a new checkpoint, neither loses nor doubles
    rows, and batch and stream may share a store. Ledger counts are taken over the touched
    batches, since a landing batch may span micro-batches. An order file with a malformed
    timestamp is left out and gets a failed ledger row; the batch load meets it again.
    """
    spec = SOURCES[source]
    table = store.raw(source)

    def load(frame: DataFrame, epoch: int) -> None:
        session = frame.sparkSession
        now = F.lit(as_utc(settings.now)).cast("timestamp")
        rows = frame.withColumn("source_name", F.lit(source)).withColumn("ingested_at_utc", now)
        if source == L.ORDERS:
            rows = _without_malformed(session, rows, store, settings, now)
        rows = with_load(rows, F.col(PART)).drop("source_name", PART)
        tables.overwrite_partitions(rows, table, LOAD)
        # One value per landing batch of this micro-batch.
        batches = [r[0] for r in rows.select(BATCH_PARTITION).distinct().collect()]
        whole = (
            tables.read_table(session, table)
            .filter(F.col(BATCH_PARTITION).isin(batches))
            .withColumn("source_name", F.lit(source))
        )
        if source == L.ORDERS:
            loads = L.order_windows(whole, settings.weather_lookback_days, L.KEY)
        else:
            loads = whole.groupBy(*L.KEY).agg(F.count(F.lit(1)).alias("raw_loaded_rows"))
        loads = loads.withColumn("raw_table_id", F.lit(table))
        prior = L.read_ledger(session, store.ledger)
        save_ledger(session, store, L.loaded_rows(loads, prior, now))

    return (
        landing_stream(spark, landing, spec)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain(
    spark: SparkSession,
    landing: str,
    store: Store,
    settings: Settings,
    checkpoint: str,
    extras: Enrichment | None = None,
) -> RunSummary:
    """Load what has landed of all sources, enrich the waiting orders, publish what is ready.

    Each source has its own stream, with its own columns and its own checkpoint below
    ``checkpoint``; they run one after the other, since all write to one ledger. Then
    enrichment and gate go over the ledger as after a batch load, so both leave the same.
    """
    before = L.read_ledger(spark, store.ledger)
    for source in SOURCES:
        start_load(spark, landing, source, store, settings, f"{checkpoint}/{source}").awaitTermination()
    return finish_load(spark, store, settings, extras or Enrichment(), before)


def _without_malformed(
    spark: SparkSession, rows: DataFrame, store: Store, settings: Settings, now: Column
) -> DataFrame:
    """The rows of sound files; the others' ledger rows say that they failed."""
    wrong = [F.col(f"malformed_{c}") > 0 for c in L.WINDOW_SOURCES]
    checks = L.order_windows(rows, settings.weather_lookback_days, L.KEY)
    path = fresh_folder(spark, "malformed-files")
    checks.filter(wrong[0] | wrong[1]).select(*L.KEY).write.parquet(path)
    failed = spark.read.schema("source_name string, batch_id string, source_file_name string").parquet(path)
    if failed.isEmpty():
        return rows
    keys = failed.withColumn("raw_table_id", F.lit(store.raw(L.ORDERS)))
    problem = ValueError("orders contain invalid timestamps")
    save_ledger(spark, store, L.failed_rows(keys, L.read_ledger(spark, store.ledger), problem, now))
    return rows.join(failed, L.KEY, "left_anti")
