"""Bootstrap and incremental ingestion as driver programs over Spark jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane.operators import ledger as L
from marketlane.session import fresh_folder
from marketlane.settings import Settings
from marketlane.sources import enrichment, landing, raw_files, tables
from marketlane.sources.registry import METADATA, SOURCES, SourceSpec

Window = tuple[date, date] | None
# Every raw table, however it is loaded, has a partition per batch and physical file: what
# is loaded again replaces itself, and nothing else.
BATCH_PARTITION, FILE_PARTITION = "batch_partition", "file_partition"
LOAD = [BATCH_PARTITION, FILE_PARTITION]
LEDGER_TRIES = 5


@dataclass(frozen=True)
class RunSummary:
    mode: str
    no_op: bool
    publish_complete: bool
    raw_batches_loaded: int = 0
    raw_rows_loaded: int = 0
    batches_marked_published: int = 0
    holiday_date_window: Window = None
    weather_date_window: Window = None


@dataclass(frozen=True)
class Store:
    """Where a deployment keeps its raw tables and its ledger."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    @property
    def ledger(self) -> str:
        return f"{self.root}/control/ledger"

    def raw_frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        """All raw tables, in the shape staging expects."""
        frames = {}
        for name, spec in SOURCES.items():
            frame = tables.read_table(spark, self.raw(name))
            frames[name] = frame.select(*spec.columns, *METADATA)
        for name in ("holidays", "weather_daily"):
            if tables.table_exists(spark, self.raw(name)):
                frames[name] = tables.read_table(spark, self.raw(name))
        return frames


@dataclass(frozen=True)
class Enrichment:
    """Landed enrichment payloads; None leaves that enrichment out of the run."""

    holidays_json: str | None = None
    weather_json: str | None = None
    location: enrichment.WeatherLocation = enrichment.WeatherLocation("sao_paulo", -23.55, -46.63)


def with_load(frame: DataFrame, part: Column | None = None) -> DataFrame:
    """Add the partition of a raw row: its batch, and its file with the part it came in.

    The prefixes keep ids such as 0007 from being read back as numbers.
    """
    name = F.concat(F.lit("f_"), "source_file_name", F.lit("|"), part if part is not None else F.lit(""))
    return frame.withColumn(BATCH_PARTITION, F.concat(F.lit("b_"), "batch_id")).withColumn(FILE_PARTITION, name)


def bootstrap_load(
    spark: SparkSession,
    files: dict[str, str],
    store: Store,
    settings: Settings,
    extras: Enrichment | None = None,
    date_range: tuple[date, date] | None = None,
) -> RunSummary:
    """Replace all eight raw tables, then the enrichments over the order dates."""
    extras = extras or Enrichment()
    moment = raw_files.as_utc(settings.now)
    loaded = rows = 0
    for name, spec in SOURCES.items():
        if name in files:
            frame = raw_files.prepare_raw(spark, files[name], spec, ingested_at=moment)
            rows += tables.replace_table(with_load(frame), store.raw(name), LOAD).loaded_rows
            loaded += 1
    wants_dates = extras.holidays_json or extras.weather_json
    if wants_dates and date_range is None:
        orders = tables.read_table(spark, store.raw(L.ORDERS))
        date_range = L.resolve_order_date_range(orders)
    holiday_window = weather_window = None
    if extras.holidays_json:
        load_holidays(spark, store, extras, *date_range, settings, mode="replace", allow_empty=False)
        holiday_window = date_range
    if extras.weather_json:
        enrichment.require_budget(*date_range, settings.weather_call_budget)
        load_weather(spark, store, extras, *date_range, settings, mode="replace")
        weather_window = date_range
    return RunSummary(
        "bootstrap",
        no_op=not (loaded or wants_dates),
        publish_complete=True,
        raw_batches_loaded=loaded,
        raw_rows_loaded=rows,
        batches_marked_published=loaded,
        holiday_date_window=holiday_window,
        weather_date_window=weather_window,
    )


def _write(frame: DataFrame, table: str, mode: str, allow_empty: bool) -> tables.WriteResult:
    if allow_empty and frame.isEmpty():
        return tables.WriteResult(table, mode, tables.NO_OP, 0, len(frame.columns))
    if mode == "replace":
        return tables.replace_table(frame, table)
    return tables.append_table(frame, table)


def load_holidays(
    spark: SparkSession,
    store: Store,
    extras: Enrichment,
    first: date,
    last: date,
    settings: Settings,
    mode: str = "append",
    allow_empty: bool = True,
) -> tables.WriteResult:
    code = enrichment.country_code(settings.holiday_country)
    records = enrichment.read_json(spark, extras.holidays_json, enrichment.HOLIDAY_JSON)
    frame = enrichment.normalize_holidays(records, first, last)
    name = f"public_holidays_{code}_{first}_{last}.json"
    frame = raw_files.add_batch_metadata(frame, name, ingested_at=raw_files.as_utc(settings.now))
    return _write(frame, store.raw("holidays"), mode, allow_empty)


def load_weather(
    spark: SparkSession,
    store: Store,
    extras: Enrichment,
    first: date,
    last: date,
    settings: Settings,
    mode: str = "append",
) -> tables.WriteResult:
    records = enrichment.read_json(spark, extras.weather_json, enrichment.WEATHER_JSON)
    frame = enrichment.normalize_weather(records, extras.location).filter(
        F.col("weather_date").between(first, last)
    )
    name = f"weather_daily_{extras.location.location_key}_{first}_{last}.json"
    frame = raw_files.add_batch_metadata(frame, name, ingested_at=raw_files.as_utc(settings.now))
    return _write(frame, store.raw("weather_daily"), mode, allow_empty=False)


@dataclass(frozen=True)
class LoadPlan:
    """What a run has to load: the stored rows of its files, and the physical paths to
    read together, by source and header. Paths and distinct headers are all the driver
    holds of them."""

    files: DataFrame
    paths: dict[str, dict[tuple[str, ...], list[str]]]


def plan_load(spark: SparkSession, landing_folder: str, ledger: DataFrame) -> LoadPlan:
    """Files that the ledger does not have as loaded, grouped by header.

    Discovery, the join with the ledger and the first lines of all new files are one Spark
    job each, whatever the number of files. Files without a byte are not listed.
    """
    new = L.unseen_files(landing.discover_batch_files(spark, landing_folder), ledger)
    folder = fresh_folder(spark, "load-plan")
    new.write.parquet(folder)
    files = spark.read.schema(new.schema).parquet(folder)
    logical = [row[0] for row in files.select("path").collect()]
    paths: dict[str, dict[tuple[str, ...], list[str]]] = {}
    if logical:
        lines = raw_files.first_lines(spark, logical)
        located = landing.batch_file_rows(lines, F.col("file"), landing_folder, "header", "file")
        grouped = located.groupBy("source_name", "header").agg(F.collect_list("file").alias("paths"))
        for name, header, same in grouped.collect():
            paths.setdefault(name, {}).setdefault(tuple(raw_files.parsed_header(header)), []).extend(same)
    return LoadPlan(files, paths)


def read_batch_files(
    spark: SparkSession, root: str, by_header: dict[tuple[str, ...], list[str]], spec: SourceSpec, moment: datetime
) -> DataFrame:
    """Many landing files of one source as one frame, whatever their column order.

    Files with the same header are read together; batch and file name come from
    each row's own path.
    """
    frames = []
    for header, same in sorted(by_header.items()):
        frame = raw_files.standardize_columns(
            raw_files.read_csv(spark, sorted(same), list(header), spec.multi_line)
        )
        raw_files.require_columns(frame, spec)
        names = frame.columns
        located = frame.select("*", F.col("_metadata.file_path").alias("_path"))
        parts = F.split(F.substring_index("_path", root.rstrip("/") + "/", -1), "/")
        annotated = raw_files.add_batch_metadata(
            located.withColumn("_batch", F.trim(F.url_decode(F.get(parts, F.lit(0))))).withColumn(
                "_file", F.get(parts, F.lit(1))
            ),
            F.col("_file"),
            F.col("_batch"),
            moment,
        )
        loaded = with_load(annotated, F.substring_index("_path", "/", -1))
        frames.append(loaded.select(*names, *METADATA, *LOAD))
    if not frames:
        raise ValueError(f"{spec.name}: no header line in any file")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def save_ledger(spark: SparkSession, store: Store, updates: DataFrame) -> DataFrame:
    """Upsert ledger rows in the stored ledger; gives the stored result.

    When another run commits in between, its rows are read and the upsert is done again.
    """
    for left in reversed(range(LEDGER_TRIES)):
        current = tables.current_path(spark, store.ledger)
        merged = L.upsert_ledger(L.read_ledger(spark, store.ledger), updates)
        try:
            tables.replace_table(merged, store.ledger, allow_empty=True, based_on=current)
            break
        except tables.ConflictError:
            if not left:
                raise
    return L.require_valid(L.read_ledger(spark, store.ledger))


def incremental_load(
    spark: SparkSession,
    landing_folder: str,
    store: Store,
    settings: Settings,
    extras: Enrichment | None = None,
) -> RunSummary:
    """Load unseen files, enrich the orders still waiting, publish what is ready.

    One Spark job per source loads all its new batches. A load replaces the partitions of
    its own files, so a file loaded again after a crash between load and ledger leaves no
    double rows, and a file that comes late into a loaded batch removes none.
    """
    extras = extras or Enrichment()
    moment = raw_files.as_utc(settings.now)
    now = F.lit(moment).cast("timestamp")
    before = L.read_ledger(spark, store.ledger)
    plan = plan_load(spark, landing_folder, before)
    key_columns = [*L.KEY, "raw_table_id"]
    for name in (r[0] for r in plan.files.select("source_name").distinct().orderBy("source_name").collect()):
        spec = SOURCES[name]
        files = plan.files.filter(F.col("source_name") == name)
        key_rows = files.withColumn("raw_table_id", F.lit(store.raw(name))).select(*key_columns)
        prior = L.read_ledger(spark, store.ledger)
        try:
            loads = load_batches(spark, landing_folder, files, plan.paths.get(name, {}), spec, store, settings, moment)
            rows = key_rows.join(loads, L.KEY, "left").withColumn(
                "raw_loaded_rows", F.coalesce("raw_loaded_rows", F.lit(0))
            )
            save_ledger(spark, store, L.loaded_rows(rows, prior, now))
        except Exception as problem:
            save_ledger(spark, store, L.failed_rows(key_rows, prior, problem, now))
            raise
    return finish_load(spark, store, settings, extras, before)


def finish_load(
    spark: SparkSession, store: Store, settings: Settings, extras: Enrichment, before: DataFrame
) -> RunSummary:
    """Enrich the orders still waiting and publish what is ready; batch and stream end so.

    ``before`` is the ledger as the run found it.
    """
    now = F.lit(raw_files.as_utc(settings.now)).cast("timestamp")
    current = L.read_ledger(spark, store.ledger)
    pending = L.pending_orders(current)
    L.require_recoverable(pending)
    windows = L.merged_windows(pending).first()
    holiday_window = _window(windows, L.HOLIDAY)
    weather_window = _window(windows, L.WEATHER)
    if extras.holidays_json and holiday_window:
        _enrich(
            spark, store, L.HOLIDAY, now,
            lambda: load_holidays(spark, store, extras, *holiday_window, settings),
        )
    if extras.weather_json and weather_window:
        enrichment.require_budget(*weather_window, settings.weather_call_budget)
        _enrich(
            spark, store, L.WEATHER, now,
            lambda: load_weather(spark, store, extras, *weather_window, settings),
        )

    current = L.read_ledger(spark, store.ledger)
    ready = L.mark_published(current, now)
    after = save_ledger(spark, store, ready) if not ready.isEmpty() else current
    summary = L.run_summary(before, after).first().asDict()
    return RunSummary(
        **summary, holiday_date_window=holiday_window, weather_date_window=weather_window
    )


def load_batches(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    by_header: dict[tuple[str, ...], list[str]],
    spec: SourceSpec,
    store: Store,
    settings: Settings,
    moment: datetime,
) -> DataFrame:
    """Load files of one source; gives rows per file and, for orders, their windows.

    Orders are checked, counted and their windows taken in one pass before anything is
    written; other sources are counted from the batches just written.
    """
    frame = read_batch_files(spark, root, by_header, spec, moment)
    if spec.name == L.ORDERS:
        loads = checked_windows(frame, settings)
        tables.overwrite_partitions(frame, store.raw(spec.name), LOAD)
        return loads
    tables.overwrite_partitions(frame, store.raw(spec.name), LOAD)
    return written_rows(spark, store, spec, files, F.lit(moment).cast("timestamp"))


def checked_windows(frame: DataFrame, settings: Settings) -> DataFrame:
    """Rows, windows and malformed texts per order file, stored; fails on malformed ones."""
    spark = frame.sparkSession
    path = fresh_folder(spark, "order-windows")
    keyed = frame.withColumn("source_name", F.lit(L.ORDERS))
    L.order_windows(keyed, settings.weather_lookback_days, L.KEY).write.parquet(path)
    windows = spark.read.parquet(path)
    wrong = [F.col(f"malformed_{c}") > 0 for c in L.WINDOW_SOURCES]
    if not windows.filter(wrong[0] | wrong[1]).isEmpty():
        L.require_well_formed(frame)
    return windows


def written_rows(
    spark: SparkSession, store: Store, spec: SourceSpec, files: DataFrame, loaded_at: Column
) -> DataFrame:
    """Rows per file of a load, from the partitions of its batches only: the join on the
    partition column prunes them as it runs."""
    batches = files.select(F.concat(F.lit("b_"), "batch_id").alias(BATCH_PARTITION)).distinct()
    return (
        tables.read_table(spark, store.raw(spec.name))
        .join(batches, BATCH_PARTITION, "left_semi")
        .filter(F.col("ingested_at_utc") == loaded_at)
        .withColumn("source_name", F.lit(spec.name))
        .groupBy(*L.KEY)
        .agg(F.count(F.lit(1)).alias("raw_loaded_rows"))
    )


def _window(row, kind: str) -> Window:
    start, end = row[f"{kind}_window_start_date"], row[f"{kind}_window_end_date"]
    return (start, end) if start is not None and end is not None else None


def _enrich(spark: SparkSession, store: Store, kind: str, now, load) -> None:
    """Run one enrichment and advance, or fail, the orders waiting for it."""
    pending = L.pending_orders(L.read_ledger(spark, store.ledger))
    try:
        load()
    except Exception as problem:
        save_ledger(spark, store, L.mark_enrichment_failed(pending, kind, problem, now))
        raise
    save_ledger(spark, store, L.mark_enriched(pending, kind, now))
