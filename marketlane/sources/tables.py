"""Stored relations: append, atomic replace, partition layout, partition upsert."""

from __future__ import annotations

import json
import logging
import threading
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import timedelta
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from marketlane.functions.frames import upsert

log = logging.getLogger(__name__)

COMPLETED, NO_OP = "completed", "no_op"
VERSION_PREFIX = "v="
# Stored tables are written once and read often: a fourth to a third smaller than by default.
CODEC = ("compression", "zstd")
MARKER, SCHEMA_FILE, LAYOUT_FILE = "_SUCCESS", "_schema.json", "_layout.json"
# Shuffle files of a query go when it ends, not when the driver happens to collect its plan.
GIVE_BACK = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_GIVING = threading.Lock()
_givers: list[str | None] = []


@dataclass(frozen=True)
class WriteResult:
    table: str
    mode: str
    state: str
    loaded_rows: int
    columns: int
    measured: Mapping[str, object] = field(default_factory=dict)


class EmptyInputError(ValueError):
    """Nothing to write where something was expected."""


class LayoutError(ValueError):
    """A table partitioned one way was to be written another way."""


class ConflictError(RuntimeError):
    """Another writer committed first."""


def file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = file_system(spark, path)
    return files.exists(location)


def delete_path(spark: SparkSession, path: str) -> None:
    files, location = file_system(spark, path)
    files.delete(location, True)


def _version_names(spark: SparkSession, table: str) -> list[str]:
    files, location = file_system(spark, table)
    if not files.exists(location):
        return []
    names = [s.getPath().getName() for s in files.listStatus(location) if s.isDirectory()]
    return sorted(name for name in names if name.startswith(VERSION_PREFIX))


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Complete versions of a table, oldest first. The commit marker comes last."""
    return [n for n in _version_names(spark, table) if path_exists(spark, f"{table}/{n}/{MARKER}")]


def _claim(spark: SparkSession, table: str) -> str:
    """A version folder no other writer has: its claim file is created exclusively."""
    taken = [int(n[len(VERSION_PREFIX) :]) for n in _version_names(spark, table)]
    number = max(taken, default=0) + 1
    while True:
        files, claim = file_system(spark, f"{table}/_claims/{number:010d}")
        if files.createNewFile(claim):
            return f"{table}/{VERSION_PREFIX}{number:010d}"
        number += 1


def _write_text(spark: SparkSession, path: str, text: str, replace: bool) -> None:
    files, location = file_system(spark, path)
    stream = files.create(location, replace)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _read_text(spark: SparkSession, path: str) -> str:
    files, location = file_system(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _schema_of(spark: SparkSession, path: str) -> StructType | None:
    note = f"{path}/{SCHEMA_FILE}"
    if not path_exists(spark, note):
        return None
    return StructType.fromJson(json.loads(_read_text(spark, note)))


def _keep_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Note the columns of a version; columns of later appends are added to it."""
    known = _schema_of(spark, path)
    fields = list(known.fields) if known is not None else []
    types = {f.name: f.dataType for f in fields}
    for field in schema.fields:
        if field.name not in types:
            fields.append(StructField(field.name, field.dataType))
        elif types[field.name] != field.dataType:
            raise ValueError(f"{path}: {field.name} is {types[field.name]}, not {field.dataType}")
    if known is None or len(fields) != len(known.fields):
        _write_text(spark, f"{path}/{SCHEMA_FILE}", StructType(fields).json(), known is not None)


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """Queries made inside remove their shuffle files when they end.

    For queries that run once, like a write: what they leave would lie on the executors'
    disks until the driver's next full garbage collection, beside the table made from it. A
    frame that is made inside and run twice computes its shuffles again.
    """
    with _GIVING:
        _givers.append(_givers[0] if _givers else spark.conf.get(GIVE_BACK, None))
        spark.conf.set(GIVE_BACK, "true")
    try:
        yield
    finally:
        with _GIVING:
            before = _givers.pop()
            if not _givers and before is None:
                spark.conf.unset(GIVE_BACK)
            elif not _givers:
                spark.conf.set(GIVE_BACK, before)


def write_files(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame to a folder once and read it back, without a version or a count."""
    return write_measured(frame, path, frame.columns, {})[0]


def write_measured(
    frame: DataFrame, path: str, columns: Sequence[str], measures: Mapping[str, Column]
) -> tuple[DataFrame, dict[str, object]]:
    """Write some columns to a folder once and read them back; measure all in the same pass."""
    seen = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    taken = [measure.alias(f"m_{name}") for name, measure in measures.items()]
    written = (frame.observe(seen, *taken) if taken else frame).select(*columns)
    with shuffles_given_back(frame.sparkSession):
        written.write.option(*CODEC).parquet(path)
    values = seen.get if taken else {}
    stored = frame.sparkSession.read.schema(written.schema).parquet(path)
    return stored, {name: values[f"m_{name}"] for name in measures}


def _values(frame: DataFrame, column: str) -> set:
    """Values of a partition column: at most one per day, hence a bounded list."""
    with shuffles_given_back(frame.sparkSession):
        return {row[0] for row in frame.select(column).distinct().collect()}


def current_path(spark: SparkSession, table: str) -> str | None:
    versions = _versions(spark, table)
    return f"{table}/{versions[-1]}" if versions else None


def table_exists(spark: SparkSession, table: str) -> bool:
    return current_path(spark, table) is not None


def partition_columns(spark: SparkSession, table: str) -> tuple[str, ...] | None:
    """By what the current version is partitioned; None when there is no version."""
    path = current_path(spark, table)
    note = f"{path}/{LAYOUT_FILE}"
    if path is None:
        return None
    return tuple(json.loads(_read_text(spark, note))) if path_exists(spark, note) else ()


def column_names(spark: SparkSession, table: str) -> list[str] | None:
    """Columns noted with the current version, without listing its files."""
    path = current_path(spark, table)
    schema = _schema_of(spark, path) if path is not None else None
    return schema.names if schema is not None else None


def _require_layout(spark: SparkSession, table: str, partition_by: Sequence[str]) -> None:
    have = partition_columns(spark, table)
    if have is not None and have != tuple(partition_by):
        raise LayoutError(f"{table} is partitioned by {list(have)}, not by {list(partition_by)}")


def read_table(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """Current version; an empty frame when there is none and a schema is given.

    The columns are those noted with the version: an empty table keeps its schema, and
    whether a column of a later batch is seen does not hang on one file's footer.
    """
    path = current_path(spark, table)
    if path is None:
        if schema is None:
            raise FileNotFoundError(f"no such table: {table}")
        return spark.createDataFrame([], schema)
    schema = schema if schema is not None else _schema_of(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def laid_out(
    frame: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]
) -> DataFrame:
    """Few files per partition value, sorted inside for min/max skipping.

    The rebalance hint lets AQE split a partition value that holds a large share
    of the rows over several tasks and files; a plain repartition by that column
    would put it into one.
    """
    if partition_by:
        frame = frame.hint("rebalance", *[F.col(c) for c in partition_by])
    if cluster_by:
        frame = frame.sortWithinPartitions(*partition_by, *cluster_by)
    return frame


def _write_counted(
    frame: DataFrame,
    path: str,
    mode: str,
    partition_by: Sequence[str],
    measures: Mapping[str, Column] | None = None,
) -> tuple[int, dict[str, object]]:
    """Write without a commit marker, count and measure, in one pass.

    The measures stand after the layout's exchange, in the tasks that write: of a task
    that runs twice they count one run.
    """
    seen = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    taken = [measure.alias(f"m_{name}") for name, measure in (measures or {}).items()]
    writer = frame.observe(seen, F.count(F.lit(1)).alias("rows"), *taken).write.mode(mode)
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").option(*CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_given_back(frame.sparkSession):
        writer.parquet(path)
    values = seen.get
    return int(values["rows"]), {name: values[f"m_{name}"] for name in measures or {}}


def replace_table(
    frame: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    allow_empty: bool = False,
    keep_for: timedelta = timedelta(days=7),
    based_on: str | None = None,
    measures: Mapping[str, Column] | None = None,
) -> WriteResult:
    """Replace a table as one step: readers see the old version or the new one.

    The new version gets a number no other writer has. It is written, counted and
    checked, and counts from the moment its commit marker is created. With ``based_on``,
    the version the frame was derived from, a version committed by someone else in the
    meantime is a ``ConflictError``. When anything fails the old version stays current,
    and trouble in cleaning up never hides the first error. Versions stay for readers
    until ``keep_for`` after they were followed. ``measures`` are aggregates over the
    rows, taken while they are written and returned in the result.
    """
    spark = frame.sparkSession
    path = _claim(spark, table)
    try:
        rows, measured = _write_counted(
            laid_out(frame, partition_by, cluster_by), path, "errorifexists", partition_by, measures
        )
        if rows == 0 and not allow_empty:
            raise EmptyInputError(f"{table}: input is empty")
        _keep_schema(spark, path, frame.schema)
        _write_text(spark, f"{path}/{LAYOUT_FILE}", json.dumps(list(partition_by)), False)
        if based_on is not None and current_path(spark, table) not in (None, based_on):
            raise ConflictError(f"{table}: {based_on} is no longer current")
        _write_text(spark, f"{path}/{MARKER}", "", False)
    except Exception:
        _try_delete(spark, path)
        raise
    _drop_old(spark, table, keep_for)
    return WriteResult(table, "replace", COMPLETED, rows, len(frame.columns), measured)


def _drop_old(spark: SparkSession, table: str, keep_for: timedelta) -> None:
    """Remove versions that were followed by another longer than ``keep_for`` ago."""
    versions = _versions(spark, table)
    for old, new in pairwise(versions):
        files, marker = file_system(spark, f"{table}/{new}/{MARKER}")
        followed = files.getFileStatus(marker).getModificationTime() / 1000
        if time.time() - followed > keep_for.total_seconds():
            _try_delete(spark, f"{table}/{old}")


def _try_delete(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception as problem:  # the caller's own error matters more
        log.warning("could not remove %s: %s", path, problem)


def append_table(
    frame: DataFrame, table: str, partition_by: Sequence[str] = (), allow_empty: bool = False
) -> WriteResult:
    """Append to the current version of a table, or start its first."""
    spark = frame.sparkSession
    path = current_path(spark, table)
    if path is None:
        return replace_table(frame, table, partition_by, allow_empty=allow_empty)
    _require_layout(spark, table, partition_by)
    _keep_schema(spark, path, frame.schema)
    rows, _ = _write_counted(frame, path, "append", partition_by)
    if rows == 0:
        if allow_empty:
            return WriteResult(table, "append", NO_OP, 0, len(frame.columns))
        raise EmptyInputError(f"{table}: input is empty")
    return WriteResult(table, "append", COMPLETED, rows, len(frame.columns))


def overwrite_partitions(frame: DataFrame, table: str, partition_by: Sequence[str]) -> WriteResult:
    """Replace only the partitions present in the frame; repeating it changes nothing.

    This works inside the current version: until it ends, readers may see a partition's
    old rows, its new ones, or neither.
    """
    spark = frame.sparkSession
    path = current_path(spark, table)
    if path is None:
        return replace_table(frame, table, partition_by)
    _require_layout(spark, table, partition_by)
    _keep_schema(spark, path, frame.schema)
    seen = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    writer = (
        frame.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option(*CODEC)
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .partitionBy(*partition_by)
    )
    with shuffles_given_back(spark):
        writer.parquet(path)
    return WriteResult(table, "overwrite", COMPLETED, int(seen.get["rows"]), len(frame.columns))


def replace_days(
    frame: DataFrame, table: str, partition: str, days: DataFrame, cluster_by: Sequence[str] = ()
) -> int:
    """Overwrite the named partitions with the frame's rows; named ones without rows go.

    ``days`` has one column, the values of a date partition: at most one a day, so that
    the list is bounded. Returns how many partitions were named. Readers see what
    ``overwrite_partitions`` lets them see.
    """
    spark = frame.sparkSession
    named = {row[0] for row in days.collect()}
    staged = f"{table}/_staged-{uuid.uuid4().hex[:12]}"
    try:
        rows = write_files(frame, staged)
        filled = _values(rows, partition)
        overwrite_partitions(laid_out(rows, [partition], cluster_by), table, [partition])
        _remove_partitions(spark, table, partition, named - filled)
    finally:
        _try_delete(spark, staged)
    return len(named)


def _remove_partitions(spark: SparkSession, table: str, partition: str, values: set) -> None:
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
        delete_path(spark, f"{current_path(spark, table)}/{partition}={name}")


def upsert_partitions(
    incoming: DataFrame,
    table: str,
    key: Sequence[str],
    partition: str,
    cluster_by: Sequence[str] = (),
) -> WriteResult:
    """Keyed upsert into a table partitioned by one column.

    Only partitions holding an incoming key, before or after, are rewritten. The
    merged rows are first written aside, so nothing is overwritten while it is
    still being read and a lost executor cannot make the two steps disagree. A
    partition all of whose rows moved elsewhere is removed. As in
    ``overwrite_partitions``, readers may meanwhile see a moved row twice or not at all.

    When the incoming columns differ from the stored ones, the whole table is
    written anew with the incoming columns, so all its files agree.
    """
    spark = incoming.sparkSession
    target = current_path(spark, table)
    if target is None:
        return replace_table(incoming, table, [partition], cluster_by)
    stored = read_table(spark, table)
    if set(stored.columns) != set(incoming.columns):
        return replace_table(upsert(stored, incoming, key), table, [partition], cluster_by)
    staged = f"{table}/_staged-{uuid.uuid4().hex[:12]}"
    try:
        fresh = write_files(incoming, f"{staged}/incoming")
        touched = (
            stored.join(fresh.select(*key), list(key), "left_semi")
            .select(partition)
            .unionByName(fresh.select(partition))
            .distinct()
        )
        touched = write_files(touched, f"{staged}/touched")
        # Partition values: at most one per day, hence a bounded list; as literals
        # they prune the scan of the existing table.
        values = [row[0] for row in touched.collect()]
        known = [v for v in values if v is not None]
        in_touched = F.col(partition).isin(known) if known else F.lit(False)
        if len(known) < len(values):
            in_touched = in_touched | F.col(partition).isNull()
        merged = upsert(stored.filter(in_touched), fresh, key)
        merged = write_files(laid_out(merged, [partition], cluster_by), f"{staged}/merged")
        filled = _values(merged, partition)
        result = overwrite_partitions(merged, table, [partition])
        _remove_partitions(spark, table, partition, set(values) - filled)
    finally:
        _try_delete(spark, staged)
    return WriteResult(table, "upsert", COMPLETED, result.loaded_rows, len(incoming.columns))
