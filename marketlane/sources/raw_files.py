"""Landing CSV files to raw frames."""

from __future__ import annotations

import csv
import os
import re
from collections.abc import Iterable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane.sources.registry import METADATA, SourceSpec


def standard_name(name: str) -> str:
    """Header text to snake case: lower case, other characters to single ``_``."""
    words = re.findall(r"[a-z0-9]+", str(name).lower())
    if not words:
        raise ValueError(f"column name {name!r} has no letter or digit: nothing would be left, an empty name")
    return "_".join(words)


def standardize_columns(frame: DataFrame) -> DataFrame:
    """Rename all columns to snake case; two columns may not end up alike."""
    names = [standard_name(c) for c in frame.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"duplicate column names after standardization: {', '.join(repeated)}")
    return frame.toDF(*names)


def require_columns(frame: DataFrame, spec: SourceSpec) -> DataFrame:
    """Fail when a required column is missing; further columns are kept."""
    missing = sorted(set(spec.columns) - set(frame.columns))
    if missing:
        raise ValueError(f"{spec.name}: missing required columns: {', '.join(missing)}")
    return frame


def generated_batch_id(file_name: str, ingested_at: datetime) -> str:
    """``<file stem>_<UTC stamp>`` for a file that comes without a batch."""
    stem = os.path.splitext(os.path.basename(file_name))[0].lower().replace(" ", "_")
    return f"{stem}_{as_utc(ingested_at).strftime('%Y%m%dT%H%M%S%fZ')}"


def as_utc(moment: datetime | None) -> datetime:
    if moment is None:
        return datetime.now(tz=UTC)
    if moment.utcoffset() is None:
        raise ValueError(f"load time {moment.isoformat()} lacks a timezone")
    return moment.astimezone(UTC)


def add_batch_metadata(
    frame: DataFrame,
    source_file: str | Column,
    batch_id: str | Column | None = None,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Add the three lineage columns. Columns may be given for many-file reads."""
    taken = sorted(set(frame.columns) & set(METADATA))
    if taken:
        raise ValueError(f"metadata columns already exist: {', '.join(taken)}")
    moment = as_utc(ingested_at)
    if isinstance(source_file, str):
        name = os.path.basename(source_file).strip()
        if not name:
            raise ValueError("a source file name is required")
        if batch_id is None:
            batch_id = generated_batch_id(name, moment)
        source_file = F.lit(name)
    if isinstance(batch_id, str):
        if not batch_id.strip():
            raise ValueError("batch_id cannot be empty")
        batch_id = F.lit(batch_id.strip())
    if batch_id is None:
        raise ValueError("batch_id is required when files come as a column")
    return frame.select(
        "*",
        batch_id.alias("batch_id"),
        F.lit(moment).cast("timestamp").alias("ingested_at_utc"),
        source_file.alias("source_file_name"),
    )


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, header``: the first line of every physical file below the paths, in one job.

    A file's first line is the first one of the split that begins it. Files without any
    line have no row.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    lines = lines.filter("start = 0").withColumn("at", F.monotonically_increasing_id())
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def parsed_header(line: str) -> list[str]:
    """Column names of a CSV header line."""
    return next(csv.reader([line.lstrip("\ufeff")]), [])


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names in the header of one file; reads its first line only."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_csv(
    spark: SparkSession, paths: str | Iterable[str], names: list[str], multi_line: bool = True
) -> DataFrame:
    """Header CSV, all columns as text. Files with line breaks inside quotes need
    ``multi_line``, which makes one task of each; others are split."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", True)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def prepare_raw(
    spark: SparkSession,
    path: str,
    spec: SourceSpec,
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Read, rename, check and annotate one landing file."""
    frame = read_csv(spark, path, header_names(spark, path), spec.multi_line)
    frame = require_columns(standardize_columns(frame), spec)
    return add_batch_metadata(frame, path.rstrip("/"), batch_id, ingested_at)
