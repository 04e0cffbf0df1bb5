"""What a registered query works on: the warehouse over one folder of test tables."""

from __future__ import annotations

import hashlib
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane import session
from marketlane.plans import rules
from marketlane.plans.warehouse import Warehouse
from marketlane.settings import Settings
from marketlane.sources.sample_tables import raw_relations

NOW = datetime(2002, 1, 1, tzinfo=UTC)
_CACHE: dict[tuple, object] = {}


def settings() -> Settings:
    return Settings(now=NOW)


def _state(spark: SparkSession, folder: str) -> tuple[int, ...]:
    """Sizes and times of what lies in a folder: a changed folder is another folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(x for s in files.listStatus(path) for x in (s.getLen(), s.getModificationTime()))


def once(spark: SparkSession, folder: str, what: str, make):
    key = (spark.sparkContext.applicationId, folder, _state(spark, folder), what)
    if key not in _CACHE:
        _CACHE[key] = make()
    return _CACHE[key]


def _prepared(spark: SparkSession, folder: str) -> None:
    """The session's settings, with shuffles sized for the tables in the folder."""
    session.prepare(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    session.size_shuffles(spark, files.getContentSummary(path).getLength())


def lazy(spark: SparkSession, folder: str) -> Warehouse:
    """Every relation as one plan from the given tables."""
    _prepared(spark, folder)
    return once(spark, folder, "lazy", lambda: Warehouse(raw_relations(spark, folder), settings()))


def published(spark: SparkSession, folder: str) -> Warehouse:
    """Facts, dimensions and marts as stored tables below the shared folder.

    Each is derived from the given tables and written on first use in a session.
    """
    _prepared(spark, folder)
    name = hashlib.md5(folder.encode()).hexdigest()[:8]

    def make() -> Warehouse:
        target = session.fresh_folder(spark, f"published-{name}")
        # Sorted files suit the size of the test tables; day folders suit large ones.
        return Warehouse(
            raw_relations(spark, folder), settings(), target, day_partitions=False, rules=rules.ALL_RULES
        )

    return once(spark, folder, "published", make)


def edge(frame: DataFrame) -> DataFrame:
    """Result columns in comparable types: amounts and rates as doubles with six
    decimals, instants without a zone."""
    items = []
    for field in frame.schema:
        kind, column = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("decimal", "double", "float"):
            column = F.round(column.cast("double"), 6)
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind in ("integer", "short", "byte"):
            column = column.cast("bigint")
        items.append(column.alias(field.name))
    return frame.select(*items)
