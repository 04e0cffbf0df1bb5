"""Version histories of master data, stored and carried on from run to run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane.operators import snapshots
from marketlane.session import fresh_folder
from marketlane.sources import tables
from marketlane.sources.raw_files import as_utc

RUN = "snapshot_run"


def run_id(moment: datetime) -> str:
    """Runs in the order of their moments, as text."""
    return as_utc(moment).strftime("run-%Y%m%dT%H%M%S%f")


@dataclass(frozen=True)
class History:
    """A stored history: open versions in one table, closed ones in another by run.

    A run reads and replaces the open versions only, at most one for each key, and adds
    the versions it closed as a partition of its own, so closed files are written once.
    The closed partition comes first and counts from the moment the open versions of
    the same run are in place: a run that fails in between shows nowhere, and its
    partition is removed by the next one.
    """

    folder: str
    key: str
    tracked: Sequence[str]

    @property
    def open_table(self) -> str:
        return f"{self.folder}/open"

    @property
    def closed_table(self) -> str:
        return f"{self.folder}/closed"

    def last_run(self, spark: SparkSession) -> str | None:
        """The last finished run; None before the first one."""
        if not tables.table_exists(spark, self.open_table):
            return None
        # Every open version names the run that wrote it. When nothing is open any more, no
        # later run can have closed anything, so the last closed partition names it.
        row = tables.read_table(spark, self.open_table).agg(F.max(RUN)).first()
        if row[0] is not None:
            return row[0]
        if not tables.table_exists(spark, self.closed_table):
            return ""
        return tables.read_table(spark, self.closed_table).agg(F.max(RUN)).first()[0] or ""

    def read(self, spark: SparkSession) -> DataFrame:
        """All versions of all finished runs."""
        last = self.last_run(spark)
        if last is None:
            raise FileNotFoundError(f"no history yet: {self.folder}")
        versions = tables.read_table(spark, self.open_table).drop(RUN)
        if tables.table_exists(spark, self.closed_table):
            closed = tables.read_table(spark, self.closed_table).filter(F.col(RUN) <= last)
            versions = versions.unionByName(closed.drop(RUN))
        return versions

    def take(self, source: DataFrame, now: datetime, close_deletes: bool = True) -> tables.WriteResult:
        """Carry the history on to the source's state; ``now`` names the run.

        Keys must be unique in the source. A run that was finished before is left as it
        is; a moment before the last run's is an error.
        """
        spark, run, last = source.sparkSession, run_id(now), self.last_run(source.sparkSession)
        moment = as_utc(now)
        if last == run:
            return tables.WriteResult(self.folder, "snapshot", tables.NO_OP, 0, len(source.columns))
        if last is not None and last > run:
            raise ValueError(f"{self.folder}: {run} is before the last run, {last}")
        if last is None:
            versions = snapshots.first_versions(source, self.key, self.tracked, moment)
        else:
            before = tables.read_table(spark, self.open_table).drop(RUN)
            versions = snapshots.scd2_merge(before, source, self.key, self.tracked, moment, close_deletes)
            self._remove_unfinished(spark, last)
        staged = fresh_folder(spark, "snapshot-step")
        versions.write.parquet(staged)
        try:
            versions = spark.read.schema(versions.schema).parquet(staged).withColumn(RUN, F.lit(run))
            ended = versions.filter(F.col("dbt_valid_to").isNotNull())
            if not ended.isEmpty():
                tables.overwrite_partitions(ended, self.closed_table, [RUN])
            still = versions.filter(F.col("dbt_valid_to").isNull())
            return tables.replace_table(still, self.open_table, cluster_by=[self.key], allow_empty=True)
        finally:
            tables.delete_path(spark, staged)

    def _remove_unfinished(self, spark: SparkSession, last: str) -> None:
        path = tables.current_path(spark, self.closed_table)
        if path is None:
            return
        # Partition values only: at most one run can be left over.
        later = tables.read_table(spark, self.closed_table).filter(F.col(RUN) > last).select(RUN).distinct()
        for row in later.collect():
            tables.delete_path(spark, f"{path}/{RUN}={row[0]}")
