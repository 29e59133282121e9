"""Layered tables as partitioned Parquet folders with a run manifest.

``<root>/<namespace>/<table>`` holds the data. ``<root>/_manifest`` records one row
per commit and ``<root>/_files`` the live files of each table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.columns import qualify
from waymark.session import Scratch, materialize
from waymark.sources.readers import list_files

MANIFEST_SCHEMA = T.StructType([
    T.StructField("table_id", T.StringType()), T.StructField("snapshot_id", T.StringType()),
    T.StructField("made_current_at", T.TimestampNTZType()), T.StructField("run_id", T.StringType()),
    T.StructField("operation", T.StringType()), T.StructField("is_current_ancestor", T.BooleanType()),
])
FILES_SCHEMA = "path string, table_id string"


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- names and existence -----------------------------------------------------------
    def path(self, table: str) -> str:
        _, namespace, name = qualify(table).split(".")
        return f"{self.root}/{namespace}/{name}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _has(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def _remove(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.delete(target, True)

    def exists(self, table: str) -> bool:
        return self._has(self.path(table))

    def ensure_namespaces(self, names: Sequence[str] = ("bronze", "silver", "gold")) -> None:
        for name in names:
            fs, target = self._fs(f"{self.root}/{name}")
            fs.mkdirs(target)

    # -- reads -------------------------------------------------------------------------
    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(table))
        return df.select(*columns) if columns else df

    def history(self) -> DataFrame:
        """One row per commit; ``is_current`` marks the newest of each table."""
        path = f"{self.root}/_manifest"
        if not self._has(path):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA).withColumn("is_current", F.lit(False))
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(path)
        newest = rows.groupBy(F.col("table_id").alias("_t")).agg(
            F.max(F.struct("made_current_at", "snapshot_id")).getField("snapshot_id").alias("_newest"))
        return rows.join(newest, F.col("table_id") == F.col("_t"), "left").select(
            *rows.columns, (F.col("snapshot_id") == F.col("_newest")).alias("is_current"))

    def recorded_at(self, table: str) -> datetime | None:
        """When the files of a table were last recorded."""
        if not self._has(f"{self.root}/_files"):
            return None
        listing = list_files(self.spark, f"{self.root}/_files").where(F.col("path").contains(f"/table_id={qualify(table)}/"))
        return listing.agg(F.max("modified")).first()[0]

    def live_files(self) -> DataFrame:
        path = f"{self.root}/_files"
        if not self._has(path):
            return self.spark.createDataFrame([], FILES_SCHEMA)
        return self.spark.read.schema(FILES_SCHEMA).parquet(path)

    # -- writes ------------------------------------------------------------------------
    def append(self, df: DataFrame, table: str, partition_by: Sequence[str], run_id: str) -> str:
        """Create or append; run-owned tables are partitioned by run first."""
        mode = "append" if self.exists(table) else "create"
        (df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(self.path(table)))
        self.commit(table, run_id, mode)
        return mode

    def overwrite_partitions(self, df: DataFrame, table: str, partition: str, run_id: str) -> str:
        """Create, or replace exactly the partitions ``df`` touches.

        ``rebalance`` groups rows by partition value but splits large ones, so a hot
        date is written by many tasks and a small one by a single task.
        """
        mode = "overwrite_partitions" if self.exists(table) else "create"
        (df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition).parquet(self.path(table)))
        self.commit(table, run_id, mode)
        return mode

    def overwrite_single_file(self, df: DataFrame, table: str, run_id: str) -> str:
        """Replace a small lookup table by one file."""
        mode = "overwrite" if self.exists(table) else "create"
        df.coalesce(1).write.mode("overwrite").parquet(self.path(table))
        self.commit(table, run_id, mode)
        return mode

    def drop_run(self, table: str, run_id: str) -> bool:
        """Forget the rows an earlier attempt of this run left behind."""
        return self._remove(f"{self.path(table)}/run_id={run_id}")

    def copy(self, source: str, table: str, run_id: str, partition_by: Sequence[str] = ()) -> None:
        """Load a Parquet folder under a table name."""
        (self.spark.read.parquet(source).hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(table)))
        self.commit(table, run_id, "overwrite")

    def commit(self, table: str, run_id: str, operation: str, at: datetime | None = None) -> str:
        """Record a new snapshot and the files that are live now."""
        table_id, snapshot = qualify(table), uuid.uuid4().hex
        moment = (at or datetime.now(UTC)).replace(tzinfo=None)
        row = [(table_id, snapshot, moment, run_id, operation, True)]
        self.spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")
        self.record_files(table)
        return snapshot

    def record_files(self, table: str) -> None:
        (list_files(self.spark, self.path(table)).select("path", F.lit(qualify(table)).alias("table_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_id")
         .parquet(f"{self.root}/_files"))

    # -- upkeep ------------------------------------------------------------------------
    def rewrite_history(self, keep: DataFrame) -> None:
        staged = materialize(keep.select(*MANIFEST_SCHEMA.names), "manifest")
        staged.write.mode("overwrite").parquet(f"{self.root}/_manifest")

    def rewrite_partitions(self, table: str, partitions: DataFrame, partition_column: str, run_id: str) -> None:
        """Compact the listed partition values of one table into ``target_files`` files each at most.

        The rows go to the shared folder first, because a job must not overwrite
        the files it is reading.
        """
        wanted = partitions.groupBy(partition_column).agg(F.max("target_files").alias("_files"))
        rows = self.read(table)
        with Scratch(self.spark, "compact") as scratch:
            staged = scratch.keep(rows.join(wanted, partition_column).select(*rows.columns, F.pmod(F.xxhash64(*rows.columns), "_files").alias("_file")), "rows")
            (staged.repartition(partition_column, "_file").drop("_file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(partition_column).parquet(self.path(table)))
        self.commit(table, run_id, "compact")

    def remove_files(self, files: DataFrame) -> int:
        """Delete the listed files; paths stream through the driver one partition at a time."""
        removed = 0
        for row in files.select("path").toLocalIterator():
            fs, target = self._fs(row["path"])
            removed += bool(fs.delete(target, False))
        return removed


def write_json_report(df: DataFrame, path: str) -> None:
    """A small report as JSON lines."""
    df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)

