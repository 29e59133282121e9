"""Snapshot expiry, orphan files and compaction plans as DataFrames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waymark import settings as S


def expiry_plan(history: DataFrame, cutoff: datetime | str, retain_last: int = S.RETAIN_LAST) -> DataFrame:
    """Snapshots to expire: older than ``cutoff``, not among the newest, not current.

    Only the snapshots older than the cutoff are candidates. Ranking them needs a
    position from the top only up to ``retain_last``, which the rank filter finds
    on the map side; the rest are expired without being ordered.
    """
    limit = F.lit(str(cutoff)).cast("timestamp_ntz")
    newest = W.partitionBy("table_id").orderBy(F.col("made_current_at").desc(), F.col("snapshot_id").desc())
    kept = (
        history.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= retain_last)
        .select(F.col("table_id").alias("_t"), F.col("snapshot_id").alias("_s"))
    )
    old = history.where((F.col("made_current_at") < limit) & ~F.coalesce(F.col("is_current"), F.lit(False)))
    return old.join(kept, (F.col("table_id") == F.col("_t")) & (F.col("snapshot_id") == F.col("_s")), "left_anti")


def path_key(path: Column) -> Column:
    """Path without scheme and authority, so differing prefixes still compare."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")


def orphan_files(listing: DataFrame, live: DataFrame, cutoff: datetime | str) -> DataFrame:
    """Listed files that no live snapshot names and that are older than ``cutoff``."""
    limit = F.lit(str(cutoff)).cast("timestamp_ntz")
    known = live.select(path_key(F.col("path")).alias("_known")).distinct()
    return (
        listing.where(F.col("modified") < limit)
        .join(known, path_key(F.col("path")) == F.col("_known"), "left_anti")
    )


def compaction_plan(files: DataFrame, where: Column | None = None, min_files: int = S.MIN_COMPACT_FILES,
                    target_bytes: int = S.TARGET_FILE_BYTES) -> DataFrame:
    """Partitions worth rewriting: at least ``min_files`` files and more than their bytes need; with the files to aim for.

    A rewritten partition holds ``target_files`` files at most, so it is not chosen again.
    """
    if where is not None:
        files = files.where(where)
    return (
        files.groupBy("partition").agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("total_bytes"))
        .withColumn("target_files", F.greatest(F.lit(1), F.ceil(F.col("total_bytes") / target_bytes)).cast("bigint"))
        .where((F.col("n_files") >= min_files) & (F.col("n_files") > F.col("target_files")))
    )
