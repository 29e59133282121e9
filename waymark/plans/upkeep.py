"""The maintenance sweep over the managed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.functions.columns import qualify
from waymark.functions.times import cutoff
from waymark.operators.maintenance import compaction_plan, expiry_plan, orphan_files
from waymark.sources.lake import Lake
from waymark.sources.readers import list_files, with_partition

RESULT_DDL = "table_id string, operation string, status string, message string"


@dataclass(frozen=True)
class Upkeep:
    expire: Sequence[str] = S.MANAGED_TABLES
    orphans: Sequence[str] | None = None  # None: the same tables as ``expire``
    compact: Sequence[str] = ()
    expire_days: int = S.EXPIRE_DAYS
    orphan_days: int = S.ORPHAN_DAYS
    retain_last: int = S.RETAIN_LAST
    delete_orphans: bool = False
    continue_on_error: bool = False
    compact_where: Column | None = None
    partition_column: str = "as_of_date"


def maintain(lake: Lake, plan: Upkeep = Upkeep(), as_of: datetime | None = None) -> DataFrame:
    """Expire snapshots, remove orphan files and compact; one result row per table and step.

    A failure stops the sweep unless ``continue_on_error``; then it still ends with
    an error once every table had its turn.
    """
    now = (as_of or datetime.now(UTC)).replace(tzinfo=None)
    results: list[tuple[str, str, str, str]] = []

    def run(table: str, operation: str, work: Callable[[str], str]) -> None:
        name = qualify(table)
        if not lake.exists(name):
            results.append((name, operation, "skipped", "table_missing"))
            return
        try:
            status, _, message = work(name).partition(":")
            results.append((name, operation, status, message))
        except Exception as problem:
            results.append((name, operation, "failed", str(problem)))
            if not plan.continue_on_error:
                raise

    def expire(name: str) -> str:
        history = lake.history()
        doomed = expiry_plan(history.where(F.col("table_id") == name), cutoff(now, plan.expire_days), plan.retain_last)
        n = doomed.count()
        if n:
            lake.rewrite_history(history.join(doomed.select("snapshot_id"), "snapshot_id", "left_anti"))
        return f"ok:{n} snapshots expired"

    def orphans(name: str) -> str:
        live = lake.live_files().where(F.col("table_id") == name)
        listing = list_files(lake.spark, lake.path(name))
        if live.isEmpty():
            return "skipped:no recorded files"
        # Files of a write that died before its commit, or of a writer beside the log, look like orphans.
        written = listing.agg(F.max("modified")).first()[0]
        if lake.recorded_at(name) is None or written > lake.recorded_at(name):
            return "skipped:files are newer than the last commit"
        found = orphan_files(listing, live, cutoff(now, plan.orphan_days))
        if plan.delete_orphans:
            return f"ok:{lake.remove_files(found)} files removed"
        return f"ok:{found.count()} files found (dry run)"

    def compact(name: str) -> str:
        if plan.partition_column not in lake.read(name).columns:
            return f"skipped:no {plan.partition_column} column"
        files = with_partition(list_files(lake.spark, lake.path(name)), lake.path(name))
        value = F.regexp_extract("partition", rf"{plan.partition_column}=([^/]*)/", 1)
        where = plan.compact_where
        if where is None:
            where = F.col(plan.partition_column) >= F.lit(cutoff(now, S.COMPACT_DAYS).date())
        files = files.withColumn(plan.partition_column, value.try_cast("date"))
        wanted = compaction_plan(files, where).select(value.try_cast("date").alias(plan.partition_column), "target_files")
        n = wanted.count()
        if n:
            lake.rewrite_partitions(name, wanted, plan.partition_column, "maintenance")
        return f"ok:{n} partitions rewritten"

    orphan_tables = plan.expire if plan.orphans is None else plan.orphans
    for table in plan.expire:
        run(table, "expire_snapshots", expire)
        if table in orphan_tables:
            run(table, "remove_orphan_files", orphans)
    for table in orphan_tables:
        if table not in plan.expire:
            run(table, "remove_orphan_files", orphans)
    for table in plan.compact:
        run(table, "rewrite_data_files", compact)
    failed = [r for r in results if r[2] == "failed"]
    if failed:
        raise RuntimeError(f"maintenance failed: {failed}")
    return lake.spark.createDataFrame(results, RESULT_DDL)
