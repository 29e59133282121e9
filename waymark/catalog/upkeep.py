"""Maintenance plans and the sweep."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from waymark import settings as S
from waymark.catalog import fixtures as X
from waymark.catalog.elt import _elt_sources
from waymark.catalog.registry import query
from waymark.operators.maintenance import compaction_plan, expiry_plan, orphan_files
from waymark.plans.elt import run_elt
from waymark.plans.upkeep import Upkeep, maintain
from waymark.session import scratch_dir
from waymark.sources.lake import Lake


@query("snapshot_expiry_plan", f"""
SELECT table_id, snapshot_id, made_current_at FROM (SELECT *, row_number() OVER (
  PARTITION BY table_id ORDER BY made_current_at DESC, snapshot_id DESC) AS place FROM ({X.HISTORY}) h)
WHERE place > 2 AND made_current_at < TIMESTAMP '2000-06-01' AND NOT is_current""")
def snapshot_expiry_plan(spark, sf):
    plan = expiry_plan(X.history(spark, sf), "2000-06-01 00:00:00")
    return plan.select("table_id", "snapshot_id", "made_current_at")


@query("orphan_files", f"""
SELECT path FROM ({X.FILES}) f WHERE modified < TIMESTAMP '2000-01-01'
  AND path NOT IN (SELECT path FROM ({X.FILES}) g WHERE status = 'F')""")
def orphans(spark, sf):
    """Files the live list does not name; the list spells paths with another scheme."""
    listing = X.files(spark, sf)
    live = listing.where(F.col("status") == "F").select(F.replace("path", F.lit("s3://bucket"), F.lit("s3a://other")).alias("path"))
    return orphan_files(listing, live, "2000-01-01 00:00:00").select("path")


@query("compaction_plan", f"""
SELECT partition, count(*) AS n_files, cast(sum(bytes) AS bigint) AS total_bytes,
  greatest(1, cast(ceil(sum(bytes) / {S.TARGET_FILE_BYTES}::double) AS bigint)) AS target_files
FROM ({X.FILES}) f WHERE as_of_date >= DATE '1999-01-01' GROUP BY 1 HAVING count(*) >= 2
  AND count(*) > greatest(1, ceil(sum(bytes) / {S.TARGET_FILE_BYTES}::double))""")
def compaction(spark, sf):
    return compaction_plan(X.files(spark, sf), F.col("as_of_date") >= F.lit("1999-01-01").cast("date"))


@query("maintenance_sweep", """
SELECT * FROM (VALUES ('lake.bronze.trips_raw', 'expire_snapshots', 'ok'), ('lake.bronze.trips_raw', 'remove_orphan_files', 'ok'),
  ('lake.gold.trip_training_matrix', 'expire_snapshots', 'ok'), ('lake.gold.trip_training_matrix', 'remove_orphan_files', 'ok'),
  ('lake.gold.absent', 'remove_orphan_files', 'skipped'), ('lake.gold.trip_training_matrix', 'rewrite_data_files', 'ok'),
  ('lake.bronze.trips_raw', 'rewrite_data_files', 'skipped')) t(table_id, operation, status)""")
def maintenance_sweep(spark, sf):
    """Build the tables from all events, then run every maintenance step over them."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    run_elt(lake, *_elt_sources(spark, sf), "run-1", "events")
    plan = Upkeep(expire=(S.BRONZE_TRIPS, S.GOLD_MATRIX), orphans=(S.BRONZE_TRIPS, S.GOLD_MATRIX, "gold.absent"),
                  compact=(S.GOLD_MATRIX, S.BRONZE_TRIPS), compact_where=F.col("as_of_date").isNotNull())
    return maintain(lake, plan, datetime(2030, 1, 1)).select("table_id", "operation", "status")
