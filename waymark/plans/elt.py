"""Bronze, silver and gold in one run."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waymark.plans.bronze import ingest
from waymark.plans.gold import build_gold
from waymark.plans.silver import build_silver
from waymark.sources.lake import Lake


def run_elt(lake: Lake, trips: DataFrame, zones: DataFrame, run_id: str, trips_uri: str = "trips",
            zones_uri: str = "zones") -> dict:
    bronze = ingest(lake, trips, zones, run_id=run_id, trips_uri=trips_uri, zones_uri=zones_uri)
    silver = build_silver(lake, run_id)
    return {"bronze": bronze, "silver": silver, "gold": build_gold(lake, run_id)}
