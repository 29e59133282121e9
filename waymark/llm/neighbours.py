"""Comparing each row of a sorted frame with the next ones, over any number of tasks.

Rows are ``key binary, id long, at long, extra binary``, range partitioned and sorted by all of
``key, id, at``: similar keys become neighbours however many rows share them, because a long run of
equal keys is cut between tasks by ``id`` and ``at``. Each task also hands out its first and last rows;
sorted among themselves once more, they give the pairs that straddle two tasks (a few rows per task).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.session import Scratch

ROW = ["key", "id", "at", "extra"]
FOUND = ["p", "q", "r"]


def _stretches(batches: Iterator[pd.DataFrame], reach: int) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Consecutive rows of a task, overlapping by ``reach``; True marks rows at either end."""
    tail, first = None, True
    for b in batches:
        if not len(b):
            continue
        rows = b if tail is None else pd.concat([tail, b], ignore_index=True)
        if first:
            yield b.head(reach), True
            first = False
        yield rows, False
        tail = rows.tail(reach)
    if tail is not None:
        yield tail, True


def compare_neighbours(rows: DataFrame, reach: int, compare: Callable[[pd.DataFrame], pd.DataFrame], scratch: Scratch, name: str) -> DataFrame:
    """``p, q, r`` (three longs) from ``compare(stretch)``, which pairs rows at most ``reach`` places apart.

    A pair may be reported twice.
    """
    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, edge in _stretches(batches, reach):
            if edge:
                yield part[ROW].assign(p=0, q=0, r=0, edge=True)
            else:
                yield compare(part).assign(key=None, id=0, at=0, extra=None, edge=False)

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, edge in _stretches(batches, reach):
            if not edge:
                yield compare(part)

    order = ["key", "id", "at"]
    ordered = rows.select(*ROW).repartitionByRange(*order).sortWithinPartitions(*order)
    found = scratch.keep(ordered.mapInPandas(within, "key binary, id long, at long, extra binary, p long, q long, r long, edge boolean"), name)
    edges = found.where("edge").select(*ROW).distinct().coalesce(1).sortWithinPartitions(*order)
    return found.where(~F.col("edge")).select(*FOUND).unionByName(edges.mapInPandas(across, "p long, q long, r long"))
