"""Near-duplicates by SimHash: fingerprints compared tile by tile, exactly.

A fingerprint has 64 bits; bit ``k`` is 1 if more than half of the text's shingle hashes have it set. The distinct
fingerprints are sorted by their population counts - of the whole, then of halves, quarters and eighths - and cut
into tiles of consecutive ones. Two fingerprints that differ in ``r`` bits differ by at most ``r`` in the counts of
any set of disjoint parts, added up. So a pair of tiles is skipped when the ranges of its counts are further apart than the
radius at any level; inside a pair the same test skips small blocks, and what is left is compared by exclusive-or and
bit counts. No pair within the radius is lost, whatever the data look like.

Sizes: a tile holds ``TILE`` fingerprints, more only where the table would otherwise have over ``MAX_TILES`` tiles, so
the ranges of all tiles (30 bytes each) are a bounded broadcast. A tile is one packed row, sent once to every tile it
has to meet. Of the links inside a pair of tiles only a spanning forest leaves the task, so a dense group costs
rows in proportion to its members. Equal fingerprints are one row from the start.

Nulls and empties: a text without words (or NULL) has fingerprint zero and is linked like any other. Rows that share
a ``doc_id`` keep their own rows. A row without ``doc_id`` joins its group but cannot name it; a group without any id
has a NULL ``component_id``. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.components import components
from waymark.llm.text import bound_batches
from waymark.session import Scratch

RADIUS = 3
SHINGLE = 3
SEED = 42
TILE = 1 << 14
MAX_TILES = 1 << 15
BLOCK = 256
#: The parts whose bits are counted: the whole, halves, quarters, eighths; (first bit, bits).
PARTS = [(at, size) for size in (64, 32, 16, 8) for at in range(0, 64, size)]
MASKS = np.array([((1 << size) - 1) << at for at, size in PARTS], np.uint64)
LEVELS = [slice(0, 1), slice(1, 3), slice(3, 7), slice(7, 15)]
#: Parts that fix all the others, from coarse to fine.
ORDER = [0, 1, 3, 5, 7, 9, 11, 13]
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = 256 * np.arange(8)


def shingle_hashes(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """XXH64 of every ``k``-word shingle, repeats included; fewer words are one shingle, none are none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(k, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, len(words) - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority of each bit, as an unsigned number."""
    seen = np.bincount((hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _COLUMN).ravel(), minlength=2048).reshape(8, 256)
    majority = 2 * (seen @ _BITS).ravel() > len(hashes)
    return int.from_bytes(np.packbits(majority, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (a signed long) of every row."""
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            marks = np.array([fingerprint(shingle_hashes(t)) for t in b["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fingerprint": marks.view(np.int64)})

    return docs.select("doc_id", "text").mapInPandas(hashed, "doc_id long, fingerprint long")


def sort_key(mark: Column) -> Column:
    """The population counts that order the tiles, packed from coarse to fine."""
    key = F.lit(0).cast("long")
    for part in ORDER:
        at, size = PARTS[part]
        mask = ((1 << size) - 1) << at
        bits = F.bit_count(mark.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")))
        key = F.shiftleft(key, size.bit_length()) + bits
    return key


def part_counts(marks: np.ndarray) -> np.ndarray:
    """Population counts of all parts, one row per fingerprint."""
    return np.bitwise_count(marks[:, None] & MASKS)


def boxes(marks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest counts of each stretch of ``size`` fingerprints."""
    counts, at = part_counts(marks), np.arange(0, len(marks), size)
    return np.minimum.reduceat(counts, at).astype(np.int16), np.maximum.reduceat(counts, at).astype(np.int16)


def may_meet(low: np.ndarray, high: np.ndarray, others_low: np.ndarray, others_high: np.ndarray, radius: int) -> np.ndarray:
    """Which of the other ranges of counts are not further away than the radius at any level."""
    gap = np.maximum(np.maximum(others_low - high, low - others_high), 0)
    return np.logical_and.reduce([gap[:, level].sum(1) <= radius for level in LEVELS])


def roots(p: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the links ``p - q``."""
    label = np.arange(n)
    while len(p):
        a, b = label[p], label[q]
        open_ = a != b
        p, q, a, b = p[open_], q[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def tile_links(ours: np.ndarray, theirs: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, or inside one; both as ``(fingerprint, root)``."""
    every = ours if theirs is None else np.concatenate([ours, theirs])
    other, shift = (ours, 0) if theirs is None else (theirs, len(ours))
    low, high = boxes(ours, BLOCK)
    other_low, other_high = boxes(other, BLOCK)
    label = np.arange(len(every))
    for i in range(len(low)):
        near = np.flatnonzero(may_meet(low[i], high[i], other_low, other_high, radius))
        if theirs is None:
            near = near[near >= i]
        mine, found = ours[i * BLOCK:(i + 1) * BLOCK, None], []
        for j in near.tolist():
            x, y = np.nonzero(np.bitwise_count(mine ^ other[j * BLOCK:(j + 1) * BLOCK]) <= radius)
            x, y = x + i * BLOCK, y + (j * BLOCK + shift)
            found.append((x[x != y], y[x != y]))
        if found:  # one block row at a time, so the links kept stay few
            x, y = map(np.concatenate, zip(*found, strict=True))
            label = roots(label[x], label[y], len(every))[label]
    moved = np.flatnonzero(label != np.arange(len(every)))
    return every[moved], every[label[moved]]


def tiles(marks: DataFrame, size: int) -> DataFrame:
    """``tile, low, high, data``: consecutive fingerprints of the sorted table, packed."""
    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, serial = np.zeros(0, np.uint64), 0
        part = None
        for b in batches:
            if not len(b):
                continue
            part = int(b["part"].iloc[0])
            held = np.concatenate([held, b["fingerprint"].to_numpy(np.int64).view(np.uint64)])
            while len(held) >= size:
                yield tile(part, serial, held[:size])
                held, serial = held[size:], serial + 1
        if len(held):
            yield tile(part, serial, held)

    def tile(part: int, serial: int, some: np.ndarray) -> pd.DataFrame:
        low, high = boxes(some, len(some))
        return pd.DataFrame({"tile": [part << 32 | serial], "low": [low.astype(np.uint8).tobytes()], "high": [high.astype(np.uint8).tobytes()], "data": [some.tobytes()]})

    ordered = marks.select("fingerprint", sort_key(F.col("fingerprint")).alias("counts")).repartitionByRange("counts", "fingerprint")
    ordered = ordered.sortWithinPartitions("counts", "fingerprint").select("fingerprint", F.spark_partition_id().alias("part"))
    return ordered.mapInPandas(packed, "tile long, low binary, high binary, data binary")


def links(marks: DataFrame, radius: int, scratch: Scratch, tile_size: int = TILE) -> DataFrame:
    """``a, b``: links that connect all distinct ``marks(fingerprint)`` within the radius, a forest per pair of tiles."""
    spark = marks.sparkSession
    size = max(tile_size, -(-marks.count() // MAX_TILES))
    stored = scratch.keep(tiles(marks, size), "tiles")
    ranges = stored.select("tile", "low", "high").orderBy("tile").collect()  # MAX_TILES and one a partition at most
    names = np.array([r["tile"] for r in ranges], np.int64)
    low, high = (np.frombuffer(b"".join(r[x] for r in ranges), np.uint8).reshape(-1, len(PARTS)).astype(np.int16) for x in ("low", "high"))

    def meetings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in b["id"].tolist():
                other = i + np.flatnonzero(may_meet(low[i], high[i], low[i:], high[i:], radius))
                yield pd.DataFrame({"tile": names[i], "other": names[other]})

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for tile, other, data, more in zip(b["tile"], b["other"], b["data"], b["more"], strict=True):
                ours = np.frombuffer(data, np.uint64)
                p, q = tile_links(ours, None if tile == other else np.frombuffer(more, np.uint64), radius)
                yield pd.DataFrame({"a": p.view(np.int64), "b": q.view(np.int64)})

    pairs = spark.range(len(names), numPartitions=max(1, min(len(names), 4 * spark.sparkContext.defaultParallelism)))
    pairs = scratch.keep(pairs.mapInPandas(meetings, "tile long, other long"), "meetings")
    other = stored.select(F.col("tile").alias("other"), F.col("data").alias("more"))
    met = pairs.join(stored.select("tile", "data"), "tile").join(other, "other")
    return met.select("tile", "other", "data", F.when(F.col("tile") != F.col("other"), F.col("more")).alias("more")).mapInPandas(compared, "a long, b long")


def group_documents(docs: DataFrame, radius: int = RADIUS, tile_size: int = TILE) -> DataFrame:
    """``doc_id, fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bound_batches(docs.sparkSession)
    with Scratch(docs.sparkSession, "simhash") as scratch:
        own = scratch.keep(fingerprints(docs), "fingerprints")
        marks = scratch.keep(own.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "marks")
        found = scratch.keep(links(marks.select("fingerprint"), radius, scratch, tile_size), "links")
        labels = components(found, scratch)
        placed = marks.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        placed = placed.select("fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("root"))
        least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
        placed = placed.join(least, "root").select("fingerprint", "component_id")
        return scratch.result(own.join(placed, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"))
