"""Near-duplicate groups by an LSH forest: sorted signature orders, neighbours by longest common prefix.

1. Every text becomes its set of word shingles (64-bit hashes), an exact fingerprint of that set and
   ``TREES`` label sequences of ``DEPTH`` minhashes each. Texts with equal sets are one class from here on.
2. Each tree sorts the classes by its labels. A class meets the next ``REACH`` ones while the common prefix
   holds at least ``ROOT`` labels: in a sparse region that is everything under the root prefix, in a dense one
   only those that agree at a greater depth - the depth follows the region.
3. Pairs are confirmed on the full sets of whole texts. The nearest neighbours of a few trees go first; pairs
   whose classes are already connected need no confirmation afterwards.
4. Dense regions that still hold several components are compared completely: blocks of the region against each
   other, spread over tasks; pairs of different components whose signatures leave the threshold possible are
   confirmed there.

A pair at 80 % similarity shares a root prefix in one of the trees with probability 1 - (1 - 0.8**5)**25 =
0.99995, higher similarities more. Components come from grouped minima, nothing is gathered on the driver.

Nulls, empties and ties: a text without words (or NULL) has an empty set and is linked with nothing. Rows with
the same ``doc_id`` are one document: what any of them links, all do. A row without ``doc_id`` stays alone, its
component is NULL and it is kept. An empty table gives an empty table; other columns are ignored by
:func:`group_documents` and passed through by :func:`drop_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.components import components
from waymark.llm.hashing import WordHashes, lowered_words, shingle_set
from waymark.llm.neighbours import compare_neighbours
from waymark.llm.text import bound_batches
from waymark.session import Scratch

HASHES, TREES, DEPTH, ROOT, REACH = 128, 25, 12, 5, 4
FIRST_TREES = 4
BLOCK = 256
MARGIN = 0.2  # five standard deviations of a similarity estimated from 125 minhashes
_rng = np.random.default_rng(7)
_A = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
# The labels of tree t: its own first ROOT hashes, so that root prefixes are independent, then others.
_PICK = np.array([[(t * ROOT + j) % HASHES for j in range(DEPTH)] for t in range(TREES)])


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(least, ((x[at:at + 2048, None] ^ _B) * _A).min(0), out=least)
    return least


def forest(shingles: np.ndarray) -> bytes:
    """``TREES`` label sequences, two bytes a label, big-endian so that bytes sort as labels do."""
    low = signature(shingles)
    low = ((low ^ (low >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)
    return low[_PICK].astype(">u2").tobytes()


def sketches(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, forest`` of every row."""
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            out = []
            for text in b["text"]:
                s = shingle_set(hashes.of(lowered_words(text)), shingle_words)
                out.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), forest(s)) if len(s) else (0, None, None))
            yield pd.DataFrame(out, columns=["n_shingles", "set_key", "forest"]).assign(doc_id=b["doc_id"].to_numpy())

    return docs.mapInPandas(sketch, "n_shingles long, set_key binary, forest binary, doc_id long")


def prefix_neighbours(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs ``p < q`` at most ``REACH`` places apart under a common root prefix; ``r`` is 1 for pairs to confirm first."""
    keys = np.frombuffer(b"".join(rows["key"]), np.uint8).reshape(len(rows), -1) if len(rows) else np.zeros((0, 1 + 2 * DEPTH), np.uint8)
    ids, root, found = rows["id"].to_numpy(), 1 + 2 * ROOT, []
    for step in range(1, min(REACH, len(rows) - 1) + 1):
        at = np.flatnonzero((keys[:-step, :root] == keys[step:, :root]).all(1))
        a, b = ids[at], ids[at + step]
        found.append(pd.DataFrame({"p": np.minimum(a, b), "q": np.maximum(a, b), "r": ((step == 1) & (keys[at, 0] < FIRST_TREES)).astype(np.int64)}))
    out = pd.concat(found) if found else pd.DataFrame({"p": [], "q": [], "r": []}, dtype=np.int64)
    return out[out["p"] < out["q"]]


def confirm(pairs: DataFrame, docs: DataFrame, shingle_words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full shingle sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = scratch.keep(docs.join(scratch.keep(ids, "ids"), "doc_id", "left_semi"), "texts")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, last, mine = WordHashes(), None, None
        for batch in batches:
            keep = []
            for a, ta, tb in zip(batch["a"], batch["ta"], batch["tb"], strict=True):
                if last != (a, ta):
                    last, mine = (a, ta), shingle_set(hashes.of(lowered_words(ta)), shingle_words)
                other = shingle_set(hashes.of(lowered_words(tb)), shingle_words)
                common = len(np.intersect1d(mine, other, assume_unique=True))
                union = len(mine) + len(other) - common
                keep.append(union > 0 and 100 * common >= percent * union)
            yield batch.loc[keep, ["a", "b"]]

    left, right = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
    return pairs.select("a", "b").join(right, "b").join(left, "a").mapInPandas(check, "a long, b long")


def linked_in_blocks(members: pd.DataFrame, shingle_words: int, percent: int) -> pd.DataFrame:
    """Links between components found in one pair of blocks of a region, confirmed on the full sets.

    A pair is looked at in the first tree that brings its ends together, only if the signatures leave the threshold
    possible, and only while the links found so far do not connect its ends.
    """
    labels = np.frombuffer(b"".join(members["forest"]), ">u2").reshape(len(members), TREES, DEPTH)[:, :, :ROOT]
    ids, side, tree = members["id"].to_numpy(), members["block"].to_numpy(), members["region"].iloc[0][0]
    group = members["component"].to_numpy().copy()
    one_block = members["low"].iloc[0] == members["high"].iloc[0]
    texts, hashes, sets, found = members["text"].tolist(), WordHashes(), {}, []

    def shingles(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(hashes.of(lowered_words(texts[i])), shingle_words)
        return sets[i]

    for i in range(len(members) - 1):
        same = labels[i + 1:] == labels[i]
        near = same.mean((1, 2)) >= percent / 100 - MARGIN
        near &= same.all(2).argmax(1) == tree
        if not one_block:
            near &= side[i + 1:] != side[i]
        for j in i + 1 + np.flatnonzero(near):
            if group[i] == group[j]:
                continue
            x, y = shingles(i), shingles(j)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= percent * (len(x) + len(y) - common):
                found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                group[group == group[j]] = group[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def open_region_links(keys: DataFrame, labels: DataFrame, docs: DataFrame, shingle_words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links across components inside dense regions that the neighbours have not joined."""
    part = keys.join(labels, keys["id"] == labels["node"], "left").select("id", "region", "forest", F.coalesce("component", "id").alias("component"))
    part = scratch.keep(part, "members")
    open_regions = part.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y")).where(f"n > {REACH + 1} and x <> y")
    open_regions = scratch.keep(open_regions.select("region", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "regions")
    members = scratch.keep(part.join(open_regions, "region"), "open")
    texts = docs.join(scratch.keep(members.select(F.col("id").alias("doc_id")).distinct(), "ids"), "doc_id", "left_semi")
    texts = scratch.keep(texts.select(F.col("doc_id").alias("id"), "text"), "texts")
    placed = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("id", "component", "forest", "region", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return placed.join(texts, "id").groupBy("region", "low", "high").applyInPandas(lambda m: linked_in_blocks(m, shingle_words, percent), "a long, b long").distinct()


def group_documents(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bound_batches(docs.sparkSession)
    with Scratch(docs.sparkSession, "forest") as scratch:
        own = scratch.keep(sketches(docs, shingle_words), "sketches")
        classes = own.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.first("forest").alias("forest"))
        classes = scratch.keep(classes, "classes")
        keys = classes.select(F.col("first_id").alias("id"), "forest", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).withColumn(
            "key", F.concat(F.unhex(F.lpad(F.hex("tree"), 2, "0")), F.expr(f"substring(forest, tree * {2 * DEPTH} + 1, {2 * DEPTH})")))
        sorted_rows = keys.select("key", "id", F.lit(0).cast("long").alias("at"), F.lit(None).cast("binary").alias("extra"))
        pairs = compare_neighbours(sorted_rows, REACH, prefix_neighbours, scratch, "neighbours")
        pairs = scratch.keep(pairs.groupBy(F.col("p").alias("a"), F.col("q").alias("b")).agg(F.max("r").alias("first")), "pairs")
        links = scratch.keep(confirm(pairs.where("first = 1"), docs, shingle_words, percent, scratch), "links")
        labels = components(links, scratch)
        rest = across_components(pairs.where("first = 0"), labels)
        links = links.unionByName(scratch.keep(confirm(rest, docs, shingle_words, percent, scratch), "links"))
        labels = components(links, scratch)
        regions = keys.select("id", "forest", F.substring("key", 1, 1 + 2 * ROOT).alias("region"))
        dense = regions.groupBy("region").count().where(f"count > {REACH + 1}").select("region")
        dense = scratch.keep(dense, "dense")
        if not dense.isEmpty():
            more = scratch.keep(open_region_links(regions.join(dense, "region", "left_semi"), labels, docs, shingle_words, percent, scratch), "links")
            if not more.isEmpty():
                links = links.unionByName(more)
                labels = components(links, scratch)
        # Rows of one doc_id may lie in several classes; the smallest label of any of them holds for all.
        placed = own.select("doc_id", "n_shingles", "set_key").join(classes.select("set_key", "first_id"), "set_key", "left")
        placed = placed.join(labels, placed["first_id"] == labels["node"], "left")
        placed = placed.select("doc_id", "n_shingles", F.coalesce("component", "first_id", "doc_id").alias("component_id"))
        return scratch.result(placed.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def across_components(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not connected yet."""
    a, b = (labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def drop_copies(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns; of rows that share a ``doc_id`` all stay or go."""
    with Scratch(docs.sparkSession, "forest-keep") as scratch:
        gone = scratch.result(group_documents(docs, shingle_words, percent).where("not kept").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
