"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact confirmation.

Words are lower-cased with ASCII punctuation removed. Every item gets the largest window size ``c`` of ``SIZES``
that, with windows ``c / 2`` words apart, fits completely into a passage of the item's length at any offset, also
between and beside as many changed words as the threshold allows, at the ends too. All windows of the item of that size have a 64-bit SimHash over their two-word features; documents are covered by
windows of each size, ``c / 2`` apart. A leaked passage therefore contains a document
window that stands opposite an item window, with the same fingerprint if the words are the same.

Fingerprints are compared through four 16-bit blocks: of two fingerprints at distance 7 or less one block differs
in at most one bit, and the index holds every block value of an item with its 16 one-bit neighbours. So all
fingerprints within ``RADIUS`` are found, none is missed. Each candidate places the whole item over the document;
the Jaccard similarity of the five-word shingles there, plain or weighted, must reach ``least``. A shingle counts as
often as it occurs; its weight is one over the number of different texts of the whole benchmark that hold it, so
neither equal items nor the slices below change a verdict.

Items shorter than the smallest window are compared as one window of their own length.

The benchmark is read in slices of at most ``SLICE_ITEMS`` items and ``SLICE_CHARS`` characters, so what a task
holds is bounded; a larger benchmark takes more passes over the documents.

Nulls and empties: texts without words hold nothing and are found in nothing. Equal items are all reported. Rows
that share a ``doc_id`` are reported under it with the best similarity. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.hashing import WordHashes, finish, runs
from waymark.llm.text import bound_batches
from waymark.session import Scratch

SIZES = (4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512)
RADIUS = 7
SHINGLE = 5
SEGMENT = 32_768  # window starts whose sums are held at a time
LEAST = 0.8
GROUP_CHARS = 200_000
SLICE_ITEMS, SLICE_CHARS = 20_000, 20_000_000
_DROP = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_BITS = np.array([0] + [1 << i for i in range(16)], np.uint16)


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(None, _DROP).split()


def window_size(words: int) -> int:
    """The window for items of so many words; shorter items are their own window.

    A similarity of 0.8 allows a ninth of the shingles to be lost: five for a changed word inside, one for each word lost
    at the ends. For every number of changes inside, with what is left spent at the ends, the longest unchanged stretch
    must still hold a window at any offset.
    """
    lost = max(words - SHINGLE + 1, 0) // 9
    stretch = min((words - k - (lost - SHINGLE * k)) // (k + 1) for k in range(lost // SHINGLE + 1))
    return max([c for c in SIZES if c + c // 2 - 1 <= stretch], default=words)


def window_step(size: int) -> int:
    return size // 2 if size in SIZES else 1


def bit_sums(words: np.ndarray) -> np.ndarray:
    """Running sums of the 64 bits of the two-word features (of single words in a one-word text).

    Only differences over a window are used, so the sums may wrap around.
    """
    features = runs(words, min(2, len(words)))
    bits = np.unpackbits(features.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    upto = np.zeros((len(features) + 1, 64), np.int16)
    np.cumsum(bits, axis=0, dtype=np.int16, out=upto[1:])
    return upto


def fingerprints(upto: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """SimHash of the windows that begin at ``starts``: per bit, the majority over the features."""
    n = max(size - 1, 1)
    return np.packbits(upto[starts + n] - upto[starts] > n // 2, axis=1).view("<u8").ravel()


class Index:
    """The fingerprints of one slice of items, by window size and block."""

    def __init__(self, items: list[tuple[int, str]], held: dict[int, int] | None = None):
        self.hashes = WordHashes()
        self.words = [self.hashes.of(plain_words(t)) for _, t in items]
        self.ids = [i for i, _ in items]
        self.shingles = [Counter(runs(w, min(SHINGLE, len(w))).tolist()) if len(w) else Counter() for w in self.words]
        self.held = held or {}
        by_size = defaultdict(list)
        for k, w in enumerate(self.words):
            if len(w):
                by_size[window_size(len(w))].append(k)
        self.sizes = {size: self._blocks(size, ks) for size, ks in by_size.items()}

    def _blocks(self, size: int, ks: list[int]):
        marks, owner, offset = [], [], []
        for k in ks:
            starts = np.arange(len(self.words[k]) - size + 1)
            marks.append(fingerprints(bit_sums(self.words[k]), size, starts) if size > 1 else runs(self.words[k], 1))
            owner.append(np.full(len(starts), k))
            offset.append(starts)
        marks, owner, offset = map(np.concatenate, (marks, owner, offset))
        tables = []
        for block in marks.view("<u2").reshape(-1, 4).T:
            near = (block[:, None] ^ _BITS).ravel()
            order = np.argsort(near, kind="stable")
            tables.append((np.searchsorted(near[order], np.arange(65537)), order // len(_BITS)))
        return marks, owner, offset, tables

    def candidates(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(item, start, window)``: a whole item may lie at ``start``, says the window at ``window``."""
        reach = max(self.sizes, default=0)
        for at in range(0, len(words), SEGMENT):
            part = words[at:at + SEGMENT + reach]
            upto = bit_sums(part)
            for size, (marks, owner, offset, tables) in self.sizes.items():
                step = window_step(size)
                starts = np.arange(-(-at // step) * step, min(len(words) - size + 1, at + SEGMENT), step)
                if not len(starts):
                    continue
                mine = fingerprints(upto, size, starts - at) if size > 1 else runs(part, 1)[starts - at]
                for block, (ends, entries) in zip(mine.view("<u2").reshape(-1, 4).T, tables, strict=True):
                    low, n = ends[block], ends[block.astype(np.int64) + 1] - ends[block]
                    window = np.repeat(np.arange(len(mine)), n)
                    hit = entries[np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
                    near = np.bitwise_count(mine[window] ^ marks[hit]) <= RADIUS
                    found = hit[near], starts[window[near]]
                    yield from zip(owner[found[0]].tolist(), (found[1] - offset[found[0]]).tolist(), found[1].tolist(), strict=True)

    def similarity(self, item: int, there: Counter) -> float:
        """The larger one of the plain and the weighted Jaccard similarity."""
        mine = self.shingles[item]
        least = most = plain_least = plain_most = 0.0
        for s in mine.keys() | there.keys():
            weight = 1 / self.held.get(s, 1)
            low, high = min(mine[s], there[s]), max(mine[s], there[s])
            least, most = least + weight * low, most + weight * high
            plain_least, plain_most = plain_least + low, plain_most + high
        return max(least / most, plain_least / plain_most) if most else 0.0

    def found_in(self, texts: list[str | None], least: float) -> Iterator[tuple[int, int, int, int, float]]:
        """``(text, item_id, start, n_words, similarity)``: the best place of every item that a text holds.

        Texts lie end to end for the windows; what a window across two texts suggests does not survive the
        confirmation, which stays inside one text.
        """
        words = [self.hashes.of(plain_words(t)) for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        best: dict = {}
        places = {(int(np.searchsorted(bounds, window, "right")) - 1, item, start) for item, start, window in self.candidates(np.concatenate(words))}
        for text, item, start in sorted(places):
            n, start = len(self.words[item]), start - int(bounds[text])
            low, high = max(start, 0), min(start + n, len(words[text]))
            score = self.similarity(item, Counter(runs(words[text][low:high], min(SHINGLE, n)).tolist()))
            if score >= least and score > best.get((text, item), (0, 0, 0.0))[2]:
                best[text, item] = (low, high - low, score)
        return ((text, self.ids[item], *found) for (text, item), found in best.items())


def grouped(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts of about ``GROUP_CHARS`` characters with the place of the first."""
    first, chars = 0, 0
    for k, t in enumerate(texts):
        chars += len(t or "")
        if chars >= GROUP_CHARS or k + 1 == len(texts):
            yield first, texts[first:k + 1]
            first, chars = k + 1, 0


def item_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The different shingles of each item and a name of its words."""
    hashes = WordHashes()
    for b in batches:
        for text in b["text"]:
            words = hashes.of(plain_words(text))
            if len(words):
                shingles = np.unique(runs(words, min(SHINGLE, len(words)))).view(np.int64)
                yield pd.DataFrame({"shingle": shingles, "words": xxhash.xxh3_64_intdigest(words.tobytes()) - (1 << 63)})


def slices(benchmark: DataFrame, scratch: Scratch) -> Iterator[tuple[list[tuple[int, str]], dict[int, int]]]:
    """Items in bounded slices, in ``item_id`` order within even ranges of a hash, and how many texts of the whole
    benchmark hold their shingles, where it is more than one."""
    items = scratch.keep(benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null"), "items")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    named = scratch.keep(items.select("text").mapInPandas(item_shingles, "shingle long, words long").distinct(), "item-shingles")
    held = scratch.keep(named.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "held")
    n = 1 + max(2 * size["n"] // SLICE_ITEMS, 2 * (size["chars"] or 0) // SLICE_CHARS)
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        shared = held
        if n > 1:
            shared = held.join(part.select("text").mapInPandas(item_shingles, "shingle long, words long"), "shingle", "left_semi")
        found = shared.toArrow()
        counts = dict(zip(found["shingle"].to_numpy().view(np.uint64).tolist(), found["n"].to_pylist(), strict=True))
        yield sorted([(r["item_id"], r["text"]) for r in part.collect()], key=lambda r: (r[0] is None, r)), counts


def find_items(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id, item_id, start, n_words, similarity`` (places in words): the best place of each item in each document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bound_batches(docs.sparkSession)
    with Scratch(docs.sparkSession, "decontamination") as scratch:
        found = None
        for items, held in slices(benchmark, scratch):
            def search(batches: Iterator[pd.DataFrame], items=items, held=held) -> Iterator[pd.DataFrame]:
                index = Index(items, held)
                for b in batches:
                    ids, texts = b["doc_id"].tolist(), b["text"].tolist()
                    rows = [(ids[first + k], *hit) for first, some in grouped(texts) for k, *hit in index.found_in(some, least)]
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "n_words", "similarity"])

            hits = scratch.keep(docs.mapInPandas(search, "doc_id long, item_id long, start long, n_words long, similarity double"), "hits")
            found = hits if found is None else found.unionByName(hits)
        best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc("similarity"), "start")
        return scratch.result(found.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents, with all their columns, that hold no item. A document without ``doc_id`` is judged by its own text."""
    own = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    with Scratch(docs.sparkSession, "decontaminated") as scratch:
        gone = scratch.result(find_items(docs.select(own.alias("doc_id"), "text"), benchmark, least).select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, own == gone["_gone"], "left_anti").select(*docs.columns)
