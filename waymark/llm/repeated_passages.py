"""Passages of ``MIN_WORDS`` words or more that repeat across documents, by sparse suffix arrays.

1. Suffixes are kept at minimiser positions only: wherever the hash of a ``GRAM``-word run is the smallest among
   ``WINDOW`` consecutive ones. The choice depends on the words alone, so two copies of a passage keep the same places,
   and any passage of ``MIN_WORDS`` words holds a kept place within its first ``WINDOW`` words.
2. A suffix that can begin a match shares its first ``RIGHT`` = ``MIN_WORDS - WINDOW + 1`` words with another text; one
   grouped minimum and maximum per hash of these words finds those.
3. The suffixes whose ``RIGHT`` words occur at most ``REACH + 1`` times get their context - up to ``MIN_WORDS`` words to the right, which is their sort key, and
   ``WINDOW - 1`` to the left - and are sorted. Every suffix is compared with the next ``REACH`` ones, so with all of
   its key; the common prefix is the extension to the right, the common left context the one to the left. Together they
   must reach ``MIN_WORDS``. A longer passage is found piece by piece from its several kept places.
4. Where the ``RIGHT`` words occur more often, no pairs are formed: every ``MIN_WORDS`` window whose kept place is such a
   suffix is hashed, at most one window a word, and those that two classes hold are marked.
5. Overlapping pieces of a text are joined to maximal spans.

Texts with the same words are one class from the start: they repeat as a whole, and their suffixes enter once. Pairs are
only neighbours and windows are grouped by hash with one minimum and maximum, summed up before the shuffle, so the cost of
a passage in very many texts is linear. Words are split at ASCII white space with A-Z lowered; context words are compared
by 32-bit hashes of which at least 50 in a row must agree, windows by 64-bit hashes of their words.

Nulls and empties: a NULL text or one below ``MIN_WORDS`` words has no spans. Rows are documents of their own even when
they share a ``doc_id`` or have none. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.hashing import WordHashes, lowered_words, runs
from waymark.llm.neighbours import compare_neighbours
from waymark.llm.text import bound_batches
from waymark.session import Scratch

MIN_WORDS = 50
GRAM = 8
WINDOW = 24
RIGHT = MIN_WORDS - WINDOW + 1
REACH = 3


def text_class(words: np.ndarray) -> int:
    """A signed 64-bit name of a word sequence."""
    return xxhash.xxh3_64_intdigest(words.tobytes()) - (1 << 63)


def minimisers(words: np.ndarray) -> np.ndarray:
    """The minimiser position of each ``WINDOW`` consecutive places."""
    grams = runs(words, GRAM)
    if len(words) < MIN_WORDS:
        return np.zeros(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(1) + np.arange(len(grams) - WINDOW + 1)


def kept_places(words: np.ndarray) -> np.ndarray:
    """Minimiser positions that have ``RIGHT`` words to the right."""
    places = np.unique(minimisers(words))
    return places[places + RIGHT <= len(words)]


def windows_at(words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the ``MIN_WORDS`` windows whose minimiser is one of ``places``."""
    starts = np.flatnonzero(np.isin(minimisers(words)[:max(len(words) - MIN_WORDS + 1, 0)], places))
    return starts, runs(words, MIN_WORDS)[starts].view(np.int64)


def contexts(words: np.ndarray, places: np.ndarray, cls: int) -> tuple[list[bytes], list[bytes]]:
    """Right and left context of each place as 32-bit word hashes, big-endian; missing words are unique to the class."""
    short = (words >> np.uint64(32)).astype(np.uint32)
    n = len(short)

    def cut(offsets: np.ndarray) -> list[bytes]:
        at = places[:, None] + offsets
        inside = (at >= 0) & (at < n)
        own = (at.astype(np.uint32) * np.uint32(2654435761)) ^ np.uint32(cls & 0xFFFFFFFF)
        return [row.tobytes() for row in np.where(inside, short[np.clip(at, 0, n - 1)], own).astype(">u4")]

    return cut(np.arange(MIN_WORDS)), cut(-1 - np.arange(WINDOW - 1))


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows."""
    return np.cumprod(a == b, axis=1).sum(1)


def common_spans(rows: pd.DataFrame) -> pd.DataFrame:
    """``p`` (class), ``q`` and ``r`` (first word, end) of the matches between suffixes at most ``REACH`` places apart."""
    if not len(rows):
        return pd.DataFrame({"p": [], "q": [], "r": []}, dtype=np.int64)
    right = np.frombuffer(b"".join(rows["key"]), ">u4").reshape(len(rows), -1)
    left = np.frombuffer(b"".join(rows["extra"]), ">u4").reshape(len(rows), -1)
    ids, at, found = rows["id"].to_numpy(), rows["at"].to_numpy(), []
    for step in range(1, min(REACH, len(rows) - 1) + 1):
        a = np.flatnonzero((ids[:-step] != ids[step:]) & (right[:-step, 0] == right[step:, 0]))
        ahead, behind = agreeing(right[a], right[a + step]), agreeing(left[a], left[a + step])
        enough = ahead + behind >= MIN_WORDS
        for i in (a[enough], a[enough] + step):
            found.append(np.column_stack([ids[i], at[i] - behind[enough], at[i] + ahead[enough]]))
    return pd.DataFrame(np.concatenate(found) if found else np.zeros((0, 3), np.int64), columns=["p", "q", "r"])


def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Kept suffixes of the texts: hash of their first words, class and place; and one row per text with place -1."""
    hashes = WordHashes()
    for b in batches:
        for at in range(0, len(b), 200):
            keys, classes, places, ids, sizes = [], [], [], [], []
            for doc_id, text in zip(b["doc_id"].iloc[at:at + 200], b["text"].iloc[at:at + 200], strict=True):
                words = hashes.of(lowered_words(text))
                if len(words) < MIN_WORDS:
                    continue
                kept = kept_places(words)
                keys.append(np.append(runs(words, RIGHT)[kept].view(np.int64), 0))
                places.append(np.append(kept, -1))
                classes.append(np.full(len(kept) + 1, text_class(words)))
                ids += [doc_id]
                sizes += [len(words)]
            if keys:
                lengths = [len(k) for k in keys]
                yield pd.DataFrame({"key": np.concatenate(keys), "cls": np.concatenate(classes), "place": np.concatenate(places),
                                    "doc_id": np.repeat(np.array(ids, object), lengths), "n_words": np.repeat(sizes, lengths)})


def with_classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for b in batches:
        yield pd.DataFrame({"cls": [text_class(hashes.of(lowered_words(t))) for t in b["text"]], "text": b["text"]})


def placed_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for b in batches:
        for cls, text, places, often in zip(b["cls"], b["text"], b["places"], b["often"], strict=True):
            words = hashes.of(lowered_words(text))
            if text_class(words) != cls:  # another text under the same doc_id
                continue
            places = np.sort(np.asarray(places, np.int64))
            if len(places):
                right, left = contexts(words, places, cls)
                yield pd.DataFrame({"key": right, "id": cls, "at": places, "extra": left, "hash": None})
            if len(often):
                starts, marks = windows_at(words, np.asarray(often, np.int64))
                yield pd.DataFrame({"key": None, "id": cls, "at": starts, "extra": None, "hash": marks})


def islands(spans: DataFrame) -> DataFrame:
    """Overlapping or touching ``cls, start, end`` joined."""
    order = Window.partitionBy("cls").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = spans.withColumn("new", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    numbered = new.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("cls", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).select("cls", "start", "end")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, start, end, n_words``: maximal spans of words, counted from 0, covered by passages of other documents."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bound_batches(docs.sparkSession)
    with Scratch(docs.sparkSession, "passages") as scratch:
        found = docs.mapInPandas(anchors, "key long, cls long, place int, doc_id long, n_words long")
        found = scratch.keep(found.withColumn("doc_id", F.when(F.col("place") < 0, F.col("doc_id"))), "anchors")
        texts = scratch.keep(found.where("place < 0").select("doc_id", "cls", "n_words"), "texts")
        suffixes = found.where("place >= 0").select("key", "cls", "place")
        shared = suffixes.groupBy("key").agg(F.min("cls").alias("x"), F.max("cls").alias("y"), F.count(F.lit(1)).alias("n"))
        shared = shared.where("x < y").select("key", (F.col("n") > REACH + 1).alias("hot"))
        shared = scratch.keep(shared, "shared")  # stored, so that both sides of the join are plain shuffles that a hot key can split
        kept = suffixes.join(shared, "key").groupBy("cls").agg(
            F.collect_set(F.when(~F.col("hot"), F.col("place"))).alias("places"), F.collect_set(F.when(F.col("hot"), F.col("place"))).alias("often"))
        classes = texts.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.first("n_words").alias("n_words"))
        kept = scratch.keep(kept.join(classes.select("cls", "doc_id"), "cls"), "kept")
        scratch.drop(found)
        # Classes that only texts without doc_id have are joined by the class itself.
        unnamed = docs.where("doc_id is null").select("text").mapInPandas(with_classes, "cls long, text string").dropDuplicates(["cls"])
        texts_of = docs.join(kept, "doc_id").unionByName(unnamed.join(kept.where("doc_id is null"), "cls"))
        placed = texts_of.select("cls", "text", "places", "often").mapInPandas(
            placed_contexts, "key binary, id long, at long, extra binary, hash long")
        placed = scratch.keep(placed, "contexts")
        pieces = compare_neighbours(placed.where("hash is null"), REACH, common_spans, scratch, "pieces").select(
            F.col("p").alias("cls"), F.col("q").alias("start"), F.col("r").alias("end"))
        windows = placed.where("hash is not null").select("hash", F.col("id").alias("cls"), F.col("at").alias("start"))
        twice = windows.groupBy("hash").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x < y").select("hash")
        twice = scratch.keep(twice, "twice")
        marked = windows.join(twice, "hash", "left_semi").select("cls", "start", (F.col("start") + MIN_WORDS).alias("end"))
        copies = classes.where("n > 1").select("cls", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))
        spans = islands(pieces.distinct().unionByName(copies).unionByName(marked))
        return scratch.result(texts.select("doc_id", "cls").join(spans, "cls").select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words")))
