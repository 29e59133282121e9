"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained on labelled texts, one per label. A text is cut into blocks of ``BLOCK`` bytes - all of
them, a long text has many - and every block is compressed once with either dictionary. The normalised difference

    (bytes with the bad dictionary - bytes with the good one) / (sum of both)

is positive where good text explains it better. Logistic regression on the difference, fitted on labelled texts that
did not enter the dictionaries, turns it into a calibrated score.

Learning uses at most ``SAMPLE_ROWS`` texts per label and use, the ones with the smallest hash of their id, and at most
``SAMPLE_BYTES`` bytes of each, spread over the text: these bounds keep the training on the driver small whatever the
corpus. A calibration row weighs as many labelled ids as it stands for, so the scores keep the class ratio of all labels,
also where the bound cuts one class. Every text is scored as a whole.

Nulls and empties: a NULL or empty text compares equal under both dictionaries, so it scores as a difference of 0.
Without labels of both kinds every score is 0.5. Documents with contradictory labels are learned under each.
Repeated rows each get a row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import bound_batches

SAMPLE_ROWS = 1_500
SAMPLE_BYTES = 8_192
DICTIONARY_BYTES = 112_640
BLOCK = 1_024
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    intercept: float


class Compressors:
    """The two compressors of a worker."""

    def __init__(self, good: bytes, bad: bytes):
        def of(d: bytes) -> zstandard.ZstdCompressor:
            made = zstandard.ZstdCompressionDict(d)
            made.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)

        self.good, self.bad = of(good), of(bad)

    def difference(self, blocks: list[bytes]) -> float:
        good = sum(len(self.good.compress(b)) for b in blocks)
        bad = sum(len(self.bad.compress(b)) for b in blocks)
        return (bad - good) / (bad + good) if blocks else 0.0


def blocks_of(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "replace")
    return [data[at:at + BLOCK] for at in range(0, len(data), BLOCK)]


def pieces(text: str | None) -> list[bytes]:
    """Blocks of a text, at most ``SAMPLE_BYTES`` of it, evenly spread."""
    every, most = blocks_of(text), SAMPLE_BYTES // BLOCK
    return every if len(every) <= most else [every[round(k * (len(every) - 1) / (most - 1))] for k in range(most)]


def dictionary(texts: list[list[bytes]]) -> bytes:
    """A trained dictionary, or the blocks themselves where they are too few to train on."""
    samples = [p for t in texts for p in t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of weighted rows by Newton's method, lightly regularised."""
    weight = weight / weight.mean()
    scale = x.std() or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + 1e-2 * np.eye(2), a.T @ (weight * (y - p)) - 1e-2 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def sample(docs: DataFrame, labels: DataFrame) -> tuple[dict[tuple[int, int], list[list[bytes]]], dict[tuple[int, int], float]]:
    """Blocks of at most ``SAMPLE_ROWS`` texts per label and use, and how many labelled ids each chosen one stands for.

    Use 0 trains a dictionary, 1 the calibration. The ids are chosen from the labels alone, then one scan fetches the
    pieces of those texts.
    """
    order, use = F.xxhash64(F.col("doc_id"), F.lit("quality")), F.pmod(F.xxhash64("doc_id"), F.lit(2))
    size = {(r["label"], r["use"]): r["count"] for r in labels.where(F.col("label").isin(0, 1)).select("doc_id", "label", use.alias("use")).distinct().groupBy("label", "use").count().collect()}
    chosen: dict = {}
    for label in (0, 1):
        for k in (0, 1):
            ids = labels.where((F.col("label") == label) & (use == k)).select("doc_id").distinct().orderBy(order, "doc_id").limit(SAMPLE_ROWS)
            chosen[label, k] = [r["doc_id"] for r in ids.collect()]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "blocks": [pieces(t) for t in b["text"]]})

    bound_batches(docs.sparkSession)
    ids = [i for some in chosen.values() for i in some]
    rows = docs.where(F.col("doc_id").isin(ids) & (F.length("text") > 0)).select("doc_id", "text").mapInPandas(cut, "doc_id long, blocks array<binary>").collect() if ids else []
    found: dict = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["blocks"])):
        found.setdefault(r["doc_id"], []).append([bytes(x) for x in r["blocks"]])
    stands = {k: size.get(k, 0) / max(len(some), 1) for k, some in chosen.items()}
    return {k: [blocks for i in some for blocks in found.get(i, [])] for k, some in chosen.items()}, stands


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model learned from ``docs(doc_id, text)`` and ``labels(doc_id, label)``; None if a label is missing."""
    texts, stands = sample(docs, labels)
    if not texts[0, 0] or not texts[1, 0]:
        return None
    good, bad = dictionary(texts[1, 0]), dictionary(texts[0, 0])
    both = Compressors(good, bad)
    held = {k: (k, 1) if texts[k, 1] else (k, 0) for k in (0, 1)}
    x = np.array([both.difference(t) for k in (0, 1) for t in texts[held[k]]])
    y = np.array([float(k) for k in (0, 1) for _ in texts[held[k]]])
    weight = np.array([stands[held[k]] for k in (0, 1) for _ in texts[held[k]]])
    slope, intercept = logistic(x, y, weight)
    return Model(good, bad, max(slope, 0.0), intercept)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, score`` of every row of ``docs(doc_id, text)``."""
    if model is None:
        return docs.select("doc_id", F.lit(0.5).alias("score"))

    bound_batches(docs.sparkSession)
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = Compressors(model.good, model.bad)
        for b in batches:
            z = model.slope * np.array([both.difference(blocks_of(t)) for t in b["text"]], float) + model.intercept
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))})

    return docs.select("doc_id", "text").mapInPandas(scored, "doc_id long, score double")
