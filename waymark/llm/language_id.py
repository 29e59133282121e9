"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; every character that is not a letter becomes a space and runs of spaces one. N-grams of
1 to ``MAX_N`` characters are hashed into ``BUCKETS``. Learning counts n-grams per language over all labelled texts:
each task sums its own (language, bucket) counts, Spark adds them up. The model is a matrix of log probabilities,
``BUCKETS`` by languages (``MAX_LANGUAGES`` at most, so its size is bounded), that every task receives. Scoring
counts the n-grams of a few texts at a time into a sparse (text, bucket) table and multiplies.

The score is the posterior of the predicted language with the evidence of at most ``EVIDENCE`` n-grams, as n-grams of
one text are far from independent.

Whole texts are read, in pieces of ``PIECE`` characters. Nulls and empties: a text that is NULL or has no letter is
``und`` with score 0, as is every text when nothing could be learned; rows without a label are not learned from. Ties
go to the first language in code point order. Repeated rows count as often as they occur; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import bound_batches

BUCKETS = 1 << 14
MAX_N = 4
MAX_LANGUAGES = 1000
SMOOTHING = 0.5
EVIDENCE = 30.0
PIECE = 1 << 18
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters; built once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def buckets(text: str | None) -> np.ndarray:
    """The bucket of each n-gram of a text; empty if it has no letter."""
    found = []
    text = (text or "").lower()
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "replace"), "<u4")
        letter = letter_table()[codes]
        if not letter.any():
            continue
        codes = np.where(letter, codes, 32).astype(np.uint32)
        codes = np.concatenate([[32], codes[letter | np.append(True, letter[:-1])], [32]]).astype(np.uint32)
        acc = np.zeros(len(codes), np.uint32)
        for n in range(1, MAX_N + 1):
            acc = acc[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:]
            mixed = (acc ^ np.uint32(n * 0x51ED27)) * np.uint32(0x9E3779B1)
            found.append(mixed >> np.uint32(32 - 14))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log probability matrix from all rows of ``labelled(text, lang)`` with a label."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b["text"], b["lang"], strict=True):
                mine = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                mine += np.bincount(buckets(text), minlength=BUCKETS)
        for lang, mine in total.items():
            at = np.flatnonzero(mine)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": mine[at]})

    bound_batches(labelled.sparkSession)
    counts = labelled.where("lang is not null").select("text", "lang").mapInPandas(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    if counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = counts.toPandas()
    languages = sorted(rows["lang"].unique(), key=lambda s: s.encode())
    matrix = np.full((BUCKETS, len(languages)), SMOOTHING)
    for k, lang in enumerate(languages):
        mine = rows[rows["lang"] == lang]
        matrix[mine["bucket"], k] += mine["n"]
    return languages, np.log(matrix / matrix.sum(0)).astype(np.float32)


def classify(texts: list[str | None], languages: list[str], model: np.ndarray) -> list[tuple[str, float]]:
    """``(language, score)`` of every text."""
    grams = [buckets(t) for t in texts]
    totals = np.array([len(g) for g in grams])
    out = [(UNKNOWN, 0.0)] * len(texts)
    known = np.flatnonzero(totals)
    if not languages or not len(known):
        return out
    cell, count = np.unique(np.concatenate([grams[k] + BUCKETS * i for i, k in enumerate(known)]), return_counts=True)
    logs = model[cell % BUCKETS] * count[:, None]
    row = cell // BUCKETS
    sums = np.add.reduceat(logs, np.searchsorted(row, np.arange(len(known))), axis=0)
    sums *= np.minimum(1.0, EVIDENCE / totals[known])[:, None]
    odds = np.exp(sums - sums.max(1, keepdims=True))
    share = odds / odds.sum(1, keepdims=True)
    for i, k in enumerate(known):
        best = int(share[i].argmax())
        out[k] = (languages[best], float(share[i, best]))
    return out


def identify(docs: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs(doc_id, text)``."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((languages, model))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, matrix = shared.value
        for b in batches:
            texts = b["text"].tolist()
            found = [x for at in range(0, len(texts), 32) for x in classify(texts[at:at + 32], names, matrix)]
            yield pd.DataFrame(found, columns=["lang_pred", "score"]).assign(doc_id=b["doc_id"].to_numpy())

    return docs.select("doc_id", "text").mapInPandas(predict, "lang_pred string, score double, doc_id long").select("doc_id", "lang_pred", "score")
