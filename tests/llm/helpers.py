"""Texts and frames for the tests of the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row int, label int, key string"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, changes):
    words, r = text.split(), random.Random(seed)
    for _ in range(changes):
        words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
    return " ".join(words)


def frame(spark, texts, sources=None, ids=None):
    ids = ids or list(range(len(texts)))
    rows = [(i, t, None, s, None, "clash", 7, 1, None) for i, t, s in zip(ids, texts, sources or ["a"] * len(texts), strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " \t\n ", "\n\n", "word", "Ünï cödé ñ", "a b c", prose(1, 40_000), prose(2, 200), prose(2, 200), "z" * 50_000]
