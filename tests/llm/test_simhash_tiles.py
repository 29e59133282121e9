"""SimHash groups against brute force, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, edited, frame, prose
from waymark.llm import simhash_tiles
from waymark.session import Scratch


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(marks, radius):
    parent = list(range(len(marks)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(marks):
        for j in range(i):
            if (x ^ marks[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(marks))]


def test_groups_equal_brute_force(spark):
    texts = list(ODD) + ["One two THREE four", "one  two\nthree four", "Été éTÉ x", "a", "A"]
    texts += [edited(prose(40 + k % 6, 400), k, k % 4) for k in range(120)] + [prose(300 + k, 30) for k in range(40)]
    out = {r.doc_id: r for r in simhash_tiles.group_documents(frame(spark, texts), tile_size=16).collect()}
    marks = [plain_fingerprint(t) for t in texts]
    assert {i: r.fingerprint for i, r in out.items()} == {i: f"{m:016x}" for i, m in enumerate(marks)}
    want = groups(marks, 3)
    assert {i: r.component_id for i, r in out.items()} == dict(enumerate(want))
    assert len(set(want)) < len(texts) - 40  # near copies were there to be found
    assert {out[i].component_id for i in (0, 1, 2, 3)} == {0}


@pytest.mark.parametrize("tile_size", [64, 1000])
def test_links_of_crowded_and_scattered_fingerprints(spark, tile_size):
    r = random.Random(5)
    marks = {r.getrandbits(64) for _ in range(1500)} | {0, 2**64 - 1, 1, 2**63}
    for _ in range(12):  # chains and balls around some of them
        at = r.getrandbits(64)
        for _ in range(60):
            at ^= 1 << r.randrange(64) ^ 1 << r.randrange(64)
            marks.add(at)
        marks |= {at ^ 1 << k for k in range(64)}
    marks = sorted(marks)
    signed = np.array(marks, np.uint64).view(np.int64).tolist()
    with Scratch(spark, "test") as scratch:
        frame_ = spark.createDataFrame([(m,) for m in signed], "fingerprint long").repartition(5)
        edges = simhash_tiles.links(frame_, 3, scratch, tile_size).collect()
    place = {m: i for i, m in enumerate(signed)}
    assert all((marks[place[e.a]] ^ marks[place[e.b]]).bit_count() < 65 for e in edges)
    label = simhash_tiles.roots(np.array([place[e.a] for e in edges]), np.array([place[e.b] for e in edges]), len(marks))
    assert label.tolist() == groups(marks, 3)


def test_sort_key_matches_counts(spark):
    marks = np.array([0, 1, 2**63, 2**64 - 1, 0x0123456789ABCDEF], np.uint64)
    keys = [r.k for r in spark.createDataFrame([(int(m),) for m in marks.view(np.int64)], "f long").select(simhash_tiles.sort_key(F.col("f")).alias("k")).collect()]
    counts = simhash_tiles.part_counts(marks)
    for key, row in zip(keys, counts.tolist(), strict=True):
        want = 0
        for part in simhash_tiles.ORDER:
            want = (want << simhash_tiles.PARTS[part][1].bit_length()) + row[part]
        assert key == want


def test_ids_and_empty_tables(spark):
    same = prose(7, 80)
    out = simhash_tiles.group_documents(frame(spark, [same, same, same, "", None], ids=[None, 9, 4, None, None])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in out) == [(0, 0), (0, 0), (0, 4), (4, 4), (9, 4)]
    twice = simhash_tiles.group_documents(frame(spark, [same, prose(8, 80)], ids=[3, 3])).collect()
    assert [r.component_id for r in twice] == [3, 3]
    none = simhash_tiles.group_documents(frame(spark, []).limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "fingerprint", "component_id"]
