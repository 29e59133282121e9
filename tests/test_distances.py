"""Drift statistics against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.operators import distances
from waymark.operators.ranking import running_sums

RNG = np.random.default_rng(3)
A, B = np.round(RNG.normal(0, 1, 700), 2), np.round(RNG.normal(0.3, 1.4, 500), 2)


def frames(spark):
    make = lambda x, cat: spark.createDataFrame([(float(v), cat[i % len(cat)]) for i, v in enumerate(x)] + [(float("nan"), None), (None, "a")], "x double, k string").repartition(5)
    return make(A, ["a", "b"]), make(B, ["a", "b", "b", "c"])


def test_ordered_statistics(spark):
    current, reference = frames(spark)
    grid = np.unique(np.concatenate([A, B]))
    gaps = np.abs(np.searchsorted(np.sort(A), grid, "right") / len(A) - np.searchsorted(np.sort(B), grid, "right") / len(B))
    row = distances.ordered_distances(current, reference, ["x"]).first()
    assert row.ks == pytest.approx(gaps.max()) and row.wasserstein == pytest.approx((gaps[:-1] * np.diff(grid)).sum() / B.std())
    ks = distances.drift_scores(current, reference, "ks", ["k"], ["x"]).orderBy("kind").collect()
    assert [(r.kind, r.method, r.drifted) for r in ks] == [("categorical", "chisquare", True), ("numeric", "ks", True)] and 0 <= ks[1].p_value < 0.05
    same = distances.drift_scores(current, current, "ks", ["k"], ["x"]).collect()
    assert not any(r.drifted for r in same) and all(r.statistic == pytest.approx(0) for r in same)


def test_binned_statistics(spark):
    current, reference = frames(spark)
    c, r = np.array([351, 350, 0, 1]), np.array([126, 250, 125, 1])  # a, b, c, NULL
    row = distances.binned_distances(distances.histograms(current, reference, ["k"], {})).first()
    scaled = np.sqrt(r.sum() / c.sum()) * c - np.sqrt(c.sum() / r.sum()) * r
    assert row.chisquare == pytest.approx((scaled**2 / (c + r)).sum()) and row.bins == 4
    p, q = c / c.sum(), r / r.sum()
    m = (p + q) / 2
    kl = lambda x: sum(a * np.log(a / b) for a, b in zip(x, m, strict=True) if a)
    assert row.jensenshannon == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))
    with pytest.raises(ValueError):
        distances.drift_scores(current, reference, "guess")
    empty = distances.drift_scores(current.limit(0), reference, "wasserstein", ["k"], ["x"]).collect()
    assert not any(r.drifted for r in empty)


def test_running_sums_over_partitions(spark):
    rows = [(g, float(v), v % 5) for g in "ab" for v in range(500)]
    out = running_sums(spark.createDataFrame(rows, "g string, v double, n long").repartition(6), "g", "v", ["n"]).where(F.col("g") == "b").orderBy("v").collect()
    assert [r.n for r in out] == np.cumsum([v % 5 for v in range(500)]).tolist()
    assert [r.next for r in out] == [float(v) for v in range(1, 500)] + [None]
