"""Early stopping and the candidate search."""

import pytest

from waymark import settings as S
from waymark.operators import scoring


@pytest.mark.parametrize(("losses", "patience", "want"), [
    ([5, 4, 3, 2], 2, (4, False)), ([5, 4, 6, 6, 1], 2, (2, True)), ([5, 6, 4, 5, 3], 2, (5, False)), ([1], 3, (1, False)), ([2, 2, 2, 2], 3, (1, True)),
])
def test_stopping_round(losses, patience, want):
    assert scoring.stopping_round(losses, patience) == want


def test_cut_ensemble_is_a_prefix(spark):
    rows = [(float(i % 7), float(i % 24), 300.0 + 40 * (i % 24) + (i * 37) % 50) for i in range(400)]
    names = list(S.FEATURES)
    df = spark.createDataFrame(rows, "a double, b double, y double").selectExpr("y AS " + S.LABEL, *[f"{'a' if k % 2 else 'b'} AS {n}" for k, n in enumerate(names)]).repartition(1)
    candidate = scoring.CANDIDATES[5]
    long, short = (scoring.fit(df, candidate, 5000.0, n).stages[-1] for n in (6, 3))
    assert [t.toDebugString.split("\n", 1)[1] for t in long.trees[:3]] == [t.toDebugString.split("\n", 1)[1] for t in short.trees]
    model, went = scoring.fit_stopped(df, df, candidate, 5000.0, 6, 2)
    assert model.stages[-1].getNumTrees == went["best_iteration"] <= went["rounds"] <= 6
    winner, best, reports = scoring.search(df, df, 5000.0, scoring.CANDIDATES[:2], rounds=4, patience=1)
    assert min(reports, key=lambda r: r["mae_seconds_capped"])["name"] == winner.name and len(reports) == 2
