"""Requests scored inside their own rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.operators import inline_scoring
from waymark.operators.inline_scoring import instance_values, predict_in_rows, responses, tree_loader
from waymark.operators.requests import feature_rows, validate_requests
from waymark.operators.scoring import CANDIDATES, fit, score
from waymark.plans.scoring import score_requests

DDL = "request_id int, body string"


def instance(hour, **kw):
    return {**dict.fromkeys(S.FEATURES, 1), "pickup_hour": hour, **kw}


def hour_loader():
    """Built here so that tasks get the function itself and not the name of this module."""
    place = S.FEATURES.index("pickup_hour")
    return lambda: lambda m: np.log1p(m[:, place].astype("float64"))


def answer(df, load=None):
    load = load or hour_loader()
    out = responses(predict_in_rows(instance_values(validate_requests(df), "request_id"), load, 86_400.0), "request_id", "m1")
    return sorted((r.request_id, r.status_code, r.response) for r in out.collect())


def rounded(response):
    return [round(p, 6) for p in json.loads(response)["predictions"]]


def test_repeated_ids_stay_apart_and_keep_their_order(spark):
    bodies = [[instance(3), instance(1), instance(2)], [instance(5)], [instance(5)], [instance(3, pickup_dow=None)], []]
    got = answer(spark.createDataFrame([(7, json.dumps(b)) for b in bodies] + [(7, None), (7, "{")], DDL))
    assert [g[1] for g in got] == [200, 200, 200, 400, 400, 422, 422]
    assert sorted(rounded(g[2]) for g in got[:3]) == [[3.0, 1.0, 2.0], [5.0], [5.0]]


def test_no_request_no_row(spark):
    assert answer(spark.createDataFrame([], DDL)) == []
    assert [g[1] for g in answer(spark.createDataFrame([(1, "{"), (2, "[]")], DDL))] == [400, 422]


def test_many_requests_and_slices(spark, monkeypatch):
    bodies = [json.dumps([instance((i + k) % 24) for k in range(1 + i % 5)]) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(bodies)), DDL)
    whole = answer(df)
    monkeypatch.setattr(inline_scoring, "SLICE_ROWS", 3)
    flat = np.arange(20, dtype="float32").reshape(-1, 1)
    assert inline_scoring._predicted(lambda m: np.log1p(m[:, 0]), flat, 1e9).round(4).tolist() == [float(i) for i in range(20)]
    assert [rounded(r) for _, _, r in whole] == [[float((i + k) % 24) for k in range(1 + i % 5)] for i in range(40)]


@pytest.mark.parametrize("predict", [lambda m: np.full(len(m), np.nan), lambda m: np.zeros(len(m) + 1)])
def test_useless_answers_are_500(spark, predict):
    df = spark.createDataFrame([(1, json.dumps([instance(1)])), (2, "{")], DDL)
    got = answer(df, lambda: predict)
    assert [g[1] for g in got] == [500, 400] and json.loads(got[0][2]) == {"detail": "Inference failed"}


def test_no_exchange(spark):
    df = spark.createDataFrame([(1, json.dumps([instance(1)]))], DDL)
    out = responses(predict_in_rows(instance_values(validate_requests(df), "request_id"), hour_loader(), 86_400.0), "request_id", "m1")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_trees_as_arrays_agree_with_spark(spark):
    rows = [(i % 24, i % 7, float(i % 50), 300.0 + 40 * (i % 24) + (i * 37) % 50) for i in range(600)]
    columns = [{"pickup_hour": "h", "pickup_dow": "d", "avg_duration_7d_zone_hour": "IF(i < 3, double('NaN'), i)"}.get(c, "1") for c in S.FEATURES]
    df = spark.createDataFrame(rows, "h int, d int, i double, y double").selectExpr(
        f"y AS {S.LABEL}", *[f"cast({e} AS float) AS {c}" for e, c in zip(columns, S.FEATURES)]).repartition(1)
    model = fit(df, CANDIDATES[5], 5000.0, 6)
    x = np.array([[r[c] for c in S.FEATURES] for r in df.collect()], dtype="float32")
    want = [r.prediction_seconds for r in score(df, model, 5000.0).collect()]
    got = np.clip(np.expm1(tree_loader(spark, model)()(x)), 0, 5000.0)
    assert np.isnan(x).any() and np.allclose(got, want, rtol=1e-9)

    bodies = [[instance(k % 24, pickup_dow=k % 7) for k in range(i, i + 1 + i % 4)] for i in range(30)]
    requests = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], DDL)
    exploded = score(feature_rows(validate_requests(requests), "request_id").repartition(3), model, 5000.0)
    want = exploded.groupBy("request_id").agg(F.sort_array(F.collect_list(F.struct("row_index", "prediction_seconds"))).alias("p"))
    want = {r.request_id: [round(p.prediction_seconds, 6) for p in r.p] for r in want.collect()}
    assert {r.request_id: rounded(r.response) for r in score_requests(requests, model, 5000.0, "m1").collect()} == want
