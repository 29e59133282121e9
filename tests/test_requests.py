import json

import pytest
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.operators.requests import (explode_requests, feature_rows, quarantine, response_rows, scoring_rows,
                                        validate_requests)

GOOD = {"pickup_hour": 12, "pickup_dow": 1, "pickup_month": 4, "pickup_is_weekend": 0, "pickup_borough_id": 1,
        "pickup_zone_id": 10, "pickup_service_zone_id": 2, "dropoff_borough_id": 1, "dropoff_zone_id": 20,
        "dropoff_service_zone_id": 3, "route_pair_id": 100, "avg_duration_7d_zone_hour": 12.5, "avg_fare_30d_zone": 18.2,
        "trip_count_90d_zone_hour": 45.0}


def changed(**kw):
    return {**GOOD, **kw}


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


CASES = [
    (json.dumps({"instances": [GOOD]}), 200, None),
    (json.dumps({"instances": [GOOD, GOOD]}), 200, None),
    (json.dumps({"inputs": [GOOD] * 16}), 200, None),
    (json.dumps([GOOD] * 256), 200, None),
    (json.dumps(GOOD), 200, None),
    (json.dumps([changed(pickup_hour="7", avg_fare_30d_zone=" 1e1 ")]), 200, None),
    ('{"instances": [', 400, "Invalid JSON body"),
    ("[{\"pickup_hour\": NaN}]", 400, "Invalid JSON body"),
    ('{"instances": []}', 422, "Body must contain one or more instances"),
    ('{"instances": null}', 422, "Body must contain one or more instances"),
    ("3", 422, "Body must contain one or more instances"),
    ("null", 422, "Body must contain one or more instances"),
    (json.dumps([GOOD, 5]), 422, "Instance at index 1 must be an object"),
    (json.dumps([GOOD] * 257), 422, "Too many instances: 257 > 256"),
    (json.dumps([GOOD, without("pickup_dow")]), 422, "Missing required features at row 1: pickup_dow"),
    (json.dumps([changed(b=1, a=2)]), 422, "Unexpected features at row 0: a, b"),
    (json.dumps([changed(pickup_dow=None)]), 422, "Feature 'pickup_dow' is null at row 0"),
    (json.dumps([changed(pickup_dow=True)]), 422, "Feature 'pickup_dow' must be numeric at row 0"),
    (json.dumps([changed(pickup_dow="1d")]), 422, "Feature 'pickup_dow' must be numeric at row 0"),
    (json.dumps([changed(pickup_dow=[1])]), 422, "Feature 'pickup_dow' must be numeric at row 0"),
    (json.dumps([changed(pickup_dow="inf")]), 422, "Feature 'pickup_dow' must be finite at row 0"),
    (json.dumps([GOOD]).replace("12.5", "1e400"), 422, "Feature 'avg_duration_7d_zone_hour' must be finite at row 0"),
    (json.dumps([changed(route_pair_id="x", pickup_month=None)]), 422, "Feature 'pickup_month' is null at row 0"),
]


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "request_id int, body string")


def test_status_and_first_message(requests):
    got = {r.request_id: (r.status_code, r.error) for r in validate_requests(requests).collect()}
    for i, (_, status, error) in enumerate(CASES):
        assert got[i] == (status, error), CASES[i][0][:80]


def test_extra_features_allowed(spark):
    df = spark.createDataFrame([(1, json.dumps([changed(extra=1)]))], "request_id int, body string")
    assert validate_requests(df, allow_extra=True).first().status_code == 200


def test_feature_rows_keep_order_and_values(requests):
    rows = feature_rows(validate_requests(requests), "request_id")
    assert rows.columns[3:] == list(S.FEATURES)
    assert rows.where("request_id = 3").count() == 256
    r = rows.where("request_id = 5").first()
    assert (r.pickup_hour, r.avg_fare_30d_zone, r.route_pair_id) == (7.0, 10.0, 100.0)


def test_explode_and_quarantine(requests):
    n_good = sum(c[1] == 200 for c in CASES)
    assert quarantine(validate_requests(requests), "request_id").count() == len(CASES) - n_good
    assert explode_requests(requests).where("request_id = 13").count() == 0


def test_responses(requests):
    scored = scoring_rows(validate_requests(requests), "request_id").withColumn(
        "prediction_seconds", F.col("pickup_hour").cast("double") + F.coalesce("row_index", F.lit(0)))
    got = {r.request_id: (r.status_code, json.loads(r.response)) for r in response_rows(scored, "request_id", "m1").collect()}
    assert len(got) == len(CASES)
    assert got[1] == (200, {"model_version": "m1", "n_instances": 2, "predictions": [12.0, 13.0]})
    assert got[8] == (422, {"detail": "Body must contain one or more instances"})
    lost = response_rows(scored.where("NOT (request_id = 1 AND row_index = 1)"), "request_id", "m1")
    assert lost.where("request_id = 1").first().status_code == 500
