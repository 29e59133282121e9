"""Score a batch of JSON requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from waymark import settings as S
from waymark.operators.inline_scoring import instance_values, predict_in_rows, responses, tree_loader
from waymark.operators.requests import validate_requests
from waymark.session import spread_small


def score_requests(requests: DataFrame, model: PipelineModel, cap: float, model_version: str, key: str = "request_id",
                   body: str = "body", max_instances: int = S.MAX_INSTANCES) -> DataFrame:
    """One response per request: predictions in instance order, or the first error."""
    validated = validate_requests(spread_small(requests), body=body, max_instances=max_instances)
    scored = predict_in_rows(instance_values(validated, key), tree_loader(requests.sparkSession, model), cap)
    return responses(scored, key, model_version)
