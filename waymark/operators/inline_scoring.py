"""Scoring of requests inside their own rows: no explode, no exchange, no key to group by.

An accepted request becomes one list of floats, its instances one after another. A task hands the lists of an Arrow
batch to the model as one matrix and cuts the answers at the same offsets. Rejected requests carry no list, so the
model never sees them, and equal request ids stay separate requests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark import settings as S
from waymark.operators.requests import FAILED, OK
from waymark.operators.scoring import COLD_START
from waymark.session import Scratch

#: Instances a model gets at once; longer Arrow batches are cut, so a task holds a bounded matrix.
SLICE_ROWS = 65_536
Predict = Callable[[np.ndarray], np.ndarray]


def instance_values(validated: DataFrame, key: str, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """``key``, the verdict and ``values``: floats of all instances in contract order, NULL for a rejected request.

    A value that cannot be read is NULL inside the list and reaches the model as NaN.
    """
    def floats(instance):
        return F.array(*[F.trim(F.try_variant_get(instance, f"$.{f}", "string")).try_cast("double").cast("float") for f in features])

    values = F.when(F.col("status_code") == OK, F.flatten(F.transform("instances", floats)))
    return validated.select(key, "n_instances", "status_code", "error", values.alias("values"))


def _predicted(predict: Predict, matrix: np.ndarray, limit: float) -> np.ndarray:
    """Seconds per row; NaN where the model did not answer every row of a slice."""
    out = np.full(len(matrix), np.nan)
    for start in range(0, len(matrix), SLICE_ROWS):
        part = matrix[start:start + SLICE_ROWS]
        log = np.asarray(predict(part), dtype="float64").reshape(-1)
        if len(log) == len(part):
            out[start:start + len(part)] = np.clip(np.expm1(log), 0.0, limit)
    return out


def predict_in_rows(rows: DataFrame, load: Callable[[], Predict], cap: float, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """Replace ``values`` by ``predictions``, one per instance; ``load`` runs once per task and maps a float32 matrix to log values."""
    limit, width = min(float(cap), S.MAX_PREDICTION_SECONDS), len(features)
    others = [c for c in rows.columns if c != "values"]
    schema = T.StructType([*rows.select(*others).schema.fields, T.StructField("predictions", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = load()
        for batch in batches:
            lists = batch.column("values")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("float32", copy=False)
            seconds = _predicted(predict, flat.reshape(-1, width), limit)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False) // width
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
            answers = pa.ListArray.from_arrays(pa.array(offsets), pa.array(seconds), mask=lists.is_null())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), answers], names=[*others, "predictions"])

    return rows.select(*others, "values").mapInArrow(run, schema)


def responses(scored: DataFrame, key: str, model_version: str) -> DataFrame:
    """One response per row of :func:`predict_in_rows`: predictions in instance order, or the first error.

    An accepted request without one finite prediction per instance answers 500.
    """
    finite = F.forall("predictions", lambda p: F.abs(p) < F.lit(float("inf")))
    answered = F.coalesce((F.size("predictions") == F.col("n_instances")) & finite, F.lit(False))
    code = F.when((F.col("status_code") == OK) & ~answered, FAILED).otherwise(F.col("status_code"))
    good = F.to_json(F.struct(F.lit(model_version).alias("model_version"), "n_instances", "predictions"))
    detail = F.to_json(F.struct(F.coalesce("error", F.lit("Inference failed")).alias("detail")))
    return scored.select(key, code.alias("status_code"), F.when(code == OK, good).otherwise(detail).alias("response"))


def tree_loader(spark: SparkSession, model: PipelineModel) -> Callable[[], Predict]:
    """A fitted ensemble as plain arrays for :func:`predict_in_rows`.

    What reaches the driver are the nodes of the saved model: at most rounds times two to the depth plus one.
    """
    ensemble = model.stages[-1]
    with Scratch(spark, "trees") as scratch:
        path = scratch.folder("model")
        ensemble.save(path)
        node = F.col("nodeData")
        nodes = spark.read.parquet(f"{path}/data").select(
            "treeID", node["id"].alias("id"), node["prediction"].alias("value"), node["leftChild"].alias("left"),
            node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
            F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold")).toPandas()
    weights = list(ensemble.treeWeights)
    trees = []
    for tree, part in nodes.sort_values(["treeID", "id"]).groupby("treeID"):
        columns = {c: part[c].to_numpy() for c in ("value", "left", "right", "feature", "threshold")}
        trees.append((weights[tree], columns))
    cold = [S.FEATURES.index(c) for c in COLD_START]

    def predict(matrix: np.ndarray) -> np.ndarray:
        x = matrix.astype("float64")
        missing = np.isnan(x[:, cold])
        x[:, cold] = np.where(missing, -1.0, x[:, cold])
        x = np.concatenate([x, missing.astype("float64")], axis=1)
        each, total = np.arange(len(x)), np.zeros(len(x))
        for weight, t in trees:
            at = np.zeros(len(x), dtype="int64")
            while (inner := t["feature"][at] >= 0).any():
                left = x[each, np.maximum(t["feature"][at], 0)] <= t["threshold"][at]
                at = np.where(inner, np.where(left, t["left"][at], t["right"][at]), at)
            total += weight * t["value"][at]
        return total

    return lambda: predict
