"""Model fitting, candidate search and batch scoring on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.operators.metrics import error_metrics, from_log_target, to_log_target
from waymark.session import Scratch


@dataclass(frozen=True)
class Candidate:
    """One boosted-tree setting; leaves become a tree depth here."""

    name: str
    learning_rate: float
    num_leaves: int
    max_depth: int
    min_child_samples: int
    feature_fraction: float
    subsample: float

    @property
    def depth(self) -> int:
        return self.max_depth if self.max_depth > 0 else min(10, math.ceil(math.log2(self.num_leaves)))


# The published search list (L1/L2 penalties have no Spark ML counterpart).
CANDIDATES = (
    Candidate("best_trial_replay", 0.036521134985273, 20, -1, 36, 0.745279704149923, 0.9041688589514847),
    Candidate("compact_regularized", 0.03, 31, -1, 30, 0.85, 0.85),
    Candidate("wider_tree", 0.025, 63, -1, 20, 0.80, 0.80),
    Candidate("deeper_tree", 0.035, 96, 7, 40, 0.75, 0.90),
    Candidate("high_bias_low_variance", 0.05, 31, -1, 80, 0.90, 0.90),
    Candidate("small_tree_fast", 0.04, 15, -1, 60, 0.70, 0.90),
    Candidate("extra_wide_low_lr", 0.02, 128, -1, 15, 0.75, 0.85),
)
#: Boosting rounds at most, and rounds without a better one after which it stops.
MAX_ROUNDS, PATIENCE = 40, 5
#: Training rows of one part.
ROWS_PER_PART = 65_536
COLD_START = ("avg_duration_7d_zone_hour", "avg_fare_30d_zone")
MODEL_COLUMNS = (*S.FEATURES, *[f"{c}_missing" for c in COLD_START])


def with_model_columns(df: DataFrame) -> DataFrame:
    """Trees here cannot take NaN: cold starts become -1 plus an indicator column."""
    bad = {c: F.col(c).isNull() | F.isnan(c) for c in COLD_START}
    return df.withColumns({f"{c}_missing": bad[c].cast("double") for c in COLD_START}).withColumns(
        {c: F.when(bad[c], F.lit(-1.0)).otherwise(F.col(c)) for c in COLD_START})


def _regressor(c: Candidate, rounds: int, seed: int) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol="target", predictionCol="prediction_log", lossType="absolute",
        maxIter=rounds, maxDepth=c.depth, stepSize=c.learning_rate, minInstancesPerNode=c.min_child_samples,
        subsamplingRate=c.subsample, featureSubsetStrategy=str(c.feature_fraction), seed=seed, cacheNodeIds=True)


def spread_rows(df: DataFrame, scratch: Scratch) -> DataFrame:
    """``df`` stored in even parts of about ``ROWS_PER_PART`` rows; as it is where it fits one part.

    Boosting passes over its rows several times a round, one task a part: a file of few row groups would keep most cores idle.
    """
    rows = df.count()
    return df if rows <= ROWS_PER_PART else scratch.keep(df.repartition(-(-rows // ROWS_PER_PART)), "rows")


def fit(df: DataFrame, candidate: Candidate, cap: float, rounds: int, seed: int = 42) -> PipelineModel:
    """Boosted trees on the log target; a model over plain feature columns."""
    assembler = VectorAssembler(inputCols=list(MODEL_COLUMNS), outputCol="features")
    with Scratch(df.sparkSession, "fit") as scratch:
        rows = spread_rows(df.select(*S.FEATURES, S.LABEL), scratch)
        frame = with_model_columns(rows).withColumn("target", to_log_target(F.col(S.LABEL), cap))
        return Pipeline(stages=[assembler, _regressor(candidate, rounds, seed)]).fit(frame)


def score(df: DataFrame, model: PipelineModel, cap: float, output: str = "prediction_seconds") -> DataFrame:
    """Append the prediction in seconds, held inside ``[0, min(cap, one day)]``."""
    limit = min(float(cap), S.MAX_PREDICTION_SECONDS)
    scored = model.transform(with_model_columns(df.withColumns({f"_in_{c}": F.col(c) for c in COLD_START})))
    return (
        scored.withColumn(output, from_log_target(F.col("prediction_log"), limit))
        .withColumns({c: F.col(f"_in_{c}") for c in COLD_START})
        .drop("features", "prediction_log", *[f"_in_{c}" for c in COLD_START], *[f"{c}_missing" for c in COLD_START])
    )


def score_batches(df: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], keys: Sequence[str],
                  cap: float, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """Score with any external model: ``load`` runs once per task, batches arrive as float32.

    ``load()`` returns a function from a matrix to log-space predictions, for
    instance one that wraps an ONNX session.
    """
    limit = min(float(cap), S.MAX_PREDICTION_SECONDS)
    names, key_names = list(features), list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            out = batch[key_names].copy()
            log = np.asarray(predict(batch[names].to_numpy(dtype=np.float32))).reshape(-1)
            out["prediction_seconds"] = np.clip(np.expm1(log), 0.0, limit).astype("float64")
            yield out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*key_names).schema)
    return df.select(*key_names, *names).mapInPandas(run, f"{fields}, prediction_seconds double")


def fit_stopped(train: DataFrame, validation: DataFrame, candidate: Candidate, cap: float, rounds: int, patience: int) -> tuple[PipelineModel, dict]:
    """A model cut at its best round, and how boosting went.

    Boosting goes on in blocks that double until ``patience`` rounds bring nothing better on the validation rows. Trees follow
    from the seed and the rows, so fitting again with as many rounds as were best gives the same first trees.
    """
    tried = min(rounds, 2 * patience)
    while True:
        model = fit(train, candidate, cap, tried)
        trees: GBTRegressionModel = model.stages[-1]
        assembled = model.stages[0].transform(with_model_columns(validation)).withColumn("target", to_log_target(F.col(S.LABEL), cap))
        losses = trees.evaluateEachIteration(assembled, "absolute")
        best, stopped = stopping_round(losses, patience)
        if stopped or tried == rounds:
            break
        tried = min(rounds, 2 * tried)
    cut = model if best == tried else fit(train, candidate, cap, best)
    return cut, {"best_iteration": best, "rounds": tried, "stopped_early": stopped, "log_loss": float(losses[best - 1])}


def stopping_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The best round before ``patience`` rounds without a better one, 1-based, and whether those were seen."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def search(train: DataFrame, validation: DataFrame, cap: float, candidates: Sequence[Candidate] = CANDIDATES,
           rounds: int = MAX_ROUNDS, patience: int = PATIENCE, parallel: int = 4) -> tuple[Candidate, int, list[dict]]:
    """Fit every candidate with early stopping; the lowest capped MAE wins and the first wins ties.

    Both sides are written to the shared folder first: every boosting round reads them again. ``parallel``
    candidates share the cluster, as a round of a small sample leaves most of it idle. Returns the winner, its
    best number of rounds and one report per candidate, all judged with the ensemble cut at its best round.
    """
    spark = train.sparkSession
    with Scratch(spark, "search") as scratch:
        train = scratch.keep(train.select(*S.FEATURES, S.LABEL), "train")
        validation = scratch.keep(validation.select(*S.FEATURES, S.LABEL), "validation")

        def report(c: Candidate) -> dict:
            model, went = fit_stopped(train, validation, c, cap, rounds, patience)
            errors = error_metrics(score(validation, model, cap), S.LABEL, "prediction_seconds", cap).first().asDict()
            return {"name": c.name, **went, **errors}

        with ThreadPoolExecutor(parallel) as pool:
            reports = list(pool.map(inheritable_thread_target(spark)(report), candidates))
    winner = min(range(len(reports)), key=lambda i: reports[i]["mae_seconds_capped"])
    return candidates[winner], reports[winner]["best_iteration"], reports


def refit(train: DataFrame, winner: Candidate, best_iteration: int, cap: float,
          min_rounds: int = S.MIN_FINAL_ROUNDS) -> PipelineModel:
    return fit(train, winner, cap, max(min_rounds, best_iteration))
