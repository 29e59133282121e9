"""Gate, split, search, refit and evaluate on the training matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.functions.times import epoch_second
from waymark.operators.contract import contract_violations, latest_contract
from waymark.operators.gates import contract_gate, model_input_gate, require_clean, train_gate
from waymark.operators.metrics import baseline_metrics, error_metrics, label_cap
from waymark.operators.scoring import CANDIDATES, Candidate, refit, score, search
from waymark.operators.splits import nested_split
from waymark.sources.lake import Lake


def sample_keys(df: DataFrame) -> DataFrame:
    """Buckets that rise with (as_of_ts, trip_id): the second, then the first id character."""
    return df.withColumns({"_second": epoch_second(F.col("as_of_ts")), "_head": F.substring("trip_id", 1, 2)})


SAMPLE_ORDER = ("as_of_ts", "trip_id")
SAMPLE_COARSE = ("as_of_date",)
SAMPLE_FINE = ("_second", "_head")


def train(matrix: DataFrame, sample_rows: int, rounds: int, candidates: Sequence[Candidate] = CANDIDATES,
          test_start: str = S.TEST_START_DATE, min_rounds: int = S.MIN_FINAL_ROUNDS, contract: dict | None = None) -> dict:
    """The whole training flow; returns the model, the cap and all reports.

    With a loaded ``contract`` the matrix is held against what that says, else against the versions of this release.
    """
    require_clean(contract_gate(matrix, contract) if contract else train_gate(matrix), "training matrix")
    require_clean(model_input_gate(matrix), "model input")
    parts = nested_split(sample_keys(matrix), sample_rows, [F.col(c) for c in SAMPLE_ORDER], SAMPLE_COARSE, SAMPLE_FINE,
                         test_start)
    cap, median = label_cap(parts["train"], S.LABEL)
    winner, best_iteration, reports = search(parts["search_train"], parts["search_judged"], cap, candidates, rounds)
    model = refit(parts["train"], winner, best_iteration, cap, min_rounds)
    evaluated = {
        name: error_metrics(score(parts[name], model, cap), S.LABEL, "prediction_seconds", cap).first().asDict()
        for name in ("inner_validation", "test")
    }
    baseline = baseline_metrics(parts["train"], parts["test"], S.LABEL).first().asDict()
    return {"model": model, "label_cap": cap, "train_median": median, "winner": winner.name,
            "best_iteration": best_iteration, "candidates": reports, "metrics": evaluated, "baseline": baseline}


def load_training_inputs(lake: Lake) -> tuple[DataFrame, dict]:
    """The matrix in contract order and its newest, checked contract."""
    contracts = latest_contract(lake.read(S.GOLD_CONTRACTS, S.CONTRACT_COLUMNS)).where(
        F.col("feature_version") == S.FEATURE_VERSION)
    broken = contract_violations(contracts).first()
    if broken is None:
        raise ValueError(f"no contract for {S.FEATURE_VERSION}")
    if broken["violations"]:
        raise ValueError(f"contract is not usable: {broken['violations']}")
    return lake.read(S.GOLD_MATRIX, S.MATRIX_COLUMNS), contracts.first().asDict()
