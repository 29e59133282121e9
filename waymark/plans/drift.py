"""Compare a current matrix with the published one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waymark import settings as S
from waymark.operators.distances import drift_scores
from waymark.operators.drift import drift_report, psi
from waymark.operators.gates import coerce_matrix, drift_gate, require_clean
from waymark.sources.lake import write_json_report


def run_drift(current: DataFrame, reference: DataFrame, share: float = S.DRIFT_SHARE,
              threshold: float = S.DRIFT_PSI_THRESHOLD, snapshot_id: str | None = None,
              output: str | None = None, method: str = "psi") -> DataFrame:
    """Gate both sides, score every feature and the label by one method, and report.

    ``threshold`` holds for PSI; the other methods have their own (see :mod:`waymark.operators.distances`).
    """
    sides = {"current": coerce_matrix(current), "reference": coerce_matrix(reference)}
    rows = {name: require_clean(drift_gate(df), f"{name} drift input")["n_rows"] for name, df in sides.items()}
    if method == "psi":
        scores = psi(sides["current"], sides["reference"], threshold=threshold)
    else:
        scores = drift_scores(sides["current"], sides["reference"], method)
    report = drift_report(scores, rows["current"], rows["reference"], (*S.FEATURES, S.LABEL), share, snapshot_id)
    if output:
        write_json_report(scores, f"{output}/columns")
        write_json_report(report, f"{output}/summary")
    return report
