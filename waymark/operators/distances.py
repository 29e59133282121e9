"""Two-sample statistics per column: Kolmogorov-Smirnov, chi-square, Jensen-Shannon and Wasserstein.

Each side is reduced to counts per value before the sides meet. Statistics over ordered values come from running sums
over range partitions, so no column is sorted in one task and nothing is sampled. NULL and NaN numbers are left out; a
NULL category is a category. A statistic of a column without rows on one side is NULL and no drift.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.operators.drift import decile_edges, histograms, psi
from waymark.operators.ranking import running_sums

#: A test drifts below this probability, a distance from this value on.
LEAST_P, LEAST_DISTANCE = 0.05, 0.1
#: The method for the other kind of column when one method is asked for.
NUMERIC = {"psi": "psi", "jensenshannon": "jensenshannon", "ks": "ks", "wasserstein": "wasserstein", "chisquare": "ks"}
CATEGORICAL = {"psi": "psi", "jensenshannon": "jensenshannon", "ks": "chisquare", "wasserstein": "jensenshannon", "chisquare": "chisquare"}
_KS_TERMS = 100


def value_counts(current: DataFrame, reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, value, c, r`` of numeric columns."""
    def side(df: DataFrame, c: int, r: int) -> DataFrame:
        values = df.select(*[F.col(x).cast("double").alias(x) for x in columns]).unpivot([], list(columns), "column_name", "value")
        values = values.where(F.col("value").isNotNull() & ~F.isnan("value"))
        return values.groupBy("column_name", "value").agg((F.count(F.lit(1)) * c).alias("c"), (F.count(F.lit(1)) * r).alias("r"))

    both = side(current, 1, 0).unionByName(side(reference, 0, 1))
    return both.groupBy("column_name", "value").agg(F.sum("c").alias("c"), F.sum("r").alias("r"))


def ks_probability(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided probability of a distance as large, with Stephens' correction."""
    size = F.sqrt(n * m / (n + m))
    x = (size + 0.12 + 0.11 / size) * d
    terms = F.transform(F.sequence(F.lit(1), F.lit(_KS_TERMS)), lambda j: F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * x * x))
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    return F.when(x < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))  # the series needs x away from 0


def ordered_distances(current: DataFrame, reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column the largest gap between the distribution functions and the area between them."""
    counts = value_counts(current, reference, columns)
    totals = counts.groupBy("column_name").agg(
        F.sum("c").alias("n_c"), F.sum("r").alias("n_r"), F.sum(F.col("r") * F.col("value")).alias("_s"), F.sum(F.col("r") * F.col("value") * F.col("value")).alias("_q"))
    upto = running_sums(counts, "column_name", "value", ["c", "r"]).join(F.broadcast(totals), "column_name")  # one row per column
    gap = F.abs(F.try_divide("c", "n_c") - F.try_divide("r", "n_r"))
    mean = F.try_divide("_s", "n_r")
    spread = F.sqrt(F.greatest(F.try_divide("_q", "n_r") - mean * mean, F.lit(0.0)))
    found = upto.groupBy("column_name", "n_c", "n_r", spread.alias("spread")).agg(
        F.max(gap).alias("ks"), F.coalesce(F.sum(gap * (F.col("next") - F.col("value"))), F.lit(0.0)).alias("area"))
    known = (F.col("n_c") > 0) & (F.col("n_r") > 0)
    return found.select("column_name", "n_c", "n_r", F.when(known, F.col("ks")).alias("ks"),
                        F.when(known, F.col("area") / F.greatest("spread", F.lit(1e-3))).alias("wasserstein"))


def binned_distances(counts: DataFrame) -> DataFrame:
    """Per column of ``column_name, bin, n_current, n_reference`` the chi-square statistic of the two rows of counts and the Jensen-Shannon distance."""
    counts = counts.where(F.col("bin").isNotNull() & (F.col("n_current") + F.col("n_reference") > 0))
    totals = counts.groupBy("column_name").agg(F.sum("n_current").alias("tc"), F.sum("n_reference").alias("tr"), F.count(F.lit(1)).alias("bins"))
    joined = counts.join(F.broadcast(totals.where("tc > 0 and tr > 0")), "column_name")
    c, r = F.col("n_current"), F.col("n_reference")
    scaled = F.sqrt(F.col("tr") / F.col("tc")) * c - F.sqrt(F.col("tc") / F.col("tr")) * r
    p, q = c / F.col("tc"), r / F.col("tr")
    middle = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / middle)).otherwise(0.0)

    return joined.groupBy("column_name", "bins").agg(
        F.sum(scaled * scaled / (c + r)).alias("chisquare"), F.sqrt(F.greatest(F.sum(part(p) + part(q)) / 2, F.lit(0.0))).alias("jensenshannon"))


def chisquare_is_large(statistic: Column, freedom: Column) -> Column:
    """Whether the probability is below ``LEAST_P``, by the cube-root normal approximation."""
    freedom = F.nullif(freedom, F.lit(0))  # a column with one bin has no freedom and does not drift
    spread = 2 / (9 * freedom)
    return ((F.pow(statistic / freedom, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread) > 1.6448536269514722)


def drift_scores(current: DataFrame, reference: DataFrame, method: str = "psi", categorical: Sequence[str] = S.CATEGORICAL_FEATURES,
                 numeric: Sequence[str] = (*S.NUMERIC_FEATURES, S.LABEL), threshold: float | None = None) -> DataFrame:
    """``column_name, kind, method, statistic, p_value, drifted`` of every column by the method or its counterpart.

    ``threshold`` replaces ``LEAST_DISTANCE`` for distances. Only what the method needs is computed.
    """
    if method not in NUMERIC:
        raise ValueError(f"unknown drift method {method}; choose one of {sorted(NUMERIC)}")
    least, rows = LEAST_DISTANCE if threshold is None else threshold, []
    for kind, columns, how in (("numeric", list(numeric), NUMERIC[method]), ("categorical", list(categorical), CATEGORICAL[method])):
        if not columns:
            continue
        none = F.lit(None).cast("double")
        if how in ("ks", "wasserstein"):
            found = ordered_distances(current, reference, columns)
            p = ks_probability(F.col("ks"), F.col("n_c"), F.col("n_r")) if how == "ks" else none
            drifted = p < LEAST_P if how == "ks" else F.col(how) >= least
        elif how == "psi":
            found = psi(current, reference, columns if kind == "categorical" else (), columns if kind == "numeric" else ())
            p, drifted = none, F.col("psi") >= least
        else:
            edges = decile_edges(reference, columns) if kind == "numeric" else {}
            found = binned_distances(histograms(current, reference, columns if kind == "categorical" else (), edges))
            p = none
            drifted = chisquare_is_large(F.col("chisquare"), F.col("bins") - 1) if how == "chisquare" else F.col(how) >= least
        rows.append(found.select("column_name", F.lit(kind).alias("kind"), F.lit(how).alias("method"), F.col(how).cast("double").alias("statistic"),
                                 p.alias("p_value"), F.coalesce(drifted, F.lit(False)).alias("drifted")))
    return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
