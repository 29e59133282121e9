"""Query registration and the small dialect differences of the fixtures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


class SparkDialect:
    sha = staticmethod(lambda x: f"sha2({x}, 256)")
    dow = staticmethod(lambda ts: f"dayofweek({ts})")
    text = staticmethod(lambda x: f"cast({x} AS string)")
    add_seconds = staticmethod(lambda ts, n: f"timestampadd(SECOND, cast({n} AS int), {ts})")


class DuckDialect:
    sha = staticmethod(lambda x: f"sha256({x})")
    dow = staticmethod(lambda ts: f"cast(dayofweek({ts}) + 1 AS int)")
    text = staticmethod(lambda x: f"cast({x} AS varchar)")
    add_seconds = staticmethod(lambda ts, n: f"({ts} + to_seconds(cast({n} AS bigint)))")


def select(exprs: Callable[[type], dict[str, str]], source: str) -> str:
    """The DuckDB statement of a fixture given as alias -> expression."""
    return "SELECT " + ", ".join(f"{e} AS {a}" for a, e in exprs(DuckDialect).items()) + f" FROM {source}"


def spark_select(df: DataFrame, exprs: Callable[[type], dict[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {a}" for a, e in exprs(SparkDialect).items()])
