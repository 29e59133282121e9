"""Point-in-time trailing aggregates that stay linear on hot keys.

A RANGE window over raw rows puts a whole key in one task and re-reads its frame
for every row. Here rows are first summed per (key, second) with map-side
combine, and the timeline is cut into chunks (a day by default). The frame
``[t - W, t - 1]`` is then the sum of three parts:

* head: seconds of t's own chunk before t,
* middle: whole chunks between, from one total per (key, chunk),
* tail: seconds of the chunk W earlier, from t's offset onwards.

Each part is a running sum, so the work per task is bounded by the number of
seconds in a chunk, however many rows a key holds. Nothing is subtracted, so a
NaN or a very large value only touches the frames it belongs to.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NULL_SECOND = -(2**60)  # rows without a time see exactly their own peers


@dataclass(frozen=True)
class Trailing:
    """One feature: ``agg`` of ``value`` per ``keys`` over the last ``seconds``."""

    name: str
    keys: tuple[str, ...]
    seconds: int
    agg: str  # "avg", "sum" or "count"
    value: str | None = None
    default: float | None = None


def trailing_features(df: DataFrame, second: Column, specs: Sequence[Trailing],
                      chunk_seconds: int = 86_400) -> DataFrame:
    """Append one double column per spec; the current second is never included."""
    for spec in specs:
        if spec.seconds % chunk_seconds or spec.seconds <= 0:
            raise ValueError(f"{spec.name}: {spec.seconds} s is not a multiple of {chunk_seconds} s")
    plain = {k: _plain_key(df, k) for spec in specs for k in spec.keys}
    timed = df.select("*", F.coalesce(second, F.lit(_NULL_SECOND)).alias("_sec"),
                      *[F.expr(f"{e} AS `{name}`") for parts in plain.values() for name, e in parts.items()])
    by_keys: dict[tuple[str, ...], list[Trailing]] = {}
    for spec in specs:
        by_keys.setdefault(tuple(name for k in spec.keys for name in plain[k]), []).append(spec)
    tables = sorted(
        ((keys, _features_per_second(timed, keys, group, chunk_seconds)) for keys, group in by_keys.items()),
        key=lambda kt: -len(kt[0]),
    )
    # Fold narrower key sets into the widest one first: those joins run on summed
    # rows, so the raw rows are shuffled once, not once per key set.
    widest, feature_table = tables[0]
    left = []
    for keys, table in tables[1:]:
        if set(keys) <= set(widest):
            feature_table = feature_table.join(table, ["_sec", *keys], "left")
        else:
            left.append((keys, table))
    out = timed.join(feature_table, ["_sec", *widest], "left")
    for keys, table in left:
        out = out.join(table, ["_sec", *keys], "left")
    return out.select(*df.columns, *[spec.name for spec in specs])


def _plain_key(df: DataFrame, key: str) -> dict[str, str]:
    """The key as columns that are never NULL.

    Plain equality then treats NULL keys as one group and lets windows and joins
    share one partitioning.
    """
    kind = df.schema[key].dataType
    value = f"`{key}`" if isinstance(kind, T.NumericType | T.StringType) else f"cast(`{key}` AS string)"
    if not df.schema[key].nullable:
        return {f"_k_{key}": value}
    blank = "0" if isinstance(kind, T.NumericType) else "''"
    return {f"_k_{key}": f"coalesce({value}, {blank})", f"_z_{key}": f"`{key}` IS NULL"}


def _measures(spec: Trailing) -> dict[str, str]:
    """The running sums one feature needs, by name."""
    if spec.agg == "count":
        return {"n_rows": "count(1)"}
    return {f"s_{spec.value}": f"sum(`{spec.value}`)", f"n_{spec.value}": f"count(`{spec.value}`)"}


def _features_per_second(df: DataFrame, keys: Sequence[str], specs: Sequence[Trailing], chunk: int) -> DataFrame:
    by = ", ".join(f"`{k}`" for k in keys)
    measures = {name: agg for spec in specs for name, agg in _measures(spec).items()}
    needed = list(dict.fromkeys((m, spec.seconds // chunk) for spec in specs for m in _measures(spec)))
    spans = sorted({span for _, span in needed})

    grain = (
        df.groupBy(*keys, "_sec").agg(*[F.expr(f"{agg} AS `{name}`") for name, agg in measures.items()])
        .selectExpr("*", f"pmod(_sec, {chunk}) AS _off", f"(_sec - pmod(_sec, {chunk})) div {chunk} AS _chunk")
    )

    # Each summed row also visits the chunks that are one window length later, where
    # it may belong to the tail.
    lags = ", ".join(str(x) for x in (0, *spans))
    spread = grain.selectExpr("* EXCEPT (_chunk)", "_chunk AS _own", f"explode(array({lags})) AS _lag").selectExpr(
        "* EXCEPT (_own)", "_own + _lag AS _chunk")
    # One own row (_lag 0) per offset; visiting rows of the same offset sort before it in
    # the descending order, so plain ROWS frames are exact.
    before = f"(PARTITION BY {by}, _chunk ORDER BY _off, _lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    onwards = f"(PARTITION BY {by}, _chunk ORDER BY _off DESC, _lag DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    edges = spread.selectExpr(
        "*",
        *[f"sum(CASE WHEN _lag = 0 THEN `{m}` END) OVER {before} AS `head_{m}`" for m in measures],
        *[f"sum(CASE WHEN _lag = {s} THEN `{m}` END) OVER {onwards} AS `tail_{m}_{s}`" for m, s in needed],
    ).where("_lag = 0")

    totals = grain.groupBy(*keys, "_chunk").agg(*[F.expr(f"sum(`{m}`) AS `{m}`") for m in measures])
    middles = totals.selectExpr(
        *[f"`{k}`" for k in keys], "_chunk",
        *[f"sum(`{m}`) OVER (PARTITION BY {by} ORDER BY _chunk RANGE BETWEEN {s - 1} PRECEDING AND 1 PRECEDING) AS `mid_{m}_{s}`"
          for m, s in needed if s > 1],
    )
    joined = edges.join(middles, [*keys, "_chunk"], "left")

    def in_frame(m: str, s: int) -> str:
        parts = [f"head_{m}", f"tail_{m}_{s}"] + ([f"mid_{m}_{s}"] if s > 1 else [])
        total = " + ".join(f"coalesce(`{p}`, 0)" for p in parts)
        return f"(CASE WHEN _sec = {_NULL_SECOND} THEN `{m}` ELSE {total} END)"

    def feature(spec: Trailing) -> str:
        sums = [in_frame(m, spec.seconds // chunk) for m in _measures(spec)]
        if spec.agg == "avg":
            value = f"CASE WHEN {sums[1]} > 0 THEN cast({sums[0]} AS double) / {sums[1]} END"
        elif spec.agg == "sum":
            value = f"CASE WHEN {sums[1]} > 0 THEN cast({sums[0]} AS double) END"
        else:
            value = f"cast({sums[0]} AS double)"
        if spec.default is not None:
            value = f"coalesce({value}, double('{spec.default}'))"
        return f"{value} AS `{spec.name}`"

    return joined.selectExpr(*[f"`{k}`" for k in keys], "_sec", *[feature(s) for s in specs])
