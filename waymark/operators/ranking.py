"""Exact global positions and order statistics without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waymark.session import Scratch, several_passes

_SKETCH_ACCURACY = 2_000
_FEW_VALUES = 100_000  # distinct values per column that may be ranked from value counts
_FEW_ROWS = 200_000  # values of one bracket that may be sorted in one task


def range_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Append the 0-based place of each row in the order of distinct keys ``order``.

    Rows are dealt to range partitions from a sample of the keys and sorted there, so a prefix that all keys share
    does not matter; a place is the rows of the partitions before plus the place inside. The sorted rows are
    written, as counts and places must come from the same partitions; one row per partition is summed up and broadcast.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    with Scratch(df.sparkSession, "positions") as scratch:
        ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
        stored = scratch.result(ordered.withColumns({"_part": F.spark_partition_id(), "_inside": inside}))
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = stored.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    return placed.select(*df.columns, (F.col("_before") + F.col("_inside")).alias(name))


def running_sums(df: DataFrame, group: str, order: str, sums: Sequence[str]) -> DataFrame:
    """Replace ``sums`` by their running sums in the order of distinct ``order`` values of each group.

    Also ``next``, the value after (NULL for the last). As :func:`range_positions`: sums inside range partitions plus the
    sums of the partitions before; one row per group and partition meets in a task.
    """
    with Scratch(df.sparkSession, "sums") as scratch:
        ordered = df.repartitionByRange(group, order).sortWithinPartitions(group, order)
        stored = scratch.result(ordered.withColumn("_part", F.spark_partition_id()))
    parts = stored.groupBy(group, "_part").agg(F.min(order).alias("_least"), *[F.sum(c).alias(f"_all_{c}") for c in sums])
    across = W.partitionBy(group).orderBy("_part")
    ahead = across.rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col(group).alias("_group"), F.col("_part").alias("_p"), F.lead("_least").over(across).alias("_follows"),
                         *[F.coalesce(F.sum(f"_all_{c}").over(ahead), F.lit(0)).alias(f"_before_{c}") for c in sums])
    inside = W.partitionBy(group, "_part").orderBy(order)
    joined = stored.join(F.broadcast(parts), (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_p")))
    return joined.select(group, order, F.coalesce(F.lead(order).over(inside), F.col("_follows")).alias("next"),
                         *[(F.col(f"_before_{c}") + F.sum(c).over(inside)).alias(c) for c in sums])


def bucket_offsets(df: DataFrame, coarse: Sequence[str], fine: Sequence[str]) -> DataFrame:
    """Rows before each (coarse, fine) bucket, with its size and the grand total.

    Only the coarse totals meet in one task; callers choose coarse buckets whose
    number does not grow with the rows (dates, first characters).
    """
    sizes = df.groupBy(*coarse, *fine).agg(F.count(F.lit(1)).alias("_size"))
    within = W.partitionBy(*coarse).orderBy(*fine).rowsBetween(W.unboundedPreceding, -1)
    totals = sizes.groupBy(*coarse).agg(F.sum("_size").alias("_coarse_size"))
    ahead = W.orderBy(*coarse)
    totals = totals.select(
        *[F.col(c).alias(f"_c_{c}") for c in coarse],
        F.coalesce(F.sum("_coarse_size").over(ahead.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"),
        F.sum("_coarse_size").over(W.partitionBy()).alias("_total"),
    )
    cond = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in coarse]
    return (
        sizes.withColumn("_before", F.coalesce(F.sum("_size").over(within), F.lit(0)))
        .join(totals, cond, "left")
        .select(*coarse, *fine, "_size", "_total", (F.col("_ahead") + F.col("_before")).alias("_offset"))
    )


def global_position(df: DataFrame, order: Sequence[Column], coarse: Sequence[str], fine: Sequence[str],
                    offsets: DataFrame | None = None, name: str = "position") -> DataFrame:
    """Append the 0-based position of each row in the total order.

    ``coarse`` and ``fine`` are columns that rise with ``order``; a row's position
    is its bucket's offset plus its rank inside the bucket. Buckets absent from
    ``offsets`` are left out.
    """
    offsets = offsets if offsets is not None else bucket_offsets(df, coarse, fine)
    keys = [*coarse, *fine]
    marks = offsets.withColumnsRenamed({k: f"_o_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    inside = W.partitionBy(*keys).orderBy(*order)
    return (
        df.join(marks, cond)
        .drop(*[f"_o_{k}" for k in keys])
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - F.lit(1))
        .drop("_offset", "_size")
    )


def order_statistics(df: DataFrame, columns: dict[str, Column], ranks: dict[str, Sequence[int]],
                     few_values: Sequence[str] = ()) -> dict[tuple[str, int], float]:
    """The values at the given 0-based ranks of each column, NULL and NaN left out.

    Columns in ``few_values`` are ranked from their value counts. For the others a
    sketch with a guaranteed rank error brackets each rank, one pass counts the rows
    around the bracket, and the search goes on strictly inside it until few rows are
    left. Each round shrinks the candidates about 500-fold, so a trillion rows need
    four rounds, and no task holds more than a bounded number of values.
    """
    names = {c: f"v{i}" for i, c in enumerate(columns)}
    frame = df.select(*[_number(v).alias(names[c]) for c, v in columns.items()])
    found: dict[tuple[str, int], float] = {}
    few = [c for c in columns if c in few_values and ranks.get(c)]
    if few:
        found.update(_from_value_counts(frame, {c: names[c] for c in few}, ranks))
    # Open bracket (low, high) with the rows at or below low -> the ranks searched in it.
    todo: dict[tuple, list[int]] = {
        (c, None, None, 0): sorted(ranks[c]) for c in columns if c not in few and ranks.get(c)}
    while todo:
        todo = _narrow(frame, names, todo, found)
    return found


def _number(value: Column) -> Column:
    as_double = value.cast("double")
    return F.when(~F.isnan(as_double), as_double)


def _from_value_counts(frame: DataFrame, names: dict[str, str], ranks: dict[str, Sequence[int]]) -> dict:
    counts = (
        frame.select(*names.values()).unpivot([], list(names.values()), "_column", "_value")
        .where("_value IS NOT NULL").groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    )
    running = counts.withColumn("_upto", F.sum("_n").over(W.partitionBy("_column").orderBy("_value")))
    wanted = [(c, r) for c in names for r in ranks[c]]
    row = running.selectExpr(*[
        f"min(CASE WHEN _column = '{names[c]}' AND _upto > {r} THEN _value END) AS p{i}" for i, (c, r) in enumerate(wanted)]).first()
    return {key: row[f"p{i}"] for i, key in enumerate(wanted)}


def sql_double(value: float) -> str:
    """A double literal that keeps every bit."""
    return f"double('{value!r}')"


def _narrow(frame: DataFrame, names: dict[str, str], todo: dict[tuple, list[int]], found: dict) -> dict[tuple, list[int]]:
    """One round: finish the small brackets, split the others around their ranks."""
    keys = list(todo)

    def inside(key: tuple) -> str:
        column, low, high, _ = key
        value = names[column]
        tests = [f"{value} IS NOT NULL"]
        if low is not None:
            tests.append(f"{value} > {sql_double(low)}")
        if high is not None:
            tests.append(f"{value} < {sql_double(high)}")
        return f"(CASE WHEN {' AND '.join(tests)} THEN {value} END)"

    sizes = frame.selectExpr(*[f"count({inside(k)}) AS n{i}" for i, k in enumerate(keys)]).first()
    size = {k: sizes[f"n{i}"] for i, k in enumerate(keys)}
    # Small brackets are sorted whole, as many per job as stay within the row limit.
    batch, held = [], 0
    for k in sorted((k for k in keys if size[k] <= _FEW_ROWS), key=lambda k: size[k]):
        if batch and held + size[k] > _FEW_ROWS:
            _read_ranks(frame, inside, batch, todo, found)
            batch, held = [], 0
        batch.append(k)
        held += size[k]
    if batch:
        _read_ranks(frame, inside, batch, todo, found)
    large = [k for k in keys if size[k] > _FEW_ROWS]
    if not large:
        return {}
    margin = 2 / _SKETCH_ACCURACY
    # Neighbouring ranks (the two sides of an interpolated quantile) share a bracket.
    units = [(k, group) for k in large for group in _neighbours(todo[k], margin * size[k])]
    sketches = []
    for i, (k, group) in enumerate(units):
        shares = (max(0.0, (group[0] - k[3]) / size[k] - margin), min(1.0, (group[-1] - k[3]) / size[k] + margin))
        sketches.append(f"percentile_approx({inside(k)}, array({', '.join(map(sql_double, shares))}), {_SKETCH_ACCURACY}) AS b{i}")
    bounds = frame.selectExpr(*sketches).first()
    counts = []
    for i, (k, _) in enumerate(units):
        value, (low, high) = inside(k), map(sql_double, bounds[f"b{i}"])
        counts += [f"count_if({value} < {low}) AS lt{i}", f"count_if({value} = {low}) AS el{i}",
                   f"count_if({value} > {low} AND {value} < {high}) AS in{i}", f"count_if({value} = {high}) AS eh{i}"]
    row = frame.selectExpr(*counts).first()
    rest: dict[tuple, list[int]] = {}
    for i, (k, group) in enumerate(units):
        column, open_low, open_high, base = k
        low, high = bounds[f"b{i}"]
        at_low = base + row[f"lt{i}"]
        above_low = at_low + row[f"el{i}"]
        at_high = above_low + row[f"in{i}"]
        above_high = at_high + (row[f"eh{i}"] if high != low else 0)
        for r in group:
            if at_low <= r < above_low:
                found[(column, r)] = low
            elif at_high <= r < above_high:
                found[(column, r)] = high
            else:
                piece = ((column, open_low, low, base) if r < at_low else (column, low, high, above_low) if r < at_high
                         else (column, high, open_high, above_high))
                rest.setdefault(piece, []).append(r)
    return rest


def _read_ranks(frame: DataFrame, inside, batch: list[tuple], todo: dict, found: dict) -> None:
    lists = frame.selectExpr(*[f"sort_array(collect_list({inside(k)})) AS l{i}" for i, k in enumerate(batch)])
    row = lists.selectExpr(*[
        f"transform(array({', '.join(str(r - k[3]) for r in todo[k])}), i -> get(l{i}, cast(i AS int))) AS a{i}"
        for i, k in enumerate(batch)]).first()
    for i, k in enumerate(batch):
        found.update({(k[0], r): v for r, v in zip(todo[k], row[f"a{i}"], strict=True)})


def _neighbours(ranks: Sequence[int], reach: float) -> list[list[int]]:
    groups: list[list[int]] = []
    for r in sorted(ranks):
        if groups and r - groups[-1][-1] <= reach:
            groups[-1].append(r)
        else:
            groups.append([r])
    return groups


def exact_quantiles(df: DataFrame, columns: dict[str, Column], fractions: Sequence[float]) -> dict[str, list]:
    """Quantiles with linear interpolation between neighbours, exact at any size.

    NULL and NaN are left out; a column without values gives ``None``.
    """
    slim = df.select(*[_number(v).alias(f"q{i}") for i, v in enumerate(columns.values())])
    with several_passes(slim) as frame:
        return _quantiles(frame, {c: F.col(f"q{i}") for i, c in enumerate(columns)}, fractions)


def _quantiles(df: DataFrame, columns: dict[str, Column], fractions: Sequence[float]) -> dict[str, list]:
    probe = df.agg(*[c for i, v in enumerate(columns.values()) for c in (
        F.count(v).alias(f"n{i}"), F.approx_count_distinct(v, 0.05).alias(f"d{i}"))]).first()
    counts = {c: probe[f"n{i}"] for i, c in enumerate(columns)}
    few = [c for i, c in enumerate(columns) if probe[f"d{i}"] <= _FEW_VALUES]
    ranks = {}
    for c, n in counts.items():
        if n:
            lows = [int((n - 1) * f) for f in fractions]
            ranks[c] = sorted({r for low in lows for r in (low, min(low + 1, n - 1))})
    stats = order_statistics(df, {c: columns[c] for c in ranks}, ranks, few)
    out = {}
    for c, n in counts.items():
        if not n:
            out[c] = [None for _ in fractions]
            continue
        values = []
        for f in fractions:
            place = (n - 1) * f
            low = int(place)
            a, b = stats[(c, low)], stats[(c, min(low + 1, n - 1))]
            values.append(a + (b - a) * (place - low))
        out[c] = values
    return out
