"""Gates, splits, sampling, levels, label statistics, errors, candidate search and drift."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from waymark import settings as S
from waymark.catalog import fixtures as X
from waymark.catalog.registry import query, table
from waymark.functions.columns import keep_known
from waymark.operators.contract import build_contract, latest_contract
from waymark.operators.distances import drift_scores
from waymark.operators.drift import drift_report, psi
from waymark.operators.gates import (coerce_matrix, contract_gate, drift_gate, matrix_gate, model_input, model_input_gate, train_gate,
                                     training_frame)
from waymark.operators.metrics import (baseline_metrics, error_metrics, from_log_target, label_cap, prediction_parity,
                                       to_log_target)
from waymark.operators.scoring import CANDIDATES, MAX_ROUNDS, fit, score, search
from waymark.operators.splits import (category_levels, encode_by_join, even_sample, fraction_cutoff, nested_split,
                                      rows_per_date, split_by_date, split_by_fraction)

from waymark.plans.training import SAMPLE_COARSE, SAMPLE_FINE, SAMPLE_ORDER, sample_keys
from waymark.session import scratch_dir
from waymark.sources.lake import Lake

L = S.LABEL
TEST_START = "2024-01-24"

# --- gates ------------------------------------------------------------------------------------

_NAN7 = "avg_duration_7d_zone_hour"


@query("gold_gate", f"""
WITH m AS ({X.BROKEN_MATRIX})
SELECT count(*) AS n_rows, count(*) FILTER (pickup_ts IS NULL OR as_of_ts IS NULL) AS null_ts,
  count(*) FILTER (pickup_ts <> as_of_ts) AS ts_mismatch,
  count(*) FILTER (cast(pickup_ts AS date) <> as_of_date) AS date_mismatch,
  count(*) FILTER (trip_id IS NULL OR length(trip_id) <> 64) AS bad_trip_id,
  count(*) FILTER (schema_version IS DISTINCT FROM '{S.SCHEMA_VERSION}' OR feature_version IS DISTINCT FROM '{S.FEATURE_VERSION}') AS bad_version,
  count(*) FILTER ({L} IS NULL OR isnan({L}) OR {L} < 1) AS bad_label,
  count(*) FILTER (coalesce(NOT (pickup_hour BETWEEN 0 AND 23 AND pickup_dow BETWEEN 1 AND 7 AND pickup_month BETWEEN 1 AND 12
    AND pickup_is_weekend IN (0, 1) AND pickup_borough_id BETWEEN 0 AND 6 AND dropoff_borough_id BETWEEN 0 AND 6
    AND pickup_zone_id >= 0 AND dropoff_zone_id >= 0 AND pickup_service_zone_id BETWEEN 0 AND 2
    AND dropoff_service_zone_id BETWEEN 0 AND 2 AND route_pair_id BETWEEN 0 AND 4096
    AND trip_count_90d_zone_hour >= 0), true)) AS out_of_range,
  (SELECT count(*) FROM (SELECT trip_id FROM m GROUP BY trip_id HAVING count(*) > 1)) AS duplicate_ids
FROM m""")
def gold_gate(spark, sf):
    return matrix_gate(X.matrix(spark, sf, broken=True), n_service_zones=2)


def _single(column: str, expected: str, name: str) -> str:
    return (f"cast(count(*) FILTER ({column} IS NULL) > 0 OR min({column}) <> max({column}) "
            f"OR min({column}) <> '{expected}' AS bigint) AS {name}")


_VERSIONS = (_single("schema_version", S.SCHEMA_VERSION, "bad_schema_version") + ", "
             + _single("feature_version", S.FEATURE_VERSION, "bad_feature_version"))
_REQUIRED = [c for c in S.MATRIX_COLUMNS if c not in (_NAN7, "avg_fare_30d_zone")]


_TRAIN_COUNTS = f"""SELECT count(*) AS n_rows,
  count(*) FILTER (cast(as_of_ts AS date) IS DISTINCT FROM as_of_date) AS date_mismatch,
  count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in _REQUIRED)} OR isnan({L}) OR isnan(trip_count_90d_zone_hour)) AS null_required,
  count(*) FILTER (pickup_hour NOT BETWEEN 0 AND 23 OR pickup_dow NOT BETWEEN 1 AND 7 OR pickup_month NOT BETWEEN 1 AND 12
    OR pickup_is_weekend NOT IN (0, 1)) AS bad_calendar,
  count(*) FILTER (NOT coalesce({L} > 0 AND NOT isnan({L}), false)) AS label_not_positive,
  count(*) FILTER ({' OR '.join(f'coalesce({c} < 0, false)' for c in S.FEATURES if c.endswith('_id') or c.startswith('trip_count'))}) AS negative_code,
  count(*) FILTER (coalesce({_NAN7} < 0, false) OR coalesce(avg_fare_30d_zone < 0, false)) AS negative_history,
  count(*) FILTER (coalesce(isinf({_NAN7}), false) OR coalesce(isinf(avg_fare_30d_zone), false)) AS infinite_history,
  {_VERSIONS}"""


@query("train_gate", f"{_TRAIN_COUNTS} FROM ({X.BROKEN_MATRIX}) m")
def training_gate(spark, sf):
    return train_gate(X.matrix(spark, sf, broken=True))


_CODES = {"pickup_borough_id": 6, "dropoff_borough_id": 6, "pickup_service_zone_id": 1, "dropoff_service_zone_id": 1, "route_pair_id": S.ROUTE_BUCKETS}


@query("contract_gate", f"""{_TRAIN_COUNTS},
  count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in _REQUIRED)}) AS null_declared,
  count(*) FILTER (coalesce(NOT (pickup_zone_id >= 0 AND dropoff_zone_id >= 0 AND {' AND '.join(f'{c} BETWEEN 0 AND {n}' for c, n in _CODES.items())}), true)) AS outside_domain
FROM ({X.BROKEN_MATRIX}) m""")
def matrix_by_contract(spark, sf):
    """A contract that knows one service zone, written, read back and held against the matrix."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    row = build_contract(spark, run_id="r", gold_table="g", silver_table="s", snapshot_id="1", rows=1, service_zones=["A"],
                         created_ts=datetime(2024, 1, 1))
    lake.append(row, S.GOLD_CONTRACTS, ["feature_version"], "r")
    contract = latest_contract(lake.read(S.GOLD_CONTRACTS, S.CONTRACT_COLUMNS)).first().asDict()
    return contract_gate(X.matrix(spark, sf, broken=True), contract)


_NUMERIC = (*S.NUMERIC_FEATURES, L)


@query("drift_gate", f"""
SELECT count(*) AS n_rows, count(*) FILTER (trip_id IS NULL) AS null_id, count(*) FILTER (as_of_ts IS NULL) AS null_as_of_ts,
  count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in _NUMERIC)}) AS null_numeric,
  count(*) FILTER ({' OR '.join(f'coalesce(isinf({c}), false)' for c in _NUMERIC)}) AS infinite_numeric,
  count(*) FILTER ({L} <= 0) AS label_not_positive, {_VERSIONS}
FROM ({X.BROKEN_MATRIX}) m""")
def drift_input_gate(spark, sf):
    return drift_gate(X.matrix(spark, sf, broken=True))


@query("model_input_gate", f"""
SELECT count(*) AS n_rows, count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in S.CATEGORICAL_FEATURES)}) AS null_category,
  count(*) FILTER ({' OR '.join(f'coalesce(isinf({c}), false)' for c in S.NUMERIC_FEATURES)}) AS infinite_number
FROM ({X.BROKEN_MATRIX}) m""")
def input_gate(spark, sf):
    return model_input_gate(X.matrix(spark, sf, broken=True))


@query("model_input", f"""
SELECT {', '.join(f'cast({c} AS int) AS {c}' for c in S.CATEGORICAL_FEATURES)},
  cast(nullif({_NAN7}, 'NaN'::double) AS float)::double AS {_NAN7},
  cast(avg_fare_30d_zone AS float)::double AS avg_fare_30d_zone,
  cast(trip_count_90d_zone_hour AS float)::double AS trip_count_90d_zone_hour FROM ({X.MATRIX}) m""")
def model_inputs(spark, sf):
    out = model_input(X.matrix(spark, sf))
    doubles = out.withColumns({c: F.col(c).cast("double") for c in S.NUMERIC_FEATURES})
    return doubles.withColumn(_NAN7, F.when(~F.isnan(_NAN7), F.col(_NAN7)))


@query("coerce_matrix", f"""
SELECT trip_id, pickup_ts, as_of_date, cast(pickup_hour AS bigint) AS pickup_hour,
  try_cast('x' || pickup_zone_id AS bigint) AS pickup_zone_id, {L} FROM ({X.MATRIX}) m""")
def lenient_matrix(spark, sf):
    messy = X.matrix(spark, sf).select(
        "trip_id", F.col("pickup_ts").cast("string").alias("pickup_ts"), F.col("as_of_date").cast("string").alias("as_of_date"),
        F.col("pickup_hour").cast("string").alias("pickup_hour"),
        F.concat(F.lit("x"), F.col("pickup_zone_id").cast("string")).alias("pickup_zone_id"), L, F.lit(1).alias("unknown"))
    return coerce_matrix(keep_known(messy, S.MATRIX_COLUMNS))


# --- splits and samples -------------------------------------------------------------------------

@query("rows_per_date", "SELECT cast(o_orderdate AS date) AS as_of_date, count(*) AS n_rows FROM orders GROUP BY 1")
def order_dates(spark, sf):
    return rows_per_date(dated_orders(spark, sf))


def dated_orders(spark, sf):
    return table(spark, sf, "orders").withColumn("as_of_date", F.to_date("o_orderdate"))


def _sides(**sides):
    out = None
    for name, df in sides.items():
        part = rows_per_date(df).withColumn("side", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


_ORDERS = "SELECT *, cast(o_orderdate AS date) AS as_of_date FROM orders"


@query("split_fixed_date", f"""
SELECT CASE WHEN as_of_date < DATE '1999-01-07' THEN 'train' ELSE 'test' END AS side, as_of_date, count(*) AS n_rows
FROM ({_ORDERS}) GROUP BY ALL""")
def split_fixed_date(spark, sf):
    train, test = split_by_date(dated_orders(spark, sf), "1999-01-07")
    return _sides(train=train, test=test)


def _cutoff_sql(source: str, keep: float) -> str:
    return f"""(SELECT min(as_of_date) FROM (
  SELECT as_of_date, sum(n) OVER (ORDER BY as_of_date) AS c, sum(n) OVER () AS t,
    row_number() OVER (ORDER BY as_of_date) AS p, count(*) OVER () AS d
  FROM (SELECT as_of_date, count(*) AS n FROM ({source}) GROUP BY 1))
WHERE d >= 2 AND (c >= greatest(1, least(t - 1, cast(round_even(cast(t AS double) * {keep}::double, 0) AS bigint))) OR p >= d - 1))"""


@query("fraction_cutoff", f"SELECT {_cutoff_sql(_ORDERS, 0.9)} AS cutoff_date")
def order_cutoff(spark, sf):
    return fraction_cutoff(dated_orders(spark, sf), 0.9)


@query("split_fraction", f"""
SELECT CASE WHEN as_of_date <= {_cutoff_sql(_ORDERS, 0.8)} THEN 'left' ELSE 'right' END AS side, as_of_date, count(*) AS n_rows
FROM ({_ORDERS}) GROUP BY ALL""")
def split_fraction(spark, sf):
    left, right = split_by_fraction(dated_orders(spark, sf), 0.8)
    return _sides(left=left, right=right)


def _sample_sql(source: str, order: str, m: int, columns: str) -> str:
    """Positions int(i * (n-1)/(m-1)) in doubles, the last one exactly n-1."""
    return f"""
WITH src AS ({source}), r AS (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS pos, count(*) OVER () AS n FROM src),
want AS (SELECT CASE WHEN i = {m} - 1 THEN n - 1
    ELSE cast(floor(cast(i AS double) * (cast(n - 1 AS double) / {m - 1}::double)) AS bigint) END AS pos
  FROM range({m}) t(i), (SELECT count(*) AS n FROM src))
SELECT {columns} FROM r WHERE n <= {m} OR pos IN (SELECT pos FROM want)"""


@query("even_sample", _sample_sql("SELECT o_orderkey, o_orderdate FROM orders", "o_orderdate, o_orderkey", 777, "o_orderkey, o_orderdate"))
def sample_orders(spark, sf):
    orders = dated_orders(spark, sf).select("o_orderkey", "o_orderdate", "as_of_date").withColumn(
        "_block", F.floor(F.col("o_orderkey") / 512))
    picked = even_sample(orders, [F.col("o_orderdate"), F.col("o_orderkey")], 777, ["as_of_date"], ["_block"])
    return picked.select("o_orderkey", "o_orderdate")


def _nested(spark, sf):
    m = sample_keys(X.matrix(spark, sf).select("trip_id", "as_of_ts", "as_of_date"))
    return nested_split(m, 500, [F.col(c) for c in SAMPLE_ORDER], SAMPLE_COARSE, SAMPLE_FINE, TEST_START)


_TRAIN = f"SELECT trip_id, as_of_ts, as_of_date FROM ({X.MATRIX}) m WHERE as_of_date < DATE '{TEST_START}'"
_INNER = f"SELECT * FROM ({_TRAIN}) WHERE as_of_date <= {_cutoff_sql(_TRAIN, S.INNER_KEEP_FRACTION)}"
_SAMPLED = _sample_sql(_INNER, "as_of_ts, trip_id", 500, "trip_id, as_of_date")


@query("nested_split", f"""
WITH tr AS ({_TRAIN}), inn AS ({_INNER}), sam AS ({_SAMPLED}), cut AS (SELECT {_cutoff_sql('SELECT * FROM sam', S.SEARCH_KEEP_FRACTION)} AS c)
SELECT 'test' AS side, as_of_date, count(*) AS n_rows FROM ({X.MATRIX}) m WHERE as_of_date >= DATE '{TEST_START}' GROUP BY ALL
UNION ALL SELECT 'inner_train', as_of_date, count(*) FROM inn GROUP BY ALL
UNION ALL SELECT 'inner_validation', as_of_date, count(*) FROM tr WHERE as_of_date > (SELECT max(as_of_date) FROM inn) GROUP BY ALL
UNION ALL SELECT 'search_train', as_of_date, count(*) FROM sam, cut WHERE as_of_date <= c GROUP BY ALL
UNION ALL SELECT 'search_validation', as_of_date, count(*) FROM sam, cut WHERE as_of_date > c GROUP BY ALL""")
def nested(spark, sf):
    parts = _nested(spark, sf)
    return _sides(**{k: parts[k] for k in ("test", "inner_train", "inner_validation", "search_train", "search_validation")})


# --- levels ----------------------------------------------------------------------------------------

_LEVEL_COLUMNS = S.CATEGORICAL_FEATURES


@query("category_levels", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, level, cast(row_number() OVER (ORDER BY level) AS int) AS code "
    f"FROM (SELECT DISTINCT cast({c} AS bigint) AS level FROM ({X.MATRIX}) m WHERE {c} IS NOT NULL)" for c in _LEVEL_COLUMNS))
def levels(spark, sf):
    return category_levels(X.matrix(spark, sf), _LEVEL_COLUMNS)


@query("level_encode", """
WITH m AS (SELECT event_id, ts, cast(user_id % 25 AS int) AS zone, cast(hour(ts) AS int) AS hour FROM events),
k AS (SELECT * FROM m WHERE ts < TIMESTAMP '2024-01-01 12:00:00'),
lz AS (SELECT level, cast(row_number() OVER (ORDER BY level) AS int) AS code FROM (SELECT DISTINCT zone AS level FROM k)),
lh AS (SELECT level, cast(row_number() OVER (ORDER BY level) AS int) AS code FROM (SELECT DISTINCT hour AS level FROM k))
SELECT event_id, coalesce(lz.code, 0) AS zone_code, coalesce(lh.code, 0) AS hour_code
FROM m LEFT JOIN lz ON m.zone = lz.level LEFT JOIN lh ON m.hour = lh.level""")
def level_encode(spark, sf):
    """Levels learnt from the first half day, applied to every event; later hours are unknown."""
    m = table(spark, sf, "events").select("event_id", "ts", (F.col("user_id") % 25).cast("int").alias("zone"),
                                          F.hour("ts").alias("hour"))
    known = category_levels(m.where("ts < timestamp_ntz'2024-01-01 12:00:00'"), ["zone", "hour"])
    coded = encode_by_join(m, known, "zone", "zone_code")
    return encode_by_join(coded, known, "hour", "hour_code").select("event_id", "zone_code", "hour_code")


# --- label statistics and errors ----------------------------------------------------------------

@query("label_cap", f"SELECT quantile_cont({L}, 0.99) AS label_cap, median(least({L}, c)) AS capped_median "
                    f"FROM ({X.MATRIX}) m, (SELECT quantile_cont({L}, 0.99) AS c FROM ({X.MATRIX}) k)")
def cap(spark, sf):
    matrix = X.matrix(spark, sf)
    value, median = label_cap(matrix, L)
    return matrix.agg(F.max(F.lit(value)).alias("label_cap"), F.max(F.lit(median)).alias("capped_median"))


_CAP_SQL = f"(SELECT quantile_cont({L}, 0.99) FROM ({X.MATRIX}) k)"


@query("log_target", f"""
SELECT trip_id, round(ln(1 + least(greatest({L}, 0), {_CAP_SQL})), 6) AS target,
  round(least(greatest({L}, 0), {_CAP_SQL}), 6) AS back FROM ({X.MATRIX}) m""")
def log_target(spark, sf):
    matrix = X.matrix(spark, sf)
    value, _ = label_cap(matrix, L)
    target = to_log_target(F.col(L), value)
    return matrix.select("trip_id", F.round(target, 6).alias("target"), F.round(from_log_target(target, value), 6).alias("back"))


_PRED = f"cast({L} + (pickup_zone_id - 12) * 8 AS double)"


@query("eval_metrics", f"""
WITH p AS (SELECT {L} AS y, least({L}, {_CAP_SQL}) AS yc, {_PRED} AS p FROM ({X.MATRIX}) m)
SELECT cast(count(*) AS double) AS rows, round(avg(abs(p - y)), 6) AS mae_seconds_raw, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse_seconds_raw,
  median(abs(p - y)) AS medae_seconds_raw, round(avg(abs(p - yc)), 6) AS mae_seconds_capped,
  round(sqrt(avg((p - yc) * (p - yc))), 6) AS rmse_seconds_capped, round(median(abs(p - yc)), 6) AS medae_seconds_capped FROM p""")
def eval_metrics(spark, sf):
    matrix = X.matrix(spark, sf).withColumn("p", (F.col(L) + (F.col("pickup_zone_id") - 12) * 8).cast("double"))
    value, _ = label_cap(matrix, L)
    out = error_metrics(matrix, L, "p", value)
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c not in ("rows", "medae_seconds_raw")})


@query("baseline_metrics", f"""
WITH tr AS (SELECT {L} AS y FROM ({X.MATRIX}) m WHERE as_of_date < DATE '{TEST_START}'),
c AS (SELECT quantile_cont(y, 0.99) AS cap FROM tr), md AS (SELECT median(least(y, cap)) AS med FROM tr, c),
h AS (SELECT least({L}, cap) AS y, med, cap FROM ({X.MATRIX}) m, c, md WHERE as_of_date >= DATE '{TEST_START}')
SELECT round(max(cap), 6) AS label_cap, max(med) AS train_median, round(avg(abs(med - y)), 6) AS mae,
  round(sqrt(avg((med - y) * (med - y))), 6) AS rmse, round(median(abs(med - y)), 6) AS medae FROM h""")
def baseline(spark, sf):
    train, test = split_by_date(X.matrix(spark, sf), TEST_START)
    out = baseline_metrics(train, test, L)
    return out.withColumns({c: F.round(c, 6) for c in ("label_cap", "mae", "rmse", "medae")})


@query("prediction_parity", """
WITH a AS (SELECT event_id, value AS p FROM events), b AS (SELECT event_id, value + (event_id % 7) * 0.25 AS p FROM events)
SELECT count(*) AS n_rows, count(*) FILTER (b.p IS NULL) AS unmatched, round(max(abs(a.p - b.p)), 6) AS max_abs_gap,
  false AS within_tolerance FROM a LEFT JOIN b USING (event_id)""")
def parity(spark, sf):
    a = table(spark, sf, "events").select("event_id", F.col("value").alias("p"))
    b = a.withColumn("p", F.col("p") + (F.col("event_id") % 7) * 0.25)
    out = prediction_parity(a, b, "event_id", "p", None, S.PARITY_TOLERANCE)
    return out.withColumn("max_abs_gap", F.round("max_abs_gap", 6))


@query("training_frame", f"SELECT cast(sum(pickup_zone_id) AS bigint) AS zones, sum(cast({L} AS double)) AS label_sum, count(*) AS n_rows FROM ({X.MATRIX}) m")
def training_frames(spark, sf):
    return training_frame(X.matrix(spark, sf)).agg(
        F.sum("pickup_zone_id").alias("zones"), F.sum(F.col(L).cast("double")).alias("label_sum"), F.count(F.lit(1)).alias("n_rows"))


_SEARCHED = _sample_sql(_INNER, "as_of_ts, trip_id", 5_000, "trip_id, as_of_date")


@query("gbt_candidates", f"""
WITH inn AS ({_INNER}), sam AS ({_SEARCHED}), cut AS (SELECT {_cutoff_sql('SELECT * FROM sam', S.SEARCH_KEEP_FRACTION)} AS c)
SELECT {len(CANDIDATES)} AS candidates, (SELECT count(*) FROM inn, cut WHERE as_of_date > c) AS judged_rows, true AS winner_has_least_error,
  true AS some_cut, true AS all_ran_out""")
def gbt_candidates(spark, sf):
    """The whole search: every candidate, early stopping, judged on every row of the validation dates."""
    parts = _training_parts(spark, sf)
    value, _ = label_cap(parts["train"], L)
    winner, best, reports = search(parts["search_train"], parts["search_judged"], value)
    least = min(r["mae_seconds_capped"] for r in reports)
    chosen = [r for r in reports if r["name"] == winner.name][0]
    row = (len(reports), int(reports[0]["rows"]), chosen["mae_seconds_capped"] == least and chosen["best_iteration"] == best,
           any(r["best_iteration"] < r["rounds"] for r in reports), all(r["stopped_early"] or r["rounds"] == MAX_ROUNDS for r in reports))
    return spark.createDataFrame([row], "candidates int, judged_rows long, winner_has_least_error boolean, some_cut boolean, all_ran_out boolean")


def _training_parts(spark, sf):
    matrix = sample_keys(X.matrix(spark, sf))
    return nested_split(matrix, 5_000, [F.col(c) for c in SAMPLE_ORDER], SAMPLE_COARSE, SAMPLE_FINE, TEST_START)


@query("score_matrix")
def score_matrix(spark, sf):
    """Fit on the train side and score every test row."""
    train, test = split_by_date(X.matrix(spark, sf), TEST_START)
    value, _ = label_cap(train, L)
    return score(test, fit(train, CANDIDATES[5], value, MAX_ROUNDS), value).select("trip_id", L, "prediction_seconds")


# --- drift -----------------------------------------------------------------------------------------

def _psi_sql() -> str:
    parts = []
    for c in S.CATEGORICAL_FEATURES:
        parts.append(f"SELECT '{c}' AS column_name, 'categorical' AS kind, cast({c} AS varchar) AS bin, side FROM m")
    for c in (*S.NUMERIC_FEATURES, L):
        edges = ", ".join(f"quantile_cont({c}, {i / 10})" for i in range(1, 10))
        inner = f"(SELECT list_distinct([{edges}]) AS e FROM m WHERE side = 'r' AND NOT isnan({c}))"
        parts.append(f"SELECT '{c}', 'numeric', CASE WHEN isnan({c}) OR {c} IS NULL THEN NULL "
                     f"ELSE cast(len(list_filter(e, lambda x: x < {c})) AS varchar) END, side FROM m, {inner}")
    return f"""
WITH m AS (SELECT *, CASE WHEN as_of_date < DATE '2024-01-16' THEN 'r' ELSE 'c' END AS side FROM ({X.MATRIX}) x),
b AS ({' UNION ALL '.join(parts)}),
h AS (SELECT column_name, kind, bin, count(*) FILTER (side = 'c') AS c, count(*) FILTER (side = 'r') AS r FROM b GROUP BY ALL),
s AS (SELECT *, sum(c) FILTER (bin IS NOT NULL) OVER w AS tc, sum(r) FILTER (bin IS NOT NULL) OVER w AS tr FROM h WINDOW w AS (PARTITION BY column_name)),
q AS (SELECT *, greatest(c / tc::double, 1e-4) AS pc, greatest(r / tr::double, 1e-4) AS pr FROM s)
SELECT column_name, kind, count(bin) AS n_bins, round(sum((pc - pr) * ln(pc / pr)) FILTER (bin IS NOT NULL), 6) AS psi,
  coalesce(cast(sum(c) FILTER (bin IS NULL) AS bigint), 0) AS missing_current, coalesce(cast(sum(r) FILTER (bin IS NULL) AS bigint), 0) AS missing_reference
FROM q GROUP BY ALL"""


_PSI = _psi_sql()


def _scores(spark, sf):
    reference, current = split_by_date(X.matrix(spark, sf), "2024-01-16")
    return psi(current, reference)


@query("psi_categorical", f"SELECT * FROM ({_PSI}) WHERE kind = 'categorical'")
def psi_categorical(spark, sf):
    reference, current = split_by_date(X.matrix(spark, sf), "2024-01-16")
    out = psi(current, reference, numeric=())
    return out.withColumn("psi", F.round("psi", 6)).drop("drifted")


@query("psi_numeric", f"SELECT * FROM ({_PSI}) WHERE kind = 'numeric'")
def psi_numeric(spark, sf):
    out = _scores(spark, sf).where(F.col("kind") == "numeric")
    return out.withColumn("psi", F.round("psi", 6)).drop("drifted")


_SIDES = f"SELECT *, as_of_date >= DATE '2024-01-16' AS cur FROM ({X.MATRIX}) x"
_VALUES = " UNION ALL ".join(f"SELECT '{c}' AS column_name, cast({c} AS double) AS value, cur FROM m WHERE {c} IS NOT NULL AND NOT isnan({c})"
                             for c in (*S.NUMERIC_FEATURES, L))
_ORDERED = f"""
WITH m AS ({_SIDES}), v AS ({_VALUES}),
k AS (SELECT column_name, value, count(*) FILTER (cur) AS c, count(*) FILTER (NOT cur) AS r FROM v GROUP BY ALL),
t AS (SELECT column_name, sum(c) AS nc, sum(r) AS nr, greatest(sqrt(greatest(sum(r * value * value) / sum(r) - (sum(r * value) / sum(r)) ** 2, 0)), 1e-3) AS sd FROM k GROUP BY ALL),
g AS (SELECT column_name, nc, nr, sd, abs(sum(c) OVER w / nc - sum(r) OVER w / nr) AS gap, lead(value) OVER w - value AS step
  FROM k JOIN t USING (column_name) WINDOW w AS (PARTITION BY column_name ORDER BY value)),
s AS (SELECT column_name, any_value(nc) AS nc, any_value(nr) AS nr, max(gap) AS d, sum(gap * coalesce(step, 0)) / any_value(sd) AS wd FROM g GROUP BY ALL),
x AS (SELECT *, (sqrt(nc * nr / (nc + nr)) + 0.12 + 0.11 / sqrt(nc * nr / (nc + nr))) * d AS x FROM s)"""
_BINNED = f"""
WITH m AS ({_SIDES}), b AS (
{" UNION ALL ".join(f"SELECT '{c}' AS column_name, 'categorical' AS kind, coalesce(cast({c} AS varchar), '<null>') AS bin, cur FROM m" for c in S.CATEGORICAL_FEATURES)}
UNION ALL {" UNION ALL ".join(f"SELECT '{c}', 'numeric', cast(len(list_filter(e, lambda x: x < {c})) AS varchar), cur FROM m, (SELECT list_distinct([{', '.join(f'quantile_cont({c}, {i / 10})' for i in range(1, 10))}]) AS e FROM m WHERE NOT cur AND NOT isnan({c})) WHERE {c} IS NOT NULL AND NOT isnan({c})" for c in (*S.NUMERIC_FEATURES, L))}),
h AS (SELECT column_name, kind, bin, count(*) FILTER (cur) AS c, count(*) FILTER (NOT cur) AS r FROM b GROUP BY ALL),
t AS (SELECT *, sum(c) OVER w AS tc, sum(r) OVER w AS tr FROM h WINDOW w AS (PARTITION BY column_name)),
s AS (SELECT column_name, kind, count(*) AS bins, sum((sqrt(tr / tc) * c - sqrt(tc / tr) * r) ** 2 / (c + r)) AS chi,
  sqrt(greatest(sum(CASE WHEN c > 0 THEN c / tc * ln(c / tc / ((c / tc + r / tr) / 2)) ELSE 0 END
    + CASE WHEN r > 0 THEN r / tr * ln(r / tr / ((c / tc + r / tr) / 2)) ELSE 0 END) / 2, 0)) AS js FROM t GROUP BY ALL)"""


def _drift(spark, sf, method, kind=None):
    reference, current = split_by_date(X.matrix(spark, sf), "2024-01-16")
    out = drift_scores(current, reference, method, **({"categorical": ()} if kind == "numeric" else {"numeric": ()} if kind == "categorical" else {}))
    return out.select("column_name", "kind", F.round("statistic", 6).alias("statistic"), "drifted")


@query("drift_ks", f"""{_ORDERED}
SELECT column_name, 'numeric' AS kind, round(d, 6) AS statistic, CASE WHEN x < 0.2 THEN false
  ELSE list_sum([(CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * j * j * x * x) for j in range(1, 101)]) < 0.05 END AS drifted FROM x""")
def drift_ks(spark, sf):
    return _drift(spark, sf, "ks", "numeric")


@query("drift_wasserstein", f"{_ORDERED} SELECT column_name, 'numeric' AS kind, round(wd, 6) AS statistic, wd >= 0.1 AS drifted FROM x")
def drift_wasserstein(spark, sf):
    return _drift(spark, sf, "wasserstein", "numeric")


@query("drift_chisquare", f"""{_BINNED}
SELECT column_name, kind, round(chi, 6) AS statistic, bins > 1 AND ((chi / (bins - 1)) ** (1.0 / 3) - (1 - 2 / (9.0 * (bins - 1)))) / sqrt(2 / (9.0 * (bins - 1))) > 1.6448536269514722 AS drifted
FROM s WHERE kind = 'categorical'""")
def drift_chisquare(spark, sf):
    return _drift(spark, sf, "chisquare", "categorical")


@query("drift_jensenshannon", f"{_BINNED} SELECT column_name, kind, round(js, 6) AS statistic, js >= 0.1 AS drifted FROM s")
def drift_jensenshannon(spark, sf):
    return _drift(spark, sf, "jensenshannon")


@query("drift_report", f"""
WITH p AS ({_PSI}), n AS (SELECT count(*) FILTER (as_of_date >= DATE '2024-01-16') AS c, count(*) FILTER (as_of_date < DATE '2024-01-16') AS r FROM ({X.MATRIX}) x)
SELECT max(c) AS current_rows, max(r) AS reference_rows, count(*) AS monitored_columns,
  coalesce(string_agg(column_name, ',' ORDER BY list_position([{', '.join(f"'{c}'" for c in (*S.FEATURES, L))}], column_name)) FILTER (psi >= 0.1), '') AS drifted_columns,
  count(*) FILTER (psi >= 0.1) AS drifted_columns_count, count(*) FILTER (psi >= 0.1) / count(*)::double AS drift_share,
  bool_or(psi >= 0.1) AS any_drift, count(*) FILTER (psi >= 0.1) / count(*)::double >= 0.5 AS share_drift FROM p, n""")
def report(spark, sf):
    reference, current = split_by_date(X.matrix(spark, sf), "2024-01-16")
    out = drift_report(psi(current, reference), current.count(), reference.count(), (*S.FEATURES, L))
    return out.withColumn("drifted_columns", F.array_join("drifted_columns", ",")).drop(
        "schema_version", "feature_version", "reference_snapshot_id")
