import math
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.operators import ranking, splits
from waymark.operators.dedupe import dedupe_latest, duplicate_count, duplicate_keys, latest_by_key
from waymark.operators.drift import drift_report, psi
from waymark.operators.lookups import attach_codes, attach_zone_roles, fixed_code, join_coverage, sorted_codes
from waymark.operators.metrics import baseline_metrics, error_metrics, label_cap, prediction_parity
from waymark.operators.profile import profile_categorical, profile_nulls, profile_numeric, summarize_int_list, truncate_columns
from waymark.operators.trailing import Trailing, trailing_features


# --- trailing windows ---------------------------------------------------------------------------

def brute_force(rows, keys, seconds, agg):
    out = {}
    for r in rows:
        frame = [x["v"] for x in rows if all(x[k] == r[k] for k in keys) and (
            (r["sec"] is None and x["sec"] is None)
            or (r["sec"] is not None and x["sec"] is not None and r["sec"] - seconds <= x["sec"] <= r["sec"] - 1))]
        known = [v for v in frame if v is not None]
        out[r["id"]] = (float(len(frame)) if agg == "count" else (sum(known) / len(known) if known else None))
    return out


def test_null_times_and_peers(spark):
    rows = [(0, None, 5.0), (1, None, 7.0), (2, 100, 1.0), (3, 100, 2.0), (4, 105, 4.0), (5, 116, 9.0)]
    df = spark.createDataFrame(rows, "id int, sec long, v double").withColumn("k", F.lit(1))
    out = trailing_features(df, F.col("sec"), [Trailing("a", ("k",), 10, "avg", "v"), Trailing("n", ("k",), 10, "count")], 5)
    got = {r.id: (r.a, r.n) for r in out.collect()}
    assert got == {0: (6.0, 2.0), 1: (6.0, 2.0), 2: (None, 0.0), 3: (None, 0.0), 4: (1.5, 2.0), 5: (None, 0.0)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trailing_against_brute_force_with_a_hot_key(spark, seed):
    rnd = random.Random(seed)
    rows = [dict(id=i, z=0 if rnd.random() < 0.5 else rnd.choice([None, 1, 2]), h=rnd.choice([0, 1]),
                 sec=rnd.choice([None] + [rnd.randrange(-300, 700)] * 20), v=rnd.choice([None, float(rnd.randrange(50))]))
            for i in range(400)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id int, z int, h int, sec long, v double")
    specs = [Trailing("a1", ("z", "h"), 70, "avg", "v"), Trailing("n2", ("z", "h"), 400, "count", None, 0.0),
             Trailing("a3", ("z",), 10, "avg", "v", float("nan")), Trailing("a4", ("h",), 130, "avg", "v")]
    got = {r.id: r for r in trailing_features(df, F.col("sec"), specs, 10).collect()}
    assert len(got) == 400
    for name, keys, seconds, agg in (("a1", ("z", "h"), 70, "avg"), ("n2", ("z", "h"), 400, "count"), ("a3", ("z",), 10, "avg"),
                                     ("a4", ("h",), 130, "avg")):
        want = brute_force(rows, keys, seconds, agg)
        for i, w in want.items():
            g = got[i][name]
            if name == "a3" and w is None:
                assert math.isnan(g)
            else:
                assert g == pytest.approx(w)


def test_trailing_rejects_partial_chunks(spark):
    with pytest.raises(ValueError):
        trailing_features(spark.range(1), F.col("id"), [Trailing("a", ("id",), 15, "count")], 10)


def test_trailing_windows_are_bounded_by_chunks(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS k", "id AS sec", "1.0D AS v")
    plan = trailing_features(df, F.col("sec"), [Trailing("a", ("k",), 20, "avg", "v")], 10)._jdf.queryExecution().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line and "_off" in line]
    assert windows and all("_chunk" in line for line in windows)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# --- order statistics ---------------------------------------------------------------------------

@pytest.mark.parametrize("few_values,few_rows", [(100_000, 200_000), (0, 200_000), (0, 50)])
def test_exact_quantiles_match_numpy(spark, monkeypatch, few_values, few_rows):
    monkeypatch.setattr(ranking, "_FEW_VALUES", few_values)
    monkeypatch.setattr(ranking, "_FEW_ROWS", few_rows)
    monkeypatch.setattr(ranking, "_SKETCH_ACCURACY", 50)
    rng = np.random.default_rng(4)
    a = rng.normal(size=5000).round(3)
    b = np.where(rng.random(5000) < 0.4, 7.0, rng.integers(0, 40, 5000)).astype(float)  # one value holds over a third
    rows = [(float(x), float(y) if i % 50 else None, float("nan") if i % 9 else float(y)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = ranking.exact_quantiles(df, {c: F.col(c) for c in "abc"}, qs)
    for j, c in enumerate("abc"):
        clean = np.array([r[j] for r in rows if r[j] is not None and not math.isnan(r[j])])
        assert got[c] == pytest.approx(np.quantile(clean, qs).tolist(), abs=1e-12), c


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert ranking.exact_quantiles(df, {"a": F.col("a")}, [0.5]) == {"a": [None]}


def test_quantile_interpolates(spark):
    df = spark.range(1, 11).withColumn("x", F.col("id").cast("double"))
    assert ranking.exact_quantiles(df, {"x": F.col("x")}, [0.99])["x"][0] == pytest.approx(9.91)


# --- sampling and splits -------------------------------------------------------------------------

@pytest.mark.parametrize("n,m", [(10, 4), (10, 1), (10, 10), (10, 25), (97, 13), (1000, 333), (1, 1), (1, 5), (2, 2), (500, 499)])
def test_even_sample_matches_linspace(spark, n, m):
    rows = [(i, date(2024, 1, 1) + timedelta(days=0 if i < n // 3 else i % 4 + 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, d date").withColumn("b", F.floor(F.col("id") / 8))
    ordered = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    want = [ordered[i] for i in (range(n) if n <= m else np.linspace(0, n - 1, num=m, dtype=int))]
    got = splits.even_sample(df, [F.col("d"), F.col("id")], m, ["d"], ["b"]).orderBy("d", "id").collect()
    assert [r.id for r in got] == want


def test_global_position_is_dense(spark):
    df = spark.createDataFrame([(i, i % 5, (i * 37) % 101) for i in range(400)], "id int, c int, f int")
    rows = ranking.global_position(df, [F.col("c"), F.col("f"), F.col("id")], ["c"], ["f"]).collect()
    want = {r[0]: i for i, r in enumerate(sorted(((i, i % 5, (i * 37) % 101) for i in range(400)), key=lambda r: (r[1], r[2], r[0])))}
    assert {r.id: r.position for r in rows} == want


def test_range_positions_with_one_shared_prefix(spark):
    names = [f"https://host/path/{(k * 7919) % 20_000:05d}" for k in range(20_000)]
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "name string, k int").repartition(6)
    placed = ranking.range_positions(df, ["name"])
    want = {n: i for i, n in enumerate(sorted(names))}
    assert {r["name"]: r.position for r in placed.collect()} == want and placed.columns == ["name", "k", "position"]
    parts = sorted(r["count"] for r in df.repartitionByRange(16, "name").groupBy(F.spark_partition_id()).count().collect())
    assert len(parts) == 16 and parts[-1] < 2 * parts[8]  # a shared prefix does not gather rows
    assert ranking.range_positions(df.limit(0), ["name"]).count() == 0


# The cutoffs are worked out by hand: the first day on which the running count reaches the wanted rows, never the last day.
@pytest.mark.parametrize("counts,keep,day", [([5, 5], 0.9, 1), ([1, 1, 8], 0.25, 2), ([10, 1, 1], 0.1, 1), ([3, 3, 3, 3], 0.5, 2), ([1, 9], 0.05, 1),
                                             ([2, 3, 5, 15], 0.1, 1)])
def test_fraction_cutoff(spark, counts, keep, day):
    df = spark.createDataFrame([(date(2024, 1, 1 + i),) for i, n in enumerate(counts) for _ in range(n)], "as_of_date date")
    assert splits.fraction_cutoff(df, keep).first()[0] == date(2024, 1, day)
    left, right = splits.split_by_fraction(df, keep)
    assert left.count() == sum(counts[:day]) and right.count() == sum(counts[day:])


def test_split_by_date_checks_sides(spark):
    df = spark.createDataFrame([(date(2025, 1, 6),), (date(2025, 1, 7),)], "as_of_date date")
    train, test = splits.split_by_date(df, check=True)
    assert (train.count(), test.count()) == (1, 1)
    with pytest.raises(ValueError):
        splits.split_by_date(df, "2030-01-01", check=True)
    with pytest.raises(ValueError):
        splits.split_by_fraction(df, 1.0)


def test_levels(spark):
    df = spark.createDataFrame([(3, 1), (1, None), (3, 9)], "a int, b int")
    levels = splits.category_levels(df, ["a", "b"])
    assert sorted(levels.collect()) == [("a", 1, 1), ("a", 3, 2), ("b", 1, 1), ("b", 9, 2)]
    out = splits.encode_by_join(df, levels, "a", "x").select("x").orderBy("x").collect()
    assert [r.x for r in out] == [1, 2, 2]
    joined = splits.encode_by_join(df, levels, "b", "y").orderBy("a", "b").collect()
    assert [r.y for r in joined] == [0, 1, 2]


# --- dedupe and lookups --------------------------------------------------------------------------

def test_dedupe_latest(spark):
    rows = [("k", datetime(2024, 1, 2), 1), ("k", None, 9), ("k", datetime(2024, 1, 2), 3), ("j", None, 2)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v int")
    assert {(r.k, r.v) for r in dedupe_latest(df, "k", ["t"]).collect()} == {("k", 3), ("j", 2)}
    assert latest_by_key(df.drop("t"), "k").where("k = 'k'").first().v == 9
    assert duplicate_keys(df, ["k"]).first().n_rows == 3
    assert duplicate_count(df, "k").first().duplicate_rows == 2


def test_dedupe_trims_hot_keys_before_the_shuffle(spark):
    plan = dedupe_latest(spark.range(10).selectExpr("id % 2 AS k", "id"), "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def zones(spark):
    return spark.createDataFrame([(1, "Queens", "A", "Boro Zone"), (2, " EWR ", "B", "Airports"), (3, None, "C", None)],
                                 "location_id long, borough string, zone string, service_zone string")


def test_zone_roles_and_codes(spark):
    trips = spark.createDataFrame([(1, 2), (3, 99), (None, 1)], "pickup_location_id long, dropoff_location_id long")
    out = attach_zone_roles(trips, zones(spark))
    got = {(r.pickup_location_id, r.dropoff_location_id): (r.pickup_borough, r.dropoff_borough) for r in out.collect()}
    assert got == {(1, 2): ("Queens", " EWR "), (3, 99): (None, None), (None, 1): (None, "Queens")}
    codes = out.select(fixed_code(F.col("dropoff_borough"), S.BOROUGH_CODES).alias("c")).collect()
    assert sorted(r.c for r in codes) == [0, 2, 6]
    table = sorted_codes(out, ["pickup_service_zone", "dropoff_service_zone"])
    assert {r.value: r.code for r in table.collect()} == {"airports": 1, "boro zone": 2}
    coded = attach_codes(out, table, {"dropoff_service_zone": "c"})
    assert sorted(r.c for r in coded.collect()) == [0, 1, 2]


def test_join_coverage(spark):
    trips = spark.createDataFrame([(1,), (1,), (99,), (None,)], "pickup_location_id long")
    r = join_coverage(trips, zones(spark), ["pickup_location_id"]).first()
    assert (r.n_rows, r.null_keys, r.unmatched) == (4, 1, 1)


# --- metrics, profiles, drift --------------------------------------------------------------------

def test_metrics(spark):
    rng = np.random.default_rng(1)
    y, p = rng.integers(1, 400, 501).astype(float), rng.integers(1, 400, 501).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    cap, median = label_cap(df, "y")
    assert cap == pytest.approx(np.quantile(y, 0.99)) and median == np.median(np.clip(y, 0, cap))
    r = error_metrics(df, "y", "p", cap).first()
    yc = np.clip(y, 0, cap)
    assert r.mae_seconds_raw == pytest.approx(np.abs(p - y).mean())
    assert r.rmse_seconds_capped == pytest.approx(math.sqrt(((p - yc) ** 2).mean()))
    assert r.medae_seconds_capped == pytest.approx(np.median(np.abs(p - yc)))
    b = baseline_metrics(df, df, "y").first()
    assert b.mae == pytest.approx(np.abs(yc - median).mean()) and b.medae == pytest.approx(np.median(np.abs(yc - median)))


def test_prediction_parity(spark):
    a = spark.createDataFrame([(i, float(i)) for i in range(300)], "id int, p double")
    b = a.withColumn("p", F.col("p") + F.when(F.col("id") == 200, 1.0).otherwise(0.00001))
    first = prediction_parity(a, b, "id", "p", S.PARITY_ROWS, S.PARITY_TOLERANCE).first()
    assert first.n_rows == 128 and first.within_tolerance
    assert not prediction_parity(a, b, "id", "p", None, S.PARITY_TOLERANCE).first().within_tolerance


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, "x", True), (float("nan"), None, True), (3.0, "x", None), (None, "y", False)],
                               "a double, b string, c boolean")
    assert {(r.column_name, r.null_count) for r in profile_nulls(df).collect()} == {("a", 2), ("b", 1), ("c", 1)}
    wide = spark.range(3).select(*[F.when(F.col("id") >= k % 3, F.lit(1)).alias(f"c{k:02d}") for k in range(1, 31)])
    assert profile_nulls(wide).count() == 20 and [r.null_count for r in profile_nulls(wide, 3).collect()] == [2, 2, 2]
    n = profile_numeric(df).first()
    assert (n.n_values, n.mean, n.min, n.p50, n.max) == (2, 2.0, 1.0, 2.0, 3.0)
    top = {(r.column_name, r["rank"]): (r.value, r.n_rows, r.n_distinct) for r in profile_categorical(df).collect()}
    assert top[("b", 1)] == ("x", 2, 2) and top[("b", 3)] == (None, 1, 2) and top[("c", 1)] == ("true", 2, 2)


def test_display_helpers(spark):
    df = spark.createDataFrame([("a" * 181,), ("b" * 180,)], "t string")
    assert [len(r.t) for r in truncate_columns(df).collect()] == [180, 180]
    lists = spark.createDataFrame([([],), ([4],), (list(range(5, 25)),), ([1, 5] * 10,), (None,)], "v array<int>")
    got = [r[0] for r in lists.select(summarize_int_list(F.col("v"))).collect()]
    assert got == ["[]", "[4]", "int_range(5..24) [len=20]", "[1, 5, 1, 5, 1, ..., 5, 1, 5] [len=20]", None]


def psi_reference(cur, ref, bins):
    c, r = (np.maximum(np.array([x.count(b) for b in bins]) / len(x), 1e-4) for x in (cur, ref))
    return float(((c - r) * np.log(c / r)).sum())


def test_psi_and_report(spark):
    rnd = random.Random(2)
    ref, cur = [rnd.choice([0, 1, 2]) for _ in range(900)], [rnd.choice([1, 2, 3]) for _ in range(600)]
    num_r, num_c = [rnd.gauss(0, 1) for _ in ref], [rnd.gauss(0.05, 1) for _ in cur]
    a = spark.createDataFrame(list(zip(cur, num_c)) + [(1, float("nan"))], "cat int, num double")
    b = spark.createDataFrame(list(zip(ref, num_r)), "cat int, num double")
    rows = {r.column_name: r for r in psi(a, b, ["cat"], ["num"]).collect()}
    assert rows["cat"].psi == pytest.approx(psi_reference(cur + [1], ref, [0, 1, 2, 3])) and rows["cat"].drifted
    edges = np.quantile(num_r, [i / 10 for i in range(1, 10)])
    to_bin = lambda xs: [int((edges < x).sum()) for x in xs]
    assert rows["num"].psi == pytest.approx(psi_reference(to_bin(num_c), to_bin(num_r), range(10)))
    assert rows["num"].missing_current == 1
    r = drift_report(psi(a, b, ["cat"], ["num"]), 601, 900, ["cat", "num"]).first()
    assert r.drifted_columns == ["cat"] and r.drift_share == 0.5 and r.any_drift and r.share_drift
