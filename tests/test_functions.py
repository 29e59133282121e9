import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from waymark.functions import columns as C
from waymark.functions.hashing import canonical_json_text, columns_hash, merge_digests, route_bucket, schema_hash, stable_id, table_digest
from waymark.functions.parsing import norm_text, safe_code, safe_double, safe_long, safe_ts
from waymark.functions.times import as_instant, calendar_parts, cutoff, duration_seconds, epoch_second, utc_wall
from waymark.operators.contract import feature_spec


def values(spark, texts, build):
    rows = [(i, t) for i, t in enumerate(texts)]
    out = spark.createDataFrame(rows, "i int, t string").select("i", build(F.col("t")).alias("v")).orderBy("i").collect()
    return [r["v"] for r in out]


def test_safe_ts(spark):
    got = values(spark, [" 2024-01-02 03:04:05 ", "2024-01-02T03:04:05.250", "2024-01-02", "", None, "soon", "2024-13-01",
                         "2024-01-02T03:04:05Z", "2024-01-02 03:04:05+02:00", "2024-03-10 02:30:00"], safe_ts)
    assert got == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 250000), datetime(2024, 1, 2), None, None,
                   None, None, datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 1, 4, 5), datetime(2024, 3, 10, 2, 30)]


def test_safe_numbers(spark):
    texts = ["12", " +7 ", "-3", "1.0", "x", "", None, "99999999999999999999", "1e2", "1d", "NaN", ".5", "Infinity", "1."]
    assert values(spark, texts, safe_long) == [12, 7, -3] + [None] * 11
    assert values(spark, texts, safe_code) == [12, 7, -3, 1] + [None] * 9 + [1]
    assert values(spark, texts, safe_double) == [12.0, 7.0, -3.0, 1.0, None, None, None, 1e20, 100.0, None, None, 0.5, None, 1.0]


def test_norm_text(spark):
    assert values(spark, ["  Boro ZONE ", None, ""], norm_text) == ["boro zone", "", ""]


def test_time_parts_do_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 0, 900000), datetime(2024, 3, 10, 2, 31, 0, 100000)),
                                (datetime(1969, 12, 31, 23, 59, 59, 500000), datetime(1970, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    rows = df.select(epoch_second(F.col("a")).alias("s"), duration_seconds(F.col("a"), F.col("b")).alias("d"),
                     utc_wall(as_instant(F.col("a"))).alias("back"), "a", *calendar_parts(F.col("a"))).collect()
    assert [(r.s, r.d) for r in rows] == [(1710037800, 60), (-1, 1)]
    assert all(r.back == r.a for r in rows)
    assert (rows[0].pickup_hour, rows[0].pickup_dow, rows[0].pickup_month, rows[0].pickup_is_weekend) == (2, 1, 3, 1)


def test_cutoff():
    assert cutoff(datetime(2024, 1, 8), 7) == datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        cutoff(datetime(2024, 1, 8), -1)


def test_route_bucket_matches_hashlib(spark):
    pairs = [(15, 30), (1, 1), (24, 7), (0, 5), (5, 0)]
    rows = spark.createDataFrame(pairs, "p int, d int").select(
        "p", "d", route_bucket(F.col("p"), F.col("d"), "trip_eta_route_pair_v1", 4096).alias("b")).collect()
    for r in rows:
        digest = hashlib.sha256(f"{r.p}||{r.d}||trip_eta_route_pair_v1".encode()).hexdigest()
        want = int(digest[:15], 16) % 4096 + 1 if r.p > 0 and r.d > 0 else 0
        assert r.b == want
    assert next(r.b for r in rows if (r.p, r.d) == (15, 30)) == 1370


def test_stable_id_counts_null_as_empty(spark):
    r = spark.createDataFrame([("a", None)], "x string, y string").select(stable_id(["x", "y"]).alias("k")).first()
    assert r.k == hashlib.sha256(b"a||").hexdigest()


def test_hashes():
    assert columns_hash(["a", "b"]) == hashlib.sha256(b"a\nb").hexdigest()
    assert schema_hash({"b": 1, "a": [1]}) == hashlib.sha256(b'{"a":[1],"b":1}').hexdigest()


def test_canonical_json(spark):
    got = values(spark, ['{"b": 1.0, "a": [1, {"z": null, "y": "q"}]}', '{"a":[1,{"y":"q","z":null}],"b":1}', "{"], canonical_json_text)
    assert got[0] == got[1] and got[2] is None


def test_table_digest_ignores_order(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 3)
    a, b = (table_digest(d, ["id", "v"]).first() for d in (df, df.orderBy(F.col("id").desc()).repartition(7)))
    assert a == b
    assert a != table_digest(df.withColumn("v", F.col("v") + 1), ["id", "v"]).first()
    assert a != table_digest(df.unionByName(df.limit(1)).unionByName(df.limit(1)), ["id", "v"]).first()  # a row two times more
    parts = table_digest(df.withColumn("p", F.col("id") % 3), ["id", "v"], ["p"])
    assert merge_digests(parts).first() == a and parts.count() > 1
    texts = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc")], "x string, y string")
    assert len({tuple(table_digest(texts.where(F.col("y") == y), ["x", "y"]).first()) for y in ("c", "bc", "abc")}) == 3
    assert tuple(table_digest(df.limit(0), ["id", "v"]).first()) == (0, "0", "0", "0" * 16, "0" * 16)


@pytest.mark.parametrize("name,want", [("PULocationID", "pulocation_id"), ("tpep_pickup_datetime", "tpep_pickup_datetime"),
                                       ("Trip Distance (mi)", "trip_distance_mi"), ("__a--B", "a_b"), ("VendorID", "vendor_id")])
def test_normalize_name(name, want):
    assert C.normalize_name(name) == want


def test_normalize_errors(spark):
    with pytest.raises(ValueError):
        C.normalize_name("--")
    with pytest.raises(ValueError):
        C.normalize_columns(spark.createDataFrame([(1, 2)], "`fooBar` int, foo_bar int"))


def test_first_value_takes_first_readable(spark):
    df = spark.createDataFrame([(None, "5", "6"), ("x", "7", None)], "a string, b string, c string")
    got = [r[0] for r in df.select(C.first_value(df, ("a", "absent", "b", "c"), safe_long)).collect()]
    assert got == [5, 7]
    with pytest.raises(KeyError):
        C.first_value(df, ("nope",))
    assert df.select(C.typed(df, ("nope",), safe_long, "bigint").alias("n")).schema["n"].dataType.simpleString() == "bigint"


def test_text_schema_and_raw_json(spark):
    df = spark.createDataFrame([(1, None)], "b int, a string")
    assert C.to_text_schema(df, ["a", "b", "c"]).first().asDict() == {"a": None, "b": "1", "c": None}
    assert df.select(C.raw_record_json(df)).first()[0] == '{"a":null,"b":1}'


def test_cast_if_present(spark):
    out = C.cast_if_present(spark.createDataFrame([("1",), ("x",)], "a string"), {"a": "int", "zz": "int"})
    assert [r.a for r in out.collect()] == [1, None]


def test_computed_once_is_not_copied_into_filters(spark):
    df = C.computed_once(spark.range(10), {"h": F.sha2(F.col("id").cast("string"), 256)}).where("h > '5'").select("h")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sha2(") == 1


def test_column_diff_and_qualify():
    assert C.column_diff(["a", "c"], ["a", "b"]) == {"missing": ["b"], "extra": ["c"], "order_matches": False}
    assert C.qualify("gold.m") == "lake.gold.m" and C.qualify("x.gold.m") == "x.gold.m"
    for bad in ("m", "a.b.c.d", "gold.m;drop"):
        with pytest.raises(ValueError):
            C.qualify(bad)
    assert C.parse_table_list("gold.a, gold.b,gold.a") == ["lake.gold.a", "lake.gold.b"]


def test_require_guards(spark):
    df = spark.range(0)
    with pytest.raises(ValueError):
        C.require_columns(df, ["x"], "t")
    with pytest.raises(ValueError):
        C.require_non_empty(df, "t")


def test_feature_spec_shape():
    spec = feature_spec(["airports", "boro zone"])
    by_name = {r["name"]: r for r in spec}
    assert len(spec) == 21
    assert by_name["pickup_service_zone_id"]["domain"] == [0, 1, 2]
    assert by_name["pickup_borough_id"]["domain"] == [0, 1, 2, 3, 4, 5, 6]
    assert by_name["dropoff_zone_id"]["domain"] == "positive_location_ids_and_0_unknown"
    assert len(by_name["route_pair_id"]["domain"]) == 4097 and by_name["route_pair_id"]["bucket_count"] == 4096
    assert by_name["label_trip_duration_seconds"]["target_metric"] == "mae"
    assert "categorical_feature" not in by_name["pickup_hour"]


def test_event_date(spark):
    from waymark.functions.times import event_date

    df = spark.createDataFrame([(None, datetime(2024, 1, 2, 23))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(event_date(F.col("a"), F.col("b"))).first()[0] == date(2024, 1, 2)
