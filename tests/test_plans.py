import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.functions.hashing import schema_hash
from waymark.operators.contract import (build_contract, contract_conflicts, contract_violations, current_snapshot,
                                        explode_contract, feature_spec, latest_contract, pin_snapshot)
from waymark.operators.gates import (contract_gate, count_violations, drift_gate, matrix_gate, require_clean, require_exact_columns, train_gate)
from waymark.operators.maintenance import compaction_plan, expiry_plan, orphan_files
from waymark.operators.scoring import CANDIDATES, score
from waymark.plans.bronze import ingest, to_bronze
from waymark.plans.drift import run_drift
from waymark.plans.elt import run_elt
from waymark.plans.gold import build_gold, filter_run
from waymark.plans.scoring import score_requests
from waymark.plans.silver import build_silver
from waymark.plans.training import load_training_inputs, train
from waymark.plans.upkeep import Upkeep, maintain
from waymark.session import scratch_dir
from waymark.sources.lake import Lake, write_json_report
from waymark.sources.readers import (latest_by_time, list_files, read_csv_lookup, read_dataset, read_first_files, read_skipping_corrupt,
                                     with_partition)


def raw_trips(spark, n=600, offset=0, days=20):
    start = datetime(2025, 1, 1, 0, 0, 5)
    rows = []
    for i in range(offset, offset + n):
        t = start + timedelta(minutes=i * 47 % (days * 1440), seconds=i % 50)
        rows.append((t.isoformat(sep=" "), (t + timedelta(seconds=60 + i % 900)).isoformat(), str(i % 3 + 1), str((i * 7) % 4 + 1),
                     str(i), "1.5", f"{5 + i % 30}.0", f"{6 + i % 30}"))
    rows += [("garbage", "garbage", "1", "1", "1", "1", "1", "1"), (rows[0][0], rows[0][0], "1", "1", "1", "1", "1", "1"),
             (rows[0][0], rows[0][1], "1", "1", "1", "-1", "1", "1"), (rows[0][0], rows[0][1], None, "1", "1", "1", "1", "1")]
    return spark.createDataFrame(rows, "lpep_pickup_datetime string, lpep_dropoff_datetime string, PULocationID string, "
                                       "DOLocationID string, VendorID string, trip_distance string, fare_amount string, total_amount string")


def raw_zones(spark):
    return spark.createDataFrame([("1", "Queens", "A", "Boro Zone"), ("1", "Bronx", "A", "Boro Zone"), ("2", "EWR", "B", "EWR"),
                                  ("3", "Manhattan", "C", "Yellow Zone")], "LocationID string, Borough string, Zone string, service_zone string")


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lake(spark, scratch_dir(spark, "test-lake"))
    run_elt(lake, raw_trips(spark), raw_zones(spark), "r1")
    return lake


def test_layers(lake):
    assert lake.read(S.BRONZE_TRIPS).count() == 603  # only the undated row is gone
    silver = lake.read(S.SILVER_TRIPS)
    assert set(silver.columns) == set(S.CANONICAL_COLUMNS) and silver.count() == 600
    assert silver.where("pickup_location_id = 1").select("pickup_borough").distinct().count() == 1
    gold = lake.read(S.GOLD_MATRIX, S.MATRIX_COLUMNS)
    assert gold.count() == 600 and gold.where("pickup_service_zone_id > 0").count() == 600
    contract = lake.read(S.GOLD_CONTRACTS, S.CONTRACT_COLUMNS).first()
    assert contract.training_row_count == 600
    assert contract.schema_hash == schema_hash(feature_spec(["boro zone", "ewr", "yellow zone"]))
    assert json.loads(contract.encoding_spec_json)["pickup_service_zone_id"]["values"] == {
        "1": "boro zone", "2": "ewr", "3": "yellow zone"}


def test_history_and_snapshots(lake):
    history = lake.history()
    assert history.where("is_current").count() == 5
    table = "lake.silver.trip_canonical"
    snap = pin_snapshot(history, table)
    assert current_snapshot(history, table).first().snapshot_id == snap
    with pytest.raises(ValueError):
        pin_snapshot(history, table, "older")
    with pytest.raises(ValueError):
        pin_snapshot(history, "lake.silver.none")


def test_rerun_is_idempotent_and_other_runs_stay(spark):
    lake = Lake(spark, scratch_dir(spark, "rerun"))
    for _ in range(2):
        ingest(lake, raw_trips(spark, 50), raw_zones(spark), run_id="a", trips_uri="x@1", zones_uri="z")
    ingest(lake, raw_trips(spark, 30), raw_zones(spark), run_id="b", trips_uri="x@1", zones_uri="z")
    counts = {r.run_id: r["count"] for r in lake.read(S.BRONZE_TRIPS).groupBy("run_id").count().collect()}
    assert counts == {"a": 53, "b": 33}
    assert lake.read(S.BRONZE_ZONES).count() == 3
    build_silver(lake, "b")
    assert filter_run(lake.read(S.SILVER_TRIPS), "b").count() == 30
    with pytest.raises(ValueError):
        build_silver(lake, "missing")


def test_contract_conflict_stops_before_publishing(spark):
    lake = Lake(spark, scratch_dir(spark, "conflict"))
    run_elt(lake, raw_trips(spark, 60), raw_zones(spark), "r1")
    more = raw_zones(spark).union(spark.createDataFrame([("4", "Bronx", "D", "Airports")], "a string, b string, c string, d string"))
    ingest(lake, raw_trips(spark, 60, offset=1000), more, run_id="r2", trips_uri="x", zones_uri="z")
    build_silver(lake, "r2")
    before = lake.read(S.GOLD_MATRIX).count()
    with pytest.raises(ValueError, match="encoding_spec_json"):
        build_gold(lake, "r2")
    assert lake.read(S.GOLD_MATRIX).count() == before


def test_contract_operators(spark):
    def one(run, at, zones, **change):
        df = build_contract(spark, run_id=run, gold_table="lake.gold.m", silver_table="lake.silver.t", snapshot_id="1", rows=5,
                            service_zones=zones, created_ts=at)
        return df.withColumns({k: F.lit(v) for k, v in change.items()}) if change else df

    old = one("a", datetime(2024, 1, 1), ["x"]).union(one("b", datetime(2024, 1, 2), ["x", "y"]))
    assert latest_contract(old).first().run_id == "b"
    same = one("c", datetime(2024, 1, 3), ["x", "y"])
    spaced = json.dumps(json.loads(same.first().label_spec_json), indent=2)
    assert contract_conflicts(old, same.withColumn("label_spec_json", F.lit(spaced))).count() == 0
    clash = contract_conflicts(old, one("d", datetime(2024, 1, 3), ["x"], gold_table="other"))
    assert {r.field for r in clash.collect()} == {"gold_table", "feature_spec_json", "encoding_spec_json"}
    assert contract_violations(same).first().violations == []
    bad = one("e", datetime(2024, 1, 3), ["x"], schema_hash="zz", label_spec_json="{")
    assert contract_violations(bad).first().violations == ["unreadable label_spec_json", "schema_hash is not sha256 hex"]
    kinds = {r.kind: r["count"] for r in explode_contract(same).groupBy("kind").count().collect()}
    assert kinds == {"column": 21, "encoding": 7, "value": 16, "aggregate": 3, "label": 9}


def test_gates(spark, lake):
    gold = lake.read(S.GOLD_MATRIX, S.MATRIX_COLUMNS)
    assert require_clean(matrix_gate(gold, 3), "m")["n_rows"] == 600
    require_clean(train_gate(gold), "m")
    require_clean(drift_gate(gold), "m")
    twice = gold.union(gold.limit(1))
    with pytest.raises(ValueError, match="duplicate_ids"):
        require_clean(matrix_gate(twice, 3), "m")
    with pytest.raises(ValueError, match="out_of_range"):
        require_clean(matrix_gate(gold, 2), "m")
    with pytest.raises(ValueError, match="label_too_large"):
        require_clean(matrix_gate(gold, 3, max_label=100), "m")
    with pytest.raises(ValueError, match="bad_schema_version"):
        require_clean(train_gate(gold, schema_version="v0"), "m")
    with pytest.raises(ValueError, match="no rows"):
        require_clean(train_gate(gold.where("false")), "m")
    with pytest.raises(ValueError):
        require_exact_columns(gold.drop("trip_id"), S.MATRIX_COLUMNS, "m")
    _, contract = load_training_inputs(lake)
    require_clean(contract_gate(gold, contract), "m")
    with pytest.raises(ValueError, match="bad_feature_version"):
        require_clean(contract_gate(gold, {**contract, "feature_version": "v0"}), "m")
    spec = json.loads(contract["feature_spec_json"])
    for column in spec["output_columns"]:
        if column["name"] == "pickup_borough_id":
            column["domain"] = [0, 99]
    with pytest.raises(ValueError, match="outside_domain"):
        require_clean(contract_gate(gold, {**contract, "feature_spec_json": json.dumps(spec)}), "m")
    with pytest.raises(ValueError, match="columns differ"):
        contract_gate(gold, {**contract, "output_columns_json": '["trip_id"]'})
    assert count_violations(gold, {"x": F.col("pickup_hour") > 23}).first().asDict() == {"n_rows": 600, "x": 0}


def test_training_and_scoring(spark, lake):
    matrix, contract = load_training_inputs(lake)
    assert contract["feature_version"] == S.FEATURE_VERSION
    result = train(matrix, sample_rows=150, rounds=2, candidates=CANDIDATES[4:6], test_start="2025-01-17", min_rounds=3, contract=contract)
    assert result["winner"] in {c.name for c in CANDIDATES[4:6]} and len(result["candidates"]) == 2
    assert result["metrics"]["test"]["rows"] == matrix.where("as_of_date >= '2025-01-17'").count()
    scored = score(matrix, result["model"], result["label_cap"])
    assert scored.where("prediction_seconds IS NULL OR prediction_seconds < 0").count() == 0
    assert scored.agg(F.max("prediction_seconds")).first()[0] <= result["label_cap"]
    body = {c: 1 for c in S.FEATURES}
    requests = spark.createDataFrame([(1, json.dumps([body, body])), (2, "{")], "request_id int, body string")
    got = {r.request_id: (r.status_code, json.loads(r.response)) for r in
           score_requests(requests, result["model"], result["label_cap"], "m1").collect()}
    assert got[1][0] == 200 and len(got[1][1]["predictions"]) == 2 and got[2] == (400, {"detail": "Invalid JSON body"})


def test_drift_job(spark, lake):
    gold = lake.read(S.GOLD_MATRIX, S.MATRIX_COLUMNS)
    out = scratch_dir(spark, "drift")
    shifted = gold.withColumn("pickup_zone_id", F.lit(77))
    same = run_drift(gold, gold).first()
    assert same.drifted_columns == [] and not same.any_drift and same.monitored_columns == 15
    moved = run_drift(shifted, gold, output=out).first()
    assert moved.drifted_columns == ["pickup_zone_id"] and moved.any_drift and not moved.share_drift
    assert json.loads(spark.read.text(f"{out}/summary").first()[0])["drifted_columns_count"] == 1
    with pytest.raises(ValueError):
        run_drift(gold.withColumn("trip_id", F.lit(None).cast("string")), gold)


def test_maintenance_sweep(spark):
    lake = Lake(spark, scratch_dir(spark, "upkeep"))
    run_elt(lake, raw_trips(spark, 80, days=3), raw_zones(spark), "r1")
    gold = lake.read(S.GOLD_MATRIX)
    extra = lake.path(S.GOLD_MATRIX)
    gold.where("as_of_date = '2025-01-01'").limit(0).write.mode("append").partitionBy("as_of_date").parquet(extra)
    stray = f"{extra}/as_of_date=2025-01-01/part-stray.parquet"
    gold.drop("as_of_date").limit(1).coalesce(1).write.parquet(f"{lake.root}/one")
    source = next(f for f in os.listdir(f"{lake.root}/one") if f.endswith(".parquet"))
    with open(f"{lake.root}/one/{source}", "rb") as a, open(stray, "wb") as b:
        b.write(a.read())
    os.utime(stray, (0, 0))
    later = datetime(2040, 1, 1)
    plan = Upkeep(orphans=(*S.MANAGED_TABLES, "gold.none"), delete_orphans=True, compact=(S.GOLD_MATRIX, S.SILVER_TRIPS),
                  compact_where=F.col("as_of_date").isNotNull())
    rows = {(r.table_id, r.operation): (r.status, r.message) for r in maintain(lake, plan, later).collect()}
    assert rows[("lake.gold.trip_training_matrix", "remove_orphan_files")] == ("ok", "1 files removed")
    assert not os.path.exists(stray)
    assert rows[("lake.gold.none", "remove_orphan_files")] == ("skipped", "table_missing")
    assert rows[("lake.silver.trip_canonical", "rewrite_data_files")][0] == "skipped"
    assert lake.read(S.GOLD_MATRIX).count() == 80
    assert lake.history().where("is_current").count() == 5


def test_expiry_keeps_newest_and_current(spark):
    rows = [("t", str(i), datetime(2024, 1, i), i == 2) for i in range(1, 7)]
    history = spark.createDataFrame(rows, "table_id string, snapshot_id string, made_current_at timestamp_ntz, is_current boolean")
    got = {r.snapshot_id for r in expiry_plan(history, datetime(2024, 1, 6), retain_last=2).collect()}
    assert got == {"1", "3", "4"}


def test_orphans_and_compaction(spark):
    listing = spark.createDataFrame([("s3://b/a", datetime(2024, 1, 1)), ("s3://b/c", datetime(2024, 1, 1)), ("file:/b", datetime(2024, 1, 9))],
                                    "path string, modified timestamp_ntz")
    live = spark.createDataFrame([("s3a://other/a",)], "path string")
    assert [r.path for r in orphan_files(listing, live, "2024-01-05 00:00:00").collect()] == ["s3://b/c"]
    files = spark.createDataFrame([("p1", 10), ("p1", 20), ("p1", 300 << 20), ("p2", 5), ("p3", 10), ("p3", 300 << 20)], "partition string, bytes long")
    assert [(r.partition, r.n_files, r.target_files) for r in compaction_plan(files).collect()] == [("p1", 3, 2)]


def test_readers(spark):
    base = scratch_dir(spark, "readers")
    spark.range(30).withColumn("d", F.col("id") % 3).write.partitionBy("d").parquet(f"{base}/t")
    spark.range(2).selectExpr("id", "id AS extra", "9 AS d").write.mode("append").partitionBy("d").parquet(f"{base}/t")
    assert read_dataset(spark, f"{base}/t").count() == 32
    files = with_partition(list_files(spark, f"{base}/t"), f"{base}/t").where("path LIKE '%.parquet'")
    assert {r.partition for r in files.collect()} == {"d=0/", "d=1/", "d=2/", "d=9/"}
    everything = read_first_files(spark, f"{base}/t", 1000)
    assert everything.count() == 32 and "extra" in everything.columns
    spark.createDataFrame([("1", "a")], "LocationID string, Zone string").write.option("header", True).csv(f"{base}/csv")
    assert read_csv_lookup(spark, f"{base}/csv").first().asDict() == {"LocationID": "1", "Zone": "a"}
    with open(f"{base}/t/d=0/part-bad.parquet", "wb") as f:
        f.write(b"not parquet")
    assert read_skipping_corrupt(spark, f"{base}/t").count() == 32
    listing = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 3)), ("c", datetime(2024, 1, 2))],
                                    "path string, modified timestamp_ntz")
    assert latest_by_time(listing).first().path == "b"
    write_json_report(spark.range(1), f"{base}/report")
    assert spark.read.text(f"{base}/report").first()[0] == '{"id":0}'


def test_bronze_prefers_first_readable_candidate(spark):
    raw = spark.createDataFrame([(None, "2024-01-01 10:00:00", "1.0"), ("2024-02-02T00:00:00", "x", "9")],
                                "lpep_pickup_datetime string, tpep_pickup_datetime string, PULocationID string")
    out = to_bronze(raw.withColumns({c: F.lit("1") for c in ("trip_distance", "fare_amount", "total_amount")}), "r", "u@1", "1")
    got = sorted((r.pickup_ts, r.pickup_location_id, r.event_date, r.source_file) for r in out.collect())
    assert got == [(datetime(2024, 1, 1, 10), 1, date(2024, 1, 1), "u"), (datetime(2024, 2, 2), 9, date(2024, 2, 2), "u")]
    assert json.loads(out.where("pickup_location_id = 9").first().raw_record_json)["tpep_pickup_datetime"] == "x"


def test_instants_are_read_as_utc(spark):
    raw = spark.sql("SELECT timestamp_seconds(1710037800) AS tpep_pickup_datetime, '1' AS PULocationID, '1' AS trip_distance, "
                    "'1' AS fare_amount, '1' AS total_amount")
    assert to_bronze(raw, "r", "u", "1").first().pickup_ts == datetime(2024, 3, 10, 2, 30)


def test_stream_bronze(spark):
    from waymark.streaming.jobs import read_files, stream_ingest

    base = scratch_dir(spark, "stream-bronze")
    raw_trips(spark, 40).coalesce(3).write.parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    stream_ingest(read_files(spark, f"{base}/in", schema, max_files=1), lambda b: to_bronze(b, "r1", "u@1", "1").drop("run_id"),
                  f"{base}/out", "r1", f"{base}/state").awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == 43
