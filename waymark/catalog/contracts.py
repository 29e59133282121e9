"""Snapshots, contracts and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F


from waymark.catalog import fixtures as X
from waymark.catalog.registry import query, table
from waymark.functions.hashing import canonical_json_text
from waymark.operators.contract import (contract_conflicts, contract_violations, current_snapshot, explode_contract,
                                        latest_contract)


@query("latest_snapshot", f"""
SELECT table_id, snapshot_id, made_current_at FROM ({X.HISTORY}) h WHERE is_current_ancestor
QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY made_current_at DESC, snapshot_id DESC) = 1""")
def latest_snapshot(spark, sf):
    return current_snapshot(X.history(spark, sf))


@query("latest_contract", f"""
SELECT run_id, feature_version, schema_hash, training_row_count, created_ts FROM ({X.CONTRACTS}) c
QUALIFY row_number() OVER (PARTITION BY feature_version ORDER BY created_ts DESC) = 1""")
def newest_contracts(spark, sf):
    return latest_contract(X.contracts(spark, sf)).select("run_id", "feature_version", "schema_hash", "training_row_count",
                                                          "created_ts")


@query("contract_checks", f"""
SELECT run_id, feature_version, concat_ws(';',
  CASE WHEN NOT json_valid(encoding_spec_json) THEN 'unreadable encoding_spec_json' END,
  CASE WHEN NOT regexp_full_match(schema_hash, '[0-9a-f]{{64}}') THEN 'schema_hash is not sha256 hex' END,
  CASE WHEN output_columns_json = '["a"]' THEN 'output columns differ' END,
  CASE WHEN training_row_count <= 0 THEN 'no training rows' END) AS violations FROM ({X.CONTRACTS}) c""")
def contract_checks(spark, sf):
    return contract_violations(X.contracts(spark, sf)).withColumn("violations", F.array_join("violations", ";"))


@query("contract_specs", f"""
WITH c AS (SELECT run_id, feature_version, c_custkey, c_nationkey, c_mktsegment FROM ({X.CONTRACTS}) k
  JOIN customer ON run_id = 'run-' || c_custkey)
SELECT run_id, feature_version, 'column' AS kind, 'f' || c_nationkey AS name, 'int32' AS detail, 'feature/required' AS extra FROM c
UNION ALL SELECT run_id, feature_version, 'encoding', 'z', 'versioned_lookup', 's' FROM c WHERE c_custkey % 19 <> 0
UNION ALL SELECT run_id, feature_version, 'value', 'z', '1', c_mktsegment FROM c WHERE c_custkey % 19 <> 0
UNION ALL SELECT run_id, feature_version, 'value', 'z', '2', 'b' FROM c WHERE c_custkey % 19 <> 0
UNION ALL SELECT run_id, feature_version, 'aggregate', 'a', '7d', 'k,h' FROM c
UNION ALL SELECT run_id, feature_version, 'label', 'name', 'label', NULL FROM c
UNION ALL SELECT run_id, feature_version, 'label', 'unit', 'seconds', NULL FROM c""")
def contract_specs(spark, sf):
    readable = X.contracts(spark, sf).withColumn(
        "encoding_spec_json", F.when(F.try_parse_json("encoding_spec_json").isNotNull(), F.col("encoding_spec_json")))
    return explode_contract(readable)


@query("contract_stability", f"""
WITH c AS (SELECT run_id, feature_version, created_ts, c_custkey, c_mktsegment, c_nationkey FROM ({X.CONTRACTS}) k
  JOIN customer ON run_id = 'run-' || c_custkey),
o AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY feature_version ORDER BY created_ts DESC) = 1),
p AS (SELECT 'new-' || n.c_custkey AS run_id, n.feature_version, n.c_custkey AS nk, o.c_custkey AS ok,
  n.c_mktsegment AS nm, o.c_mktsegment AS om, n.c_nationkey AS nn, o.c_nationkey AS onat FROM c n JOIN o USING (feature_version))
SELECT run_id, feature_version, 'model_family' AS field FROM p WHERE nk % 7 = 0
UNION ALL SELECT run_id, feature_version, 'output_columns_json' FROM p WHERE (nk % 17 = 0) <> (ok % 17 = 0)
UNION ALL SELECT run_id, feature_version, 'feature_spec_json' FROM p WHERE nn <> onat
UNION ALL SELECT run_id, feature_version, 'encoding_spec_json' FROM p WHERE nm <> om OR nk % 19 = 0 OR ok % 19 = 0
UNION ALL SELECT run_id, feature_version, 'aggregate_spec_json' FROM p WHERE nk % 5 = 0""")
def contract_stability(spark, sf):
    """Every customer's contract, re-issued with reordered JSON and some changes, against the newest of its version."""
    old = X.contracts(spark, sf)
    key = F.regexp_extract("run_id", r"(\d+)$", 1).cast("bigint")
    new = old.withColumns({
        "run_id": F.concat(F.lit("new-"), key.cast("string")),
        "model_family": F.when(key % 7 == 0, F.lit("linear")).otherwise(F.col("model_family")),
        "label_spec_json": F.lit('{ "unit":"seconds",\n "name":"label" }'),
        "aggregate_spec_json": F.when(key % 5 == 0, F.replace("aggregate_spec_json", F.lit("7d"), F.lit("8d")))
        .otherwise(F.col("aggregate_spec_json")),
    })
    return contract_conflicts(old, new)


@query("canonical_json", """
SELECT event_id, '{"a":{"x":' || event_id || ',"y":[1,2]},"k":' || json_extract(props, '$.k') || '}' AS doc FROM events""")
def canonical_documents(spark, sf):
    events = table(spark, sf, "events")
    text = F.concat(F.lit('{ "k": '), F.get_json_object("props", "$.k"), F.lit(', "a": {"y": [1, 2], "x": '),
                    F.col("event_id").cast("string"), F.lit("}}"))
    return events.select("event_id", canonical_json_text(text).alias("doc"))


