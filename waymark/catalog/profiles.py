"""Table profiles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.catalog import fixtures as X
from waymark.catalog.registry import query, table
from waymark.operators.profile import (partition_counts, profile_categorical, profile_dates, profile_label, profile_nulls,
                                       profile_numeric, summarize_int_list, summarize_map, summarize_text_list,
                                       truncate_columns)
from waymark.session import scratch_dir
from waymark.sources.lake import Lake
from waymark.sources.readers import (cap_rows, describe_metadata, latest_by_time, list_files, read_columns,
                                     read_checked, read_first_files)

_BROKEN_TESTS = {c: f"{c} IS NULL" + (f" OR isnan({c})" if c in (*S.NUMERIC_FEATURES, S.LABEL) else "") for c in S.MATRIX_COLUMNS}


@query("profile_nulls", f"""
WITH m AS ({X.BROKEN_MATRIX}), n AS (
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, count(*) FILTER ({t}) AS null_count, count(*) AS n FROM m" for c, t in _BROKEN_TESTS.items())})
SELECT column_name, null_count, null_count * 100.0::double / n AS null_pct FROM n WHERE null_count > 0""")
def nulls(spark, sf):
    return profile_nulls(X.matrix(spark, sf, broken=True))


_NUM = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")


@query("profile_numeric", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS n_values, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  cast(min({c}) AS double) AS min, cast(quantile_cont({c}, 0.25) AS double) AS p25, cast(quantile_cont({c}, 0.5) AS double) AS p50,
  cast(quantile_cont({c}, 0.75) AS double) AS p75, cast(max({c}) AS double) AS max FROM lineitem""" for c in _NUM))
def numeric(spark, sf):
    out = profile_numeric(table(spark, sf, "lineitem"), _NUM)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std")})



@query("profile_categorical", "\nUNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS column_name, (SELECT count(DISTINCT {c}) FROM documents) AS n_distinct,
  cast(row_number() OVER (ORDER BY count(*) DESC, {c}) AS int) AS rank, {c} AS value, count(*) AS n_rows
  FROM documents GROUP BY {c}) WHERE rank <= 5""" for c in ("lang", "source", "text")))
def categorical(spark, sf):
    return profile_categorical(table(spark, sf, "documents"), ["lang", "source", "text"])


@query("profile_label", f"""
WITH m AS (SELECT CASE WHEN isnan({S.LABEL}) THEN NULL ELSE {S.LABEL} END AS y FROM ({X.BROKEN_MATRIX}) b)
SELECT count(y) AS non_null, count(*) - count(y) AS nulls, min(y) AS min, round(avg(y), 6) AS mean, median(y) AS median,
  round(quantile_cont(y, 0.95), 6) AS p95, max(y) AS max FROM m""")
def label(spark, sf):
    out = profile_label(X.matrix(spark, sf, broken=True), S.LABEL)
    return out.withColumns({"mean": F.round("mean", 6), "p95": F.round("p95", 6)})


@query("profile_dates", f"""
WITH d AS ({X.DIRTY})
SELECT 'pickup_raw' AS column_name, min(try_cast(trim(pickup_raw) AS timestamp)) AS min_ts, max(try_cast(trim(pickup_raw) AS timestamp)) AS max_ts FROM d
UNION ALL SELECT 'second_raw', min(try_cast(trim(second_raw) AS timestamp)), max(try_cast(trim(second_raw) AS timestamp)) FROM d""")
def dates(spark, sf):
    return profile_dates(X.dirty(spark, sf), ["pickup_raw", "second_raw"])


@query("truncate_preview", """
SELECT doc_id, CASE WHEN length(text) > 180 THEN substring(text, 1, 177) || '...' ELSE text END AS text, lang FROM documents""")
def truncated(spark, sf):
    return truncate_columns(table(spark, sf, "documents").select("doc_id", "text", "lang"))


@query("int_list_preview", """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN
    CASE WHEN p_size = 0 THEN '[]' WHEN p_size <= 10 THEN '[' || array_to_string(range(1, p_size + 1), ', ') || ']'
    ELSE 'int_range(1..' || p_size || ') [len=' || p_size || ']' END
  ELSE CASE WHEN p_size <= 10 THEN '[' || array_to_string(list_transform(range(1, p_size + 1), lambda x: x * 3), ', ') || ']'
    ELSE '[3, 6, 9, 12, 15, ..., ' || (p_size - 2) * 3 || ', ' || (p_size - 1) * 3 || ', ' || p_size * 3 || '] [len=' || p_size || ']' END
  END AS preview FROM part""")
def int_lists(spark, sf):
    part = table(spark, sf, "part")
    step = F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(3)
    values = F.when(F.col("p_size") > 0, F.sequence(step, F.col("p_size") * step, step)).otherwise(F.array().cast("array<int>"))
    return part.select("p_partkey", summarize_int_list(values).alias("preview"))


@query("nested_preview", """
WITH p AS (SELECT p_partkey, range(1, p_size + 1) AS r, p_size, p_type, chr(39) AS q FROM part)
SELECT p_partkey,
  '{ ' || array_to_string(list_concat(list_transform(r[1:12], lambda x: 'k' || x || '=' || p_type),
    CASE WHEN p_size > 12 THEN ['... +' || (p_size - 12) || ' more'] ELSE [] END), ', ') || ' }' AS map_preview,
  CASE WHEN p_size <= 10 THEN '[' || array_to_string(list_transform(r, lambda x: q || 'k' || x || q), ', ') || ']'
    ELSE '[' || array_to_string(list_transform(r[1:5], lambda x: q || 'k' || x || q), ', ') || ', ..., '
      || array_to_string(list_transform(r[p_size - 2:p_size], lambda x: q || 'k' || x || q), ', ') || '] [len=' || p_size || ']'
  END AS list_preview
FROM p""")
def nested(spark, sf):
    part = table(spark, sf, "part")
    keys = F.transform(F.sequence(F.lit(1), "p_size"), lambda x: F.concat(F.lit("k"), x.cast("string")))
    filled = part.withColumn("keys", F.when(F.col("p_size") > 0, keys).otherwise(F.array().cast("array<string>")))
    pairs = F.map_from_arrays("keys", F.transform("keys", lambda k: F.col("p_type")))
    return filled.select("p_partkey", summarize_map(pairs).alias("map_preview"), summarize_text_list(F.col("keys")).alias("list_preview"))


@query("metadata_summary", """
SELECT c_custkey, 2 AS format_version, 'u' || c_custkey AS table_uuid, cast(c_custkey * 10 AS bigint) AS current_snapshot_id,
  'id long,seg' || c_nationkey || ' string' AS columns, 'as_of_date' AS partition_fields,
  (c_custkey * 10 || ',' || (c_custkey * 10 - 1) || ',' || (c_custkey * 10 - 2)) AS last_snapshots FROM customer""")
def metadata_summary(spark, sf):
    """One table-metadata document per customer."""
    c = table(spark, sf, "customer")
    snap = [F.format_string('{"snapshot-id":%d,"timestamp-ms":%d}', F.col("c_custkey") * 10 - i, F.lit(1000 - i)) for i in (3, 0, 2, 1)]
    doc = F.concat(
        F.lit('{"format-version":2,"table-uuid":"u'), F.col("c_custkey").cast("string"),
        F.lit('","location":"s3://x","current-schema-id":1,"current-snapshot-id":'), (F.col("c_custkey") * 10).cast("string"),
        F.lit(',"schemas":[{"schema-id":0,"fields":[]},{"schema-id":1,"fields":[{"id":1,"name":"id","required":true,"type":"long"},'
              '{"id":2,"name":"seg'), F.col("c_nationkey").cast("string"),
        F.lit('","required":false,"type":"string"}]}],"partition-specs":[{"spec-id":0,"fields":[{"name":"as_of_date",'
              '"transform":"identity"}]}],"snapshots":['), F.concat_ws(",", *snap), F.lit("]}"))
    out = describe_metadata(c.select(doc.alias("value"), "c_custkey"))
    # The document keys the row: its uuid carries the customer.
    return out.select(F.substring("table_uuid", 2, 20).cast("bigint").alias("c_custkey"), "format_version", "table_uuid",
                      "current_snapshot_id", F.array_join("columns", ",").alias("columns"),
                      F.array_join("partition_fields", ",").alias("partition_fields"),
                      F.array_join("last_snapshots", ",").alias("last_snapshots"))


@query("partition_counts", "SELECT 'o_orderstatus=' || o_orderstatus AS partition, cast(least(count(*), 3) AS bigint) AS n_files FROM orders GROUP BY ALL")
def partitions(spark, sf):
    path = scratch_dir(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    place = F.row_number().over(Window.partitionBy("o_orderstatus").orderBy("o_orderkey"))
    for k in range(3):  # three writes, so three files a status
        some = orders.withColumn("_k", place).where(F.col("_k") % 3 == k).drop("_k")
        some.repartition("o_orderstatus").write.mode("append").partitionBy("o_orderstatus").parquet(path)
    return partition_counts(spark.read.parquet(path))


@query("file_listing")
def file_listing(spark, sf):
    return list_files(spark, sf).where(F.col("path").endswith(".parquet"))


@query("latest_file")
def latest_file(spark, sf):
    return latest_by_time(list_files(spark, sf))


@query("bounded_files", "SELECT count(*) AS n_rows, cast(sum(o_orderkey) AS bigint) AS key_sum FROM orders")
def bounded_files(spark, sf):
    """A copy of orders read back file by file, up to more files than it has."""
    path = scratch_dir(spark, "orders")
    table(spark, sf, "orders").select("o_orderkey", "o_custkey").repartition(3, "o_custkey").write.parquet(path)
    return read_first_files(spark, path, 20).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum"))


@query("pruned_scan", "SELECT o_totalprice, o_orderkey FROM orders WHERE o_totalprice > 300000")
def pruned_scan(spark, sf):
    return read_columns(spark, f"{sf}/orders.parquet", ["o_totalprice", "o_orderkey"]).where(F.col("o_totalprice") > 300000)


@query("skip_corrupt_scan", """
SELECT count(*) AS n_rows, cast(sum(c_custkey) AS bigint) AS key_sum, cast(0 AS bigint) AS n_files, 'read' AS reason FROM customer
UNION ALL SELECT NULL, NULL, 1, 'not parquet' UNION ALL SELECT NULL, NULL, 1, 'truncated'""")
def skip_corrupt_scan(spark, sf):
    """A copy of customer with two broken files among its own: all rows, and both files named."""
    path = scratch_dir(spark, "broken")
    customers = table(spark, sf, "customer")
    customers.select("c_custkey", "c_name").repartition(3).write.parquet(path)
    segment = customers.agg(F.max("c_mktsegment").alias("t"))
    for start in ("", "PAR1"):
        segment.select(F.concat(F.lit(start), "t").alias("line")).coalesce(1).write.mode("append").text(path)
    data, quarantine = read_checked(spark, path)
    whole = data.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("c_custkey").alias("key_sum")).select("n_rows", "key_sum", F.lit(0).cast("bigint").alias("n_files"), F.lit("read").alias("reason"))
    bad = quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("n_files"))
    none = F.lit(None).cast("bigint")
    return whole.unionByName(bad.select(none.alias("n_rows"), none.alias("key_sum"), "n_files", "reason"))


@query("row_cap", "SELECT least(count(*), 5000) AS n_rows FROM events")
def row_cap(spark, sf):
    return cap_rows(table(spark, sf, "events"), 5000).agg(F.count(F.lit(1)).alias("n_rows"))


@query("table_copy", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def table_copy(spark, sf):
    """A Parquet file loaded under a warehouse table name and read back."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    lake.copy(f"{sf}/customer.parquet", "bronze.customer", "run-1", ("c_mktsegment",))
    return lake.read("bronze.customer", ["c_custkey", "c_name", "c_mktsegment"])
