"""Inputs: datasets, lookups, pruned table scans and file listings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.columns import normalize_columns, raw_record_json, to_text_schema
from waymark.functions.times import instants_to_utc_wall, utc_wall
from waymark.settings import RAW_TRIP_FIELDS, RAW_ZONE_FIELDS


def read_dataset(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", **options) -> DataFrame:
    """A whole dataset; executors read the files, nothing passes through the driver."""
    return spark.read.format(fmt).options(**options).load(path if isinstance(path, str) else list(path))


def read_csv_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, every column as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only ``columns``, in that order; the scan reads nothing else."""
    return spark.read.parquet(path).select(*columns)


def read_skipping_corrupt(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The readable rows below ``path``. Without a schema all footers are merged, as the first file may be a broken one."""
    reader = spark.read.option("ignoreCorruptFiles", True)
    return (reader.schema(schema) if schema else reader.option("mergeSchema", True)).parquet(path)


def read_checked(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """The readable rows below ``path``, and ``path, length, reason`` of every file that gave none.

    The scan says which files it got rows from; only the others are opened again, to name what is wrong: ``not parquet``
    (no marker at the start), ``truncated`` (none at the end), ``unreadable`` (both, but no rows) or ``empty``.
    """
    data = read_skipping_corrupt(spark, path, schema)
    seen = data.select(F.col("_metadata.file_path").alias("path")).distinct()
    # Only paths of files that gave nothing; the driver lists every path anyway to plan the scan.
    suspects = [r["path"] for r in list_files(spark, path).join(seen, "path", "left_anti").select("path").collect()]
    if not suspects:
        return data, spark.createDataFrame([], "path string, length bigint, reason string")
    opened = spark.read.format("binaryFile").load(suspects)
    marker = F.lit(b"PAR1")
    reason = (F.when(F.col("length") == 0, "empty").when(F.substring("content", 1, 4) != marker, "not parquet")
              .when(F.substring("content", -4, 4) != marker, "truncated").otherwise("unreadable or without rows"))
    return data, opened.select("path", "length", reason.alias("reason"))


def land_trips(raw: DataFrame) -> DataFrame:
    """Source rows in the all-text landing schema, with the record kept as JSON."""
    return _land(raw, RAW_TRIP_FIELDS)


def land_zones(raw: DataFrame) -> DataFrame:
    return _land(raw, RAW_ZONE_FIELDS)


def _land(raw: DataFrame, fields: Sequence[str]) -> DataFrame:
    named = instants_to_utc_wall(normalize_columns(raw))
    return to_text_schema(named.withColumn("raw_record_json", raw_record_json(named)), fields)


def cap_rows(df: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` rows; 0 keeps everything."""
    return df.limit(max_rows) if max_rows > 0 else df


def preview(df: DataFrame, n: int = 2) -> DataFrame:
    return df.limit(n)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time (UTC) of every data file below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), utc_wall(F.col("modificationTime")).alias("modified"))


def with_partition(files: DataFrame, root: str) -> DataFrame:
    """Add the ``a=1/b=2`` part of each path."""
    return files.withColumn("partition", F.regexp_extract("path", r"((?:[^/=]+=[^/]*/)+)[^/]*$", 1))


def read_first_files(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """The first ``max_files`` Parquet files by name; differing columns become NULL."""
    files = (list_files(spark, path).where(F.col("path").endswith(".parquet"))
             .orderBy("path").limit(max_files).select("path").collect())
    if not files:
        raise ValueError(f"no Parquet files under {path}")
    frames = [spark.read.option("basePath", path).parquet(r["path"]) for r in files]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_by_time(files: DataFrame) -> DataFrame:
    """Path of the most recently modified file."""
    return files.agg(F.max_by("path", F.struct("modified", "path")).alias("path"), F.max("modified").alias("modified"))


METADATA_DDL = (
    "struct<`format-version`: int, `table-uuid`: string, location: string, `current-snapshot-id`: bigint, "
    "`current-schema-id`: int, "
    "schemas: array<struct<`schema-id`: int, fields: array<struct<id: int, name: string, required: boolean, type: string>>>>, "
    "`partition-specs`: array<struct<`spec-id`: int, fields: array<struct<name: string, transform: string>>>>, "
    "snapshots: array<struct<`snapshot-id`: bigint, `timestamp-ms`: bigint, operation: string>>>"
)


def describe_metadata(texts: DataFrame, column: str = "value", last: int = 3) -> DataFrame:
    """Version, columns, partition fields and the last snapshots of table-metadata JSON texts."""
    doc = F.from_json(column, METADATA_DDL)
    current = F.get(F.filter(doc["schemas"], lambda s: s["schema-id"] == doc["current-schema-id"]), F.lit(0))
    newest = F.slice(F.reverse(F.array_sort(F.transform(
        doc["snapshots"], lambda s: F.struct(s["timestamp-ms"].alias("at"), s["snapshot-id"].alias("id"))))), 1, last)
    return texts.select(
        doc["format-version"].alias("format_version"), doc["table-uuid"].alias("table_uuid"),
        doc["location"].alias("location"), doc["current-snapshot-id"].alias("current_snapshot_id"),
        F.transform(current["fields"], lambda f: F.concat_ws(" ", f["name"], f["type"])).alias("columns"),
        F.flatten(F.transform(doc["partition-specs"], lambda s: F.transform(s["fields"], lambda f: f["name"])))
        .alias("partition_fields"),
        F.transform(newest, lambda s: s["id"]).alias("last_snapshots"),
    )


def describe_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column, as rows."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, T.StructType().add("position", "int").add("name", "string")
                                 .add("type", "string").add("nullable", "boolean"))
