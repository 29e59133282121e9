"""Table profiles computed in one or two distributed passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.parsing import safe_ts
from waymark.operators.ranking import exact_quantiles

TOP_VALUES = 5
MAX_TEXT = 180
MAX_LIST = 10
MAX_MAP = 12


def _missing(df: DataFrame, column: str):
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def profile_nulls(df: DataFrame, max_columns: int | None = None) -> DataFrame:
    """Columns with missing values (NULL or NaN), worst first; all of them unless ``max_columns`` asks for a top list."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.when(_missing(df, c), 1)).alias(c) for c in df.columns])
    out = (
        row.unpivot(["_rows"], list(df.columns), "column_name", "null_count")
        .where(F.col("null_count") > 0)
        .select("column_name", "null_count", (F.col("null_count") * 100.0 / F.col("_rows")).alias("null_pct"))
        .orderBy(F.col("null_count").desc(), "column_name")
    )
    return out if max_columns is None else out.limit(max_columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.5, 0.75])
    stats = []
    for c in columns:
        v = F.when(~_missing(df, c), F.col(c).cast("double"))
        q25, q50, q75 = (F.lit(q).cast("double") for q in quartiles[c])
        stats.append(F.struct(
            F.lit(c).alias("column_name"), F.count(v).alias("n_values"), F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"), F.min(v).alias("min"), q25.alias("p25"), q50.alias("p50"),
            q75.alias("p75"), F.max(v).alias("max")))
    return df.agg(F.array(*stats).alias("_s")).select(F.inline("_s"))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and value, NULL included, in one shuffle."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    )


def profile_categorical(df: DataFrame, columns: Sequence[str] | None = None, top: int = TOP_VALUES) -> DataFrame:
    """The most frequent values of the named or all text columns, with the number of distinct non-null values.

    Ties go to the smaller value. The rank filter trims each column to its top
    values on the map side, and the distinct count is a plain combined count.
    """
    counts = value_counts(df, list(columns or text_columns(df)))
    distinct = counts.groupBy("column_name").agg(F.count("value").alias("n_distinct"))
    ranked = W.partitionBy("column_name").orderBy(F.col("n_rows").desc(), F.col("value").asc_nulls_last())
    best = counts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return best.join(distinct, "column_name").select("column_name", "n_distinct", "rank", "value", "n_rows")


def profile_label(df: DataFrame, column: str) -> DataFrame:
    """Non-null and missing counts, min, mean, median, 95th percentile and max."""
    median, p95 = exact_quantiles(df, {column: F.col(column)}, [0.5, 0.95])[column]
    value = F.when(~_missing(df, column), F.col(column).cast("double"))
    return df.agg(
        F.count(value).alias("non_null"), (F.count(F.lit(1)) - F.count(value)).alias("nulls"),
        F.min(value).alias("min"), F.avg(value).alias("mean"), F.lit(median).cast("double").alias("median"),
        F.lit(p95).cast("double").alias("p95"), F.max(value).alias("max"),
    )


def profile_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest readable timestamp per column."""
    aggs = [F.struct(F.lit(c).alias("column_name"), F.min(safe_ts(F.col(c))).alias("min_ts"), F.max(safe_ts(F.col(c))).alias("max_ts")) for c in columns]
    return df.agg(F.array(*aggs).alias("_s")).select(F.inline("_s"))


def truncate_columns(df: DataFrame, limit: int = MAX_TEXT) -> DataFrame:
    """Text longer than ``limit`` is cut and marked with three dots."""
    return df.withColumns({
        f.name: _shorten(F.col(f.name), limit)
        for f in df.schema if isinstance(f.dataType, T.StringType)
    })


def summarize_int_list(values, limit: int = MAX_LIST):
    """Text preview of an integer array: a range when consecutive, else head and tail."""
    size = F.size(values)
    text = F.transform(values, lambda x: x.cast("string"))
    first, last = F.get(values, F.lit(0)), F.get(values, size - 1)
    consecutive = F.forall(F.transform(values, lambda x, i: x - i), lambda d: d == first)
    length = F.concat(F.lit(" [len="), size.cast("string"), F.lit("]"))
    return (
        F.when(values.isNull(), F.lit(None).cast("string"))
        .when((size > limit) & consecutive,
              F.concat(F.lit("int_range("), first.cast("string"), F.lit(".."), last.cast("string"), F.lit(")"), length))
        .when(size > limit, F.concat(F.lit("["), F.array_join(F.slice(text, 1, 5), ", "), F.lit(", ..., "),
                                     F.array_join(F.slice(text, F.greatest(size - 2, F.lit(1)), 3), ", "),
                                     F.lit("]"), length))
        .otherwise(F.concat(F.lit("["), F.array_join(text, ", "), F.lit("]")))
    )


def _shorten(text, limit: int = MAX_TEXT):
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, max(0, limit - 3)), F.lit("..."))).otherwise(text)


def summarize_text_list(values, limit: int = MAX_LIST):
    """Text preview of a text array: quoted items, head and tail when long."""
    size = F.size(values)
    quoted = F.transform(values, lambda x: F.concat(F.lit("'"), _shorten(x), F.lit("'")))
    return F.when(size > limit, F.concat(
        F.lit("["), F.array_join(F.slice(quoted, 1, 5), ", "), F.lit(", ..., "),
        F.array_join(F.slice(quoted, F.greatest(size - 2, F.lit(1)), 3), ", "), F.lit("] [len="), size.cast("string"), F.lit("]"),
    )).otherwise(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def summarize_map(values, limit: int = MAX_MAP):
    """Text preview of a text-to-text map: the first entries and how many more there are."""
    entries = F.map_entries(values)
    shown = F.transform(F.slice(entries, 1, limit), lambda e: F.concat(e["key"], F.lit("="), _shorten(e["value"])))
    more = F.size(entries) - limit
    note = F.array(F.concat(F.lit("... +"), more.cast("string"), F.lit(" more")))
    parts = F.when(more > 0, F.concat(shown, note)).otherwise(shown)
    return F.concat(F.lit("{ "), F.array_join(parts, ", "), F.lit(" }"))


def partition_counts(df: DataFrame) -> DataFrame:
    """Files per ``name=value`` folder of a partitioned table."""
    files = df.select(F.col("_metadata.file_path").alias("path")).distinct()
    parts = F.regexp_extract_all("path", F.lit(r"([^/]+=[^/]*)(?=/)"), F.lit(1))
    return (files.select(F.explode(parts).alias("partition"))
            .groupBy("partition").agg(F.count(F.lit(1)).alias("n_files")))
