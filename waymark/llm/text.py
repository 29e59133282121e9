"""Expressions over whole texts shared by the operators.

A word is a run of characters other than the six ASCII white-space characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def lines(text: Column) -> Column:
    """A text split at line feeds; NULL and the empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def lower_to(spark: SparkSession, name: str, rows: int) -> None:
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def bound_reads(spark: SparkSession, rows: int = 512) -> None:
    """Lower the number of rows that Parquet scans hold at once, whose columns are arrays of the JVM's heap, for whole texts.

    Like :func:`bound_batches` this is a setting of the session that stays.
    """
    lower_to(spark, "spark.sql.parquet.columnarReaderBatchSize", rows)


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Lower the number of rows that reach a Python worker, or are read, at once, for rows that are whole texts.

    This is a setting of the session; it stays, as results are computed after an operator returns.
    """
    lower_to(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    bound_reads(spark)
