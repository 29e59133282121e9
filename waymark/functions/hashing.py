"""Stable identifiers, hash buckets and order-insensitive digests."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stable_id(columns: Sequence[str], sep: str = "||") -> Column:
    """SHA-256 over the columns as text, NULL counted as empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(sep, *parts), 256)


def hash_bucket(columns: Sequence[Column], salt: str, buckets: int) -> Column:
    """A bucket in ``1..buckets`` from the first 60 bits of a salted SHA-256."""
    digest = F.sha2(F.concat_ws("||", *[c.cast("string") for c in columns], F.lit(salt)), 256)
    head = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int") + F.lit(1)


def route_bucket(pickup: Column, dropoff: Column, salt: str, buckets: int) -> Column:
    """:func:`hash_bucket` of the two zones, 0 when either zone is unknown."""
    known = (pickup > 0) & (dropoff > 0)
    return F.when(known, hash_bucket([pickup, dropoff], salt, buckets)).otherwise(F.lit(0)).cast("int")


def columns_hash(columns: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(columns).encode()).hexdigest()


def canonical_json(value: object) -> str:
    """Driver-side JSON text with sorted keys, for the one-row contract."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def schema_hash(spec: object) -> str:
    return hashlib.sha256(canonical_json(spec).encode()).hexdigest()


def canonical_json_text(value: Column) -> Column:
    """JSON text re-rendered with sorted keys; NULL when it does not parse.

    A VARIANT keeps object fields sorted by name, so two texts of the same
    document render alike.
    """
    return F.to_json(F.try_parse_json(value))


def row_text(columns: Sequence[str]) -> Column:
    """A text that tells apart any two rows of these columns: each value with its length, NULL as ``-``."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def table_digest(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, and sums modulo 2^64 and exclusive-ors of both halves of each row's MD5; one row per ``by`` group.

    The order of rows does not matter, a row more or less or changed does, also one that occurs twice (exclusive-or alone
    would lose it). Digests of parts of a table add up: see :func:`merge_digests`.
    """
    md5 = F.md5(row_text(columns))
    halves = {"hi": F.substring(md5, 1, 16), "lo": F.substring(md5, 17, 16)}
    own = df.select(*by, *[F.conv(h, 16, 10).cast("decimal(20,0)").alias(f"sum_{k}") for k, h in halves.items()],
                    *[F.conv(h, 16, -10).cast("bigint").alias(f"xor_{k}") for k, h in halves.items()], F.lit(1).cast("bigint").alias("n_rows"))
    return _digest_sums(own, by)


def merge_digests(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The digest of a table from those of its parts."""
    own = parts.select(*by, *[F.col(f"sum_{k}").cast("decimal(20,0)").alias(f"sum_{k}") for k in ("hi", "lo")],
                       *[F.conv(F.col(f"xor_{k}"), 16, -10).cast("bigint").alias(f"xor_{k}") for k in ("hi", "lo")], "n_rows")
    return _digest_sums(own, by)


def _digest_sums(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    word = F.lit(str(1 << 64)).cast("decimal(38,0)")
    sums = [F.coalesce(F.sum(f"sum_{k}").cast("decimal(38,0)") % word, F.lit(0)).cast("decimal(20,0)").cast("string").alias(f"sum_{k}") for k in ("hi", "lo")]
    xors = [F.lower(F.lpad(F.hex(F.coalesce(F.bit_xor(f"xor_{k}"), F.lit(0).cast("bigint"))), 16, "0")).alias(f"xor_{k}") for k in ("hi", "lo")]
    return rows.groupBy(*by).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"), *sums, *xors)
