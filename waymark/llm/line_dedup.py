"""Repeated lines removed with levelled sorted runs of line hashes.

The store is a list of runs per level. A run is a table of ``h1, h2, owner``: the 128-bit hash of a line's key and
the smallest ``doc_id`` that holds it, bucketed and sorted by the hash. A batch groups its own lines, merge-anti-joins
the result with every run to find the keys that are new, and adds those as a run of level 0; ``FANOUT`` runs of a
level are merged into one of the next. Runs keep their buckets, so a join moves the batch and never the store.
Batches must come in ascending ``doc_id`` order for the smallest document to own a line; :func:`dedup_lines` cuts a
table that way.

A line's key is the line without ASCII white space at both ends, A-Z lowered. Keys of at least ``MIN_CHARS`` code
points that lie in two documents or more lose all their lines except in the owner.

A frequent line costs one row per task before the shuffle and one row per document that holds it afterwards; the join
that carries the owner back to those rows reads the runs as plain files, so that both sides are shuffled and the skew
join can split it. Batches and buckets grow with the counted keys.

Nulls and empties: a NULL or empty text is one empty line, never dropped. Rows sharing a ``doc_id`` are one document
for the rule and keep separate output rows. A row without ``doc_id`` keeps all its lines and owns none. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.text import LOWER, SPACE_CHARS, UPPER, let, lines
from waymark.session import Scratch, scratch_dir

MIN_CHARS = 10
FANOUT = 2
#: Rows of keys that a batch and a bucket hold, about; at least ``MIN_BATCHES`` and ``MIN_BUCKETS`` of them.
BATCH_KEYS, MIN_BATCHES = 2_000_000_000, 4
BUCKET_KEYS, MIN_BUCKETS = 4_000_000, 16


class LineStore:
    """Levelled runs of line hashes under the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int = MIN_BUCKETS, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = [[]]

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        # By the number of the bucket itself: whatever the partitions are, a bucket is one file.
        bucket = F.pmod(F.hash("h1", "h2"), F.lit(self.buckets))
        sized = rows.repartition(self.buckets, bucket).sortWithinPartitions(bucket, "h1", "h2")
        sized.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", scratch_dir(self.spark, name)).saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def plain_runs(self) -> list[DataFrame]:
        return [self.spark.read.schema(self.spark.table(name).schema).parquet(self._path(name)) for level in self.levels for name in level]

    def _path(self, name: str) -> str:
        return self.spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]

    def add(self, batch: DataFrame) -> None:
        """Add the keys of ``batch(h1, h2, doc_id)`` that no run holds."""
        new = batch.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"))  # added up before it is shuffled
        for run in self.runs():
            new = new.join(run.hint("merge"), ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(new))
        self._compact()

    def _compact(self) -> None:
        for k, level in enumerate(self.levels):
            if len(level) < self.fanout:
                return
            merged = self.spark.table(level[0])
            for name in level[1:]:
                merged = merged.unionByName(self.spark.table(name))
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(self._write(merged))
            for name in level:
                self._remove(name)
            self.levels[k] = []

    def _remove(self, name: str) -> None:
        path = self._path(name)
        self.spark.sql(f"DROP TABLE {name}")
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def close(self) -> None:
        for level in self.levels:
            for name in level:
                self._remove(name)
        self.levels = [[]]


def line_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, row, pos, h1, h2`` of every line whose key is long enough."""
    own = docs.select("doc_id", "row", F.posexplode(lines(F.col("text"))).alias("pos", "line"))
    keyed = own.select("doc_id", "row", "pos", F.translate(F.btrim("line", F.lit(SPACE_CHARS)), UPPER, LOWER).alias("key"))
    return keyed.where((F.length("key") >= MIN_CHARS) & F.col("doc_id").isNotNull()).select(
        "doc_id", "row", "pos", F.xxhash64(F.lit("a"), "key").alias("h1"), F.xxhash64(F.lit("b"), "key").alias("h2"))


def _without(text: Column, gone: Column) -> Column:
    """The lines of a text at other places than ``gone``, by merging the two in one sort."""
    numbered = F.transform(lines(text), lambda line, i: F.struct(i.alias("i"), F.lit(1).alias("kind"), line.alias("line")))
    marks = F.transform(gone, lambda i: F.struct(i.alias("i"), F.lit(0).alias("kind"), F.lit("").alias("line")))
    both = F.sort_array(F.concat(numbered, marks))
    return let(both, lambda rows: F.transform(
        F.filter(rows, lambda r, k: (r["kind"] == 1) & ((k == 0) | (F.get(rows, k - 1)["kind"] == 1))), lambda r: r["line"]))


def dedup_lines(docs: DataFrame, batches: int | None = None) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row of ``docs(doc_id, text)``, ``text`` without the dropped lines."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Scratch(spark, "lines") as scratch:
        # Rows are told apart by their text, so that rows which share a doc_id get their own lines back.
        whole = docs.withColumn("row", F.xxhash64(F.lit("row"), "text"))
        keys = scratch.keep(line_keys(whole), "keys")
        n = keys.count()
        batches = batches or max(MIN_BATCHES, -(-n // BATCH_KEYS))
        cuts = keys.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)] or [0.5], 10_000)).first()[0] or []
        cuts = sorted(set(cuts[:batches - 1]))
        store = LineStore(spark, max(MIN_BUCKETS, -(-n // BUCKET_KEYS)))
        try:
            for low, high in zip([None, *cuts], [*cuts, None], strict=True):
                within = (F.lit(True) if low is None else F.col("doc_id") > low) & (F.lit(True) if high is None else F.col("doc_id") <= high)
                store.add(keys.where(within).select("h1", "h2", "doc_id"))
            dropped = scratch.keep(dropped_lines(keys, store), "dropped")
        finally:
            store.close()
        joined = whole.join(dropped, ["doc_id", "row"], "left")
        kept = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(_without(F.col("text"), F.col("gone")), "\n"))
        return scratch.result(joined.select(
            "doc_id", kept.alias("text"), F.size(lines(F.col("text"))).cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")))


def dropped_lines(keys: DataFrame, store: LineStore) -> DataFrame:
    """``doc_id, row, gone``: the places of the lines that a row loses.

    The runs are read as plain files here: a bucketed side has no shuffle, and only a join of two shuffles can be split
    where a frequent line makes one of its parts large.
    """
    owners = None
    for run in store.plain_runs():  # a key lies in one run only
        owners = run if owners is None else owners.unionByName(run)
    held = keys.select("doc_id", "row", "pos", "h1", "h2").hint("merge")
    found = held.join(owners, ["h1", "h2"]).where(F.col("doc_id") != F.col("owner")).select("doc_id", "row", "pos")
    return found.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("gone"))
