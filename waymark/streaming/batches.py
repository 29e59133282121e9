"""Tables that a stream adds to in numbered folders, one a micro-batch.

A batch only ever writes its own folder, ``new/batch=N``, and a replay overwrites it, so losing the driver at any moment
loses nothing and doubles nothing. Readers combine the folders: :func:`stream_latest` tables keep the newest row of a key,
:func:`waymark.streaming.metrics` tables add up. From time to time :func:`fold_latest` writes what the batches
so far amount to as ``base/gen=N``, only the partitions they touched, and a folder counts once Spark has marked it
complete; only then are the batches it replaces removed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from waymark.operators.dedupe import dedupe_latest

FOLD_EVERY = 8


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def complete(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers ``N`` of the folders ``path/name=N`` that a job has finished, ascending."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = [int(f.partition("=")[2]) for f in found if f.startswith(f"{name}=")]
    return sorted(n for n in numbers if fs.exists(_folder(spark, f"{path}/{name}={n}/_SUCCESS")[0]))


def remove(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def write_batch(rows: DataFrame, path: str, batch_id: int, partition: str | None = None) -> None:
    """The folder of one micro-batch; a replay replaces it."""
    rows = rows.hint("rebalance", partition) if partition else rows
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(f"{path}/batch={batch_id}")


def stream_latest(source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                  key: str | Sequence[str], order: Sequence[str], partition: str, fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Keep the newest row per key, whatever order rows arrive in; read the table with :func:`latest_rows`.

    A micro-batch costs what its own rows cost: it is deduplicated and written. Every ``fold_every`` batches the touched
    partitions are folded. The partition value must follow from the key, as the pickup date follows from a trip's id.
    Nothing is dropped for being late and no state grows with the stream.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(dedupe_latest(transform(batch), key, order), f"{path}/new", batch_id, partition)
        if (batch_id + 1) % fold_every == 0:
            fold_latest(batch.sparkSession, path, key, order, partition)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _parts(spark: SparkSession, path: str, partition: str) -> tuple[DataFrame | None, DataFrame | None, list[int]]:
    """Folded rows, rows of later batches, and the numbers of those batches."""
    gens = complete(spark, f"{path}/base", "gen")
    batches = [n for n in complete(spark, f"{path}/new", "batch") if not gens or n > gens[-1]]
    base = new = None
    if batches:
        new = spark.read.option("basePath", f"{path}/new").parquet(*[f"{path}/new/batch={n}" for n in batches]).drop("batch")
    if gens:
        every = spark.read.option("basePath", f"{path}/base").parquet(*[f"{path}/base/gen={n}" for n in gens])
        # One row per partition value: the generation that wrote it last holds all of it.
        last = every.groupBy(F.col(partition).alias("_p")).agg(F.max("gen").alias("_g"))
        base = every.join(F.broadcast(last), F.col(partition).eqNullSafe(F.col("_p")) & (F.col("gen") == F.col("_g")), "left_semi").drop("gen")
    return base, new, batches


def latest_rows(spark: SparkSession, path: str, key: str | Sequence[str], order: Sequence[str], partition: str) -> DataFrame:
    """The newest row of every key. Partitions that no unfolded batch touches are read as they are."""
    base, new, _ = _parts(spark, path, partition)
    if new is None:
        return base
    if base is None:
        return dedupe_latest(new, key, order)
    touched = F.broadcast(new.select(F.col(partition).alias("_p")).distinct())
    same = F.col(partition).eqNullSafe(F.col("_p"))
    merged = dedupe_latest(base.join(touched, same, "left_semi").unionByName(new), key, order)
    return base.join(touched, same, "left_anti").unionByName(merged)


def fold_latest(spark: SparkSession, path: str, key: str | Sequence[str], order: Sequence[str], partition: str) -> None:
    """Write the touched partitions anew as the next generation, then drop the batches it holds.

    A fold that is cut short leaves an unmarked folder, which is not read and is overwritten by the next try.
    """
    base, new, batches = _parts(spark, path, partition)
    if not batches:
        return
    if base is not None:
        touched = F.broadcast(new.select(F.col(partition).alias("_p")).distinct())
        new = base.join(touched, F.col(partition).eqNullSafe(F.col("_p")), "left_semi").unionByName(new)
    rows = dedupe_latest(new, key, order)
    rows.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(f"{path}/base/gen={batches[-1]}")
    for n in complete(spark, f"{path}/new", "batch"):
        if n <= batches[-1]:
            remove(spark, f"{path}/new/batch={n}")
