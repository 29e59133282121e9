"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Above this many rows a lookup side is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 200_000
# Inputs up to this size may be redistributed or kept in memory for repeated scans.
SMALL_BYTES = 1 << 30


def build_session(app: str = "waymark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; sizing stays with the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder of this cluster.

    ``spark.checkpoint.dir`` decides. Only a local master may fall back to a
    temporary folder, because there driver and executors share the disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/waymark-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several actions need the same frame: the written files cut the
    lineage and outlive lost executors.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Folders of one job under the shared folder; closing it removes what was not handed out.

    ``keep`` stores a frame that the job reads several times, ``drop`` removes one early, and
    ``result`` stores the frame given to the caller, whose folder stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for df in list(self.paths):
            self.drop(df)

    def _store(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
        path = scratch_dir(self.spark, f"{self.name}-{name}")
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def folder(self, name: str) -> str:
        """A new folder name for something that is no frame."""
        path = scratch_dir(self.spark, f"{self.name}-{name}")
        self.paths[path] = path
        return path

    def keep(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        kept, path = self._store(df, name, partition_by)
        self.paths[kept] = path
        return kept

    def result(self, df: DataFrame) -> DataFrame:
        return self._store(df, "result")[0]

    def drop(self, df: DataFrame) -> None:
        jvm, path = self.spark.sparkContext._jvm, self.paths.pop(df)
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after counting that it is small enough."""
    rows = df.select(F.lit(1)).limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows else df


def _plan_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small(df: DataFrame, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Use every core for costly per-row work on a small input.

    A small file is a single scan task. Only when the plan statistics promise at
    most ``max_bytes`` are the rows redistributed; a large input already has more
    splits than cores and is left alone.
    """
    if _plan_bytes(df) > max_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


@contextmanager
def several_passes(df: DataFrame, max_bytes: int = SMALL_BYTES) -> Iterator[DataFrame]:
    """``df`` for an algorithm that scans it repeatedly: kept in memory only when small.

    A large frame is scanned again each time, with its columns pruned; callers with
    an expensive plan store it with :func:`materialize` first.
    """
    if _plan_bytes(df) > max_bytes:
        yield df
        return
    kept = spread_small(df, max_bytes).persist()
    try:
        yield kept
    finally:
        kept.unpersist()
