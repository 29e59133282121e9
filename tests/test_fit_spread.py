"""Training rows reach the trees in even parts, whatever files they come from."""

from pyspark.sql import functions as F

from waymark.operators import scoring
from waymark.session import Scratch, scratch_dir


def test_one_row_group_becomes_even_parts(spark, monkeypatch):
    monkeypatch.setattr(scoring, "ROWS_PER_PART", 1_000)
    path = scratch_dir(spark, "one-file")
    spark.range(7_500).withColumn("x", F.when(F.col("id") % 3 > 0, F.col("id") % 5)).coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    with Scratch(spark, "spread-test") as scratch:
        parts = scoring.spread_rows(one, scratch)
        sizes = [r["n"] for r in parts.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) == 8 and sum(sizes) == 7_500 and max(sizes) <= 1_000
        assert sorted(map(repr, parts.collect())) == sorted(map(repr, one.collect()))
        assert scoring.spread_rows(one.limit(1_000), scratch).count() == 1_000 and len(scratch.paths) == 1


def test_fit_stores_spread_rows(spark, monkeypatch):
    kept = []
    keep = Scratch.keep
    monkeypatch.setattr(scoring, "ROWS_PER_PART", 100)
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name, **more: (kept.append(name), keep(self, df, name, **more))[1])
    rows = spark.range(450).select(*[(F.col("id") % 7).cast("double").alias(c) for c in scoring.S.FEATURES], (F.col("id") % 7 * 60 + 60).cast("double").alias(scoring.S.LABEL), F.lit("x").alias("other"))
    model = scoring.fit(rows, scoring.CANDIDATES[5], 1_000.0, 2)
    assert kept == ["rows"] and scoring.score(rows, model, 1_000.0).count() == 450
