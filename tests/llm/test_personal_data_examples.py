"""What the trees of personal_data learn from."""

from pyspark.sql import functions as F

from waymark.llm import personal_data
from waymark.session import Scratch


def test_every_span_counts(spark):
    number = F.lpad(F.col("id").cast("string"), 7, "2")
    base = spark.range(12_000).select(F.col("id").alias("row"), F.concat(F.lit("please call us +1 212 "), number, F.lit(" today")).alias("text"))
    plain = spark.range(11_000).select((F.col("id") + 20_000).alias("row"), F.concat(F.lit("part "), number, F.lit(" of 4")).alias("text"))
    with Scratch(spark, "examples-test") as scratch:
        found = personal_data.spans(base.unionByName(plain).repartition(5), scratch)
        every = personal_data.examples(found, scratch)
        rows = every.collect()
        # A base span is one rewritten span to accept, and one sentence of the words before it to refuse.
        assert sum(r.weight for r in rows if r.label == 1) == 12_000
        assert sum(r.weight for r in rows if r.label == 0) == 12_000 + 11_000
        assert len(rows) < 1_000 and {r.use for r in rows} == {0, 1}
        again = personal_data.examples(found, scratch).collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_forms_of_rewritten_spans_are_not_refused(spark):
    base = spark.range(64).select(F.col("id").alias("row"), F.lit("write to all of us: +12125550100 now").alias("text"))
    alike = spark.range(50).select((F.col("id") + 100).alias("row"), F.lit("room 212-555-0199 here").alias("text"))
    with Scratch(spark, "examples-test") as scratch:
        found = personal_data.spans(base.unionByName(alike), scratch)
        rows = personal_data.examples(found, scratch).collect()
        assert found.where("not base and not touched").count() == 50
        assert sum(r.weight for r in rows if r.label == 1) == 64 and not any(r.digits == 10 for r in rows if r.label == 0)
