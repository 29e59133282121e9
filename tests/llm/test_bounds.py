"""Settings of the session that bound what is held of whole texts at once."""

import public_tokenizers
import pytest
from tests.llm.helpers import frame, prose
from waymark.llm import mixing, quality_rules, token_files
from waymark.llm.text import bound_reads
from waymark.session import scratch_dir

READS = "spark.sql.parquet.columnarReaderBatchSize"


@pytest.fixture
def plain(spark):
    spark.conf.unset(READS)
    yield spark
    spark.conf.unset(READS)


def write(docs):
    token_files.write_tokens(docs, scratch_dir(docs.sparkSession, "bounds-test"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@pytest.mark.parametrize("step", [write, quality_rules.filter_documents, mixing.mix])
def test_whole_texts_are_read_few_at_a_time(plain, step):
    step(frame(plain, [prose(k, 60) for k in range(4)]))
    assert int(plain.conf.get(READS)) == 512


def test_a_lower_bound_stays(plain):
    plain.conf.set(READS, "100")
    bound_reads(plain)
    assert plain.conf.get(READS) == "100"
