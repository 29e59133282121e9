"""Alignment of two tokenizers against brute force over whole texts."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tests.llm.helpers import ODD, frame, prose
from waymark.llm import token_alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def soup(seed):
    """Words, white space of many kinds, digits, scripts and marks in any order."""
    r = random.Random(seed)
    bits = [" ", "  ", "\n", "\t ", " \n", " ", "　", "\x1c", "a", "it's", "don't ", "été", "12345", "...", "日本語", "🙂", "é", "ﬁ", "<|endoftext|>", "<s>", "<0x41>", "zz" * 9, "Word", "­", "\r\n", "x​y"]
    return "".join(r.choice(bits) for _ in range(r.randrange(1, 60)))


def expected(texts):
    """The contract, from whole texts and sets of ends."""
    a, b = Tokenizer.from_file(FILES[0]), SentencePieceProcessor(model_file=FILES[1])
    a.encode_special_tokens = True
    alphabet, names = token_alignment.byte_alphabet(), {i: t for t, i in a.get_vocab().items()}
    all_groups, holders = [], defaultdict(set)
    for d, text in enumerate(texts):
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(alphabet[c] for c in names[i]) for i in ids_a]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends = []
                for some in (bytes_a, bytes_b):
                    at, mine = 0, []
                    for t in some:
                        at += len(t)
                        mine.append(at)
                    ends.append(mine)
                common = sorted(set(ends[0]) & set(ends[1]))
                i = j = 0
                for c in common:
                    x, y = [], []
                    while i < len(ids_a) and ends[0][i] <= c:
                        x.append(ids_a[i])
                        i += 1
                    while j < len(ids_b) and ends[1][j] <= c:
                        y.append(ids_b[j])
                        j += 1
                    groups.append((x, y))
        all_groups.append(groups)
        for x, y in groups:
            for p in set(x):
                for q in set(y):
                    holders[p, q].add(d)
    count = {k: len(v) for k, v in holders.items()}
    most = defaultdict(int)
    for (p, _), n in count.items():
        most[p] = max(most[p], n)
    rows = []
    for groups in all_groups:
        if not groups:
            rows.append((0,) * 6 + ("",))
            continue
        links = [(p, q) for x, y in groups for p in x for q in y]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                     sum(count[k] == most[k[0]] for k in links), sum(count[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return rows


@pytest.mark.parametrize("frequent", [1_000_000, 40, 0])
def test_alignment_equals_brute_force(spark, frequent, monkeypatch):
    monkeypatch.setattr(token_alignment, "ROUND_CHARS", 300)
    texts = [t for t in ODD if len(t or "") < 40_000] + [soup(k) for k in range(250)] + ["▁ odd mark", " ", "a ", " a", prose(5, 3000), "-" * 300 + "=" * 301]
    texts += ["same text here"] * 5
    token_alignment._aligners.clear()
    out = token_alignment.align(frame(spark, texts), *FILES, frequent=frequent).collect()
    found = {r.doc_id: tuple(r)[1:] for r in out}
    assert found == dict(enumerate(expected(texts)))
    assert out[0].__fields__ == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_forgetting_and_large_groups(spark):
    aligner = token_alignment.Aligner.at(*FILES)
    aligner.use(None)
    texts = [soup(900 + k) for k in range(60)]
    whole = [aligner.numbers[p].sum(0).tolist() for p in aligner.places(pa.array(texts))]
    aligner.forget()
    limit, token_alignment.LARGE_GROUP = token_alignment.LARGE_GROUP, 1
    try:
        assert [aligner.numbers[p].sum(0).tolist() for p in [aligner.places(pa.array([t]))[0] for t in texts]] == whole
    finally:
        token_alignment.LARGE_GROUP = limit
        aligner.forget()
    last_a, last_b = token_alignment.last_of_component(*(np.array(x) for x in ([2, 4, 6, 8], [1, 3, 5, 7, 8])))
    assert set(last_a.tolist()) == set(last_b.tolist()) == {4}


def test_long_stretch_and_empty_table(spark):
    long = "z" * 50_000
    row = token_alignment.align(frame(spark, [long, None], ids=[None, 3]), *FILES).orderBy("doc_id").collect()
    assert row[0].doc_id is None and row[0].n_a > 0 and row[0].n_links > 0 and tuple(row[1]) == (3, 0, 0, 0, 0, 0, 0, "")
    none = token_alignment.align(frame(spark, []).limit(0), *FILES)
    assert none.count() == 0


def test_texts_are_encoded_once(spark):
    texts = [soup(k) for k in range(40)] + [None, ""]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    docs = frame(spark, texts).select("doc_id", "text")
    out = token_alignment.align(docs.mapInArrow(counted, docs.schema), *FILES).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == dict(enumerate(expected(texts)))
    assert seen.value == len(texts)


@pytest.mark.parametrize("frequent", [1_000_000, 0])
def test_repeated_links_of_large_groups(spark, frequent, monkeypatch):
    monkeypatch.setattr(token_alignment, "PAIRS_AT_ONCE", 3)
    texts = ["z" * 1_501 + " and " + "z" * 1_501, "z" * 1_501, "and and", "and zz"]
    ids = [token_alignment.Aligner.at(*FILES)._encode([texts[1]])[k] for k in (0, 1)]
    assert len(ids[0]) * len(ids[1]) > token_alignment.LARGE_GROUP
    found = {r.doc_id: tuple(r)[1:] for r in token_alignment.align(frame(spark, texts), *FILES, frequent=frequent).collect()}
    assert found == dict(enumerate(expected(texts)))


def test_links_of_long_texts(monkeypatch):
    aligner = token_alignment.Aligner.at(*FILES)
    places = aligner.places(pa.array([soup(2_000 + k) * 3 for k in range(30)] + ["a z" + "z" * 1_500 + " a a"]))
    whole = [[x.tolist() for x in aligner.links(p)] for p in places]
    monkeypatch.setattr(token_alignment, "LONG_TEXT", 0)
    assert [[x.tolist() for x in aligner.links(p)] for p in places] == whole
    assert [sum(times) for _, times in whole] == [int(aligner.numbers[p, 4].sum()) for p in places]
