"""Chunks of the token files: few new ones, and the ids of whole-text encoding."""

import os
import subprocess
import sys

import public_tokenizers
import pyarrow as pa
import pytest

from waymark.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TRAPS = ["Word. word, WORD! word", "<|EndOfText|> <|endoftext|>. a<|startoftext|>.b", "İ. İİ, J̌. ǰ é. É. é? Ÿ; ß:", "don't. Don'T, it's.'s x.'ll", "a.b.c ..a. 1.2,3 A1.B2",
         "Σας. ΣΑΣ. KK.  x. y ", "ȧ. İ. i̇.", "", None, " . ", "×. ÷, Ω. ö̈."]


def encoder():
    return token_files.Encoder(PATH)


def test_ids_are_those_of_whole_texts():
    e = encoder()
    assert e.cuts and e.folds
    for _ in range(2):  # new chunks, then known ones
        got = [x.tolist() for x in e.encode(pa.array(TRAPS, pa.string()))]
        assert got == [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in TRAPS]


def test_case_and_marks_make_no_new_chunks():
    e = encoder()
    e.encode(pa.array(["Harbour, harbour. HARBOUR! harbour; Harbour? harbour"]))
    assert sorted(e.known.to_pylist()) == ["!", ",", ".", ";", "?", "harbour"]


def test_frequent_chunks_stay(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_CHUNKS", 20)
    e, learnt = encoder(), []
    learn = e.learn
    e.learn = lambda chunks: (learnt.extend(chunks), learn(chunks))
    for k in range(60):
        texts = ["often seen", " ".join(f"x{k}y{i}" for i in range(8))]
        assert [x.tolist() for x in e.encode(pa.array(texts))] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(e.known) <= 20 + 10
    assert learnt.count("often") == learnt.count("seen") == 1


@pytest.mark.parametrize("at_once", [1, 5, 1 << 20])
def test_rows_packed_together(monkeypatch, at_once):
    import numpy as np

    monkeypatch.setattr(token_files, "IDS_AT_ONCE", at_once)
    rows = [np.array(x, np.uint32) for x in ([], [0], [255, 256, 65_535, 65_536, 1 << 24], [], [7] * 9, [])]
    sizes = np.array([len(x) for x in rows])
    control, data = token_files.pack_rows(np.concatenate(rows), sizes)
    assert list(zip(control, data, strict=True)) == [token_files.pack(x) for x in rows]
    got = [token_files.unpack_rows(control[x:y], data[x:y], sizes[x:y]) for x, y in token_files.runs(sizes)]
    assert np.concatenate(got).tolist() == np.concatenate(rows).tolist()
    assert list(token_files.runs(sizes))[0][0] == 0 and list(token_files.runs(sizes))[-1][1] == len(sizes)


LONG_TEXTS = """
import numpy as np, public_tokenizers, pyarrow as pa
from waymark.llm import token_files
e = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
text = " ".join(f"word{k % 500}" for k in range(60_000))
texts = pa.array([text] * 60 + [None, ""], pa.string())
before = pa.total_allocated_bytes()
got = e.encode(texts)
want = np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
assert len(got) == 62 and all((x == want).all() for x in got[:60]) and not len(got[60]) and not len(got[61])
print((pa.default_memory_pool().max_memory() - before) / len(text))
"""


def test_memory_does_not_follow_the_texts_of_a_batch():
    """Arrow's buffers for sixty long texts: the size of some, not of all."""
    env = os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)}
    run = subprocess.run([sys.executable, "-c", LONG_TEXTS], env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert float(run.stdout) < 60


@pytest.mark.parametrize("sizes", [[], [0, 0], [5], [3, 3, 0, 9, 1, 1], [100, 0, 100]])
def test_stretches_hold_every_row_once(sizes):
    import numpy as np

    got = [k for x, y in token_files.runs(np.array(sizes, np.int64), 4) for k in range(x, y)]
    assert got == list(range(len(sizes)))
