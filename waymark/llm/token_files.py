"""Token files: ids by frequency rank in byte-aligned variable length, decoded by table lookup.

Layout under one folder, all written by Spark's own committer so that a lost executor or a
repeated task leaves no half files:

* ``vocabulary``: ``rank, id`` - rank 0 is the most frequent id, ties go to the smaller id;
* ``blocks``: one row per document in ascending ``doc_id`` order - ``part, doc_id, start_in_part,
  n_tokens, control, data``. Four ids share a control byte (two bits each: bytes minus one);
  ``data`` holds the low-order-first bytes of the ranks without leading zeros;
* ``parts``: ``part, start`` - ids in all parts before this one.

Tokenizing: a tokenizer that drops white space maps each white-space separated chunk on its own,
so a worker keeps the ids of chunks it has met (a bounded number) and asks the library for new ones. A tokenizer
that keeps white space is refused. Where the tokenizer itself parts letters from the marks behind them, texts are cut
there too, and where it lower-cases, chunks of ASCII letters are known by their lower-case form: fewer chunks are new.

Nulls and empties: a NULL or empty text is the end id alone. Rows that share a ``doc_id`` follow each
other ordered by their ids; a NULL ``doc_id`` comes first. An empty table gives empty files.
Further columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from waymark.llm.text import bound_batches
from waymark.session import Scratch

CACHED_CHUNKS = 300_000
JOINED = 50
# Ids (or chunks) that are gathered, packed or unpacked at once, and bytes cut into chunks at once, as far as texts are not longer themselves.
IDS_AT_ONCE = 1 << 17
BYTES_AT_ONCE = 1 << 22
MARKS = ".,;:!?"
# Letters that no normal form joins with a mark, up to the end of Latin-1.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.int64)
KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
_tokenizers: dict = {}


class Encoder:
    """One tokenizer of a worker with the ids of the chunks met so far, laid end to end.

    The library's own threads are switched off: a task has one core, and Spark runs the tasks side by side. Beyond
    ``CACHED_CHUNKS`` chunks those found in most batches stay, at most half, and the others are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.ids_of([" a  b\n", "a", "b"]) != self.ids_of(["a b", "a", "b"]) or self.ids_of(["a b"])[0] != sum(self.ids_of(["a", "b"]), []):
            raise ValueError("this tokenizer does not drop white space, so its ids do not follow from the chunks of a text")
        self.cuts, self.folds = self.parts_marks(), self.lowers()
        self.known = pa.array([], pa.string())
        self.ids, self.ends, self.batches = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int32)

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in _tokenizers:
            _tokenizers[path] = cls(path)
        return _tokenizers[path]

    def added(self) -> list[str]:
        return [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text

    def parts_marks(self) -> bool:
        """Whether a piece always ends between one of ``LETTERS`` and one of ``MARKS``."""
        pre = self.tokenizer.pre_tokenizer
        if pre is None or any(m in t for t in self.added() for m in MARKS):
            return False
        letters = [chr(c) for c in range(256) if re.match(f"[{LETTERS}]", chr(c))]
        return all(any(x == 2 for _, (x, _) in pre.pre_tokenize_str(f"q{c}{m}z")) and self.normal(f"q{c}{m}z") == f"q{self.normal(c)}{m}z" and len(self.normal(c)) == 1
                   for c in letters for m in MARKS)

    def lowers(self) -> bool:
        """Whether words of ASCII letters are lower-cased: all pairs of letters, and no added token that is such a word."""
        pairs = "".join(x + y for x in string.ascii_letters for y in string.ascii_letters)
        return self.normal(pairs) == pairs.lower() and not any(t.isascii() and t.isalpha() for t in self.added())

    def forget(self) -> None:
        often = np.argsort(-self.batches, kind="stable")[:CACHED_CHUNKS // 2]
        often = np.sort(often[self.batches[often] > 1])
        self.ids, self.ends = self.gathered(often)
        self.known, self.batches = self.known.take(pa.array(often)), np.ones(len(often), np.int32)

    def gathered(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known chunks one after another, and where each one's begin and the last one's end."""
        upto = np.concatenate([[0], np.cumsum((self.ends[1:] - self.ends[:-1])[place])])
        ids = np.empty(upto[-1], np.uint32)
        for at in range(0, len(place), IDS_AT_ONCE):
            some, own = place[at:at + IDS_AT_ONCE], upto[at:at + IDS_AT_ONCE + 1]
            ids[own[0]:own[-1]] = self.ids[np.repeat(self.ends[some] - own[:-1], np.diff(own)) + np.arange(own[0], own[-1])]
        return ids, upto

    def ids_of(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def learn(self, chunks: list[str]) -> None:
        """Ids of new chunks, encoded ``JOINED`` at a time in one text and told apart by the places they come from."""
        joined = [chunks[at:at + JOINED] for at in range(0, len(chunks), JOINED)]
        found, sizes = [], []
        for at in range(0, len(joined), 200):
            some = joined[at:at + 200]
            for words, e in zip(some, self.tokenizer.encode_batch([" ".join(w) for w in some], add_special_tokens=False), strict=True):
                begins = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                owner = np.searchsorted(begins, np.array([x for x, _ in e.offsets] or [0], np.int64), "right")
                found.append(np.array(e.ids, np.uint32))
                sizes.append(np.bincount(owner[:len(e.ids)], minlength=len(words)))
        self.known = pa.concat_arrays([self.known, pa.array(chunks, pa.string())])
        self.ids = np.concatenate([self.ids, *found])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])
        self.batches = np.concatenate([self.batches, np.zeros(len(chunks), np.int32)])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text. A batch is taken in stretches, so that its memory does not grow with the length of its texts."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        return [ids for x, y in runs(sizes, BYTES_AT_ONCE) for ids in self.encode_stretch(texts.slice(x, y - x))]

    def encode_stretch(self, texts: pa.Array) -> list[np.ndarray]:
        """Chunks are cut and numbered by Arrow, and the ids of all texts gathered at once."""
        if len(self.known) > CACHED_CHUNKS:
            self.forget()
        texts = pc.fill_null(texts, "")
        if self.cuts:
            texts = pc.replace_substring_regex(texts, f"([{LETTERS}])([{MARKS}])", r"\1 \2")
        chunks = pc.ascii_split_whitespace(texts)
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.string())
        if self.folds:
            distinct = pc.if_else(pc.match_substring_regex(distinct, "^[A-Za-z]+$"), pc.ascii_lower(distinct), distinct)
        places = pc.index_in(distinct, value_set=self.known)
        if places.null_count:
            missing, n = distinct.filter(places.is_null()).unique(), len(self.known)
            self.learn(missing.to_pylist())
            places = pc.coalesce(places, pc.add(pc.index_in(distinct, value_set=missing), n))
        places = places.to_numpy().astype(np.int64)
        self.batches[places] += 1
        ids, upto = self.gathered(places[coded.indices.to_numpy()])
        borders = upto[np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).to_numpy())])].tolist()
        return [ids[x:y] for x, y in itertools.pairwise(borders)]


def runs(sizes: np.ndarray, at_once: int | None = None) -> Iterator[tuple[int, int]]:
    """Rows cut into stretches of about ``at_once`` (else ``IDS_AT_ONCE``) ids or bytes."""
    stretch = np.cumsum(sizes, dtype=np.int64) // (at_once or IDS_AT_ONCE)
    borders = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(sizes)]
    return ((x, y) for x, y in itertools.pairwise(borders) if x < y)


def cut_at(whole: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = whole.tobytes()
    return [raw[x:y] for x, y in itertools.pairwise([0, *ends.tolist()])]


def pack_rows(ranks: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control bytes and data bytes of several sequences, whose ranks follow each other."""
    ranks = ranks.astype("<u4")
    wide = np.uint8(1) + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < wide[:, None]]
    ends, control_ends = np.cumsum(sizes), np.cumsum(-(-sizes // 4))
    codes = np.zeros(4 * int(control_ends[-1]), np.uint8)
    codes[np.arange(len(ranks)) + np.repeat(4 * (control_ends + -sizes // 4) - (ends - sizes), sizes)] = wide - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return cut_at(control, control_ends), cut_at(data, np.concatenate([[0], np.cumsum(wide, dtype=np.int64)])[ends])


def unpack_rows(control: list[bytes], data: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The ranks of several rows of a block file one after another."""
    at_row = 4 * (np.cumsum(-(-sizes // 4)) + -sizes // 4) - (np.cumsum(sizes) - sizes)
    wide = LENGTHS[np.frombuffer(b"".join(control), np.uint8)].ravel()[np.arange(int(sizes.sum())) + np.repeat(at_row, sizes)]
    at = np.cumsum(wide) - wide
    raw = np.frombuffer(b"".join([*data, b"\0\0\0"]), np.uint8).astype(np.uint32)
    return (raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24) & KEEP[wide]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of a sequence of ranks."""
    (control,), (data,) = pack_rows(ranks, np.array([len(ranks)]))
    return control, data


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of one row of a block file."""
    return unpack_rows([control], [data], np.array([n]))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text and write the files of ``path``."""
    end = np.asarray([end_id], "<u4").tobytes()

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder.at(tokenizer), ZstdCompressor(level=1)
        for b in batches:
            ids = [packer.compress(ids.astype("<u4").tobytes() + end) for ids in encoder.encode(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])
        ids = None
        pa.default_memory_pool().release_unused()  # the worker stays, idle, beside those of the next stages

    def unzipped(column: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of many rows one after another and how many each row has."""
        opener, raw, size = ZstdDecompressor(), [], 0
        for zipped in column:
            raw.append(opener.decompress(zipped))
            size += len(raw[-1]) // 4
            if size >= IDS_AT_ONCE:
                yield np.frombuffer(b"".join(raw), "<u4"), np.array([len(x) // 4 for x in raw])
                raw, size = [], 0
        if raw:
            yield np.frombuffer(b"".join(raw), "<u4"), np.array([len(x) // 4 for x in raw])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for ids, _ in unzipped(b["ids"]):
                seen = np.bincount(ids)
                if len(seen) > len(total):
                    total = np.pad(total, (0, len(seen) - len(total)))
                total[:len(seen)] += seen
        yield pd.DataFrame({"id": (ids := np.flatnonzero(total)), "n": total[ids]})

    spark = docs.sparkSession
    bound_batches(spark)
    with Scratch(spark, "tokens") as scratch:
        tokens = scratch.keep(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(tokenized, "doc_id long, ids binary"), "ids")
        # At most one row per id of the vocabulary reaches the driver.
        counts = tokens.select("ids").mapInPandas(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
        order = [r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))]
        rank_of = np.zeros(max(order, default=0) + 1, np.uint32)
        rank_of[order] = np.arange(len(order))

        def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            done = 0
            for b in batches:
                control, data, sizes = [], [], [np.zeros(0, np.int64)]
                for ids, n in unzipped(b["ids"]):
                    for column, more in zip((control, data), pack_rows(rank_of[ids], n), strict=True):
                        column.extend(more)
                    sizes.append(n)
                sizes = np.concatenate(sizes)
                ends = done + np.cumsum(sizes)
                done = int(ends[-1]) if len(ends) else done
                yield pd.DataFrame({"part": b["part"], "doc_id": b["doc_id"], "start_in_part": ends - sizes, "n_tokens": sizes, "control": control, "data": data})

        spark.createDataFrame(pd.DataFrame({"rank": np.arange(len(order)), "id": np.array(order, np.int64)}), "rank long, id long").write.parquet(f"{path}/vocabulary")
        ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids").withColumn("part", F.spark_partition_id())
        ordered.select("part", "doc_id", "ids").mapInPandas(packed, "part int, doc_id long, start_in_part long, n_tokens long, control binary, data binary").write.parquet(f"{path}/blocks")
    totals = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens`` with ``ids`` (or, as a digest, ``ids_crc32``) of every document."""
    vocabulary = np.array([r["id"] for r in spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()] or [0], "<u4")

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            control, data, sizes, rows = b["control"].tolist(), b["data"].tolist(), b["n_tokens"].to_numpy(np.int64), []
            for x, y in runs(sizes):
                ids = vocabulary[unpack_rows(control[x:y], data[x:y], sizes[x:y])]
                if digest:
                    rows += map(zlib.crc32, cut_at(ids, 4 * np.cumsum(sizes[x:y])))
                else:
                    rows += np.split(ids.astype(np.int64), np.cumsum(sizes[x:y])[:-1])
            last = {"ids_crc32" if digest else "ids": rows}
            yield pd.DataFrame({"doc_id": b["doc_id"], "start": b["start"], "n_tokens": b["n_tokens"]} | last)

    blocks = spark.read.parquet(f"{path}/blocks").join(spark.read.parquet(f"{path}/parts"), "part")
    rows = blocks.select("doc_id", (F.col("start") + F.col("start_in_part")).alias("start"), "n_tokens", "control", "data")
    return rows.mapInPandas(decoded, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<long>"))
