"""Two tokenizers of one text aligned: groups of tokens between common ends, found by pointer jumping.

Both tokenizers cut the same bytes. Every token points to the farthest-right token of the other side that it overlaps
(itself, if none ends later); repeated doubling ``next = next[next]`` over whole arrays takes all tokens to
the last one of their component, which names the group. The number of doublings is the logarithm of the longest chain.

Stretches. A space after another character than white space is a border for both sides: the byte-level
pattern starts a new piece there, and no piece of the other vocabulary has a space inside (checked when it is
loaded; otherwise whole texts are encoded). So a text is a sequence of stretches, and a worker remembers what it
learned of a stretch; at ``CACHED`` stretches it forgets all of them and goes on. New stretches are encoded end to end.

Counts. Texts are encoded once: a row keeps its distinct id pairs and how often it holds each. From these rows the
documents of each pair are counted, and a second pass over them adds up the counts without any text. The most frequent
pairs, at most ``FREQUENT`` of them, are broadcast; links of other pairs leave the task as rows and are joined with the
counts, so the result is exact at any number of pairs. A group of very many tokens is held as distinct ids with their numbers.

Nulls and empties: a NULL or empty text, and one whose tokens do not give back its bytes, has no tokens: zeros and an
empty digest. Rows that share a ``doc_id`` are documents of their own; a NULL ``doc_id`` stays. An empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import bound_batches
from waymark.session import Scratch

CACHED = 500_000
FREQUENT = 1_000_000
ROUND_CHARS = 100_000
PAIRS_AT_ONCE = 1_000_000
LONG_TEXT = 65_536
LARGE_GROUP = 4_096
SPACE_MARK = "▁"
#: A lone space at the end of a text stays with the word before: the second library gives no token for it alone.
BORDER = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
#: Where not every space is a border: after white space, at the start and at the end.
UNEVEN = "^ | $|[" + "".join(f"\\x{{{ord(c):x}}}" for c in map(chr, range(0x3001)) if c.isspace()) + "] "
ID_BITS = 32
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
TOKENS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
LINKED = f"{TOKENS}, pairs array<long>, times array<long>"
_aligners: dict = {}


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def last_of_component(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B the place in B of the last token of its component.

    ``ends`` are the byte ends of tokens that cut the same bytes on either side.
    """
    n = len(ends_a)
    over = np.searchsorted(ends_a, ends_b)
    succ = np.concatenate([n + np.searchsorted(ends_b, ends_a), np.where(ends_a[over] > ends_b, over, n + np.arange(len(ends_b)))])
    while not np.array_equal(further := succ[succ], succ):
        succ = further
    return succ[:n] - n, succ[n:] - n


def offsets(sizes: np.ndarray) -> np.ndarray:
    """Where each of some lists laid end to end begins, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(sizes)])


def names_of(fields: str) -> list[str]:
    return [f.split()[0] for f in fields.split(", ")]


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets(sizes), pa.int32()), pa.array(values, pa.int64()))


def room(held: np.ndarray, size: int) -> np.ndarray:
    """``held`` with place for ``size`` rows, at least a quarter more where it grows."""
    return held if size <= len(held) else np.concatenate([held, np.zeros((max(size, 5 * len(held) // 4) - len(held), *held.shape[1:]), held.dtype)])


class Aligner:
    """Both tokenizers of a worker with the stretches met so far."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(byte_level), SentencePieceProcessor(model_file=pieces)
        self.a.encode_special_tokens = True
        alphabet, vocabulary = byte_alphabet(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(names)]
        self.in_stretches = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in names)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in some], np.int64) for some in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = (pa.array([str(i) for i in range(len(some))], pa.large_string()) for some in (self.a_bytes, self.b_bytes))
        self.forget()

    @classmethod
    def at(cls, byte_level: str, pieces: str) -> Aligner:
        key = (byte_level, pieces)
        if key not in _aligners:
            _aligners[key] = cls(*key)
        return _aligners[key]

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 5), np.int64)  # faults, tokens of A, of B, groups, links
        self.first = np.zeros(1, np.int64)  # where the links of each stretch begin, and those of the next one would
        self.pairs = np.zeros(0, np.int64)
        self.times: dict[int, np.ndarray] = {}  # how often each pair counts, for stretches with a very large group

    def use(self, most: int | None = None) -> None:
        """Forget all stretches once there are more than ``most``, or ``CACHED``."""
        if len(self.known) > (CACHED if most is None else most):
            self.forget()

    def stretches(self, text: str) -> list[str]:
        """The stretches of space+text, each without the space it starts with."""
        return [s[1:] for s in BORDER.split(" " + text)] if self.in_stretches else [text]

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All stretches end to end, and for each text where its own begin and how many there are."""
        texts = pc.if_else(pc.equal(pc.fill_null(texts, ""), ""), None, texts)
        uneven = pc.match_substring_regex(texts, UNEVEN) if self.in_stretches else pc.is_valid(texts)
        even = pc.split_pattern(pc.if_else(uneven, None, texts), " ")
        odd = pa.array([self.stretches(t) if t is not None else None for t in pc.if_else(uneven, texts, None).to_pylist()], pa.list_(pa.string()))
        n_even, n_odd = (pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False).astype(np.int64) for some in (even, odd))
        flat = pa.concat_arrays([even.flatten(), odd.flatten()])
        start = np.where(n_odd > 0, n_even.sum() + np.cumsum(n_odd) - n_odd, np.cumsum(n_even) - n_even)
        return flat, start, n_even + n_odd

    def _encode(self, stretches: list[str]):
        """``ids of A, ids of B`` of stretches laid end to end, or None where they do not give back the bytes or borders."""
        whole = " " + " ".join(stretches)
        a = self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        b = self.b.encode(whole[1:], num_threads=1)
        raw = whole.encode("utf-8", "replace")
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        sizes = np.array([1 + len(s.encode("utf-8", "replace")) for s in stretches], np.int64)
        ends = np.cumsum(sizes)
        for ids, lengths in ((a, self.a_sizes), (b, self.b_sizes)):
            if not np.isin(ends, np.cumsum(lengths[ids])).all():
                return None
        return a, b, sizes

    def learn(self, stretches: list[str]) -> None:
        """Encode and align stretches not met before."""
        units, good, bad = [], [], []
        plain = [s for s in stretches if s and not s[-1].isspace()]
        at = size = 0
        for k, s in enumerate(plain):
            size += len(s)
            if size >= ROUND_CHARS or k + 1 == len(plain):
                units.append(plain[at:k + 1])
                at, size = k + 1, 0
        # A stretch that ends in white space would run into the next one, so it is encoded alone.
        units += [[s] for s in stretches if not s or s[-1].isspace()]
        for unit in units:
            found = self._encode(unit)
            if found:
                good.append((unit, *found))
            else:
                for s in unit:
                    alone = self._encode([s]) if len(unit) > 1 else None
                    good.append(([s], *alone)) if alone else bad.append(s)
        if bad:
            none = np.zeros(0, np.int64)
            self._add(bad, np.array([[1, 0, 0, 0, 0]] * len(bad), np.int64), [""] * len(bad), none, none, np.zeros(len(bad) + 1, np.int64))
        for unit, a, b, sizes in good:
            self._align(unit, a, b, sizes)

    def _add(self, stretches, numbers, groups, pairs, times, cuts) -> None:
        """Remember stretches; ``cuts`` tell where the links of each begin among ``pairs``, and where they end."""
        at = len(self.groups)
        to, old = at + len(stretches), int(self.first[at])
        self.known.update(zip(stretches, range(at, to), strict=True))
        self.numbers, self.first = room(self.numbers, to), room(self.first, to + 1)
        self.pairs = room(self.pairs, old + len(pairs))
        self.numbers[at:to], self.first[at:to + 1] = numbers, old + cuts
        self.pairs[old:old + len(pairs)] = pairs
        self.times |= {at + k: times[cuts[k]:cuts[k + 1]].copy() for k in np.flatnonzero(numbers[:, 4] > np.diff(cuts)).tolist()}
        self.groups += groups

    def _align(self, stretches: list[str], a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> None:
        n, ends_b = len(stretches), np.cumsum(self.b_sizes[b])
        last_a, last_b = last_of_component(np.cumsum(self.a_sizes[a]), ends_b)
        terminal = np.flatnonzero(last_b == np.arange(len(b)))
        group_a, group_b = np.searchsorted(terminal, last_a), np.searchsorted(terminal, last_b)
        count_a, count_b = np.bincount(group_a, minlength=len(terminal)), np.bincount(group_b, minlength=len(terminal))
        first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
        place = np.searchsorted(np.cumsum(sizes), ends_b[terminal])  # the stretch of each group

        # Links of ordinary groups, then those of very large ones by distinct ids.
        large = count_a * count_b > LARGE_GROUP
        each = np.where(large[group_a], 0, count_b[group_a])
        i = np.repeat(np.arange(len(a)), each)
        j = first_b[group_a[i]] + np.arange(len(i)) - np.repeat(np.cumsum(each) - each, each)
        keys, number, owner = [a[i] << ID_BITS | b[j]], [np.ones(len(i), np.int64)], [place[group_a[i]]]
        for g in np.flatnonzero(large).tolist():
            x, many_x = np.unique(a[first_a[g]:first_a[g] + count_a[g]], return_counts=True)
            y, many_y = np.unique(b[first_b[g]:first_b[g] + count_b[g]], return_counts=True)
            keys.append((x[:, None] << ID_BITS | y).ravel())
            number.append((many_x[:, None] * many_y).ravel())
            owner.append(np.full(len(x) * len(y), place[g]))
        keys, number, owner = map(np.concatenate, (keys, number, owner))
        order = np.argsort(owner, kind="stable")
        keys, number, owner = keys[order], number[order], owner[order]
        cuts = np.searchsorted(owner, np.arange(n + 1))

        sums = np.zeros((n, 5), np.int64)
        of_a, of_b = place[group_a], place[group_b]
        sums[:, 1], sums[:, 2] = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        sums[:, 3] = np.bincount(place, minlength=n)
        np.add.at(sums[:, 4], owner, number)
        self._add(stretches, sums, self._names(a, b, count_a, count_b, np.bincount(place, minlength=n)), keys, number, cuts)

    def _names(self, a, b, count_a, count_b, count) -> list[str]:
        """The groups of each stretch as text, from the tokens of each group on either side and the groups of each stretch."""
        def joined(names: pa.Array, sizes: np.ndarray, mark: str) -> pa.Array:
            return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets(sizes), pa.int64()), names), pa.scalar(mark, names.type))

        left, right = joined(self.a_names.take(pa.array(a)), count_a, ","), joined(self.b_names.take(pa.array(b)), count_b, ",")
        return joined(pc.binary_join_element_wise(left, right, pa.scalar("|", left.type)), count, ";").to_pylist()

    def places(self, texts: pa.Array) -> list[np.ndarray]:
        """The stretches of each text, as places in what is known."""
        flat, start, n = self.cut(texts)
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [s for s in distinct if s not in self.known]
        if new:
            self.learn(new)
        place = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        return [place[x:x + k] for x, k in zip(start.tolist(), n.tolist(), strict=True)]

    def links(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs linked in a text of these stretches, ascending, and how often each is."""
        often = None
        if len(places) > LONG_TEXT:  # which repeats most of its stretches, so each is laid out once
            places, often = np.unique(places, return_counts=True)
        begin, size = self.first[places], self.first[places + 1] - self.first[places]
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        large = [k for k, p in enumerate(places.tolist()) if p in self.times] if self.times else []
        if often is None and not large:
            return np.unique(self.pairs[at], return_counts=True)
        times, end = np.ones(len(at), np.int64), np.cumsum(size)
        for k in large:
            times[end[k] - size[k]:end[k]] = self.times[int(places[k])]
        if often is not None:
            times *= np.repeat(often, size)
        pairs, inverse = np.unique(self.pairs[at], return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, inverse, times)
        return pairs, total


def linked(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Per row of ``docs(doc_id, text)`` its tokens and groups, its distinct linked pairs and how often it holds each; see ``LINKED``."""
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.at(byte_level, pieces)
        nothing = 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)

        def given(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
            *sums, digests, pairs, times = zip(*rows, strict=True)
            sizes = np.array([len(p) for p in pairs], np.int64)
            columns = [ids, *(pa.array(c, pa.int64()) for c in sums), pa.array(digests, pa.string()), *(lists(np.concatenate(c), sizes) for c in (pairs, times))]
            return pa.RecordBatch.from_arrays(columns, names_of(LINKED))

        for b in batches:
            rows, at, held = [], 0, 0
            for places in aligner.places(b.column("text")) if b.num_rows else []:
                sums = aligner.numbers[places].sum(0).tolist()
                if not len(places) or sums[0]:
                    rows.append(nothing)
                    continue
                digest = hashlib.sha256(";".join(map(aligner.groups.__getitem__, places.tolist())).encode()).hexdigest()
                rows.append((*sums[1:], digest, *aligner.links(places)))
                held += len(rows[-1][-1])
                if held >= PAIRS_AT_ONCE:
                    yield given(b.column("doc_id").slice(at, len(rows)), rows)
                    rows, at, held = [], at + len(rows), 0
            if rows:
                yield given(b.column("doc_id").slice(at), rows)
            aligner.use()

    return docs.select("doc_id", "text").mapInArrow(aligned, LINKED)


def most_frequent(rated: DataFrame, bound: int) -> tuple[tuple, bool]:
    """``(pairs, counts, best)`` of the pairs counted most often, at most ``bound``, and whether these are all."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = rated.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # at most 8 a binary digit
    total, least = 0, math.inf
    for r in sizes:
        if total + r["count"] > bound:
            break
        total, least = total + r["count"], r["step"]
    some = rated.where(step >= least) if total else rated.limit(0)
    held = some.select("pair", "n", "best").toArrow()
    pair, n, best = (held.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return (pair[order], n[order].astype(np.int64), best[order].astype(np.int64)), total == sum(r["count"] for r in sizes)


def align(docs: DataFrame, byte_level: str, pieces: str, frequent: int = FREQUENT) -> DataFrame:
    """Per row of ``docs(doc_id, text)`` the tokens, groups and links of both tokenizers; see ``RESULT``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bound_batches(spark)
    with Scratch(spark, "alignment") as scratch:
        links = scratch.keep(linked(docs, byte_level, pieces), "links")
        counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
        counts = scratch.keep(counts.withColumn("a", F.shiftright("pair", ID_BITS)), "counts")
        most = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row per id of the vocabulary
        rated = scratch.keep(counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")), "rated")
        table, whole = most_frequent(rated, frequent)
        shared = spark.sparkContext.broadcast(table)
        fields = f"{TOKENS}, n_best long, count_sum long, rare array<long>, times array<long>"

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, count, best = shared.value
            for b in batches:
                ends = offsets(pc.list_value_length(b.column("pairs")).to_numpy(zero_copy_only=False).astype(np.int64))
                pairs, times = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
                sums = [offsets(np.where(hit, times * some[at], 0) if len(known) else np.zeros(len(pairs), np.int64)) for some in (best, count)]
                missed = np.diff(offsets(~hit)[ends])
                added = [pa.array(np.diff(some[ends]), pa.int64()) for some in sums] + [lists(some[~hit], missed) for some in (pairs, times)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-2], *added], names_of(fields))

        found = links.mapInArrow(summed, fields)
        if whole:
            return scratch.result(found.select(names_of(RESULT)))
        found = scratch.keep(found.withColumn("row", F.monotonically_increasing_id()), "rows")
        loose = found.select("row", F.explode(F.arrays_zip("rare", "times")).alias("link")).select("row", F.col("link.rare").alias("pair"), "link.times")
        more = loose.join(rated, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_counts"))
        full = found.join(more, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        full = full.withColumn("count_sum", F.col("count_sum") + F.coalesce("more_counts", F.lit(0)))
        return scratch.result(full.select(names_of(RESULT)))
