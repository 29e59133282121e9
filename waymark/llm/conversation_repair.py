"""Broken conversations repaired at least cost: Viterbi over pieces, by rank convergence.

A turn may be kept (0), given the role user or assistant (1) or deleted (2; blank and repeated turns must be), and
an empty turn may be inserted anywhere (5); a truncated turn that stays adds 5. The initials of the roles left must read
``(s?(ua)+)?``. Of the cheapest edits those with the ASCII-least initials (Delete, Insert, Keep, Rerole) are taken.

The state is the place in that expression, so going backward a turn maps a vector of four costs to another one.
Vectors that differ by a constant lead to the same edits and are one class; few classes exist, as an insertion bounds
how far costs can differ. Conversations are sorted by range partitions and cut into pieces, so that one conversation may hold
any share of the rows:

1. every piece runs backward from the same speculative vector, the one of a conversation's end;
2. a vector that some piece arrives at and no piece has started from is tried in a fix-up pass by the pieces of all cut
   conversations, until nothing new arrives (usually after one pass, as pieces forget where they started);
3. the pieces of a conversation are stitched from its end to its start, which gives each its true vector;
4. forward, every piece is traced from each of the four states, the states are stitched, and each piece is traced once more
   with its costs, taking the least edit that is still cheapest at every step.

A piece has at most ``PIECE_TURNS`` turns and about ``PIECE_CHARS`` characters; stitching sees one row per piece.
Conversations that lie in one piece, nearly all, need none of 2 to 4.

Order: by ``turn`` (nulls first), then role, then a hash of role and text. Nulls: a NULL role or text is one space; rows
without ``conv_id`` are one conversation. The first of several equal turns stays, the others are duplicates. An empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.text import SPACE, SPACE_CHARS, bound_batches
from waymark.session import Scratch

PIECE_TURNS = 16_384
PIECE_CHARS = 4_000_000
DELETE, INSERT, RELABEL, CUT_SHORT = 2, 5, 1, 5
SOUND, BLANK, REPEATED, TRUNCATED = range(4)
INITIALS = "sua"
OTHER = len(INITIALS)
#: States: nothing yet, after a system turn, after user, after assistant. ROLE_AFTER: what an edit may write there.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
WRITES = (USER, USER, ASSISTANT, USER)
ROLE_AFTER = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
PIECE = ("conv_id long, piece long, roles array<string>, texts array<string>, codes binary, blank long, duplicate long, truncated long, "
         "illegal long, least long, most long, turns long, first_turn long, last_turn long, first_mark long, last_mark long")
REPAIRED = "conv_id long, piece long, several boolean, roles array<string>, texts array<string>, audit string, cost long, blank long, duplicate long, truncated long, illegal long, least long, most long, turns long"


@cache
def before(code: int, after: tuple) -> tuple:
    """Costs to go before a turn, from those after it; a code is ``4 * fault + initial``."""
    fault, initial = divmod(code, 4)
    extra = CUT_SHORT if fault == TRUNCATED else 0
    costs = []
    for state in range(4):
        best = DELETE + after[state]
        if fault not in (BLANK, REPEATED):
            best = min(best, RELABEL + extra + after[WRITES[state]], extra + after[FOLLOWS[state, initial]] if (state, initial) in FOLLOWS else FAR)
        costs.append(best)
    user, assistant = min(costs[USER], INSERT + costs[ASSISTANT]), min(costs[ASSISTANT], INSERT + costs[USER])
    return min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant


@cache
def backward(code: int, after: tuple) -> tuple[tuple, int]:
    """:func:`before` as a class of vectors and the constant taken off."""
    costs = before(code, after)
    return tuple(c - min(costs) for c in costs), min(costs)


@cache
def edits(code: int, after: tuple, state: int) -> tuple[str, int]:
    """The least of the cheapest edits up to and with this turn, and the state they lead to."""
    fault, initial = divmod(code, 4)
    extra, costs, done = CUT_SHORT if fault == TRUNCATED else 0, before(code, after), ""
    while True:
        if DELETE + after[state] == costs[state]:
            return done + "D", state
        if INSERT + costs[WRITES[state]] == costs[state]:
            done, state = done + "I", WRITES[state]
            continue
        kept = FOLLOWS.get((state, initial))
        if kept is not None and extra + after[kept] == costs[state]:
            return done + "K", kept
        return done + "R", WRITES[state]


def run_back(codes: bytes, end: tuple) -> tuple[list[tuple], tuple, int]:
    """The vectors after each turn, the one before the first, and the constant."""
    vectors, total = [], 0
    for code in reversed(codes):
        vectors.append(end)
        end, more = backward(code, end)
        total += more
    return vectors[::-1], end, total


def trace(codes: bytes, vectors: list[tuple], state: int) -> tuple[list[str], int]:
    """The edits at each turn and the state after the last."""
    audit = []
    for code, after in zip(codes, vectors, strict=True):
        done, state = edits(code, after, state)
        audit.append(done)
    return audit, state


def apply_edits(roles: list[str], texts: list[str], audit: list[str], state: int, codes: bytes) -> tuple[list[str], list[str]]:
    """The turns that the edits leave."""
    out_roles, out_texts = [], []
    for role, text, done, code in zip(roles, texts, audit, codes, strict=True):
        for edit in done:
            if edit == "D":
                continue
            kept = edit == "K"
            state = FOLLOWS[state, code % 4] if kept else WRITES[state]
            out_roles.append(role if kept else ROLE_AFTER[state])
            out_texts.append("" if edit == "I" else text)
    return out_roles, out_texts


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive turns of one conversation packed into rows, in the order of the sorted task."""
    rows, held, chars, serial, part = [], [], 0, 0, 0

    def packed() -> tuple:
        codes = bytearray()
        before_ = None
        for r in held:
            same = before_ is not None and before_.turn == r.turn and (before_.role, before_.text) == (r.role, r.text)
            fault = REPEATED if r.fault != BLANK and (same or r.later) else r.fault
            codes.append(4 * fault + (INITIALS.find(r.role[:1]) if r.role[:1] and r.role[0] in INITIALS else OTHER))
            before_ = r
        kinds, faults = [c % 4 for c in codes], [c // 4 for c in codes]
        turns = [r.turn for r in held if r.turn is not None]
        return (held[0].conv_id, part << 32 | serial, [r.role for r in held], [r.text for r in held], bytes(codes), *map(faults.count, (BLANK, REPEATED, TRUNCATED)),
                sum(p not in LEGAL for p in zip(kinds, kinds[1:], strict=False)), min(turns, default=None), max(turns, default=None), len(set(turns)),
                held[0].turn, held[-1].turn, held[0].mark, held[-1].mark)

    names = PIECE.replace("array<string>", "array").split(", ")
    names = [n.split()[0] for n in names]

    def table() -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in ("conv_id", "least", "most", "first_turn", "last_turn")})

    for b in batches:
        for r in b.astype({"conv_id": "object", "turn": "object"}).itertuples(index=False):
            r = r._replace(conv_id=None if pd.isna(r.conv_id) else int(r.conv_id), turn=None if pd.isna(r.turn) else int(r.turn))
            if held and (held[0].conv_id != r.conv_id or len(held) >= PIECE_TURNS or chars >= PIECE_CHARS):
                rows.append(packed())
                held, chars, serial = [], 0, serial + 1
            part = r.part
            held.append(r)
            chars += len(r.text)
        if rows:
            yield table()
            rows = []
    if held:
        rows.append(packed())
        yield table()


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def pieces(turns: DataFrame) -> DataFrame:
    """Conversations ``conv_id, turn, role, text`` as sorted pieces with their faults."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("copy"))
    own = own.withColumns({"mark": F.xxhash64(F.lit("a"), "role", "text"), "mark2": F.xxhash64(F.lit("b"), "role", "text")})
    sound = F.btrim("text", F.lit(SPACE_CHARS))
    own = own.withColumn("fault", F.when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK).when(~F.substring(sound, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND))
    often = own.groupBy("conv_id", "mark", "mark2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn")).alias("first")).where("n > 1")
    often = often.select(F.col("conv_id").alias("c"), F.col("mark").alias("m"), F.col("mark2").alias("m2"), F.col("first.turn").alias("first"), F.lit(True).alias("again"))
    marked = own.join(often, _same(F.col("conv_id"), F.col("c")) & (F.col("mark") == F.col("m")) & (F.col("mark2") == F.col("m2")), "left")
    later = F.coalesce(F.col("again") & F.col("turn").isNotNull() & (F.col("first").isNull() | (F.col("turn") > F.col("first"))), F.lit(False))
    order = ["conv_id", "turn", "role", "mark", "mark2", "copy"]
    ordered = marked.select(*order, "text", "fault", later.alias("later")).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", "turn", "role", "text", "mark", "fault", "later", F.spark_partition_id().alias("part"))
    return ordered.mapInPandas(_pieces, PIECE)


def _name(vector: tuple) -> str:
    return ",".join(map(str, vector))


def _vector(name: str) -> tuple:
    return tuple(map(int, name.split(",")))


def _passes(cut: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, piece, end, start``: where every piece of cut conversations leads from each class of vectors."""
    seen, new, tried = set(), [END], None
    while new:  # the classes are few: costs differ by at most two insertions
        seen |= set(new)
        ends = list(new)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(c, p, _name(end), _name(run_back(codes, end)[1])) for c, p, codes in zip(b["conv_id"], b["piece"], b["codes"], strict=True) for end in ends]
                yield pd.DataFrame(rows, columns=["conv_id", "piece", "end", "start"]).astype({"conv_id": "Int64"})

        found = scratch.keep(cut.select("conv_id", "piece", "codes").mapInPandas(run, "conv_id long, piece long, end string, start string"), "passes")
        tried = found if tried is None else tried.unionByName(found)
        arrived = {_vector(r["start"]) for r in found.select("start").distinct().collect()}
        new = sorted(arrived - seen)
    return tried


def _stitch_back(group: pd.DataFrame) -> pd.DataFrame:
    """The true vector after each piece of one conversation."""
    leads = {(p, end): start for p, end, start in zip(group["piece"], group["end"], group["start"], strict=True)}
    names, now, rows = sorted(group["piece"].unique().tolist(), reverse=True), _name(END), []
    for p in names:
        rows.append((p, now))
        now = leads[p, now]
    return pd.DataFrame(rows, columns=["piece", "end"])


def _stitch_on(group: pd.DataFrame) -> pd.DataFrame:
    """The state before each piece of one conversation."""
    rows, state = [], START
    group = group.sort_values("piece")
    for k, (p, end, exits) in enumerate(zip(group["piece"], group["end"], group["exits"], strict=True)):
        rows.append((p, end, state, k == 0, k + 1 == len(group)))
        state = int(exits[state])
    return pd.DataFrame(rows, columns=["piece", "end", "state", "first", "last"])


def stitched(cut: DataFrame, scratch: Scratch) -> DataFrame:
    """``piece, end, state, first, last`` of the pieces of cut conversations."""
    group = F.struct("conv_id")  # a NULL is a conversation, too
    ends = _passes(cut, scratch).groupBy(group.alias("c")).applyInPandas(_stitch_back, "piece long, end string")
    ends = scratch.keep(ends, "ends")

    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for codes, end in zip(b["codes"], b["end"], strict=True):
                vectors = run_back(codes, _vector(end))[0]
                rows.append("".join(str(trace(codes, vectors, state)[1]) for state in range(4)))
            yield b[["conv_id", "piece", "end"]].astype({"conv_id": "Int64"}).assign(exits=rows)

    left = cut.join(ends, "piece").select("conv_id", "piece", "codes", "end").mapInPandas(exits, "conv_id long, piece long, end string, exits string")
    return left.groupBy(group.alias("c")).applyInPandas(_stitch_on, "piece long, end string, state int, first boolean, last boolean")


def repair(turns: DataFrame) -> DataFrame:
    """Repaired conversations in pieces (see ``REPAIRED``): turns left, audit, cost and faults of each piece."""
    spark = turns.sparkSession
    bound_batches(spark)
    with Scratch(spark, "repair") as scratch:
        stored = scratch.result(pieces(turns))
        slim = stored.drop("roles", "texts")
        cut = slim.groupBy("conv_id").count().where("count > 1").select(F.col("conv_id").alias("c"))
        cut = slim.join(cut, _same(F.col("conv_id"), F.col("c")), "left_semi")
        # What the turn before a piece says about its first one.
        prior = Window.partitionBy("conv_id").orderBy("piece")
        last_code = F.conv(F.hex(F.substring("codes", -1, 1)), 16, 10).cast("int")
        first_code = F.conv(F.hex(F.substring("codes", 1, 1)), 16, 10).cast("int")
        cut = cut.withColumns({"inner": F.lag("piece").over(prior).isNotNull(), "turn_before": F.lag("last_turn").over(prior),
                               "mark_before": F.lag("last_mark").over(prior), "kind_before": F.lag(last_code % 4).over(prior), "first_code": first_code})
        again = F.col("inner") & _same(F.col("turn_before"), F.col("first_turn")) & (F.col("mark_before") == F.col("first_mark"))
        again = again & ~F.floor(F.col("first_code") / 4).isin(BLANK, REPEATED)
        code = F.when(again, 4 * REPEATED + F.col("first_code") % 4).otherwise(F.col("first_code"))
        kind = F.col("first_code") % 4
        legal = ((F.col("kind_before") == 0) & (kind == 1)) | ((F.col("kind_before") == 1) & (kind == 2)) | ((F.col("kind_before") == 2) & (kind == 1))
        cut = cut.select("conv_id", "piece", F.concat(F.unhex(F.lpad(F.hex(code), 2, "0")), F.expr("substring(codes, 2)")).alias("codes"),
                         (F.col("inner") & ~legal).cast("long").alias("more_illegal"), F.coalesce(again, F.lit(False)).cast("long").alias("more_duplicate"),
                         F.coalesce(again & (F.floor(F.col("first_code") / 4) == TRUNCATED), F.lit(False)).cast("long").alias("less_truncated"),
                         F.coalesce(F.col("inner") & (F.col("turn_before") == F.col("first_turn")), F.lit(False)).cast("long").alias("less_turns"))
        cut = scratch.keep(cut, "cut")
        if cut.isEmpty():
            known = spark.createDataFrame([], "piece long, end string, state int, first boolean, last boolean")
        else:
            known = stitched(cut, scratch)
        known = known.join(cut.drop("conv_id").withColumnRenamed("codes", "fixed"), "piece")
        known = scratch.result(known)

        def repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = []
                for r in b.itertuples(index=False):
                    several = isinstance(r.end, str)
                    codes, end, state, first, last = (r.fixed, _vector(r.end), int(r.state), r.first, r.last) if several else (r.codes, END, START, True, True)
                    vectors, ahead, cost = run_back(codes, end)
                    audit, after = trace(codes, vectors, state)
                    roles, texts = apply_edits(list(r.roles), list(r.texts), audit, state, codes)
                    cost += ahead[START] if first else 0
                    tail = ""
                    while last and END[after]:
                        after, tail = WRITES[after], tail + "I"
                        roles.append(ROLE_AFTER[after])
                        texts.append("")
                    rows.append((several, roles, texts, "".join(audit) + tail, cost))
                out = pd.DataFrame(rows, columns=["several", "roles", "texts", "audit", "cost"])
                for c in ("conv_id", "piece", "blank", "duplicate", "truncated", "illegal", "least", "most", "turns"):
                    out[c] = b[c].astype("Int64").to_numpy(dtype=object, na_value=None)
                yield out

        def fixed(name: str, change: str, sign: int) -> Column:
            return (F.col(name) + sign * F.coalesce(change, F.lit(0))).alias(name)

        joined = stored.join(known, "piece", "left").select(
            "conv_id", "piece", "roles", "texts", "codes", "fixed", "end", "state", "first", "last", "blank", fixed("duplicate", "more_duplicate", 1),
            fixed("truncated", "less_truncated", -1), fixed("illegal", "more_illegal", 1), "least", "most", fixed("turns", "less_turns", -1))
        return joined.mapInPandas(repaired, REPAIRED)


def _lines() -> Column:
    return F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")


def digests(parts: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of conversations in several pieces, streamed through their task in order."""
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, begun = None, None, False
        for b in batches:
            rows = []
            for c, n, lines in zip(b["conv_id"].astype("Int64").to_numpy(dtype=object, na_value=None), b["left"], b["lines"], strict=True):
                if state is not None and c != now:
                    rows.append((now, state.hexdigest()))
                    state = None
                if state is None:
                    now, state, begun = c, hashlib.sha256(), False
                if n:  # a piece of which nothing is left adds no line
                    state.update((("\n" if begun else "") + lines).encode())
                    begun = True
            if rows:
                yield pd.DataFrame(rows, columns=["c", "several_sha256"]).astype({"c": "Int64"})
        if state is not None:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["c", "several_sha256"]).astype({"c": "Int64"})

    slim = parts.select("conv_id", "piece", F.size("roles").alias("left"), _lines().alias("lines"))
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInPandas(hashed, "c long, several_sha256 string")


def summarize(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost, the audit and the SHA-256 of the repaired ``role:text`` lines.

    A conversation's audit and digest are single values; a cut conversation's audit of one letter per turn meets
    in one row, its texts are streamed.
    """
    own = repaired.select("conv_id", "piece", "several", "audit", "cost", "blank", "duplicate", "truncated", "illegal", "least", "most", "turns",
                          F.when(~F.col("several"), F.sha2(_lines(), 256)).alias("sha"))
    sums = own.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "turns")), F.min("least").alias("least"), F.max("most").alias("most"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit"), F.max("sha").alias("sha"))
    more = digests(repaired.where("several"))
    joined = sums.join(more, _same(sums["conv_id"], more["c"]), "left")
    return joined.select("conv_id", F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated",
                         "illegal", "cost", "audit", F.coalesce("several_sha256", "sha").alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of stops, repeated or given to the user by a checksum of ``conv_id:turn``; nulls are one space."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))) % 20
    own = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    changed = own.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                         F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                         F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
    return changed.drop("again")
