"""Repaired conversations against a search over all edits, also where a conversation is cut into many pieces."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from waymark.llm import conversation_repair, queries

SCHEMA = "conv_id long, turn long, role string, text string, piece string, cost int, kind int"
LEGAL = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = text.strip(SPACE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Cheapest first, then ASCII-least: a plain search over turns done, roles so far (as far as they matter) and edits."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, shape, left = heapq.heappop(heap)
        if (i, shape) in done:
            continue
        done.add((i, shape))
        if i == len(rows) and LEGAL.fullmatch(shape):
            return cost, audit, "\n".join(left)

        def add(more, edit, step, role="", text=""):
            grown = shape + role[:1]
            if role and not any(LEGAL.fullmatch(grown + x) for x in ("", "a", "ua")):
                return
            grown = grown if len(grown) < 3 else "ua" if grown[-1] == "a" else "uau"  # a longer history goes on like a shorter one
            heapq.heappush(heap, (cost + more, audit + edit, i + step, grown, left + ((f"{role}:{text}",) if role else ())))

        for role in ("user", "assistant"):
            add(5, "I", 0, role)
        if i < len(rows):
            _, _, role, text = rows[i]
            add(2, "D", 1)
            if marks[i] not in ("blank", "duplicate"):
                extra = 5 if marks[i] == "truncated" else 0
                if role:
                    add(extra, "K", 1, role, text)
                for new in ("user", "assistant"):
                    add(1 + extra, "R", 1, new, text)


def expected(table):
    """The contract over ``(conv_id, turn, role, text)`` rows."""
    held = {c: [] for c, *_ in table}
    for c, t, role, text in table:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held[c] += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, rows in held.items():
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        marks, turns = faults(rows), [r[1] for r in rows if r[1] is not None]
        cost, audit, left = cheapest(rows, marks)
        illegal = sum((a[2] + " ")[0] + (b[2] + " ")[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(marks.count, ("blank", "duplicate", "truncated")), illegal, cost, audit,
                  hashlib.sha256(left.encode()).hexdigest())
    return out


def made(seed):
    r, rows = random.Random(seed), []
    for c in [*range(60), None]:
        n = r.choice([1, 2, 3, 5, 8, 14])
        for t in range(n):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "User"]) if r.random() < 0.3 else ["user", "assistant"][t % 2]
            text = r.choice(["Fine.", "Well!", "no stop", "", " \t", "Last one?  \n", None, f"text {r.randrange(9)}."])
            rows.append((c, t if t or r.random() < 0.8 else None, role if r.random() < 0.95 else None, text))
    return rows


@pytest.mark.parametrize(("seed", "size"), [(1, 16_384), (2, 1), (3, 2), (4, 3)])
def test_repair_equals_search(spark, tmp_path, monkeypatch, seed, size):
    monkeypatch.setattr(conversation_repair, "PIECE_TURNS", size)
    rows = made(seed)
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(7)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    out = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    want = expected(rows)
    assert {r.conv_id: tuple(r)[1:] for r in out} == want and len(out) == len(want)


def test_long_conversation_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "PIECE_TURNS", 40)
    r = random.Random(11)
    rows = [(7, k // 2 if k < 300 else k, r.choice(["user", "assistant", "system"]), r.choice(["Yes.", "no stop", "", f"t{k}!"])) for k in range(1200)]
    rows += [(8, k, "user", "never a stop") for k in range(400)] + [(9, None, "user", "Same.")] * 300
    table = [x for x in rows if x[0] != 7] + [(c, t, a, b) for c, t, a, b in rows if c == 7]
    frame = spark.createDataFrame([(*x, "x", 1, 2) for x in table], SCHEMA).repartition(5)
    out = {x.conv_id: x for x in conversation_repair.summarize(conversation_repair.repair(frame)).collect()}
    for c in (8, 9):
        mine = [x for x in rows if x[0] == c]
        cost, audit, left = cheapest(mine, faults(mine))
        assert (out[c].cost, out[c].audit, out[c].repaired_sha256) == (cost, audit, hashlib.sha256(left.encode()).hexdigest())
    # Equal turns of a conversation have an order of their own here, so this one is compared with one single piece.
    monkeypatch.setattr(conversation_repair, "PIECE_TURNS", 16_384)
    whole = {x.conv_id: x for x in conversation_repair.summarize(conversation_repair.repair(frame.coalesce(1))).collect()}
    assert whole == out


def test_classes_of_vectors_are_few_and_empty_tables(spark):
    seen, new = {conversation_repair.END}, [conversation_repair.END]
    while new:
        new = [v for u in new for code in range(16) for v in [conversation_repair.backward(code, u)[0]] if v not in seen and not seen.add(v)]
    assert len(seen) < 100
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.summarize(conversation_repair.repair(none)).count() == 0
    assert conversation_repair.damage(none).where(F.lit(True)).count() == 0
