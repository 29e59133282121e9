"""Mixing sources to target weights by entropy balancing.

Targets: sources in code point order (NULL last) weigh 1, 2, 3, repeating, and share the whole number of words;
a target stops at ``cap`` times its source's size and the excess goes to the others by weight. That is a water
level: a source is capped if the level times its weight lies above its cap.

Rates: among all document rates with the wanted number of words per source, and none above ``cap``, the ones of least
relative entropy to "each document once" are ``min(cap, exp(lambda * size / mean size))`` with one ``lambda`` per
source, the solution of a convex dual. Its gradient is the words taken minus the target; Newton steps on the logarithm
of their ratio, kept inside a bracket, bring it to zero for all sources at once. Each step is one grouped sum over a table of (source, size, number of documents), however many documents there are.

Copies: rates depend on the size only, so whole classes of documents with one source and size are rounded: the copies
of classes in size order are differences of the rounded running sum. What the words then miss is repaired by up to
``REPAIRS`` moves per source, each changing copies of the one class that fits best. Large classes are split by a hash
of the key so that no task ranks more than a few thousand documents. Ties are broken by hash and key: reruns agree.

Nulls and empties: a NULL text has size 0; documents of size 0 are never taken. A NULL source is a source of its own.
Rows that repeat are separate documents if their key differs; equal keys share one place in the ranking, so
they are taken together or ranked arbitrarily among themselves. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.text import bound_reads, word_count
from waymark.session import Scratch, broadcast_if_small

CAP = 3
WEIGHTS = (1, 2, 3)
STEPS, TOLERANCE = 60, 1e-4
REPAIRS = 4
CLASS_ROWS = 5_000


def targets(sources: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from one row per source; the windows run over sources, not documents."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight).withColumn("cap", F.lit(float(cap)) * F.col("source_size"))
    # In order of cap per weight, capped sources come first; the level is what the others share by weight.
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    levels = weighed.select(
        "*", ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))).alias("level"))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(whole)["level"]
    return levels.withColumn("level", level).select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def rate(tilt: Column, scaled: Column, cap: int) -> Column:
    """Copies per document; the exponent is held where the cap decides anyway."""
    return F.least(F.lit(float(cap)), F.exp(F.least(tilt * scaled, F.lit(20.0))))


def solve(classes: DataFrame, wanted: DataFrame, cap: int, scratch: Scratch) -> DataFrame:
    """``source, tilt`` (NULL: every document at the cap) from Newton steps on the dual, all sources at once."""
    mean = classes.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = wanted.where("source_size > 0").join(mean, wanted["source"].eqNullSafe(mean["source"])).select(
        wanted["source"], "target", "mean", F.when(F.col("target") < cap * F.col("source_size") * (1 - 1e-12), F.lit(0.0)).alias("tilt"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(None).cast("double").alias("miss"))
    state = scratch.keep(state, "tilts")
    for _ in range(STEPS):
        s = state.alias("s")
        r = rate(F.col("tilt"), F.col("size") / F.col("mean"), cap)
        words = F.col("n") * F.col("size")
        sums = classes.join(s, classes["source"].eqNullSafe(F.col("s.source"))).groupBy(F.col("s.source").alias("source"), "target", "mean", "tilt", "low", "high").agg(
            F.sum(words * r).alias("words"),
            F.sum(F.when(r < cap, words * r * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"))
        sums = sums.withColumn("gap", F.log(F.col("words") / F.col("target"))).withColumn("slope", F.col("slope") / F.col("words"))
        low = F.when(F.col("gap") <= 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("gap") >= 0, F.col("tilt")).otherwise(F.col("high"))
        bracket = sums.withColumn("low", low).withColumn("high", high).withColumn("newton", F.col("tilt") - F.col("gap") / F.col("slope"))
        inside = (F.col("slope") > 0) & (F.col("low").isNull() | (F.col("newton") > F.col("low"))) & (F.col("high").isNull() | (F.col("newton") < F.col("high")))
        middle = F.when(F.col("low").isNull(), F.col("high") * 2 - 1).when(F.col("high").isNull(), F.col("low") * 2 + 1).otherwise((F.col("low") + F.col("high")) / 2)
        miss = F.abs("gap")
        step = F.when(F.col("tilt").isNull() | (miss < TOLERANCE), F.col("tilt")).when(inside, F.col("newton")).otherwise(middle)
        after = scratch.keep(bracket.select("source", "target", "mean", step.alias("tilt"), "low", "high", F.when(F.col("tilt").isNotNull(), miss).alias("miss")), "tilts")
        scratch.drop(state)
        state = after
        if (state.agg(F.max("miss")).first()[0] or 0.0) < TOLERANCE:
            break
    else:
        raise RuntimeError("the rates did not settle")
    return state


def round_classes(classes: DataFrame, tilts: DataFrame, cap: int, scratch: Scratch) -> DataFrame:
    """``source, size, salt, n, copies`` with whole copies per class, repaired towards the targets."""
    c, t = classes.alias("c"), tilts.alias("t")
    rated = c.join(t, F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        "c.source", "size", "salt", "n", "target", (F.coalesce(rate(F.col("tilt"), F.col("size") / F.col("mean"), cap), F.lit(float(cap))) * F.col("n")).alias("want"))
    upto = F.round(F.sum("want").over(Window.partitionBy("source").orderBy("size", "salt").rowsBetween(Window.unboundedPreceding, 0)), 6)
    whole = F.floor(upto + 0.5)
    ordered = rated.withColumn("whole", whole)
    back = F.lag("whole", 1, 0).over(Window.partitionBy("source").orderBy("size", "salt"))
    now = scratch.keep(ordered.select("source", "size", "salt", "n", "target", F.least(F.col("whole") - back, cap * F.col("n")).cast("long").alias("copies")), "copies")
    for _ in range(REPAIRS):
        taken = now.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
        n, g = now.alias("n"), taken.alias("g")
        room = F.when(F.col("gap") > 0, cap * F.col("n.n") - F.col("copies")).otherwise(F.col("copies"))
        moves = F.least(F.floor(F.abs("gap") / F.col("size") + 0.5), room).cast("long")
        joined = n.join(g, F.col("n.source").eqNullSafe(F.col("g.source"))).select("n.*", "gap", moves.alias("moves"))
        better = F.abs(F.abs("gap") - F.col("moves") * F.col("size"))
        best = joined.where("moves > 0").groupBy("source").agg(F.min(F.struct(better.alias("left"), F.col("size"), F.col("salt"), F.abs("gap").alias("gap"))).alias("b")).where("b.left < b.gap")
        j, b = joined.alias("j"), best.alias("b")
        chosen = F.col("j.source").eqNullSafe(F.col("b.source")) & (F.col("j.size") == F.col("b.b.size")) & (F.col("j.salt") == F.col("b.b.salt"))
        moved = F.when(F.col("b.b").isNull(), 0).when(F.col("gap") > 0, F.col("moves")).otherwise(-F.col("moves"))
        after = scratch.keep(j.join(b, chosen, "left").select("j.source", "size", "salt", "n", "target", (F.col("copies") + moved).alias("copies")), "copies")
        scratch.drop(now)
        now = after
    return now


def _salt(key: str, salts: Column) -> Column:
    """The part of a large class that a row belongs to."""
    return F.pmod(F.xxhash64(key), salts).cast("int")


def _draw(key: str) -> Column:
    """The order in which rows of a part get a copy more."""
    return F.xxhash64(key, F.lit("mix"))


def copies(docs: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, size, source_size, target, copies`` and the ``carry`` columns for every row of ``docs(key, source, text)``.

    ``carry`` may also name ``source`` and the rounding class, ``salt`` of ``salts``.
    """
    with Scratch(docs.sparkSession, "mixing") as scratch:
        rows = docs.select(F.col(key).alias("doc_id"), *(c for c in carry if c not in ("source", "salt", "salts")), F.col("source").alias("source"), word_count(F.col("text")).alias("size"))
        rows = scratch.keep(rows, "sizes")
        counted = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("m"))
        counted = scratch.keep(counted.withColumn("salts", F.ceil(F.col("m") / CLASS_ROWS).cast("int")), "classes")
        wanted = scratch.keep(targets(counted.groupBy("source").agg(F.sum(F.col("m") * F.col("size")).alias("source_size")), cap, weights), "targets")
        tilts = solve(counted.where("size > 0").select("source", "size", F.col("m").alias("n")), wanted, cap, scratch)
        r, k = rows.alias("r"), counted.alias("k")
        salted = r.join(k, F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r.size") == F.col("k.size"))).select(
            "r.*", "salts", _salt("doc_id", F.col("salts")).alias("salt"))
        salted = scratch.keep(salted, "salted")
        classes = salted.where("size > 0").groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n"))
        rounded = round_classes(scratch.keep(classes, "salted-classes"), tilts, cap, scratch)
        rank = F.row_number().over(Window.partitionBy("source", "size", "salt").orderBy(_draw("doc_id"), "doc_id"))
        ranked, c, w = salted.withColumn("rank", rank).alias("r"), rounded.alias("c"), wanted.alias("w")
        placed = ranked.join(c, F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.size") == F.col("c.size")) & (F.col("r.salt") == F.col("c.salt")), "left")
        mine = F.floor(F.col("c.copies") / F.col("c.n")) + F.when(F.col("rank") <= F.col("c.copies") % F.col("c.n"), 1).otherwise(0)
        with_copies = placed.select("r.*", F.coalesce(mine, F.lit(0)).cast("long").alias("copies")).alias("p")
        return scratch.result(with_copies.join(w, F.col("p.source").eqNullSafe(F.col("w.source"))).select(
            F.col("doc_id").alias(key), *(f"p.{c}" for c in carry), "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies"))


def mix(docs: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mixed documents: every row as often as its copies say, with its own columns.

    Inside a class of rounding the rows with the smallest hashes have one copy more, so a row's copies follow from its own
    hash and the limit of its class; classes are joined, not rows, and no text is shuffled while they are few.
    Equal rows (by 128 bits) cannot be told apart: one of them stands for the pooled copies of all.
    """
    bound_reads(docs.sparkSession)
    keys = ["_key", "_key1"]
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64(*docs.columns).alias("_key"), F.xxhash64(F.lit("mix"), *docs.columns).alias("_key1"), "source", "text")
    with Scratch(docs.sparkSession, "mix") as scratch:
        found = copies(own, cap, weights, key="_key", carry=("_key1", "source", "salt", "salts"))
        several = found.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
        several = scratch.result(several.select(*keys, "copies"))
        used = found.where("size > 0")
        salts = scratch.result(used.groupBy("source", "size").agg(F.first("salts").alias("salts")))
        limits = used.groupBy("source", "size", "salt").agg(F.min("copies").alias("low"), F.max(F.struct("copies", _draw("_key").alias("draw"), "_key")).alias("top"))
        limits = scratch.result(limits.where("top.copies > 0"))
    rows = own.select("_row", *keys, F.col("source").alias("_source"), word_count(F.col("text")).alias("_size"))
    s, m = broadcast_if_small(salts).alias("s"), broadcast_if_small(limits).alias("m")
    classed = rows.join(s, F.col("_source").eqNullSafe(F.col("s.source")) & (F.col("_size") == F.col("s.size"))).select(
        "_row", *keys, "_source", "_size", _salt("_key", F.col("salts")).alias("_salt"))
    limited = classed.join(m, F.col("_source").eqNullSafe(F.col("m.source")) & (F.col("_size") == F.col("m.size")) & (F.col("_salt") == F.col("m.salt")))
    more = F.struct(_draw("_key").alias("draw"), F.col("_key")) <= F.struct(F.col("top.draw").alias("draw"), F.col("top._key").alias("_key"))
    single = limited.select("_row", *keys, F.when(more, F.col("top.copies")).otherwise(F.col("low")).alias("copies")).join(several.select(*keys), keys, "left_anti")
    equal = rows.select("_row", *keys).join(several, keys).groupBy(*keys).agg(F.first("_row").alias("_row"), F.first("copies").alias("copies"))
    every = single.select("_row", "copies").unionByName(equal.select("_row", "copies")).where("copies > 0")
    return every.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_n")).select("_row.*")
