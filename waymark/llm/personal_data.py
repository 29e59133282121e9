"""Personal data spans: exact base patterns, and candidates that boosted trees select.

Base kinds are found leftmost and non-overlapping per kind and checked (address parts, Luhn, digit counts). Two wider
generators propose overlapping spans: addresses spelled with spaces or "(at)", and any run of grouped digits. Gradient
boosted trees judge the proposals by format and context - counts of digits, groups, separators, the neighbouring
characters and hint words, but not the checksums.

They learn what to accept from base spans rewritten into forms that only the wide generators match, left in their
context: phones without ``+``, addresses with ``@`` and dots spelled out, cards and host numbers with other separators. They
learn what to refuse from proposals no base span touches, except those in a form that a rewritten span takes (these may be
personal data that the base patterns do not know), and from sentences with a spelled ``@`` made of the words before base
spans. A proposal is added if no base span touches it, it passes the checks of its kind, and its probability reaches a
threshold: the lowest at which ``PRECISION`` of the held-out examples are to be accepted. Of overlapping ones the mail stays.

Only built-in expressions and the JVM's boosted trees touch rows. The patterns are written so that a long run of equal
characters is passed once: a match starts at the start of a run or where the last match ended, and repeats are
possessive. The trees learn from all base spans and all proposals to refuse, half of which set the threshold. Examples with
the same features and label become one row with their number as its weight, so that learning grows with the kinds of
examples. The trees' splits lie between values of all these rows, up to a million of them (beyond, Spark ML picks the
splits to try from a million, and still weighs each by all rows). Every proposal is judged.

Offsets are code points, the end is exclusive. Nulls and empties: a NULL text is empty and has no spans. Repeated rows
are judged separately. With too few proposals to learn from nothing is added. An empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.text import let
from waymark.session import Scratch

LEAST_OF_EACH = 25
PRECISION = 0.9
MOST_BINS = 1_000
CONTEXT = 24
KINDS = ("email", "ip", "card", "phone")
_MAIL = "[A-Za-z0-9._%+-]"
# The base patterns, in forms that take linear time.
BASE = {
    "email": rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "wide_mail": rf"(?:\G|(?<!{_MAIL})){_MAIL}++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "wide_digits": r"[+(]?[0-9](?:[ ().-]{0,2}[0-9])++",
}
GUARD = {"email": "@", "ip": "[0-9]\\.", "card": "[0-9]", "phone": "\\+[0-9]", "wide_mail": "@|\\(at\\)|\\[at\\]", "wide_digits": "[0-9]"}
FEATURES = ("digits", "letters", "size", "dots", "dashes", "spaces", "parens", "groups", "longest", "plus", "mail", "before_word", "after_word", "before_mark", "after_mark", "hint", "spelled", "loose")


def matches(text: Column, generator: str, pattern: str) -> Column:
    """Matches in order: number, text, length of what lies before it since the last one, and context."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))
    found = let(both, lambda z: F.transform(z["m"], lambda m, i: F.struct(
        F.lit(generator).alias("generator"), i.alias("i"), m.alias("match"), F.length(z["p"][i]).alias("gap"),
        F.right(z["p"][i], F.lit(CONTEXT)).alias("before"), F.left(z["p"][i + 1], F.lit(CONTEXT)).alias("after"))))
    return F.when(text.rlike(GUARD[generator]), found)


def luhn(digits: Column) -> Column:
    """Whether 14 to 19 digits have a right check digit."""
    total = let(F.reverse(digits), lambda d: F.aggregate(
        F.sequence(F.lit(1), F.length(d)), F.lit(0),
        lambda acc, i: acc + let(d.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x))))
    return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(False)


def host_number(match: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def valid(generator: Column, match: Column) -> Column:
    """Whether a base match passes the check of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    return (F.when(generator == "email", F.lit(True)).when(generator == "ip", host_number(match)).when(generator == "card", luhn(digits))
            .when(generator == "phone", F.length(digits).between(10, 15)).otherwise(False))


def likely_kind(generator: Column, match: Column) -> Column:
    """The kind whose check a wide match passes, or NULL."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    return (F.when(generator == "wide_mail", "email").when(host_number(F.regexp_replace(match, " ", "")), "ip")
            .when(luhn(digits), "card").when(F.length(digits).between(7, 13), "phone"))


def form(match: Column) -> Column:
    """A hash of the match with its words and digits made equal."""
    return F.xxhash64(F.regexp_replace(F.regexp_replace(match, "[A-Za-z][A-Za-z0-9._%+-]*+", "a"), "[0-9]", "9"))


def rewritten(base: DataFrame) -> DataFrame:
    """Base spans in forms that only the wide generators match (label 1), and sentences from the words before them (label 0)."""
    pick = F.pmod(F.xxhash64("row", "start", "generator"), F.lit(4)).cast("int") + 1

    def one_of(*values: Column | str) -> Column:
        return F.element_at(F.array(*[F.lit(v) if isinstance(v, str) else v for v in values]), pick)

    match, parts = F.col("match"), F.split("match", "@")
    # Half of the hosts keep their last two labels only, so that their number decides nothing.
    host = F.when(F.pmod(F.xxhash64("start", "row"), F.lit(4)) < 2, F.substring_index(parts[1], ".", -2)).otherwise(parts[1])
    digits = F.regexp_replace(match, "[^0-9]", "")
    head, middle, last = (F.right(digits, F.lit(10)).substr(a, n) for a, n in ((1, 3), (4, 3), (7, 4)))
    plain = F.when(match.rlike("^\\+[0-9]+$"), F.concat_ws(" ", head, middle, last)).otherwise(match.substr(F.lit(2), F.length(match)))
    forms = {
        "email": F.concat(parts[0], one_of(" (at) ", "(at)", " [at] ", "[at]"), F.replace(host, F.lit("."), one_of(" (dot) ", ".", " [dot] ", "[dot]"))),
        "phone": one_of(F.concat(F.lit("("), head, F.lit(") "), middle, F.lit("-"), last), F.concat_ws("-", head, middle, last), F.concat_ws(".", head, middle, last), plain),
        "card": F.regexp_replace(digits, F.lit("([0-9]{4})(?=[0-9])"), F.concat(F.lit("$1"), one_of(".", "--", ". ", " -"))),
        "ip": F.replace(match, F.lit("."), one_of(". ", " .", " . ", ". ")),
    }
    accept = F.coalesce(*[F.when(F.col("generator") == k, c) for k, c in forms.items()])
    near = F.regexp_extract_all("before", F.lit("[A-Za-z]{2,}"), F.lit(0))
    refuse = F.when(F.size(near) >= 3, F.concat(F.element_at(near, -3), one_of(" (at) ", " @ ", " [at] ", "(at) "), F.element_at(near, -2), F.lit(". "), F.element_at(near, -1)))
    both = F.array(F.struct(accept.alias("match"), F.lit(1.0).alias("label")), F.struct(refuse.alias("match"), F.lit(0.0).alias("label")))
    each = base.select("row", "start", "before", "after", F.explode(both).alias("e")).where("e.match is not null")
    made = each.select("row", "start", "before", "after", "e.match", "e.label")
    return made.select("row", "start", "label", form(F.col("match")).alias("form"), *features())


def features() -> list[Column]:
    m = F.col("match")
    count = lambda pattern: F.regexp_count(m, F.lit(pattern))
    groups = F.split(m, "[^0-9]+")
    flags = {
        "digits": count("[0-9]"), "letters": count("[A-Za-z]"), "size": F.length(m), "dots": count("\\."), "dashes": count("-"), "spaces": count(" "),
        "parens": count("[()]"), "groups": count("[0-9]+"), "longest": F.array_max(F.transform(groups, lambda g: F.length(g))), "plus": m.startswith("+"),
        "mail": m.contains("@"), "before_word": F.col("before").rlike("[A-Za-z0-9_]$"), "after_word": F.col("after").rlike("^[A-Za-z0-9_]"),
        "before_mark": F.col("before").rlike("[=:#/$\"']\\s?$"), "after_mark": F.col("after").rlike("^[=:#/$\"'%]"),
        "spelled": count("[\\[(](?:at|dot)[)\\]]"), "loose": count("\\. "),
        "hint": F.col("before").rlike("(?i)(?:tel|phone|call|mail|contact|card|host|server|ip)\\b"),
    }
    return [F.coalesce(flags[name].cast("double"), F.lit(0.0)).alias(name) for name in FEATURES]


def spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``row, generator, start, end, base, touched, kind, form`` and the features of every match; text and context of base spans."""
    each = [F.coalesce(matches(F.col("text"), g, p), F.expr("array()")) for g, p in (BASE | WIDE).items()]
    listed = docs.select("row", F.explode(F.concat(*each)).alias("c")).select("row", "c.*")
    order = Window.partitionBy("row", "generator").orderBy("i")
    size = F.length("match")
    placed = listed.withColumn("end", F.sum(F.col("gap") + size).over(order)).withColumn("start", F.col("end") - size)
    checked = placed.withColumn("base", valid(F.col("generator"), F.col("match")))
    wide = F.col("generator").startswith("wide")
    checked = checked.where(F.col("base") | (wide & (F.col("generator").eqNullSafe("wide_mail") | (F.length(F.regexp_replace("match", "[^0-9]", "")) >= 7))))
    checked = overlaps(checked, F.col("base"))
    own = [F.when(F.col("base"), F.col(c)).alias(c) for c in ("match", "before", "after")]
    made = checked.select("row", "generator", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "base", F.col("met").alias("touched"),
                          F.when(~F.col("base"), likely_kind(F.col("generator"), F.col("match"))).alias("kind"), form(F.col("match")).alias("form"), *own, *features())
    return scratch.keep(made, "spans")


def overlaps(df: DataFrame, which: Column) -> DataFrame:
    """``df`` with ``met``: whether a row of ``which`` overlaps it in its text (true for these rows themselves)."""
    by_start = Window.partitionBy("row").orderBy("start")
    left = F.max(F.when(which, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    right = F.min(F.when(which, F.col("start"))).over(by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    return df.withColumn("met", F.coalesce(left > F.col("start"), F.lit(False)) | F.coalesce(right < F.col("end"), F.lit(False)))


def examples(found: DataFrame, scratch: Scratch) -> DataFrame:
    """``use, label``, features and ``weight`` (how many) of all rewritten base spans and proposals to refuse."""
    kinds = ["use", "label", "form", *FEATURES]

    def counted(df: DataFrame) -> DataFrame:
        return df.withColumn("use", F.pmod(F.xxhash64("start", "row"), F.lit(2))).groupBy(*kinds).agg(F.count(F.lit(1)).alias("n"))

    made = scratch.keep(counted(rewritten(found.where("base"))), "rewritten")
    taken = made.where("label = 1").select("form").distinct()
    plain = counted(found.where("not base and not touched").withColumn("label", F.lit(0.0))).join(taken, "form", "left_anti")
    every = made.unionByName(plain).groupBy("use", "label", *FEATURES).agg(F.sum("n").cast("double").alias("weight"))
    # In a fixed order, so that a rerun adds up the same sums.
    return scratch.keep(every.sortWithinPartitions("use", "label", *FEATURES), "examples")


def added(found: DataFrame, scratch: Scratch) -> DataFrame | None:
    """``row, kind, start, end`` of the proposals the trees select; None if there is too little to learn from."""
    every = examples(found, scratch)
    seen = {(r["use"], r["label"]): r for r in every.groupBy("use", "label").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows")).collect()}
    if min(seen[u, y]["n"] if (u, y) in seen else 0 for u in (0, 1) for y in (0.0, 1.0)) < LEAST_OF_EACH:
        return None
    # With as many bins as the root of the rows, Spark ML looks at all rows for the splits to try.
    bins = min(max(32, math.isqrt(sum(r["rows"] for (u, _), r in seen.items() if u == 0)) + 1), MOST_BINS)
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(maxIter=20, maxDepth=4, maxBins=bins, seed=5, labelCol="label", weightCol="weight")
    model = trees.fit(vector.transform(every.where("use = 0")))

    def judged(df: DataFrame) -> DataFrame:
        return model.transform(vector.transform(df)).withColumn("p", vector_to_array("probability")[1])

    levels = judged(every.where("use = 1")).groupBy(F.floor(F.col("p") * 100).alias("bin")).agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n"))
    threshold, good, n = None, 0.0, 0.0
    for r in sorted(levels.collect(), key=lambda r: -r["bin"]):  # at most 101 rows
        good, n = good + r["good"], n + r["n"]
        if good >= PRECISION * n:
            threshold = r["bin"] / 100
    if threshold is None:
        return None
    # At least one half: below, a proposal is likelier to be refused, however few held-out ones that concerns.
    chosen = judged(found.where("not base and not touched and kind is not null")).where(F.col("p") >= max(threshold, 0.5))
    mail = F.col("generator") == "wide_mail"
    return overlaps(chosen, mail).where(mail | ~F.col("met")).select("row", "kind", "start", "end")


def joined(spans_list: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.sort_array(spans_list), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans, n_spans`` of every row of ``docs(doc_id, text)``."""
    with Scratch(docs.sparkSession, "personal-data") as scratch:
        # A row number that survives recomputation: it is stored with the texts that can hold anything.
        own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
        maybe = F.col("text").rlike("[0-9]|@|\\(at\\)|\\[at\\]")
        rows = scratch.keep(own.select("doc_id", "row", F.when(maybe, F.col("text")).alias("text")), "rows")
        found = spans(rows.where("text is not null"), scratch)
        base = found.where("base").select("row", F.col("generator").alias("kind"), "start", "end", F.lit(True).alias("base"))
        more = added(found, scratch)
        every = base if more is None else base.unionByName(more.withColumn("base", F.lit(False)))
        number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
        span = F.struct("start", number.alias("kind"), "end")
        counts = [F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in KINDS]
        by_row = every.groupBy("row").agg(*counts, F.collect_list(F.when(F.col("base"), span)).alias("b"), F.collect_list(span).alias("s"))
        texts = by_row.select("row", *[f"n_{k}" for k in KINDS], joined(F.col("b")).alias("base_spans"), joined(F.col("s")).alias("spans"), F.size("s").cast("long").alias("n_spans"))
        whole = rows.select("doc_id", "row").join(texts, "row", "left")
        return scratch.result(whole.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
                                           *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")],
                                           F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans")))
