"""Quality rules judged per host: shrunken failure rates decide over all documents of a host.

Every document is measured against its own rules. Per host and rule the failures are counted,
and the rate is shrunk by a beta prior fitted to all hosts by the method of moments:
``(failures + a) / (documents + a + b)``. A host with one bad page is hardly moved from the
corpus rate, one with thousands keeps its own. A host is refused when a shrunken rate reaches
``max_host_rate``; its documents go with it.

Nulls and empties: a NULL text has no words and fails the base rule; documents without a host
form one host of their own. Repeated rows count as often as they occur. An empty table gives
an empty table. Extra columns pass through; a column named like a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import SPACE, bound_reads, let, lines, words
from waymark.session import Scratch, broadcast_if_small

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
MAX_SYMBOL_RATE = 0.1
MAX_DUP_LINE_RATE = 0.3
SALTS = 32
RULES = ("base", "symbols", "lines")


def repeated_words(hashes: Column) -> Column:
    """How many words lie in a three-word window that occurs twice or more, from the words' hashes.

    Texts without a repeated window, most of them, end after one hash set. In the others the windows are
    sorted with their places; equal neighbours are repeats. Each place, in order, covers up to three words
    that the next one does not.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - 3), lambda i: F.xxhash64(hashes[i], hashes[i + 1], hashes[i + 2]))

    def covered(ws: Column) -> Column:
        places = let(F.sort_array(F.transform(ws, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), lambda p: F.sort_array(F.transform(
            F.filter(p, lambda x, i: ((i > 0) & (x.h == F.get(p, i - 1).h)) | (F.get(p, i + 1).h == x.h)), lambda x: x.i)))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, start, lambda acc, i: F.struct((acc.n + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc.n)

    total = let(windows, lambda ws: F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0)).otherwise(covered(ws)))
    return F.when(F.size(hashes) >= 3, total).otherwise(0).cast("long")


def measures(text: Column) -> Column:
    """The counts of one text as a struct."""
    wordy = F.filter(lines(text), lambda line: line.rlike(f"[^{SPACE}]"))
    return F.struct(
        let(words(text), lambda ws: F.struct(
            F.size(ws).cast("long").alias("n"), F.length(F.array_join(ws, "")).cast("long").alias("chars"),
            let(F.transform(ws, lambda w: F.xxhash64(w)), repeated_words).alias("repeated"))).alias("w"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(wordy, lambda ls: F.struct(F.size(ls).alias("all"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))).alias("l"))


def document_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and the failures of each rule, next to the other columns except the text."""
    rest = [c for c in docs.columns if c != text]
    # Whole texts enter once; afterwards only numbers travel.
    m = docs.select(*rest, measures(F.col(text)).alias("_m"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return m.select(
        *[c for c in rest if c not in {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed"}],
        F.col("_m.w.n").alias("n_words"), F.col("_m.w.chars").alias("word_chars"), F.col("_m.n_symbols").alias("n_symbols"),
        F.col("_m.l.dup").alias("n_dup_lines"), F.col("_m.w.repeated").alias("n_repeat_words"), F.col("_m.l.all").alias("_lines"),
    ).withColumn("base_failed", base).withColumn("failed", F.struct(
        F.col("base_failed").alias("base"),
        (F.col("n_symbols") > MAX_SYMBOL_RATE * F.col("word_chars")).alias("symbols"),
        (F.col("n_dup_lines") > MAX_DUP_LINE_RATE * F.col("_lines")).alias("lines"))).drop("_lines")


def host_verdicts(rules: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, shrunken rates and whether the host is refused."""
    failures = [F.sum(F.col(f"failed.{r}").cast("long")).alias(f"_f_{r}") for r in RULES]
    hosts = rules.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("_n"), *failures)
    # The prior is one row for the whole corpus: a handful of sums, whatever the number of hosts.
    sums = [F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("_n")).alias("nn")]
    for r in RULES:
        rate = F.col(f"_f_{r}") / F.col("_n")
        sums += [F.sum(f"_f_{r}").alias(f"f_{r}"), F.sum(F.col("_n") * rate * rate).alias(f"s_{r}")]
    whole = hosts.agg(*sums).first()
    shrunk = []
    for r in RULES:
        a, b = beta_prior(whole["k"], whole["n"] or 0, whole["nn"] or 0, whole[f"f_{r}"] or 0, whole[f"s_{r}"] or 0.0)
        shrunk.append(((F.col(f"_f_{r}") + a) / (F.col("_n") + a + b)).alias(f"rate_{r}"))
    rated = hosts.select("_host", "_n", *shrunk)
    refused = F.lit(False)
    for r in RULES:
        refused = refused | (F.col(f"rate_{r}") >= max_rate)
    return rated.withColumn("host_refused", refused)


def beta_prior(hosts: int, n: int, nn: int, failures: int, squares: float) -> tuple[float, float]:
    """Moment estimates of a beta prior from sums over hosts, weighted by documents.

    ``squares`` is the sum of documents times squared rate. The spread beyond what chance gives
    sets the strength ``a + b``, held between one document and a thousand.
    """
    if n == 0:
        return 0.5, 0.5
    mean = min(max(failures / n, 0.5 / (n + 1)), 1 - 0.5 / (n + 1))
    chance = mean * (1 - mean)
    between = squares / n - mean * mean
    spread = (between - chance * hosts / n) / max(1 - nn / (n * n), 1e-9) if hosts > 1 else 0.0
    strength = min(max(chance / spread - 1, 1.0), 1000.0) if spread > 0 else 1000.0
    return mean * strength, (1 - mean) * strength


def judge(rules: DataFrame, host: str, refused: DataFrame, key: str) -> DataFrame:
    """``kept`` for every row, given the refused hosts. ``key`` spreads a large host over ``SALTS`` join keys."""
    salted = refused.select("_host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit(True).alias("_refused"))
    left = rules.withColumn("_spread", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    joined = left.join(salted, F.col(host).eqNullSafe(F.col("_host")) & (F.col("_spread") == F.col("_salt")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("_refused").isNull()).drop("_host", "_salt", "_spread", "_refused")


def rate_documents(docs: DataFrame, host: str = "source", text: str = "text", key: str = "doc_id", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every document."""
    with Scratch(docs.sparkSession, "quality-rules") as scratch:
        rules = scratch.keep(document_rules(docs, text), "measures")
        refused = scratch.keep(host_verdicts(rules, host, max_host_rate).where("host_refused"), "hosts")
        return scratch.result(judge(rules, host, refused, key))


def filter_documents(docs: DataFrame, host: str = "source", text: str = "text", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that pass, with their own columns.

    The base rules are read off each row again instead of joining stored verdicts back, so no text is shuffled; only the
    refused hosts are joined, broadcast after a count, else spread over ``SALTS`` keys.
    """
    bound_reads(docs.sparkSession)
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col(host).alias("_own_host"), F.col(text).alias("_text"))
    with Scratch(docs.sparkSession, "quality-rules") as scratch:
        rules = scratch.keep(document_rules(own.select("_own_host", "_text"), "_text").select("_own_host", "base_failed", "failed"), "measures")
        refused = scratch.result(host_verdicts(rules, "_own_host", max_host_rate).where("host_refused").select("_host"))
    passed = document_rules(own, "_text").select("_row", "_own_host", "base_failed").where("not base_failed")
    return judge(passed, "_own_host", broadcast_if_small(refused), "_row").where("kept").select("_row.*")
