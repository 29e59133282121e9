"""The registered queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.catalog.registry import table
from waymark.llm import (
    conversation_repair,
    decontamination,
    language_id,
    line_dedup,
    minhash_forest,
    mixing,
    personal_data,
    quality_classifier,
    quality_rules,
    repeated_passages,
    simhash_tiles,
    token_alignment,
    token_files,
)
from waymark.llm.catalog import ORACLES, QUERIES, query  # noqa: F401
from waymark.llm.text import LOWER, UPPER, held_out
from waymark.session import scratch_dir

WORDS_SQL = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _host_rate_sql(rule: str) -> str:
    mean = f"least(greatest(f_{rule} / n, 0.5 / (n + 1)), 1 - 0.5 / (n + 1))"
    return f"""SELECT h.source, (h.f_{rule} + m * s) / (h.n + s) AS rate FROM h, (SELECT m, CASE WHEN spread > 0 THEN
  least(greatest(m * (1 - m) / spread - 1, 1.0), 1000.0) ELSE 1000.0 END AS s FROM (SELECT m, CASE WHEN k > 1 THEN
  (s_{rule} / n - m * m - m * (1 - m) * k / n) / greatest(1 - nn / (n * n), 1e-9) ELSE 0 END AS spread
  FROM (SELECT *, {mean} AS m FROM c)))"""


QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
v AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
m AS (SELECT d.doc_id, source, cast(len(w) AS bigint) AS n_words,
  cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS bigint) AS word_chars,
  cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
  cast(coalesce(n_repeat_words, 0) AS bigint) AS n_repeat_words FROM d LEFT JOIN v USING (doc_id)),
f AS (SELECT *, cast(len(l) - len(list_distinct(l)) AS bigint) AS n_dup_lines,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_symbols > 0.1 * word_chars AS symbols FROM m),
h AS (SELECT source, cast(count(*) AS double) AS n, cast(sum(base_failed::int) AS double) AS f_base,
  cast(sum(symbols::int) AS double) AS f_symbols, cast(sum((n_dup_lines > 0.3 * len(l))::int) AS double) AS f_lines
  FROM f GROUP BY source),
c AS (SELECT cast(count(*) AS double) AS k, sum(n) AS n, sum(n * n) AS nn, sum(f_base) AS f_base, sum(f_symbols) AS f_symbols,
  sum(f_lines) AS f_lines, sum(f_base * f_base / n) AS s_base, sum(f_symbols * f_symbols / n) AS s_symbols,
  sum(f_lines * f_lines / n) AS s_lines FROM h),
x AS (SELECT DISTINCT source FROM ({" UNION ALL ".join(_host_rate_sql(r) for r in quality_rules.RULES)}) WHERE rate >= 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM x WHERE x.source IS NOT DISTINCT FROM f.source) AS kept FROM f"""


@query("op5_quality_rules", QUALITY_SQL)
def op5_quality_rules(spark, sf):
    rated = quality_rules.rate_documents(table(spark, sf, "documents"))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def write_and_read_tokens(spark, docs):
    """Token files of all documents in a new folder of the shared store, read back as digests."""
    import public_tokenizers

    path = scratch_dir(spark, "token-files")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_tokens(spark, path, digest=True)


@query("op4_token_files")
def op4_token_files(spark, sf):
    return write_and_read_tokens(spark, table(spark, sf, "documents"))


GROUPS_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
  ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS z FROM documents UNION SELECT e.b, r.z FROM r JOIN e ON r.a = e.a),
c AS (SELECT a AS doc_id, min(z) AS component_id FROM r GROUP BY a)
SELECT doc_id, cast(coalesce(n, 0) AS bigint) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)"""


@query("op7_minhash_forest", GROUPS_SQL)
def op7_minhash_forest(spark, sf):
    return minhash_forest.group_documents(table(spark, sf, "documents"), shingle_words=4, percent=80)


@query("op6_decontamination")
def op6_decontamination(spark, sf):
    return decontamination.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op2_entropy_mixing")
def op2_entropy_mixing(spark, sf):
    mixed = mixing.copies(table(spark, sf, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


LINES_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
m AS (SELECT doc_id, pos, line, owner IS NOT NULL AND owner <> doc_id AS gone FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, cast(count(*) FILTER (WHERE gone) AS bigint) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""


@query("op3_line_dedup", LINES_SQL)
def op3_line_dedup(spark, sf):
    kept = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_language_id")
def op9_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    languages, model = language_id.learn(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = language_id.identify(docs, languages, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op10_personal_data")
def op10_personal_data(spark, sf):
    found = personal_data.find_personal_data(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_spans")


@query("op8_repeated_passages")
def op8_repeated_passages(spark, sf):
    return repeated_passages.repeated_passages(table(spark, sf, "documents"))


@query("op13_simhash_tiles")
def op13_simhash_tiles(spark, sf):
    return simhash_tiles.group_documents(table(spark, sf, "documents"))


@query("op11_token_alignment")
def op11_token_alignment(spark, sf):
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align(table(spark, sf, "documents"), *files)


@query("op12_conversation_repair")
def op12_conversation_repair(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.summarize(conversation_repair.repair(conversation_repair.damage(rows)))
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    joined = ids.join(found, ids["id"].eqNullSafe(found["conv_id"]), "left")
    numbers = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return joined.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
