"""The registered query of each operator, and the SQL that checks it where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import (
    backoff, collocations, decontaminate, divergence, katz, language, line_dedup, mixing, ngram_join, packing, site_quality, token_counts, toxicity, weak_rules)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_sites(pages: DataFrame) -> DataFrame:
    """Rows (doc_id, host, path, suffix, declared): where each document stands, one row for each of its pages.

    The last number of a page's address is the document's id. The path is the first folder.
    """
    place = F.regexp_extract("url", r"^[A-Za-z]+://[^/]+(/[^?#]*)", 1)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/:?#]+)", 1))
    none_if_empty = lambda c: F.when(c != "", c)
    found = pages.select(
        F.regexp_extract(place, r"/(\d+)(?:\.html?)?/?$", 1).try_cast("long").alias("doc_id"), none_if_empty(host).alias("host"),
        F.regexp_extract(place, r"^/([^/]*)/", 1).alias("path"), none_if_empty(F.regexp_extract(host, r"\.([^.]+)$", 1)).alias("suffix"),
        none_if_empty(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([a-z]+)", 1))).alias("declared"))
    return found.filter("doc_id is not null")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "text")


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
named AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM lines),
solid AS (SELECT doc_id, i, t FROM named WHERE t <> ''),
windows AS (
  SELECT doc_id, i AS a, lead(i, 2) OVER w AS b, t, lead(t, 1) OVER w AS t2, lead(t, 2) OVER w AS t3
  FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY i) QUALIFY b IS NOT NULL),
firsts AS (
  SELECT t, t2, t3, min({'d': doc_id, 'a': a}) AS f FROM windows GROUP BY ALL HAVING count(*) > 1),
later AS (
  SELECT doc_id, a, b FROM windows JOIN firsts USING (t, t2, t3) WHERE NOT (doc_id = f.d AND a < f.a + 3)),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM later),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, text FROM kept
"""


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.token_prefix_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512, keep_table=False)
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit", F.col("cut_chars"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.mark_contained(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hit_words").cast("long")
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("found_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found_items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP5_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
runs AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM doc_words, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, runs.n, item_id FROM runs JOIN windows ON runs.k = windows.k AND runs.n = windows.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = backoff.train_backoff(docs.filter(~katz.held_out("doc_id")))
    return backoff.score_backoff(docs, model, trained=~katz.held_out("doc_id")).withColumn("held_out", katz.held_out("doc_id")).withColumn(
        "train_tokens", F.lit(model.train_tokens).cast("long"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = page_sites(table(spark, sf_dir, "pages"))
    return site_quality.judge_sites(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), sites)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = weak_rules.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.fused_languages(table(spark, sf_dir, "documents"), page_sites(table(spark, sf_dir, "pages")))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"), n=5, threshold=0.8, recall=0.999)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.grade_toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", "expected_severity", "toxic")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"), least=100, top=2000)


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM cut GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM cut, range(1, 6) t(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, k, f, c, string_split(phrase, ' ') AS w FROM (SELECT *, unnest(range(1, k)) AS c FROM grams WHERE k > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.c, x.f AS l, y.f AS r, t.n,
    (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN total t USING (lang)
  JOIN grams x ON x.lang = c.lang AND x.k = c.c AND x.phrase = array_to_string(c.w[:c.c], ' ')
  JOIN grams y ON y.lang = c.lang AND y.k = c.k - c.c AND y.phrase = array_to_string(c.w[c.c + 1:], ' ')),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT DISTINCT g.lang, array_to_string(g.w[i:i + m - 1], ' ') AS phrase, g.f
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT lang, k, f, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM grams WHERE k > 2)) g),
longest AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY ALL),
kept AS (SELECT w.* FROM worst w LEFT JOIN longest o USING (lang, phrase) WHERE o.f IS NULL OR 100 * o.f < 100 * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"), top=200, least_docs=3)


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM found GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms QUALIFY rank <= 200)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""


def op13_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), weights=(1, 2, 3), cap=3)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_quality_rules": op6_quality_rules,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_language_id": op8_language_id,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_source_divergence": op12_source_divergence,
    "op13_mixing_sources": op13_mixing_sources,
}
ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op5_benchmark_decontamination": OP5_SQL,
    "op11_phrase_collocations": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
}
