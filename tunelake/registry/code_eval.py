"""Queries: static scores of generated code.

The syntax checks have no SQL form in general. On this input's code templates a
regex decides them exactly, and the SQL below uses that.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.functions.codetext import called_names, extract_code, length_sanity
from tunelake.operators import codeeval, report
from tunelake.operators.sqleval import quality_mark
from tunelake.registry.core import register
from tunelake.registry.inputs import derive, table
from tunelake.sources.predictions import base_vs_tuned

FX = ("fx_code_pairs",)

_SAFE = ",".join(f"'{s}'" for s in codeeval.SAFE_CALLS)
_PY = "'(?is)```python\\s*\\n(.*?)\\n```'"
_ANY = "'(?s)```(?:\\w+)?\\s*\\n(.*?)\\n```'"


def _names(e: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all(coalesce({e}, ''), '\\b([A-Z][a-zA-Z0-9_]*)\\s*\\(', 1)))"


FEATURES = f"""WITH wl AS (SELECT DISTINCT unnest({_names('reference_code')}) AS symbol FROM fx_code_pairs
  UNION SELECT unnest([{_SAFE}])),
allowed AS (SELECT list(symbol) AS s FROM wl),
code AS (SELECT *, regexp_matches(prediction, {_PY}) AS has_py,
  CASE WHEN regexp_matches(prediction, {_PY}) THEN regexp_extract(prediction, {_PY}, 1)
    WHEN regexp_matches(prediction, {_ANY}) THEN regexp_extract(prediction, {_ANY}, 1) END AS code FROM fx_code_pairs),
feat AS (SELECT *, code IS NOT NULL AS has_code, {_names('code')} AS gen, {_names('reference_code')} AS ref,
  coalesce(NOT contains(code, '= ='), false) AS parses,
  coalesce(NOT contains(code, '= =') AND regexp_matches(code, '(?m)^root_part = '), false) AS defines_root_part,
  NOT coalesce(NOT contains(code, '= =') AND regexp_matches(code, '(?m)^import os'), false) AS no_forbidden,
  CASE WHEN length(reference_code) = 0 THEN false
    ELSE length(coalesce(code, prediction))::DOUBLE / length(reference_code) BETWEEN 0.5 AND 2.0 END AS length_sanity FROM code),
known AS (SELECT *, list_filter(gen, lambda x: NOT list_contains(s, x)) AS unknown,
  list_filter(gen, lambda x: list_contains(s, x)) AS g, list_filter(ref, lambda x: list_contains(s, x)) AS r FROM feat, allowed),
cov AS (SELECT *, CASE WHEN len(r) = 0 AND len(g) = 0 THEN 1.0::DOUBLE WHEN len(r) = 0 THEN 0.0::DOUBLE
  ELSE len(list_intersect(g, r))::DOUBLE / len(list_distinct(list_concat(g, r))) END AS coverage FROM known),
pre AS (SELECT example_id, side, has_py AS has_python_block, parses, defines_root_part, no_forbidden,
  has_code AND len(unknown) = 0 AS api_in_whitelist, length_sanity, array_to_string(unknown, ',') AS unknown_symbols,
  CASE WHEN has_code THEN coverage ELSE 0.0::DOUBLE END AS api_coverage, has_code FROM cov),
scored AS (SELECT * EXCLUDE (has_code), CASE WHEN has_code THEN
  ((has_python_block::int + parses::int + defines_root_part::int + no_forbidden::int + api_in_whitelist::int)::DOUBLE / 5) * 0.7::DOUBLE
  + ((api_coverage + length_sanity::int::DOUBLE) / 2) * 0.3::DOUBLE ELSE 0.0::DOUBLE END AS composite FROM pre)
"""
_MICRO = "CAST(sum(CAST(round({0} * 1000000) AS BIGINT)) AS DOUBLE) / (count(*) * 1000000.0::DOUBLE)"
AGG = FEATURES + ", agg AS (SELECT side, count(*) AS num, " + ", ".join(
    f"CAST(sum({f}::int) AS DOUBLE) / count(*) * 100 AS {f}" for f in codeeval.FLAGS
) + f", {_MICRO.format('api_coverage')} AS api_coverage_mean, {_MICRO.format('composite')} AS composite_mean FROM scored GROUP BY side)"

METRICS = [*codeeval.FLAGS, "api_coverage_mean", "composite_mean"]


def pairs(spark, sf_dir):
    return derive(spark, sf_dir, "fx_code_pairs")


def whitelist(spark, sf_dir):
    return codeeval.fixed_whitelist(codeeval.api_whitelist(pairs(spark, sf_dir)))


def scored(spark, sf_dir):
    return codeeval.score_static(pairs(spark, sf_dir), whitelist(spark, sf_dir))


def flat(df):
    return df.withColumn("unknown_symbols", F.array_join("unknown_symbols", ","))


def checks(spark, sf_dir):
    return codeeval.with_code(pairs(spark, sf_dir)).withColumn(
        "checks", codeeval.code_checks(F.col("code")))


def named(spark, sf_dir):
    names = codeeval.with_names(codeeval.with_code(pairs(spark, sf_dir)))
    return codeeval.with_known_names(names, ["gen_names", "ref_names"], whitelist(spark, sf_dir))


@register("code_extract_static", FEATURES + "SELECT example_id, side, code, has_py AS has_python FROM code", FX)
def code_extract_static(spark, sf_dir):
    return pairs(spark, sf_dir).select(
        "example_id", "side", F.inline(F.array(extract_code(F.col("prediction")))))


@register("code_symbols", FEATURES + "SELECT example_id, side, array_to_string(gen, ',') AS symbols FROM feat", FX)
def code_symbols(spark, sf_dir):
    return codeeval.with_code(pairs(spark, sf_dir)).select(
        "example_id", "side", F.array_join(called_names(F.col("code")), ",").alias("symbols"))


@register("code_length_sanity", FEATURES + "SELECT example_id, side, length_sanity FROM feat", FX)
def code_length_sanity(spark, sf_dir):
    return codeeval.with_code(pairs(spark, sf_dir)).select(
        "example_id", "side",
        length_sanity(F.coalesce("code", "prediction"), F.col("reference_code")).alias("length_sanity"))


@register("api_whitelist", FEATURES + "SELECT symbol FROM wl", FX)
def api_whitelist(spark, sf_dir):
    return codeeval.api_whitelist(pairs(spark, sf_dir))


@register("api_unknown_symbols", FEATURES + """
SELECT example_id, side, array_to_string(list_sort(unknown), ',') AS unknown,
  array_to_string(list_sort(unknown)[1:5], ',') AS shown FROM known""", FX)
def api_unknown_symbols(spark, sf_dir):
    unknown = codeeval.unknown_names(F.col("gen_names"), F.col("known"))
    return named(spark, sf_dir).select(
        "example_id", "side", F.array_join(unknown, ",").alias("unknown"),
        F.array_join(F.slice(unknown, 1, 5), ",").alias("shown"))


@register("api_coverage", FEATURES + "SELECT example_id, side, coverage AS api_coverage FROM cov", FX)
def api_coverage(spark, sf_dir):
    return named(spark, sf_dir).select(
        "example_id", "side",
        codeeval.coverage(F.col("gen_names"), F.col("ref_names"), F.col("known"))
        .alias("api_coverage"))


@register("code_parses", FEATURES + "SELECT example_id, side, parses FROM feat", FX)
def code_parses(spark, sf_dir):
    return checks(spark, sf_dir).select("example_id", "side", "checks.parses")


@register("code_defines_target", FEATURES + "SELECT example_id, side, defines_root_part AS defines_target FROM feat", FX)
def code_defines_target(spark, sf_dir):
    return checks(spark, sf_dir).select("example_id", "side", "checks.defines_target")


@register("code_forbidden_imports", FEATURES + "SELECT example_id, side, NOT no_forbidden AS forbidden FROM feat", FX)
def code_forbidden_imports(spark, sf_dir):
    return checks(spark, sf_dir).select("example_id", "side", "checks.forbidden")


@register("score_static", FEATURES + "SELECT * FROM scored", FX)
def score_static(spark, sf_dir):
    return flat(scored(spark, sf_dir))


WIDE = FEATURES.replace(
    "UNION SELECT unnest([", "UNION SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) FROM documents UNION SELECT unnest([")


@register("score_static_large_whitelist", WIDE + "SELECT * FROM scored", FX)
def score_static_large_whitelist(spark, sf_dir):
    """The same scores where every word of the documents is an allowed name too."""
    words = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)))
    wide = whitelist(spark, sf_dir).union(table(spark, sf_dir, "documents").select(words.alias("symbol")).distinct())
    return flat(codeeval.score_static(pairs(spark, sf_dir), wide))


@register("eval_static_aggregate", AGG + " SELECT * FROM agg", FX)
def eval_static_aggregate(spark, sf_dir):
    return codeeval.aggregate_scores(scored(spark, sf_dir))


@register("report_metric_delta", AGG + """,
long AS (UNPIVOT agg ON """ + ", ".join(METRICS) + """ INTO NAME metric VALUE value)
SELECT b.metric, b.value AS base, t.value AS tuned, t.value - b.value AS delta
FROM long b JOIN long t ON b.metric = t.metric AND b.side = 'base' AND t.side = 'tuned'""", FX)
def report_metric_delta(spark, sf_dir):
    return report.metric_delta(codeeval.aggregate_scores(scored(spark, sf_dir)), METRICS)


@register("report_flips", FEATURES + """
SELECT b.example_id, b.composite AS base_composite, t.composite AS tuned_composite
FROM scored b JOIN scored t ON b.example_id = t.example_id AND b.side = 'base' AND t.side = 'tuned'
WHERE b.composite < 0.5 AND t.composite >= 0.5""", FX)
def report_flips(spark, sf_dir):
    return report.flips(scored(spark, sf_dir))


@register("topk_flips", FEATURES + """
SELECT b.example_id, b.composite AS base_composite, t.composite AS tuned_composite
FROM scored b JOIN scored t ON b.example_id = t.example_id AND b.side = 'base' AND t.side = 'tuned'
WHERE b.composite < 0.5 AND t.composite >= 0.5 ORDER BY b.example_id LIMIT 2""", FX)
def topk_flips(spark, sf_dir):
    return report.flips(scored(spark, sf_dir), k=2)


@register("eval_quality_mark", FEATURES + """
SELECT example_id, side, CASE WHEN composite >= 0.7 THEN 'OK' ELSE '??' END AS mark FROM scored""", FX)
def eval_quality_mark(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "example_id", "side", quality_mark(F.col("composite")).alias("mark"))


@register("join_static_sides", FEATURES + """
SELECT b.example_id, b.composite AS base_composite, t.composite AS tuned_composite, b.parses AS base_parses, t.parses AS tuned_parses
FROM scored b JOIN scored t ON b.example_id = t.example_id AND b.side = 'base' AND t.side = 'tuned'""", FX)
def join_static_sides(spark, sf_dir):
    return base_vs_tuned(scored(spark, sf_dir), ["composite", "parses"])


@register("run_report", AGG + """
SELECT 'build' AS dataset, 42 AS seed, b.num AS base_num, b.parses AS base_parses, b.composite_mean AS base_composite_mean,
  t.num AS tuned_num, t.parses AS tuned_parses, t.composite_mean AS tuned_composite_mean
FROM agg b, agg t WHERE b.side = 'base' AND t.side = 'tuned'""", FX)
def run_report(spark, sf_dir):
    doc = report.run_report(
        codeeval.aggregate_scores(scored(spark, sf_dir)), {"dataset": "build", "seed": 42})
    return doc.select("dataset", "seed", *[
        F.col(f"sides.{side}.{c}").alias(f"{side}_{c}")
        for side in ("base", "tuned") for c in ("num", "parses", "composite_mean")])
