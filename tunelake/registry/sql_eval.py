"""Queries: generated SQL against true SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.functions.sqltext import with_normal_sql
from tunelake.operators import sqleval
from tunelake.registry.core import register
from tunelake.registry.inputs import derive, table
from tunelake.registry.sql_text import normalized_cte
from tunelake.sources.predictions import attach_predictions, base_vs_tuned

FX = ("fx_sql_pairs",)
SIDES = {"base": "base_prediction", "tuned": "tuned_prediction"}

LONG = """
long AS (SELECT example_id, 'base' AS side, base_prediction AS prediction, truth, base_error AS error FROM fx_sql_pairs
  UNION ALL SELECT example_id, 'tuned', tuned_prediction, truth, NULL FROM fx_sql_pairs)"""
MATCHED = (
    f"WITH {LONG},"
    + normalized_cte("p", "long", "example_id, side, prediction, error", "prediction") + ","
    + normalized_cte("t", "fx_sql_pairs", "example_id", "truth") + """,
m AS (SELECT p.*, t.norm AS truth_norm, p.norm = t.norm AS correct FROM p JOIN t USING (example_id))
"""
)


def _pairs(spark, sf_dir):
    return derive(spark, sf_dir, "fx_sql_pairs")


def _matched(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    preds = sqleval.sides_from_columns(pairs, SIDES, carry=["example_id", "base_error"])
    preds = preds.withColumn("error", F.when(F.col("side") == "base", F.col("base_error")))
    return sqleval.match_predictions(
        preds.drop("base_error"), pairs.select("example_id", "truth"))


@register("eval_exact_match", MATCHED + """
SELECT side, count(*) AS num, CAST(sum(correct::int) AS BIGINT) AS correct,
  CAST(sum(correct::int) AS DOUBLE) / count(*) * 100 AS accuracy_pct FROM m GROUP BY side""", FX)
def eval_exact_match(spark, sf_dir):
    return sqleval.accuracy(_matched(spark, sf_dir))


@register("eval_improvement", MATCHED + """,
a AS (SELECT side, count(*) AS num, CAST(sum(correct::int) AS BIGINT) AS correct,
  CAST(sum(correct::int) AS DOUBLE) / count(*) * 100 AS pct FROM m GROUP BY side)
SELECT b.num AS base_num, b.correct AS base_correct, b.pct AS base_accuracy_pct,
  t.num AS tuned_num, t.correct AS tuned_correct, t.pct AS tuned_accuracy_pct,
  t.pct - b.pct AS improvement_pct
FROM a b, a t WHERE b.side = 'base' AND t.side = 'tuned'""", FX)
def eval_improvement(spark, sf_dir):
    return sqleval.accuracy_with_delta(sqleval.accuracy(_matched(spark, sf_dir)))


@register("sql_normalize", "WITH " + LONG.strip() + "," + normalized_cte(
    "p", "long", "example_id, side", "prediction") + " SELECT * FROM p", FX)
def sql_normalize(spark, sf_dir):
    preds = sqleval.sides_from_columns(_pairs(spark, sf_dir), SIDES, carry=["example_id"])
    return with_normal_sql(preds, "prediction", "norm").drop("prediction")


@register("join_prediction_truth", MATCHED + """
SELECT example_id, side, norm AS prediction_norm, truth_norm, correct FROM m""", FX)
def join_prediction_truth(spark, sf_dir):
    return _matched(spark, sf_dir).select(
        "example_id", "side", "prediction_norm", "truth_norm", "correct")


@register("join_base_tuned", MATCHED + """
SELECT b.example_id, b.correct AS base_correct, t.correct AS tuned_correct
FROM m b JOIN m t ON b.example_id = t.example_id AND b.side = 'base' AND t.side = 'tuned'""", FX)
def join_base_tuned(spark, sf_dir):
    return base_vs_tuned(_matched(spark, sf_dir), ["correct"])


@register("eval_outcome_mark", MATCHED + """
SELECT example_id, side, CASE WHEN coalesce(error, '') <> '' THEN 'ERR' WHEN correct THEN 'OK' ELSE 'MISS' END AS mark
FROM m""", FX)
def eval_outcome_mark(spark, sf_dir):
    return _matched(spark, sf_dir).select(
        "example_id", "side",
        sqleval.outcome_mark(F.col("correct"), F.col("error")).alias("mark"))


@register("eval_error_counts", """
SELECT side, count(*) AS num, CAST(sum((coalesce(error, '') <> '')::int) AS BIGINT) AS errors
FROM fx_sql_sides GROUP BY side""", ("fx_sql_sides",))
def eval_error_counts(spark, sf_dir):
    return sqleval.error_counts(derive(spark, sf_dir, "fx_sql_sides"))


@register("topk_fixed_examples", MATCHED + """
SELECT b.example_id, b.prediction AS base_prediction, t.prediction AS tuned_prediction
FROM m b JOIN m t ON b.example_id = t.example_id AND b.side = 'base' AND t.side = 'tuned'
WHERE NOT b.correct AND t.correct ORDER BY b.example_id LIMIT 5""", FX)
def topk_fixed_examples(spark, sf_dir):
    return sqleval.fixed_examples(_matched(spark, sf_dir), k=5)


@register("predictions_attach", """
WITH ex AS (SELECT p_partkey AS example_id, p_name AS human FROM part),
sides AS (SELECT 'base' AS side UNION ALL SELECT 'tuned' UNION ALL SELECT 'other')
SELECT example_id, human, sides.side, coalesce(f.prediction, '') AS prediction, f.error,
  CAST(coalesce(f.latency_ms, 0) AS BIGINT) AS latency_ms
FROM ex CROSS JOIN sides LEFT JOIN fx_sql_sides f USING (example_id, side)""", ("fx_sql_sides",))
def predictions_attach(spark, sf_dir):
    examples = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("example_id"), F.col("p_name").alias("human"))
    return attach_predictions(
        examples, derive(spark, sf_dir, "fx_sql_sides"), sides=("base", "tuned", "other"))
