"""Queries: caller-supplied Python functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.operators import generate
from tunelake.registry.core import register
from tunelake.registry.inputs import table


def _summarize(batch):
    return batch[["doc_id"]].assign(
        first_line=batch["text"].str.split("\n").str[0],
        n_lines=batch["text"].str.count("\n") + 1)


@register("udf_map_examples", """
SELECT doc_id, split_part(text, chr(10), 1) AS first_line, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS n_lines
FROM documents""")
def udf_map_examples(spark, sf_dir):
    return generate.map_examples(
        table(spark, sf_dir, "documents").select("doc_id", "text"), _summarize,
        "doc_id bigint, first_line string, n_lines bigint")


def _stub_model(prompt: str) -> str:
    if "ring" in prompt:
        raise ValueError("no rings")
    return f"SELECT '{prompt}'"


GENERATE_SQL = """
SELECT p_partkey AS example_id, CASE WHEN contains(p_name, 'ring') THEN '' ELSE concat('SELECT ', chr(39), p_name, chr(39)) END AS prediction,
  CASE WHEN contains(p_name, 'ring') THEN 'ValueError: no rings' END AS error, NOT contains(p_name, 'ring') AS timed FROM part"""


def _prompts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("example_id"), F.col("p_name").alias("prompt"))


def _told(answers):
    return answers.select("example_id", "prediction", "error", (F.col("latency_s") > 0).alias("timed"))


@register("udf_generate", GENERATE_SQL)
def udf_generate(spark, sf_dir):
    return _told(generate.generate(_prompts(spark, sf_dir), _stub_model, keep=["example_id"], concurrency=8))


@register("udf_generate_in_flight", GENERATE_SQL)
def udf_generate_in_flight(spark, sf_dir):
    """Several calls of a task under way at once, each with a time limit."""
    return _told(generate.generate(_prompts(spark, sf_dir), _stub_model, keep=["example_id"], concurrency=8, in_flight=4, limit_s=60))
