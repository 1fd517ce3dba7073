"""Registered queries against their SQL, and the pipeline stage by stage."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import compare, connect  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from tunelake.llm import ngram_join, queries  # noqa: E402


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == []


def test_all_are_registered():
    names = contract.queries()
    assert {*queries.QUERIES, "pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns and out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        seen[name], docs = out, out
    texts = seen["benchmark_decontamination"]
    assert ngram_join.linked_documents(seen["ngram_jaccard_join"]).filter("n_links > 0").count() == 0
    marked = queries.op5_benchmark_decontamination(spark, sf_dir).filter("not contaminated").select("doc_id")
    assert texts.count() > 0.5 * labels.count() and marked.count() > 0
    packed = seen["best_fit_packing"]
    assert packed.select("doc_id").distinct().count() == texts.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0
