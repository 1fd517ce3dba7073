"""Every registered query against its SQL, on the smallest tables, and its plan."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tunelake.functions.quantiles import value_counts
from tunelake.registry.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan
    assert compare(df, duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", [
    "tok_collate", "tok_pack_wrapped", "tok_pack_examples", "split_train_eval", "sse_request_fold",
    "log_phases", "quantile_index", "eval_static_aggregate"])
def test_results_do_not_depend_on_partitions(spark, sf_dir, duck, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pushdown_reaches_the_scan(spark, sf_dir):
    """The counts behind the quantiles, before they are checkpointed."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = value_counts(lineitem, ["l_returnflag"], "l_extendedprice")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in plan
    assert "IsNotNull(l_extendedprice)]" in plan


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 2


def test_contract_lists_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) and set(QUERIES) == set(ORACLES)
