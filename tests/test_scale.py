"""Ordered, ranked and joined results against brute force, with hot keys."""

import math
import random
import re

import pandas as pd
import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.functions.ordered import last_before, running_sum
from tunelake.functions.numbering import row_numbers
from tunelake.functions.quantiles import index_quantiles
from tunelake.operators import perf, splits, tokens, trainlog
from tunelake.operators.codeeval import api_whitelist, score_static

rng = random.Random(7)
# One key holds most rows.
EVENTS = [(("hot" if rng.random() < 0.8 else f"k{i % 5}"), i, rng.choice([None, 1, 2, 3])) for i in range(3000)]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "key string, at long, v int").repartition(7)


@pytest.mark.parametrize("block_rows", [1, 64, 10_000])
def test_running_sum_and_last(events, block_rows):
    df = running_sum(events, ["key"], "at", F.col("v"), "upto", block_rows=block_rows)
    df = last_before(df, ["key"], "at", F.col("v"), "prev", block_rows=block_rows)
    total, last, want = {}, {}, {}
    for key, at, v in EVENTS:
        prev = last.get(key)
        total[key] = total.get(key, 0) + (v or 0)
        last[key] = v if v is not None else prev
        want[at] = (total[key], prev)
    assert {r.at: (r.upto, r.prev) for r in df.collect()} == want


def test_index_quantiles(spark):
    groups = {
        "spread": [rng.random() for _ in range(2001)], "same": [1.5] * 500, "one": [3.0],
        "heavy": [0.0] * 900 + [float(i) for i in range(100)], "twenty": [float(i) for i in range(20)],
        "signs": [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(500)],
        "close": [1.0 + i * 2.0**-52 for i in range(3000)] + [-5e-324, 5e-324, 0.0, -1.0, float("inf"), float("-inf")],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("one", None), ("none", None)]
    rng.shuffle(rows)
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: r for r in index_quantiles(df, ["k"], "x", probs).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        vs = sorted(vs)
        assert got[k].n == len(vs)
        for name, q in probs.items():
            assert got[k][name] == vs[min(len(vs) - 1, int(q * len(vs)))], (k, name)


@pytest.mark.parametrize("kind", ["long", "int", "decimal(12,3)", "float"])
def test_index_quantiles_of_other_numbers(spark, kind):
    low = {"long": -(2**61), "int": -(2**30), "decimal(12,3)": -(10**8), "float": -(10**4)}[kind]
    df = spark.range(4_000).select(F.lit("k").alias("k"), (F.lit(low) + F.pmod(F.xxhash64("id"), F.lit(-2 * low))).cast(kind).alias("x"))
    values = sorted(r.x for r in df.collect())
    got = index_quantiles(df, ["k"], "x", {"p1": 0.01, "p50": 0.5, "p99": 0.99}).first()
    assert [got.p1, got.p50, got.p99] == [values[int(4_000 * q)] for q in (0.01, 0.5, 0.99)]


def test_quantiles_order_nan_last_and_refuse_text(spark):
    df = spark.createDataFrame([("k", x) for x in (float("nan"), 1.0, float("inf"))], "k string, x double")
    got = index_quantiles(df, ["k"], "x", {"low": 0.0, "mid": 0.5, "high": 1.0}).first()
    assert got.low == 1.0 and got.mid == float("inf") and math.isnan(got.high)
    with pytest.raises(TypeError):
        index_quantiles(df.withColumn("x", F.col("x").cast("string")), ["k"], "x", {"mid": 0.5})


def test_no_quantile_task_holds_a_group(spark):
    """A million values in two groups: nothing but the top of the count tree is dealt by group alone."""
    df = spark.range(1_000_000).select((F.col("id") % 2).alias("k"), F.rand(3).alias("x"))
    made = index_quantiles(df, ["k"], "x", {"p50": 0.5})
    assert len(made.collect()) == 2
    plan = made._jdf.queryExecution().executedPlan().toString()
    by_group = [line for line in plan.split("Initial Plan")[0].splitlines() if re.search(r"hashpartitioning\(k#\d+L?, \d+\)", line)]
    counts = df.select("k", F.floor(F.log2("x") + 1080).alias("e")).distinct().count()
    assert by_group and counts < 100  # the top level: one row for each binary exponent or so


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_split_is_exact_nested_and_stable(spark, n):
    ids = spark.range(n)
    def eval_ids(f, parts):
        return {r.id for r in splits.holdout(ids.repartition(parts), "id", fraction=f).collect()}
    five, ten = eval_ids(0.05, 3), eval_ids(0.1, 8)
    assert (len(five), len(ten)) == (math.ceil(n * 0.05), math.ceil(n * 0.1))
    assert five <= ten and ten == eval_ids(0.1, 1)
    split = splits.split_exact(ids, "id").groupBy("split").count().collect()
    assert sum(r["count"] for r in split) == n
    assert splits.split_exact(ids, "id", fraction=0).filter("split = 'eval'").count() == 0
    one = splits.holdout(ids, "id", count=splits.floor_count_min1(0.001))
    assert one.count() == max(1, int(n * 0.001))


def test_pick_stays_inside_the_holdout(spark):
    ids = spark.range(2000)
    held = {r.id for r in splits.holdout(ids, "id").collect()}
    picked = {r.id for r in splits.pick_subset(ids, "id", 50).collect()}
    assert len(picked) == 50 and picked <= held


def test_threshold_split_is_about_the_fraction(spark):
    n = splits.split_by_threshold(spark.range(5000), "id", fraction=0.2).filter("split = 'eval'").count()
    assert 850 < n < 1150


LENGTHS = [rng.choice([0, 1, 3, 10, 16]) for _ in range(400)]


@pytest.fixture(scope="module")
def examples(spark):
    rows = [(i, [i * 100 + j + 1 for j in range(n)]) for i, n in enumerate(LENGTHS)]
    return spark.createDataFrame(rows, "id long, input_ids array<int>")


def all_tokens():
    return sorted(i * 100 + j + 1 for i, n in enumerate(LENGTHS) for j in range(n))


def test_wrapped_packs_keep_every_token(examples):
    packs = tokens.pack_wrapped(examples, "id", 16, num_buckets=5).collect()
    assert sorted(t for p in packs for t in p.input_ids) == all_tokens()
    last = {}
    for p in packs:
        last[p.bucket] = max(last.get(p.bucket, 0), p.block)
    assert len(last) > 3
    assert all(len(p.input_ids) == 16 for p in packs if p.block < last[p.bucket])


def test_whole_example_packs(examples):
    packs = tokens.pack_examples(examples, "id", 16, num_buckets=5).collect()
    assert sorted(t for p in packs for t in p.input_ids) == all_tokens()
    assert sorted(i for p in packs for i in p.example_ids) == list(range(len(LENGTHS)))
    for p in packs:
        assert len(p.input_ids) <= 16
        for start, i in zip(p.starts, p.example_ids):
            assert p.input_ids[start:start + LENGTHS[i]] == [i * 100 + j + 1 for j in range(LENGTHS[i])]


def test_packs_with_repeated_ids_and_long_examples(spark):
    df = spark.createDataFrame([(1, [1, 2]), (1, [3]), (2, [4] * 20), (None, [5])], "id int, input_ids array<int>")
    packs = tokens.pack_examples(df, "id", 16, num_buckets=1, cut_long=True).collect()
    assert sorted(t for p in packs for t in p.input_ids) == [1, 2, 3] + [4] * 16 + [5]
    assert sum(p.tokens_cut for p in packs) == 4


def plain_next_fit(lengths, max_len):
    out, pack, used = [], 0, 0
    for n in lengths:
        if used + n > max_len:
            pack, used = pack + 1, 0
        out.append((pack, used))
        used += n
    return out


@pytest.mark.parametrize("block_rows", [1, 3, 64, 100_000])
def test_next_fit_over_blocks(spark, block_rows):
    """Most rows in one bucket, empty and full examples among them: blocks give what one pass gives."""
    rng = np.random.default_rng(block_rows)
    lengths = {b: rng.choice([0, 0, 1, 2, 3, 5, 8, 13, 16], n).tolist() for b, n in ((0, 400), (1, 30), (2, 1), (3, 0))}
    rows, number = [], 0
    for b, own in lengths.items():
        for n in own:
            number += 1
            rows.append((number * 7, b, number, n))
    order = spark.createDataFrame(rows, "__uid long, bucket long, row long, size int").repartition(5)
    got = {r.row: (r.pack, r.start, r["__uid"]) for r in tokens.next_fit(order, 16, block_rows).collect()}
    assert len(got) == len(rows)
    number = 0
    for own in lengths.values():
        for want in plain_next_fit(own, 16):
            number += 1
            assert got[number] == (*want, number * 7)


def test_one_bucket_is_packed_in_many_tasks(spark):
    df = spark.range(2_000).select("id", F.sequence(F.lit(1), (F.col("id") % 9 + 1).cast("int")).alias("input_ids"))
    packs = tokens.pack_examples(df, "id", 32, num_buckets=1, block_rows=100)
    assert packs.count() and packs.agg(F.sum(F.size("input_ids"))).first()[0] == sum(i % 9 + 1 for i in range(2_000))
    streams = tokens.pack_wrapped(df, "id", 32, num_buckets=1, block_rows=100)
    assert streams.agg(F.sum(F.size("input_ids"))).first()[0] == sum(i % 9 + 1 for i in range(2_000))
    with pytest.raises(Exception, match="does not fit"):
        tokens.pack_examples(df, "id", 8, num_buckets=1).collect()


def test_batches_over_all_rows(spark):
    df = spark.range(101).select("id", F.array_repeat(F.lit(5), 3).alias("input_ids"))
    got = tokens.collate(df.repartition(7), "id", 8).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in got) == [(i, 8) for i in range(12)] + [(12, 5)]


def test_row_numbers(spark):
    df = spark.createDataFrame([(x,) for x in ["b", None, "ab", "a", "é", "z", "B"] * 1], "s string").repartition(4)
    got = [r.s for r in row_numbers(df, [F.col("s").asc_nulls_last()], "n").orderBy("n").collect()]
    assert got == ["B", "a", "ab", "b", "z", "é", None]
    many = row_numbers(spark.range(1_000, numPartitions=9).select(F.col("id"), F.hash("id").alias("h")), ["h", "id"], "n")
    rows = many.orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 1_001)) and [(r.h, r.id) for r in rows] == sorted((r.h, r.id) for r in rows)
    assert row_numbers(df.limit(0), ["s"], "n").count() == 0


def test_collate(examples):
    ready = tokens.add_aux(examples).withColumn(
        "token_type_ids", F.when(F.col("id") % 2 == 0, F.array_repeat(F.lit(7), 40)))
    rows = tokens.collate(ready, "id", 4, pad_id=101, num_buckets=5).collect()
    assert len(rows) == len(LENGTHS)
    groups = {}
    for r in rows:
        groups.setdefault((r.bucket, r.batch), []).append(r)
        n = LENGTHS[r.id]
        ids = [r.id * 100 + j + 1 for j in range(n)]
        assert r.input_ids == ids + [101] * (r.width - n)
        assert r.labels == ids + [-100] * (r.width - n)
        assert r.attention_mask == [1] * n + [0] * (r.width - n)
        assert r.token_type_ids == [7 if r.id % 2 == 0 else 0] * r.width
    for batch in groups.values():
        assert len({r.width for r in batch}) == 1 and batch[0].width == max(LENGTHS[r.id] for r in batch)
        assert len(batch) <= 4


@pytest.mark.parametrize("block_rows", [1, 5, 1000])
def test_response_fold(spark, block_rows):
    def data(s):
        return f"data: {s}"
    content, usage = '{"choices":[{"delta":{"content":"x"}}]}', '{"usage":{"completion_tokens":%d}}'
    both = '{"choices":[{"delta":{"content":"x"}}],"usage":{"completion_tokens":4}}'
    cases = {
        1: ([": hi", data(content), data(content), data(usage % 9), data(content), data("[DONE]"), data(content)], (1, 10, 5)),
        2: ([data("{bad"), data(content), data(both), data("{}")], (1, 4, 3)),
        3: ([data("[DONE]"), data(content), data(usage % 5)], (None, 0, 0)),
        4: ([data('{"choices":[]}'), data(content), data('{"usage":{}}'), ""], (1, 1, 3)),
        5: ([data(content)] * 40 + [data(usage % 2)] + [data(content)] * 3, (0, 5, 43)),
    }
    rows = [(k, i, 1000 + i, line) for k, (lines, _) in cases.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "request_id long, seq long, recv_us long, line string").repartition(5)
    starts = spark.createDataFrame([(k, 1000) for k in cases], "request_id long, start_us long")
    got = {r.request_id: (r.ttft_us, r.completion_tokens, r.total_us)
           for r in perf.fold_responses(df, starts, block_rows=block_rows).collect()}
    assert got == {k: w for k, (_, w) in cases.items()}


LOG = [
    "=== Rank 0: logging session started (local) ===", "[TRAIN] step=1/? loss=nan lr=?",
    "[EVAL] Running evaluation...", "noise", "[EVAL] Running evaluation...", "[EVAL] eval_loss=0.5", "noise",
    "[EVAL] Running evaluation...", "=== Rank 0: logging session started (local) ===", "[TRAIN] step=2/10 loss=1.5 lr=2e-04",
]


@pytest.mark.parametrize("block_rows", [1, 3, 100])
def test_log_phases_and_sessions(spark, block_rows):
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(LOG)], "file string, line_no long, value string")
    got = trainlog.phases(df, block_rows=block_rows).orderBy("line_no").collect()
    assert [r.phase for r in got] == ["train"] * 2 + ["eval"] * 4 + ["train", "eval", "train", "train"]
    assert [r.line_no for r in got if r.phase_start] == [2, 7]
    got = trainlog.sessions(df, block_rows=block_rows).orderBy("line_no").collect()
    assert [r.session for r in got] == [1] * 8 + [2] * 2


def test_log_metrics(spark):
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(LOG)], "file string, line_no long, value string")
    first, loss, last = trainlog.metrics(df).orderBy("line_no").collect()
    assert math.isnan(first.loss) and first.max_steps is None and first.lr is None
    assert loss.eval_loss == 0.5 and (last.step, last.max_steps, last.lr) == (2, 10, 2e-4)


PAIRS = [
    (1, "a", "```python\nroot_part = Box(1)\n```", "Box(1)\nroot_part = 1"),
    (1, "b", "```python\nx = Ball(1)\n```", "Box(1)\nroot_part = 1"), (2, "a", "no", ""),
    (2, "b", "```python\n1\n```", "2"), (3, "a", None, "Cone(2)"), (3, "b", "```py\nCone(Box)\n```", "Cone(2) + Box(1)"),
]


def names_of(df, more):
    spare = df.sparkSession.range(more).select(F.concat(F.lit("Spare"), "id").alias("symbol"))
    return api_whitelist(df).union(spare)


def test_static_scores_of_rows_without_a_key(spark):
    rows = [(None, "a", "```python\nroot_part = Box(1)\n```", "Box(1)")] * 2 + [(5, "a", "```python\nroot_part = Box(1)\n```", "Box(1)")]
    df = spark.createDataFrame(rows, "example_id int, side string, prediction string, reference_code string")
    got = score_static(df, names_of(df, 3000)).collect()
    assert len(got) == 3 and {(r.api_in_whitelist, r.composite) for r in got} == {(True, got[0].composite)}


@pytest.mark.parametrize("more_names", [0, 3000])
def test_static_scores(spark, more_names):
    df = spark.createDataFrame(PAIRS, "example_id int, side string, prediction string, reference_code string")
    got = {(r.example_id, r.side): r for r in score_static(df, names_of(df, more_names)).collect()}
    def near(key, composite, coverage, unknown):
        r = got[key]
        assert r.composite == pytest.approx(composite) and r.api_coverage == coverage
        assert r.unknown_symbols == unknown
    near((1, "a"), 1.0, 1.0, [])
    near((1, "b"), 0.7 * 3 / 5 + 0.3 * 0.5, 0.0, ["Ball"])
    near((2, "a"), 0.0, 0.0, [])
    assert got[2, "a"].no_forbidden and not got[2, "a"].length_sanity and not got[2, "a"].api_in_whitelist
    near((2, "b"), 0.7 * 4 / 5 + 0.3, 1.0, [])
    near((3, "a"), 0.0, 0.0, [])
    near((3, "b"), 0.7 * 3 / 5 + 0.3 * (0.5 + 1) / 2, 0.5, [])


def test_a_callers_tokenizer(spark):
    @F.pandas_udf("array<int>")
    def lengths(text: pd.Series) -> pd.Series:
        return text.str.split().map(lambda words: [len(w) for w in words])

    df = spark.createDataFrame([("a bbb cc dddd",), ("",)], "text string")
    got = tokens.tokenize(df, 3, tokenizer=lambda c: lengths(c)).collect()
    assert [(r.n_tokens, r.input_ids) for r in got] == [(4, [1, 3, 2]), (0, [])]


def test_split_with_many_rows_of_one_id(spark):
    ids = spark.range(100).union(spark.range(200).select(F.lit(7).cast("long").alias("id")))
    for fraction in (0.05, 0.3, 0.9):
        got = splits.split_exact(ids, "id", fraction=fraction)
        sides = got.groupBy("id").agg(F.count_distinct("split").alias("n")).filter("n > 1")
        assert sides.count() == 0
        assert got.filter("split = 'eval'").count() >= math.ceil(300 * fraction)
