"""Streams over several micro-batches, resumed record tables, shard layout."""

import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tunelake.operators import execeval, generate, perf, trainlog, weights
from tunelake.plans.evaluate import evaluate_executions, evaluate_sql, evaluate_static
from tunelake.plans.merge import merge_adapter
from tunelake.registry.inputs import derive
from tunelake.sinks.records import append_new, commit_records, committed_records, read_records, write_document, write_records
from tunelake.sources import tensors
from tunelake.sources.logs import read_logs
from tunelake.streaming import ended, responses
from tunelake.streaming import logs as log_stream
from tunelake.streaming.run import keyed_state, run_to_table


def as_stream(spark, df, order, folder, parts=4):
    """The table as files that arrive one by one in order of a column."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    step = (high - low) // parts + 1
    for i in range(parts):
        part = df.filter((F.col(order) >= low + i * step) & (F.col(order) < low + (i + 1) * step))
        part.coalesce(1).write.parquet(f"{folder}/{i}")
        for name in os.listdir(f"{folder}/{i}"):
            os.utime(f"{folder}/{i}/{name}", (1_700_000_000 + 60 * i,) * 2)
    return (
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(folder))


def run(stream, folder):
    query = (
        stream.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    assert query.awaitTermination(300)
    return stream.sparkSession.read.parquet(f"{folder}/out")


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_response_stream_equals_batch(spark, sf_dir, tmp_path):
    """Five micro-batches; one request holds nine tenths of the frames."""
    frames = derive(spark, sf_dir, "fx_frames").withColumn(
        "request_id", F.when(F.col("seq") % 10 > 0, 1).otherwise(F.col("request_id"))).cache()
    starts = frames.groupBy("request_id").agg((F.min("recv_us") - 7).alias("start_us")).filter("request_id % 3 <> 2")
    stream = as_stream(spark, frames, "seq", str(tmp_path / "in"), 5)
    got = responses.fold_response_stream(stream, starts, str(tmp_path / "run"))
    assert len(os.listdir(tmp_path / "run" / "table")) >= 5
    assert rows(got, *got.columns) == rows(perf.fold_responses(frames, starts, block_rows=50), *got.columns)


def frame(seq, at_ms, kind):
    line = {"text": 'data: {"choices":[{"delta":{"content":"x"}}]}', "usage": 'data: {"usage":{"completion_tokens":40}}', "end": "data: [DONE]"}[kind]
    return (seq, at_ms * 1000, line)


def test_rows_come_out_when_requests_end(spark, tmp_path):
    """Micro-batch by micro-batch: ended requests at once, silent ones after their time, nothing twice."""
    batches = [
        [(1, *frame(0, 10, "text")), (1, *frame(1, 20, "text")), (2, *frame(0, 15, "text"))],
        [(1, *frame(1, 20, "text")), (1, *frame(2, 30, "end")), (1, *frame(3, 40, "text")), (3, *frame(0, 45, "usage"))],
        [(2, *frame(1, 50, "usage")), (2, *frame(2, 55, "text")), (2, *frame(3, 60, "end")), (1, *frame(4, 61, "end"))],
        [(4, *frame(0, 5_000, "text"))],
        [(4, *frame(1, 9_000, "end"))],
    ]
    columns = "request_id long, seq long, recv_us long, line string"
    starts = spark.createDataFrame([(i, i) for i in (1, 2, 3)], "request_id long, start_us long")
    got = []
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, columns).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        stream = spark.readStream.schema(columns).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        with keyed_state(spark):
            run_to_table(ended.ended_responses(stream, starts, idle_ms=1_000, late_ms=100), str(tmp_path / "run"))
        now = {tuple(r) for r in spark.read.parquet(str(tmp_path / "run/table")).collect()}
        got.append(now - set().union(*got))
        assert len(now) == spark.read.parquet(str(tmp_path / "run/table")).count()
    assert got[:3] == [set(), {(1, True, 9_999, 2, 29_999)}, {(2, True, 14_998, 41, 59_998)}]
    assert got[3] | got[4] == {(3, False, None, 40, 44_997), (4, True, None, 1, None)}


class Handle:
    """A state store of one key, as a processor sees it."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


class Now(int):
    def getCurrentWatermarkInMs(self):  # noqa: N802
        return int(self)

    getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815


def test_many_requests_are_folded_in_one_call():
    """A call serves a bucket of requests with one timer; each ends or is given up by itself."""
    def frames(*rows):
        return iter([pd.DataFrame(rows, columns=["request_id", "seq", "recv_us", "is_end", "has_content", "usage_tokens"])])

    handle, processor = Handle(), ended.EndedResponses(1_000)
    processor.init(handle)
    text = [(i, 0, 1_000 * i, False, True, None) for i in range(500)]
    assert list(processor.handleInputRows((0,), frames(*text), Now(0))) == [] and handle.timers == [1_001]
    ends = [(i, 1, 600_000, True, False, None) for i in range(0, 500, 2)]
    [got] = processor.handleInputRows((0,), frames(*ends), Now(0))
    assert sorted(got["request_id"]) == list(range(0, 500, 2)) and set(got["completion_tokens"]) == {1} and got["ended"].all()
    assert list(got.sort_values("request_id")["content_us"]) == [1_000 * i for i in range(0, 500, 2)] and handle.timers == [1_002]
    handle.timers = []
    [given_up] = processor.handleExpiredTimer((0,), Now(1_301), Now(1_002))
    assert sorted(given_up["request_id"]) == list(range(1, 300, 2)) and not given_up["ended"].any() and handle.timers == [1_302]


def test_shuffled_log_parts_give_the_batch_result(spark, sf_dir, tmp_path):
    """One file holds most lines; parts come in any order, some lines twice, and one never."""
    raw = derive(spark, sf_dir, "fx_log_lines").withColumn("file", F.when(F.col("line_no") % 10 > 0, "train.log").otherwise(F.col("file")))
    first = raw.groupBy("file").agg(F.min("line_no").alias("low"))
    numbered = raw.withColumn("line_no", F.row_number().over(Window.partitionBy("file").orderBy("line_no")).cast("long")).cache()
    assert first.count() > 2
    lost = numbered.filter("file = 'train.log'").count() - 5
    sent = numbered.filter(f"file <> 'train.log' or line_no <> {lost}")
    for i in range(5):
        part = sent.filter(F.pmod(F.xxhash64("line_no", F.lit(3)), F.lit(5)) == i)
        part.unionByName(sent.filter("line_no % 50 = 1" if i == 4 else "false")).repartition(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = (
        spark.readStream.schema(numbered.schema).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")))
    got = log_stream.follow_phases_late(stream, str(tmp_path / "run"), block_rows=64)
    want = trainlog.sessions(trainlog.phases(numbered)).filter(f"file <> 'train.log' or line_no < {lost}")
    columns = ("file", "line_no", "phase", "phase_start", "session")
    assert rows(got, *columns) == rows(want, *columns)
    assert sorted(r.line_no for r in log_stream.held_lines(spark, str(tmp_path / "run"), 4).collect()) == list(range(lost + 1, lost + 6))


def test_time_to_first_token_counts_from_the_start(spark):
    frames = spark.createDataFrame([(1, 0, 5000, 'data: {"choices":[{"delta":{"content":"x"}}]}')], "request_id long, seq long, recv_us long, line string")
    starts = spark.createDataFrame([(1, 1000)], "request_id long, start_us long")
    assert perf.fold_responses(frames, starts).first()[:] == (1, 4000, 1, 4000)


def test_log_stream_equals_batch(spark, sf_dir, tmp_path):
    lines = derive(spark, sf_dir, "fx_log_lines").withColumn(
        "file", F.when(F.col("line_no") % 10 > 0, "train.log").otherwise(F.col("file"))).cache()
    stream = as_stream(spark, lines, "line_no", str(tmp_path / "in"), 5)
    got = log_stream.follow_phases(stream, str(tmp_path / "phases"))
    want = trainlog.sessions(trainlog.phases(lines))
    columns = ("file", "line_no", "phase", "phase_start", "session")
    assert rows(got, *columns) == rows(want, *columns)
    got = run(trainlog.metrics(stream), str(tmp_path / "metrics"))
    assert rows(got, "file", "line_no", "step", "eval_loss") == rows(
        trainlog.metrics(lines), "file", "line_no", "step", "eval_loss")


def test_log_files(spark, tmp_path):
    (tmp_path / "train.log").write_text("[TRAIN] step=1/9 loss=2.0 lr=0.1\n[EVAL] eval_loss=0.5\n")
    (tmp_path / "train-rank3.log").write_text("noise\n[EVAL] eval_loss=0.7\n")
    lines = read_logs(spark, str(tmp_path))
    assert rows(lines, "rank", "line_no") == [(0, 1), (0, 2), (3, 1), (3, 2)]
    files = log_stream.stream_log_files(spark, str(tmp_path))
    got = run(log_stream.stream_metrics(files), str(tmp_path / "q"))
    assert rows(got, "kind", "eval_loss") == [("eval", 0.5), ("eval", 0.7), ("train", None)]


def test_index_and_snapshot_files(spark, tmp_path):
    (tmp_path / "index.json").write_text('{"weight_map":\n {"a": "s1", "b": "s2"}}')
    docs = tensors.read_documents(spark, str(tmp_path / "index.json"))
    assert rows(tensors.tensor_index(docs), "name", "shard") == [("a", "s1"), ("b", "s2")]
    files = tensors.list_files(spark, str(tmp_path)).withColumns({"model": F.lit("m"), "snapshot": F.lit("x")})
    assert tensors.latest_valid_snapshot(files, ".json").first().snapshot == "x"
    assert tensors.latest_valid_snapshot(files).count() == 0


def test_records_survive_reruns(spark, tmp_path):
    path = str(tmp_path / "records")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "idx long, v string")
    both = spark.createDataFrame([(2, "new"), (3, "c")], "idx long, v string")
    append_new(first, path, "r1", ["idx"])
    for _ in range(2):
        append_new(both, path, "r2", ["idx"])
    assert rows(read_records(spark, path), "idx", "v", "run_id") == [(1, "a", "r1"), (2, "b", "r1"), (3, "c", "r2")]
    write_records(first.limit(1), path, "r1")
    assert rows(read_records(spark, path), "idx") == [(1,), (3,)]


def test_committed_records(spark, tmp_path):
    """The newest commit of each run, the newest run of each key; nothing of a run that failed."""
    path = str(tmp_path / "table")
    commit_records(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "idx long, v string"), path, "r1")
    commit_records(spark.createDataFrame([(2, "new", 5), (3, "c", None)], "idx long, v string, extra int"), path, "r2")
    broken = spark.createDataFrame([(1, "x"), (9, "y")], "idx long, v string").withColumn(
        "v", F.when(F.col("idx") == 9, F.raise_error(F.lit("lost executor")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost executor"):
        commit_records(broken, path, "r3")
    columns = ("idx", "v", "extra", "run_id")
    want = [(1, "a", None, "r1"), (2, "new", 5, "r2"), (3, "c", None, "r2"), (None, "n", None, "r1")]
    assert sorted(rows(committed_records(spark, path, ["idx"]), *columns), key=str) == sorted(want, key=str)
    commit_records(spark.createDataFrame([(2, "again")], "idx long, v string"), path, "r1")
    want = [(2, "again", None, "r1"), (3, "c", None, "r2")]
    assert sorted(rows(committed_records(spark, path, ["idx"]), *columns), key=str) == sorted(want, key=str)


def test_pending_skips_readable_records_only(spark):
    todo = spark.range(10).withColumnRenamed("id", "idx")
    records = spark.createDataFrame([(2, "{}"), (3, "{oops"), (4, None), (5, '{"a": 1}')], "idx long, record string")
    got = execeval.pending(todo, records, limit=7, start_from=1)
    assert [r.idx for r in got.orderBy("idx").collect()] == [1, 3, 4, 6]


def executions(spark, sf_dir):
    refs = derive(spark, sf_dir, "fx_reference_invariants").withColumn(
        "bbox", F.array(F.array(*[F.lit(0.0)] * 3), F.array(F.lit(1.0), F.lit(2.0), F.col("dz"))))
    return derive(spark, sf_dir, "fx_exec_results"), refs


def test_resumed_evaluation_equals_one_run(spark, sf_dir, tmp_path):
    runs, refs = executions(spark, sf_dir)
    whole = evaluate_executions(runs, refs, str(tmp_path / "a"), "r1")
    half = runs.filter("idx % 3 = 0")
    evaluate_executions(half, refs, str(tmp_path / "b"), "r1")
    resumed = evaluate_executions(runs, refs, str(tmp_path / "b"), "r2")
    assert rows(whole.counts, *whole.counts.columns) == rows(resumed.counts, *whole.counts.columns)
    counts = {r.side: r for r in whole.counts.collect()}
    for c in counts.values():
        assert c.L3 <= c.L1 and c.L4 <= c.L1 and c.L5 <= c.L3 and c.has_code_block <= c.queried
    write_document(resumed.document, str(tmp_path / "doc"))
    doc = json.loads(spark.read.text(str(tmp_path / "doc")).first()[0])
    assert doc["n_total"] == runs.select("idx").distinct().count()
    assert doc["sides"]["base"]["L1"] == counts["base"].L1
    assert doc["config"] == {"tol": 0.1} and doc["wall_seconds"] > 0
    again = execeval.score_invariants(resumed.records.drop("L5", "L5_reason", "L5_invariants_ok"))
    assert rows(again, "idx", "side", "L5_invariants_ok") == rows(resumed.records, "idx", "side", "L5_invariants_ok")
    pct = {r.metric: r for r in whole.summary.collect()}
    assert pct["L1"].total == max(c.queried for c in counts.values())


TOL = [
    ((10.9, 6, 1.0), (10.0, 6, 1.0), True), ((11.0, 6, 1.0), (10.0, 6, 1.0), True), ((11.1, 6, 1.0), (10.0, 6, 1.0), False),
    ((0.0, 6, 1.0), (0.0, 6, 1.0), True), ((1e-9, 6, 1.0), (0.0, 6, 1.0), False), ((10.0, 5, 1.0), (10.0, 6, 1.0), False),
    ((None, 6, 1.0), (10.0, 6, 1.0), False), ((10.0, 6, None), (10.0, 6, 1.0), False), ((10.0, None, 1.0), (10.0, None, 1.0), False),
    ((10.0, 6, 2.0), (10.0, 6, 1.0), False),
]


def test_invariants(spark):
    def part(v, f, z):
        return (v, f, None if z is None else [[0.0, 0.0, 0.0], [1.0, 2.0, z]])
    kind = "struct<volume double, face_count long, bbox array<array<double>>>"
    df = spark.createDataFrame([(part(*g), part(*r), w) for g, r, w in TOL], f"g {kind}, r {kind}, want boolean")
    got = df.select(execeval.compare_invariants(F.col("g"), F.col("r")).alias("got"), "want").collect()
    assert [r.got.ok for r in got] == [r.want for r in got]


def test_sql_plan(spark):
    examples = spark.range(400).select(F.col("id").alias("example_id"), F.concat(F.lit("SELECT a"), "id").alias("truth"))
    predictions = examples.select(
        "example_id", F.explode(F.array(F.lit("base"), F.lit("tuned"))).alias("side"), "truth"
    ).select(
        "example_id", "side",
        F.when((F.col("side") == "tuned") | (F.col("example_id") % 2 == 0), F.col("truth")).alias("prediction"),
        F.when((F.col("side") == "base") & (F.col("example_id") % 2 == 1), "TimeoutError: x").alias("error"),
        F.lit(5).cast("long").alias("latency_ms"))
    ev = evaluate_sql(examples, predictions, num_examples=15)
    got = {r.side: r for r in ev.accuracy.collect()}
    assert got["tuned"].num == 15 and got["tuned"].correct == 15
    errors = {r.side: r.errors for r in ev.errors.collect()}
    assert errors == {"base": 15 - got["base"].correct, "tuned": 0}
    assert ev.fixed.count() == min(5, errors["base"])


def test_static_plan(spark, sf_dir):
    pairs = derive(spark, sf_dir, "fx_code_pairs")
    examples = pairs.filter("side = 'base'").select("example_id", "reference_code")
    predictions = pairs.select("example_id", "side", "prediction", F.lit(None).cast("string").alias("error"),
                               F.col("latency_ms").cast("long").alias("latency_ms"))
    ev = evaluate_static(examples, predictions, num_examples=12)
    assert {r.side: r.num for r in ev.aggregate.collect()} == {"base": 12, "tuned": 12}
    assert ev.delta.count() == 8 and ev.latency.count() == 2
    assert ev.detail.count() == 24 and {"prediction", "reference_code", "latency_ms", "composite"} <= set(ev.detail.columns)
    assert ev.scored.filter((F.col("api_coverage") < 0) | (F.col("api_coverage") > 1)).count() == 0


def test_product_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(weights, "ROW_BLOCK", 3)
    out, inn, r = 10, 7, 2
    a = [[float(k * 10 + j) for j in range(inn)] for k in range(r)]
    b = [[float(i - k) for k in range(r)] for i in range(out)]
    a_rows = spark.createDataFrame([("t", 0, k, a[k]) for k in range(r)], "name string, expert int, k int, values array<double>")
    b_rows = spark.createDataFrame([("t", 0, i, b[i]) for i in range(out)], "name string, expert int, row long, coeffs array<double>")
    shapes = spark.createDataFrame([("t", out)], "name string, out_dim long")
    delta = weights.lora_delta(a_rows, b_rows, shapes, 0.5, col_block=4)
    got = {(v.row, v.col): v.value for v in weights.tile_values(delta, 4).collect()}
    want = {(i, j): 0.5 * sum(b[i][k] * a[k][j] for k in range(r)) for i in range(out) for j in range(inn)}
    assert got == want


SHAPES = [
    # name, experts, A, B, status
    ("q", None, (2, 6), (5, 2), "merged"), ("wide", None, (2, 7), (5, 2), "shape_mismatch"),
    ("rank", None, (2, 6), (5, 3), "shape_mismatch"), ("e", 4, (8, 6), (5, 8), "merged"),
    ("odd", 4, (7, 6), (5, 7), "shape_mismatch"), ("count", 3, (6, 6), (5, 6), "shape_mismatch"),
    ("half", None, (2, 6), None, "incomplete"), ("hole", None, (2, 6), (5, 2), "rows_missing"), ("gone", "absent", (2, 6), (5, 2), "target_missing"),
]


def test_merge_plan(spark, tmp_path):
    keys = [(f"base_model.model.{n}.lora_{f}.weight", *s) for n, _, a, b, _ in SHAPES for f, s in (("A", a), ("B", b)) if s]
    keys += [(f"base_model.model.q.base_layer.lora_{f}.weight", *s) for f, s in (("A", (1, 6)), ("B", (5, 1)))]
    keys = spark.createDataFrame(keys, "key string, dim0 int, dim1 int")
    base = spark.createDataFrame(
        [(f"{n}.weight", f"s{i % 2}", e, 5, 6) for i, (n, e, *_) in enumerate(SHAPES) if e != "absent"],
        "name string, shard string, experts int, out_dim int, in_dim int")
    base_rows = base.select(
        "name", F.explode(F.sequence(F.lit(0), F.when(F.col("name") == "e.weight", 3).otherwise(0))).alias("expert"),
        F.array_repeat(F.lit(1.0), 6).alias("values")).withColumn(
        "row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))))
    a_rows = [("q", "bare", k, [1.0] * 6) for k in range(2)] + [("e", "bare", k, [float(k)] * 6) for k in range(8)]
    b_rows = [("q", "bare", i, [1.0, float(i)]) for i in range(5)] + [("e", "bare", i, [1.0] * 8) for i in range(5)]
    # A second pair for one tensor, and a pair that lacks a row of A.
    a_rows += [("q", "base_layer", 0, [10.0] * 6), ("hole", "bare", 0, [1.0] * 6)]
    b_rows += [("q", "base_layer", i, [1.0]) for i in range(5)] + [("hole", "bare", i, [1.0, 1.0]) for i in range(5)]
    a_rows = spark.createDataFrame(a_rows, "root string, slot string, k int, values array<double>")
    b_rows = spark.createDataFrame(b_rows, "root string, slot string, row long, coeffs array<double>")
    rep = merge_adapter(base, base_rows, keys, a_rows, b_rows, 2.0, str(tmp_path / "out"), num_experts=4)
    status = {r.target: r.status for r in rep.matched.collect()}
    assert status == {f"{n}.weight": s for n, *_, s in SHAPES}
    assert {(r.target, r.slot): r.block_rank for r in rep.matched.filter("status = 'merged'").collect()} == {
        ("q.weight", "bare"): 2, ("q.weight", "base_layer"): 1, ("e.weight", "bare"): 2}
    assert [(r.target, r.total) for r in rep.unapplied.collect()] == [("gone.weight", 1)]
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 7 * 5 + 4 * 5 and dict(written.dtypes)["values"] == "array<float>"
    values = {(r.name, r.expert, r.row): r["values"][0] for r in written.collect()}
    assert all(values["q.weight", 0, i] == 1 + 2 * (1 + i) + 20 for i in range(5))
    assert values["wide.weight", 0, 3] == values["hole.weight", 0, 3] == 1
    assert all(values["e.weight", e, i] == 1 + 2 * (4 * e + 1) for e in range(4) for i in range(5))


def test_unequal_ranks_fail_loudly(spark):
    a = spark.createDataFrame([("t", 0, 0, [1.0])], "name string, expert int, k int, values array<double>")
    b = spark.createDataFrame([("t", 0, 0, [1.0, 2.0])], "name string, expert int, row long, coeffs array<double>")
    with pytest.raises(Exception, match="unequal rank"):
        weights.lora_delta(a, b, spark.createDataFrame([("t", 1)], "name string, out_dim long"), 1.0).collect()


def test_reconciled_names_cover_the_base(spark):
    def names(*n):
        return spark.createDataFrame([(x,) for x in n], "name string")
    got = weights.reconcile_names(
        names("a.weight", "b.weight", "b.bias", "new.weight", "c.linear.weight"),
        names("a.weight", "b.linear.weight", "b.linear.bias", "c.linear.weight", "d.buffer"))
    assert rows(got, "name", "action") == sorted([
        ("a.weight", "kept"), ("b.linear.bias", "renamed"), ("b.linear.weight", "renamed"),
        ("c.linear.weight", "kept"), ("d.buffer", "copied"), ("new.weight", "kept")], key=str)


def test_names_are_never_broadcast(spark, sf_dir):
    """Tables of names are merged, at any size: the planner thinks millions of them small."""
    base, saved = derive(spark, sf_dir, "fx_base_tensors"), derive(spark, sf_dir, "fx_saved_names")
    reconciled = weights.reconcile_names(saved, base)
    pairs = weights.lora_pairs(weights.adapter_factors(derive(spark, sf_dir, "fx_adapter_keys")))
    for made in (reconciled, weights.reconcile_counts(reconciled), weights.match_pairs(pairs, base, 8), weights.unapplied(pairs, base)):
        assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pct, verdict", [(1.0, "ok"), (60.0, "fail")])
def test_trainable_share(spark, pct, verdict):
    base = spark.createDataFrame(
        [("a.q_proj.weight", None, 2, 5), ("a.gate.weight", None, 3, 10), ("mtp.q_proj.weight", None, 1, 10)],
        "name string, experts int, out_dim int, in_dim int")
    row = weights.trainable_share(base, pct).first()
    assert (row.trainable, row.total, row.pct, row.verdict) == (10, 50, 20.0, verdict)


def test_calls_in_flight_keep_their_order(spark):
    """Never more than the window, results in order, and a call over its time does not hold up the rest."""
    state = {"now": 0, "most": 0}

    def model(prompt):
        state["now"] += 1
        state["most"] = max(state["most"], state["now"])
        time.sleep({"slow": 30, "late": 0.3}.get(prompt, 0.02))
        state["now"] -= 1
        if prompt == "bad":
            raise ValueError("bad prompt")
        return prompt.upper()

    prompts = ["a", "late", "b", "bad", "slow", "c"] + [f"p{i}" for i in range(30)]
    began = time.monotonic()
    got = list(generate.answers(model, prompts, 4, 1.0))
    assert time.monotonic() - began < 10 and 2 <= state["most"] <= 5  # the one given up goes on beside the window
    assert [g[0] for g in got] == ["" if p in ("bad", "slow") else p.upper() for p in prompts]
    assert got[3][1] == "ValueError: bad prompt" and got[4][1] == "TimeoutError: no answer within 1 s"
    assert got[1][2] >= 0.3 and got[4][2] == 0
    df = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "id long, prompt string").coalesce(1)
    made = generate.generate(df, lambda p: p[::-1], keep=["id"], in_flight=8, limit_s=20).collect()
    assert [(r.id, r.prediction) for r in made] == [(i, f"p{i}"[::-1]) for i in range(40)]
    assert list(generate.answers(str.upper, [], 4, None)) == [] and list(generate.answers(str.upper, ["x"], 3, None))[0][0] == "X"
