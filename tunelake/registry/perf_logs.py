"""Queries: request latency, response streams and training logs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tunelake.functions.numbering import row_numbers
from tunelake.functions.quantiles import index_quantiles
from tunelake.operators import perf, trainlog
from tunelake.registry.core import register
from tunelake.registry.inputs import derive, table
from tunelake.sinks.shared import shared_dir
from tunelake.sources.frames import frames_before_end, parse_frames
from tunelake.sources.logs import rank_of
from tunelake.streaming import ended, responses
from tunelake.streaming import logs as log_stream
from tunelake.streaming.run import keyed_state, new_path, run_to_table

# Small blocks, so that the checks cross many block borders.
BLOCK = 1_000
# Micro-batches of the streams.
PARTS = 5
FILES = 4  # of a part
IDLE_MS = 10**9  # longer than all frames of the tables take, so requests end by their end mark alone


def _pick(value: str, group: str, probs: dict[str, float], source: str) -> str:
    picks = ", ".join(
        f"max(CASE WHEN i = least(n - 1, CAST(floor({q}::DOUBLE * n) AS BIGINT)) THEN {value} END) AS {name}"
        for name, q in probs.items())
    return f"""SELECT {group}, max(n) AS n, {picks} FROM (SELECT {group}, {value},
  row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS i, count(*) OVER (PARTITION BY {group}) AS n FROM {source})
  GROUP BY {group}"""


@register("latency_summary", f"""
WITH t AS (SELECT side, latency_ms FROM fx_code_pairs WHERE latency_ms > 0),
q AS ({_pick('latency_ms', 'side', dict(perf.LATENCY_PROBS), 't')}),
m AS (SELECT side, CAST(sum(latency_ms) AS DOUBLE) / count(*) AS mean FROM t GROUP BY side)
SELECT side, n, mean, p50, p95 FROM q JOIN m USING (side)""", ("fx_code_pairs",))
def latency_summary(spark, sf_dir):
    return perf.latency_summary(derive(spark, sf_dir, "fx_code_pairs"))


_PROBS = {"p00": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


@register("quantile_index", _pick("l_extendedprice", "l_returnflag", _PROBS, "lineitem"))
def quantile_index(spark, sf_dir):
    return index_quantiles(
        table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", _PROBS)


@register("perf_sweep", f"""
WITH t AS (SELECT concurrency, total_us FROM fx_requests WHERE ok AND total_us > 0),
q AS ({_pick('total_us', 'concurrency', {"latency_us_p50": 0.5, "latency_us_p95": 0.95}, 't')}),
a AS (SELECT concurrency, count(*) AS requests, CAST(sum((NOT ok)::int) AS BIGINT) AS errors,
  CAST(max(start_us + coalesce(total_us, 0)) - min(start_us) AS BIGINT) AS wall_us,
  CAST(sum(CASE WHEN ok THEN coalesce(completion_tokens, 0) ELSE 0 END) AS BIGINT) AS completion_tokens_total,
  sum(ok::int) AS good,
  CAST(sum(CASE WHEN ok AND total_us > 0 THEN CAST(round(coalesce(completion_tokens, 0) * 1000000 / total_us * 1000000) AS BIGINT) END) AS BIGINT) AS rates,
  CAST(sum(CASE WHEN ok AND total_us > 0 THEN total_us END) AS DOUBLE) / sum((ok AND total_us > 0)::int) AS latency_us_mean,
  CAST(sum(CASE WHEN ok THEN ttft_us END) AS DOUBLE) / nullif(count(CASE WHEN ok THEN ttft_us END), 0) AS ttft_us_mean
  FROM fx_requests GROUP BY concurrency)
SELECT a.concurrency, requests, errors, wall_us, completion_tokens_total, latency_us_mean, ttft_us_mean,
  completion_tokens_total * 1000000 / wall_us AS agg_tokens_per_s, rates / 1000000.0::DOUBLE / good AS per_stream_tokens_per_s_mean,
  latency_us_p50, latency_us_p95 FROM a JOIN q USING (concurrency)""", ("fx_requests",))
def perf_sweep(spark, sf_dir):
    return perf.sweep_summary(derive(spark, sf_dir, "fx_requests"))


FRAMES = """WITH p AS (SELECT request_id, seq, recv_us, starts_with(line, 'data: ') AS is_data,
  CASE WHEN starts_with(line, 'data: ') THEN substr(line, 7) END AS chunk FROM fx_frames),
j AS (SELECT *, coalesce(trim(chunk) = '[DONE]', false) AS is_end, CASE WHEN json_valid(chunk) THEN chunk::JSON END AS obj FROM p),
f AS (SELECT request_id, seq, recv_us, is_data, is_end,
  coalesce(json_extract_string(obj, '$.choices[0].delta.content') <> '', false) AS has_content,
  CAST(json_extract_string(obj, '$.usage.completion_tokens') AS BIGINT) AS usage_tokens,
  min(CASE WHEN is_end THEN seq END) OVER (PARTITION BY request_id) AS end_at FROM j)
"""
FOLD = FRAMES + """,
u AS (SELECT *, max(CASE WHEN usage_tokens IS NOT NULL AND seq < coalesce(end_at, 9e18) THEN seq END) OVER (PARTITION BY request_id) AS usage_at FROM f),
fold AS (SELECT request_id,
  min(CASE WHEN has_content AND seq < coalesce(end_at, 9e18) THEN recv_us END) - min(start_us) AS ttft_us,
  CAST(coalesce(max(CASE WHEN seq = usage_at THEN usage_tokens END), 0)
    + sum((has_content AND seq < coalesce(end_at, 9e18) AND seq > coalesce(usage_at, -1))::int) AS BIGINT) AS completion_tokens,
  max(CASE WHEN seq <= coalesce(end_at, 9e18) THEN recv_us END) - min(start_us) AS total_us
  FROM u LEFT JOIN fx_request_starts USING (request_id) GROUP BY request_id)
"""


@register("sse_frames", FRAMES + """
SELECT request_id, seq, has_content, usage_tokens FROM f WHERE is_data AND seq < coalesce(end_at, 9e18)""", ("fx_frames",))
def sse_frames(spark, sf_dir):
    parsed = parse_frames(derive(spark, sf_dir, "fx_frames"))
    return frames_before_end(parsed, block_rows=BLOCK).select(
        "request_id", "seq", "has_content", "usage_tokens")


FOLDS = ("fx_frames", "fx_request_starts")


@register("sse_request_fold", FOLD + "SELECT * FROM fold", FOLDS)
def sse_request_fold(spark, sf_dir):
    return perf.fold_responses(*(derive(spark, sf_dir, name) for name in FOLDS), block_rows=BLOCK)


def _streamed(spark, df, name, order):
    """A table written to the shared folder, part by part along ``order``, and opened as a stream of them."""
    path = f"{shared_dir(spark)}/{name}-in-{uuid.uuid4().hex}"
    low, high = df.agg(F.min(order), F.max(order)).first()
    step = ((high or 0) - (low or 0)) // PARTS + 1
    for i in range(PARTS):  # a stream takes files by the time they were written
        start = (low or 0) + i * step
        df.filter((F.col(order) >= start) & (F.col(order) < start + step)).repartition(FILES).write.parquet(f"{path}/{i}")
    return (
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES).option("recursiveFileLookup", "true").parquet(path))


@register("sse_ended_stream", FOLD + "SELECT true AS ended, fold.* FROM fold WHERE request_id IN (SELECT request_id FROM f WHERE is_end)", FOLDS)
def sse_ended_stream(spark, sf_dir):
    """One row for each request that ends, from the micro-batch with its end mark."""
    frames = _streamed(spark, derive(spark, sf_dir, "fx_frames"), "frames", "seq")
    rows = ended.ended_responses(frames, derive(spark, sf_dir, "fx_request_starts"), IDLE_MS)
    with keyed_state(spark):
        return run_to_table(rows, new_path(frames, "ended"))


@register("sse_request_fold_stream", FOLD + "SELECT * FROM fold", FOLDS)
def sse_request_fold_stream(spark, sf_dir):
    frames = _streamed(spark, derive(spark, sf_dir, "fx_frames"), "frames", "seq")
    return responses.fold_response_stream(frames, derive(spark, sf_dir, "fx_request_starts"), new_path(frames, "folds"))


LOGS = ("fx_log_lines",)


def _shuffled_parts(spark, df, name):
    """Like :func:`_streamed`, but a part holds lines from all over the table."""
    path = f"{shared_dir(spark)}/{name}-in-{uuid.uuid4().hex}"
    for i in range(PARTS):
        df.filter(F.pmod(F.xxhash64("file", "line_no"), F.lit(PARTS)) == i).repartition(FILES).write.parquet(f"{path}/{i}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES).option("recursiveFileLookup", "true").parquet(path)


_TRAIN = r"^\[TRAIN\] step=(\d+)/(\S+) loss=(\S+) lr=(\S+)"
_EVAL = r"^\[EVAL\] eval_loss=(\S+)"
_HEADER = r"^=== Rank (\d+): logging session started \((.*)\) ===$"


def _num(pattern: str, group: int, kind: str) -> str:
    return f"TRY_CAST(CASE WHEN regexp_matches(value, '{pattern}') THEN regexp_extract(value, '{pattern}', {group}) END AS {kind})"


METRICS = f"""SELECT file, line_no, CASE WHEN regexp_matches(value, '{_TRAIN}') THEN 'train' ELSE 'eval' END AS kind,
  {_num(_TRAIN, 1, 'BIGINT')} AS step, {_num(_TRAIN, 2, 'BIGINT')} AS max_steps, {_num(_TRAIN, 3, 'DOUBLE')} AS loss,
  {_num(_TRAIN, 4, 'DOUBLE')} AS lr, {_num(_EVAL, 1, 'DOUBLE')} AS eval_loss
FROM fx_log_lines WHERE regexp_matches(value, '{_TRAIN}') OR regexp_matches(value, '{_EVAL}')"""
PHASES = f"""WITH e AS (SELECT *, CASE WHEN starts_with(value, '[EVAL] Running evaluation...') THEN 1
  WHEN regexp_matches(value, '{_EVAL}') OR regexp_matches(value, '{_HEADER}') THEN 0 END AS event FROM fx_log_lines),
b AS (SELECT *, coalesce(last_value(event IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT file, line_no, coalesce(event = 1 AND before <> 1, false) AS phase_start,
  CASE WHEN coalesce(event = 1 AND before <> 1, false) OR (before = 1 AND NOT regexp_matches(value, '{_HEADER}')) THEN 'eval' ELSE 'train' END AS phase
FROM b"""
SESSIONS = f"""SELECT file, line_no, CAST(sum(regexp_matches(value, '{_HEADER}')::int) OVER (PARTITION BY file ORDER BY line_no) AS BIGINT) AS session
FROM fx_log_lines"""


def log_lines(spark, sf_dir):
    return derive(spark, sf_dir, "fx_log_lines")


@register("log_rank_lines", """
SELECT file, line_no, CAST(CASE WHEN file = 'train.log' THEN '0' ELSE regexp_extract(file, 'train-rank(\\d+)\\.log', 1) END AS INTEGER) AS rank,
  value FROM fx_log_lines""", LOGS)
def log_rank_lines(spark, sf_dir):
    return log_lines(spark, sf_dir).withColumn("rank", rank_of(F.col("file")))


@register("log_metrics", METRICS, LOGS)
def log_metrics(spark, sf_dir):
    return trainlog.metrics(log_lines(spark, sf_dir))


@register("log_phases", PHASES, LOGS)
def log_phases(spark, sf_dir):
    return trainlog.phases(log_lines(spark, sf_dir), block_rows=BLOCK).drop("value")


@register("log_sessions", SESSIONS, LOGS)
def log_sessions(spark, sf_dir):
    return trainlog.sessions(log_lines(spark, sf_dir), block_rows=BLOCK).drop("value")


@register("log_metrics_stream", METRICS, LOGS)
def log_metrics_stream(spark, sf_dir):
    lines = _streamed(spark, log_lines(spark, sf_dir), "logs", "line_no")
    return run_to_table(trainlog.metrics(lines), new_path(lines, "metrics"))


@register("log_phases_stream", PHASES, LOGS)
def log_phases_stream(spark, sf_dir):
    lines = _streamed(spark, log_lines(spark, sf_dir), "logs", "line_no")
    return log_stream.follow_phases(lines, new_path(lines, "phases")).drop("value", "session")


@register("log_sessions_stream", SESSIONS, LOGS)
def log_sessions_stream(spark, sf_dir):
    lines = _streamed(spark, log_lines(spark, sf_dir), "logs", "line_no")
    return log_stream.follow_phases(lines, new_path(lines, "sessions")).select(
        "file", "line_no", "session")


@register("log_late_lines_stream", f"""WITH p AS ({PHASES}), s AS ({SESSIONS})
SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY line_no) AS BIGINT) AS line_no, phase, phase_start, session
FROM p JOIN s USING (file, line_no)""", LOGS)
def log_late_lines_stream(spark, sf_dir):
    """Phases and sessions of lines that arrive in any order; each waits for those before it."""
    numbered = row_numbers(log_lines(spark, sf_dir), ["file", "line_no"], "n")
    first = numbered.groupBy("file").agg(F.min("n").alias("first"))
    numbered = numbered.join(first, "file").select("file", (F.col("n") - F.col("first") + 1).alias("line_no"), "value")
    lines = _shuffled_parts(spark, numbered, "late-logs")
    return log_stream.follow_phases_late(lines, new_path(lines, "late")).select("file", "line_no", "phase", "phase_start", "session")
