"""Latency and throughput of model requests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.functions.ordered import BLOCK_ROWS
from tunelake.functions.pytext import micro
from tunelake.functions.quantiles import index_quantiles
from tunelake.sources.frames import parse_frames

LATENCY_PROBS: Mapping[str, float] = {"p50": 0.50, "p95": 0.95}


def latency_summary(calls: DataFrame, *, key: str = "side", value: str = "latency_ms") -> DataFrame:
    """Per key, over positive latencies: n, mean and index quantiles.

    A failed call has latency 0 and is left out.
    """
    timed = calls.filter(F.col(value) > 0)
    means = timed.groupBy(key).agg((F.sum(value) / F.count(value)).alias("mean"))
    return index_quantiles(timed, [key], value, LATENCY_PROBS).join(means, key).select(
        key, "n", "mean", *LATENCY_PROBS)


def sweep_summary(requests: DataFrame) -> DataFrame:
    """Per concurrency level of a load test: errors, tokens, rates, latencies.

    ``requests``: concurrency, ok, start_us, total_us, completion_tokens,
    ttft_us. The mean stream rate adds up only requests with a non-zero time but
    divides by all good ones; the latency mean divides by the timed ones.
    """
    ok = F.col("ok")
    timed = ok & (F.col("total_us") > 0)
    tokens = F.coalesce("completion_tokens", F.lit(0))
    good, n_timed = F.count_if(ok), F.count_if(timed)
    wall = F.max(F.col("start_us") + F.coalesce("total_us", F.lit(0))) - F.min("start_us")
    rate = tokens * 1_000_000 / F.col("total_us")
    ttft = F.when(ok, F.col("ttft_us"))
    totals = requests.groupBy("concurrency").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(~ok).alias("errors"),
        wall.alias("wall_us"),
        F.coalesce(F.sum(F.when(ok, tokens)), F.lit(0)).alias("completion_tokens_total"),
        good.alias("__good"),
        F.sum(F.when(timed, micro(rate))).alias("__rates"),
        (F.sum(F.when(timed, F.col("total_us"))) / F.nullif(n_timed, F.lit(0))).alias("latency_us_mean"),
        (F.sum(ttft) / F.nullif(F.count(ttft), F.lit(0))).alias("ttft_us_mean"),
    ).withColumns({
        "agg_tokens_per_s": F.when(
            F.col("wall_us") > 0, F.col("completion_tokens_total") * 1_000_000 / F.col("wall_us")
        ).otherwise(0.0),
        "per_stream_tokens_per_s_mean": F.when(
            F.col("__good") > 0, F.coalesce("__rates", F.lit(0)) / 1e6 / F.col("__good")
        ).otherwise(0.0),
    }).drop("__good", "__rates")
    quantiles = index_quantiles(
        requests.filter(timed), ["concurrency"], "total_us",
        {f"latency_us_{k}": q for k, q in LATENCY_PROBS.items()}).drop("n")
    return totals.join(quantiles, "concurrency", "left")


def fold_blocks(frames: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per request and block of ``block_rows`` sequence numbers, all that a fold needs of it.

    A request that holds most frames is so spread over many tasks. Works on any part
    of the frames that holds a run of each request's sequence, so a stream may fold
    each micro-batch by itself.
    """
    in_block = Window.partitionBy("request_id", "block")
    seq = F.col("seq")
    end_at = F.min(F.when(F.col("is_end"), seq)).over(in_block)
    live = F.col("end_at").isNull() | (seq < F.col("end_at"))
    reported = F.when(live & F.col("usage_tokens").isNotNull(), seq)
    content = live & F.col("has_content")
    return (
        parse_frames(frames)
        .withColumn("block", F.floor(seq / F.lit(block_rows)))
        .withColumn("end_at", end_at)
        .withColumn("usage_at", F.max(reported).over(in_block))
        .groupBy("request_id", "block").agg(
            F.min("seq").alias("first_seq"),
            F.max(F.when(live | F.col("is_end") & (seq == F.col("end_at")), F.col("recv_us"))).alias("last_us"),
            F.min(F.when(content, F.col("recv_us"))).alias("content_us"),
            F.count_if(content).alias("contents"),
            F.count_if(content & (seq > F.col("usage_at"))).alias("contents_after"),
            F.max_by("usage_tokens", reported).alias("usage"),
            F.max("is_end").alias("has_end"),
        )
    )


def join_blocks(blocks: DataFrame, starts: DataFrame) -> DataFrame:
    """Fold a request's blocks, in order of their first frame, from its start on.

    ``starts`` holds (request_id, start_us), when each request was sent. Without one
    both times are null, as is the first where no frame has content.
    """
    along = Window.partitionBy("request_id").orderBy("first_seq")
    counted = blocks.withColumn(
        "ended", F.coalesce(F.max("has_end").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    ).withColumn(
        "usage_block", F.max(F.when(~F.col("ended") & F.col("usage").isNotNull(), F.col("first_seq")))
        .over(Window.partitionBy("request_id")))
    block, usage_block = F.col("first_seq"), F.col("usage_block")
    part = (
        F.when(F.col("ended"), 0)
        .when(usage_block.isNull() | (block > usage_block), F.col("contents"))
        .when(block == usage_block, F.col("usage") + F.col("contents_after"))
        .otherwise(0)
    )
    seen = ~F.col("ended")
    folded = counted.groupBy("request_id").agg(
        F.min(F.when(seen, F.col("content_us"))).alias("content_us"),
        F.sum(part).alias("completion_tokens"),
        F.max(F.when(seen, F.col("last_us"))).alias("last_us"),
    )
    return folded.join(starts.select("request_id", "start_us"), "request_id", "left").select(
        "request_id", (F.col("content_us") - F.col("start_us")).alias("ttft_us"), "completion_tokens",
        (F.col("last_us") - F.col("start_us")).alias("total_us"))


def fold_responses(frames: DataFrame, starts: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per request: time from its start to the first content, tokens, and total time.

    Tokens are the frames with content, replaced by a usage report when one
    comes; content after the report adds to it. Nothing after the end mark
    counts. Frames are (request_id, seq, recv_us, line).
    """
    return join_blocks(fold_blocks(frames, block_rows=block_rows), starts)
