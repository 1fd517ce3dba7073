"""Folding response frames as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tunelake.operators.perf import fold_blocks, join_blocks
from tunelake.streaming.run import run_batches


def fold_response_stream(frames: DataFrame, starts: DataFrame, path: str) -> DataFrame:
    """``fold_responses`` over a stream of frames, with all it holds now.

    Each micro-batch is folded to one row per request and block, and only these rows
    are kept, so no state grows in memory and a request may hold most frames. A
    request's frames must arrive in order of ``seq``; the source's rate limit bounds
    a micro-batch. Starts may come later than frames.
    """
    blocks = run_batches(frames, path, lambda batch, _: (fold_blocks(batch), None))
    return join_blocks(blocks, starts)
