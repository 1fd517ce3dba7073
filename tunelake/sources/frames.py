"""Response streams stored as text frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.functions.ordered import BLOCK_ROWS
from tunelake.functions.pytext import strip, truthy

# The frame prefix and the end mark of a response stream.
DATA_PREFIX = "data: "
END_MARK = "[DONE]"


def frame_columns(line: str = "line") -> dict[str, Column]:
    """What one frame says: end mark, text content, token usage. A frame that is
    no data line or does not parse says nothing."""
    is_data = F.col(line).startswith(DATA_PREFIX)
    chunk = F.when(is_data, F.substring(F.col(line), len(DATA_PREFIX) + 1, 2**31 - 1))
    obj = F.try_parse_json(chunk)
    return {
        "is_data": is_data,
        "is_end": F.coalesce(strip(chunk) == END_MARK, F.lit(False)),
        "has_content": truthy(
            F.try_variant_get(obj, "$.choices[0].delta.content", "string")),
        "usage_tokens": F.try_variant_get(obj, "$.usage.completion_tokens", "bigint"),
    }


def parse_frames(frames: DataFrame) -> DataFrame:
    """Frames of (request_id, seq, recv_us, line) without the text."""
    return frames.select(
        "request_id", "seq", "recv_us",
        *[c.alias(n) for n, c in frame_columns().items()])


def frames_before_end(parsed: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Data frames of each request up to its first end mark, which is left out.

    A request of any number of frames is handled in blocks of ``block_rows``
    sequence numbers; only whether a block holds an end mark moves between blocks.
    """
    block = F.floor(F.col("seq") / F.lit(block_rows))
    in_block = Window.partitionBy("request_id", "block")
    along = (
        Window.partitionBy("request_id").orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    tagged = parsed.withColumn("block", block)
    ended = (
        tagged.groupBy("request_id", "block").agg(F.max("is_end").alias("__has_end"))
        .withColumn("__ended", F.coalesce(F.max("__has_end").over(along), F.lit(False)))
        .drop("__has_end")
    )
    end_at = F.min(F.when(F.col("is_end"), F.col("seq"))).over(in_block)
    return (
        tagged.join(ended, ["request_id", "block"])
        .withColumn("__end_at", end_at)
        .filter(
            F.col("is_data") & ~F.col("__ended")
            & (F.col("__end_at").isNull() | (F.col("seq") < F.col("__end_at"))))
        .drop("block", "__ended", "__end_at")
    )
