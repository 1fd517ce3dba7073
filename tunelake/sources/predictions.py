"""Predictions recorded elsewhere, aligned to examples by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.functions.pytext import text_or_empty


def attach_predictions(
    examples: DataFrame,
    predictions: DataFrame,
    *,
    sides: Sequence[str] = ("base", "tuned"),
    key: str = "example_id",
) -> DataFrame:
    """One row per example and side. A missing or failed prediction is '' and
    keeps its error; its latency is 0, as for a call that never finished."""
    wanted = examples.withColumn("side", F.explode(F.array(*[F.lit(s) for s in sides])))
    return (
        wanted.join(
            predictions.select(key, "side", "prediction", "error", "latency_ms"),
            [key, "side"], "left",
        )
        .withColumn("prediction", text_or_empty(F.col("prediction")))
        .withColumn("latency_ms", F.coalesce(F.col("latency_ms"), F.lit(0).cast("bigint")))
    )


def base_vs_tuned(
    scored: DataFrame, columns: Sequence[str], *, key: str = "example_id",
    base: str = "base", tuned: str = "tuned",
) -> DataFrame:
    """Put both sides of each example on one row, as ``base_*`` and ``tuned_*``.

    Two inner sides of a self-join would shuffle the input twice; one grouped
    pass with plain maxima shuffles it once. Examples with only one side are left out.
    """
    def of(side: str, c: str):
        return F.max(F.when(F.col("side") == side, F.col(c)))

    return (
        scored.filter(F.col("side").isin(base, tuned))
        .groupBy(key).agg(
            (F.max(F.col("side") == base) & F.max(F.col("side") == tuned)).alias("__both"),
            *[of(base, c).alias(f"base_{c}") for c in columns],
            *[of(tuned, c).alias(f"tuned_{c}") for c in columns],
        )
        .filter("__both").drop("__both")
    )
