"""Small report tables over aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.sources.predictions import base_vs_tuned


def metric_delta(
    aggregate: DataFrame, metrics: Sequence[str], *, base: str = "base", tuned: str = "tuned"
) -> DataFrame:
    """One row per metric: both sides and the difference, null where a side is absent."""
    long = aggregate.select(
        "side", *[F.col(m).cast("double").alias(m) for m in metrics]
    ).unpivot("side", list(metrics), "metric", "value")

    def of(side: str):
        return F.max(F.when(F.col("side") == side, F.col("value")))

    return long.groupBy("metric").agg(of(base).alias("base"), of(tuned).alias("tuned")).withColumn(
        "delta", F.col("tuned") - F.col("base"))


def flips(
    scored: DataFrame, *, key: str = "example_id", threshold: float = 0.5, k: int | None = None
) -> DataFrame:
    """Examples whose composite the tuned side lifts from below the threshold;
    the first ``k`` in key order if given."""
    lifted = base_vs_tuned(scored, ["composite"], key=key).filter(
        (F.col("base_composite") < threshold) & (F.col("tuned_composite") >= threshold))
    return lifted if k is None else lifted.orderBy(key).limit(k)


def detail(attached: DataFrame, scored: DataFrame, *, keys: Sequence[str] = ("example_id", "side")) -> DataFrame:
    """Each test example with its reference, prediction, error and latency beside its scores."""
    return attached.join(scored, list(keys))


def run_report(aggregate: DataFrame, config: dict[str, str | int]) -> DataFrame:
    """One row: the run's settings and each side's aggregate, as one document.

    Only the aggregate, one row per side, is gathered; per-example detail stays
    a table of its own.
    """
    sides = F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        "side", F.struct(*[c for c in aggregate.columns if c != "side"]).alias("values")))))
    settings = [F.lit(v).alias(k) for k, v in config.items()]
    return aggregate.agg(sides.alias("sides")).select(*settings, "sides")
