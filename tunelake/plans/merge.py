"""Merging adapter tensors into base tensors, shard layout kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.operators import weights
from tunelake.sinks.tensors import write_shards


@dataclass(frozen=True)
class MergeReport:
    matched: DataFrame
    outcomes: DataFrame
    unapplied: DataFrame
    shards: DataFrame


def merge_adapter(
    base: DataFrame, base_rows: DataFrame, keys: DataFrame, a_rows: DataFrame, b_rows: DataFrame,
    scaling: float, path: str, *, num_experts: int, dtype: str = "float",
) -> MergeReport:
    """Add every pair that fits its base tensor to it and write all shards.

    ``base``: the manifest (name, shard, experts, out_dim, in_dim); ``keys``:
    adapter keys with dim0, dim1. Factor rows are as the adapter has them:
    ``a_rows`` (root, slot, k, values) and ``b_rows`` (root, slot, row, coeffs), an
    expert tensor's factors side by side; they are cut per expert here. All pairs
    of one tensor are added. A pair whose factor rows are not all there, once each
    and as long as its shapes say, gets the status ``rows_missing`` and is left out.
    """
    pair = ["root", "slot"]
    pairs = weights.lora_pairs(weights.adapter_factors(keys))
    sound = weights.sound_pairs(a_rows, b_rows, pairs).withColumn("sound", F.lit(True))
    matched = weights.match_pairs(pairs, base, num_experts).join(sound, pair, "left")
    lacking = (F.col("status") == "merged") & F.col("sound").isNull()
    matched = matched.withColumn("status", F.when(lacking, "rows_missing").otherwise(F.col("status"))).withColumn(
        "block_rank", F.when(F.col("status") == "merged", F.col("block_rank"))).drop("sound")
    good = matched.filter(F.col("status") == "merged").select(
        *pair, F.col("target").alias("name"), "out_dim", F.coalesce("experts", F.lit(1)).cast("int").alias("experts"),
        F.col("block_rank").alias("rank"), F.concat_ws(" ", *pair).alias("pair"))
    a, b = weights.split_expert_factors(
        a_rows.join(good.drop("out_dim"), pair).drop(*pair), b_rows.join(good.drop("out_dim", "rank"), pair).drop(*pair), F.col("experts"))
    delta = weights.lora_delta(a.drop("experts"), b.drop("experts"), good, scaling)
    write_shards(weights.apply_delta(base_rows, delta, dtype=dtype), base, path, dtype=dtype)
    return MergeReport(
        matched, weights.outcomes(matched), weights.unapplied(pairs, base),
        weights.shard_counts(base, matched))
