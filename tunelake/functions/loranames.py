"""Names of adapter and base tensors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# How adapter keys and base parameters are named.
ADAPTER_PREFIX = "base_model.model."
FACTOR_SUFFIX = r"\.lora_(A|B)\.weight\z"
EXPERT_INFIX = ".base_layer"
LAYERS, WRAPPED_LAYERS = "model.layers.", "model.language_model.layers."
EXPERTS = ".mlp.experts"
FUSED = {"base_layer": ".gate_up_proj", "bare": ".down_proj"}
ATTENTION = ("q_proj", "k_proj", "v_proj", "o_proj")
FROZEN_PARTS = (".gate.weight", "router", "mtp.")


def parse_adapter_key(key: Column) -> Column:
    """Struct (root, slot, factor); null for a key that is no low-rank factor.

    Slot ``base_layer`` marks the first of two fused expert tensors under one root.
    """
    bare = F.regexp_replace(key, r"\A" + ADAPTER_PREFIX.replace(".", r"\."), "")
    root = F.regexp_replace(bare, FACTOR_SUFFIX, "")
    inner = root.endswith(EXPERT_INFIX)
    clean = F.when(inner, F.left(root, F.length(root) - len(EXPERT_INFIX))).otherwise(root)
    return F.when(key.rlike(FACTOR_SUFFIX), F.struct(
        clean.alias("root"),
        F.when(inner, "base_layer").otherwise("bare").alias("slot"),
        F.regexp_extract(key, FACTOR_SUFFIX, 1).alias("factor")))


def resolve_target(root: Column, slot: Column) -> Column:
    """Base parameter that an adapter root and slot change."""
    base = F.when(
        root.startswith(LAYERS),
        F.concat(F.lit(WRAPPED_LAYERS), F.substring(root, len(LAYERS) + 1, 2**31 - 1)),
    ).otherwise(root)
    fused = F.when(slot == "base_layer", FUSED["base_layer"]).otherwise(FUSED["bare"])
    return F.concat(base, F.when(base.endswith(EXPERTS), fused).otherwise(".weight"))


def is_trainable(
    name: Column,
    modules: Sequence[str] = ATTENTION,
    parameters: Sequence[str] = (),
    frozen: Sequence[str] = FROZEN_PARTS,
) -> Column:
    """Whether a tensor belongs to a targeted module or fused parameter, and is
    in none of the parts kept frozen."""
    hit = name.rlike(r"(\A|\.)(" + "|".join(modules) + r")(\.weight)?\z")
    for p in parameters:
        hit = hit | name.endswith(p)
    for part in frozen:
        hit = hit & ~name.contains(part)
    return hit


def nested_name(name: Column) -> Column:
    """The name with ``.linear`` put before every weight and bias."""
    return F.replace(
        F.replace(name, F.lit(".weight"), F.lit(".linear.weight")),
        F.lit(".bias"), F.lit(".linear.bias"))
