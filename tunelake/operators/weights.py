"""Joining adapter tensors to base tensors, by name and by value.

Values are rows of matrices: (name, expert, row, values array<double>), expert
0 for a plain matrix. Products work on tiles, a bounded number of rows by a
bounded number of columns, so one large tensor is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions.loranames import is_trainable, nested_name, parse_adapter_key, resolve_target

ROW_BLOCK = 1_024
COL_BLOCK = 1_024


def adapter_factors(keys: DataFrame) -> DataFrame:
    """Adapter keys that are low-rank factors, with root, slot, factor and target."""
    parsed = keys.withColumn("p", parse_adapter_key(F.col("key"))).filter(F.col("p").isNotNull())
    return parsed.select("*", "p.*").drop("p").withColumn(
        "target", resolve_target(F.col("root"), F.col("slot")))


def lora_pairs(factors: DataFrame) -> DataFrame:
    """One row per root and slot with both shapes; a missing factor's shape is null."""
    def shape(f: str) -> Column:
        return F.max(F.when(F.col("factor") == f, F.struct("dim0", "dim1")))

    return factors.groupBy("root", "slot", "target").agg(
        shape("A").alias("a"), shape("B").alias("b")
    ).select(
        "root", "slot", "target", F.col("a.dim0").alias("a_rows"), F.col("a.dim1").alias("a_cols"),
        F.col("b.dim0").alias("b_rows"), F.col("b.dim1").alias("b_cols"))


def is_complete() -> Column:
    return F.col("a_rows").isNotNull() & F.col("b_rows").isNotNull()


def shapes_agree(num_experts: int) -> Column:
    """Whether the pair's product has the base tensor's shape.

    A fused tensor [experts, out, in] needs factors [experts*r, in] and
    [out, experts*r] and the expected number of experts.
    """
    experts = F.col("experts")
    outer = (F.col("a_cols") == F.col("in_dim")) & (F.col("b_rows") == F.col("out_dim"))
    inner = F.col("a_rows") == F.col("b_cols")
    fused = (experts == num_experts) & (F.pmod(F.col("a_rows"), experts) == 0)
    return outer & inner & (experts.isNull() | fused)


def match_pairs(
    pairs: DataFrame, base: DataFrame, num_experts: int, *, rank: int | None = None
) -> DataFrame:
    """Every pair with its base tensor and a status: merged, shape_mismatch,
    target_missing or incomplete; plus the rank its shape implies.

    The adapter's own ``rank`` sets the scale, whatever the shape says; given
    here, ``rank_differs`` marks the pairs whose shape disagrees with it.
    """
    tensors = base.select(F.col("name").alias("target"), "shard", "experts", "out_dim", "in_dim").hint("merge")
    status = (
        F.when(~is_complete(), "incomplete")
        .when(F.col("shard").isNull(), "target_missing")
        .when(shapes_agree(num_experts), "merged").otherwise("shape_mismatch")
    )
    matched = pairs.join(tensors, "target", "left").withColumn("status", status).withColumn(
        "block_rank",
        F.when(F.col("status") == "merged",
               (F.col("a_rows") / F.coalesce("experts", F.lit(1))).cast("bigint")))
    if rank is None:
        return matched
    return matched.withColumn("rank_differs", F.col("block_rank") != rank)


def outcomes(matched: DataFrame) -> DataFrame:
    return matched.groupBy("status").agg(F.count(F.lit(1)).alias("pairs"))


def unapplied(pairs: DataFrame, base: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` complete pairs without a base tensor, and how many there are."""
    complete = pairs.filter(is_complete())
    names = base.select(F.col("name").alias("target")).hint("merge")
    missing = complete.join(names, "target", "left_anti")
    total = missing.agg(F.count(F.lit(1)).alias("n")).scalar()
    return missing.orderBy("target", "slot").limit(k).select("target", "root", "slot").withColumn(
        "total", total)


def shard_counts(base: DataFrame, matched: DataFrame) -> DataFrame:
    """Per shard: tensors, and pairs merged into them."""
    merged = matched.filter(F.col("status") == "merged").groupBy("shard").agg(
        F.count(F.lit(1)).alias("pairs_applied"))
    return (
        base.groupBy("shard").agg(F.count(F.lit(1)).alias("tensors"))
        .join(merged, "shard", "left")
        .withColumn("pairs_applied", F.coalesce("pairs_applied", F.lit(0).cast("bigint")))
    )


def trainable_share(
    base: DataFrame, threshold_pct: float, *, modules=None, parameters=()
) -> DataFrame:
    """Trainable and total elements, their percentage, and ok or fail."""
    hit = is_trainable(F.col("name"), *([modules] if modules else []), parameters=parameters)
    numel = (F.col("out_dim") * F.col("in_dim") * F.coalesce("experts", F.lit(1))).cast("bigint")
    return base.agg(
        F.coalesce(F.sum(F.when(hit, numel)), F.lit(0)).alias("trainable"),
        F.sum(numel).alias("total"),
    ).withColumn("pct", F.col("trainable") / F.col("total") * 100).withColumn(
        "verdict", F.when(F.col("pct") < threshold_pct, "fail").otherwise("ok"))


def reconcile_names(saved: DataFrame, base: DataFrame) -> DataFrame:
    """Saved names brought back to the base's: renamed where only the nested form
    exists there, kept otherwise, and every base name still missing copied.

    Names are made from narrower columns, so the planner takes tables of millions of them
    for small enough to broadcast; they are merged instead, which holds a part at a time.
    """
    names = base.select("name").distinct()
    flat = names.select("name", F.lit(True).alias("__flat")).hint("merge")
    nested = names.select(F.col("name").alias("__nested"), F.lit(True).alias("__is_nested")).hint("merge")
    rename = F.col("__flat").isNull() & F.col("__is_nested").isNotNull()
    fixed = (
        saved.select("name").withColumn("__nested", nested_name(F.col("name")))
        .join(flat, "name", "left").join(nested, "__nested", "left")
        .select(
            F.col("name").alias("saved_name"),
            F.when(rename, F.col("__nested")).otherwise(F.col("name")).alias("name"),
            F.when(rename, "renamed").otherwise("kept").alias("action"))
    )
    copied = names.join(fixed.select("name").hint("merge"), "name", "left_anti").select(
        F.lit(None).cast("string").alias("saved_name"), "name", F.lit("copied").alias("action"))
    return fixed.unionByName(copied)


def reconcile_counts(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def sound_pairs(a_rows: DataFrame, b_rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(root, slot) of the pairs whose factor rows are all there, once each and of the stated sizes.

    ``pairs`` holds the shapes a_rows, a_cols, b_rows and b_cols as :func:`lora_pairs` gives them.
    """
    def rows_of(rows: DataFrame, index: str, values: str, f: str) -> DataFrame:
        return rows.groupBy("root", "slot").agg(
            F.count(index).alias(f"{f}_n"), F.count_distinct(index).alias(f"{f}_distinct"), F.min(index).alias(f"{f}_low"),
            F.max(index).alias(f"{f}_high"), F.min(F.size(values)).alias(f"{f}_least"), F.max(F.size(values)).alias(f"{f}_most"))

    def whole(f: str) -> Column:
        n, size = F.col(f"{f}_rows"), F.col(f"{f}_cols")
        return (
            (F.col(f"{f}_n") == n) & (F.col(f"{f}_distinct") == n) & (F.col(f"{f}_low") == 0) & (F.col(f"{f}_high") == n - 1)
            & (F.col(f"{f}_least") == size) & (F.col(f"{f}_most") == size))

    keys = ["root", "slot"]
    return (
        pairs.join(rows_of(a_rows, "k", "values", "a"), keys).join(rows_of(b_rows, "row", "coeffs", "b"), keys)
        .filter(whole("a") & whole("b")).select(*keys))


def split_expert_factors(a_rows: DataFrame, b_rows: DataFrame, num_experts: int | Column) -> tuple[DataFrame, DataFrame]:
    """Cut concatenated expert factors into one pair per expert.

    ``num_experts`` may be a column of both. The rank of a block is the number of
    coefficients of a B row over the number of experts, and a column ``rank`` of A's
    rows; without that it is looked up from B. A row k belongs to expert ``k div rank``.
    """
    experts = num_experts if isinstance(num_experts, Column) else F.lit(num_experts)
    rank = (F.size("coeffs") / experts).cast("int")
    expert = F.col("expert")
    b = b_rows.drop("expert").withColumn(
        "expert", F.explode(F.sequence(F.lit(0), experts - 1))
    ).withColumn("coeffs", F.slice("coeffs", expert * rank + 1, rank))
    if "rank" not in a_rows.columns:
        ranks = b_rows.groupBy("name").agg(F.max(rank).alias("rank"))
        a_rows = a_rows.join(ranks, "name")
    a = a_rows.withColumn("expert", F.floor(F.col("k") / F.col("rank")).cast("int")).withColumn(
        "k", F.col("k") % F.col("rank")).drop("rank")
    return a, b


def _row_block(row: str = "row") -> Column:
    return F.floor(F.col(row) / F.lit(ROW_BLOCK))


def column_tiles(rows: DataFrame, col_block: int = COL_BLOCK) -> DataFrame:
    """Cut each row's values into runs of ``col_block`` columns."""
    blocks = F.sequence(F.lit(0), F.floor((F.size("values") - 1) / F.lit(col_block)).cast("int"))
    return rows.withColumn("col_block", F.explode(blocks)).withColumn(
        "values", F.slice("values", F.col("col_block") * col_block + 1, F.lit(col_block)))


def _product(scaling: float) -> Callable[[Column, Column], Column]:
    @F.pandas_udf("array<array<double>>")
    def product(coeffs: pd.Series, tile: pd.Series) -> pd.Series:
        return pd.Series([
            list(np.array(b.tolist(), float) @ np.array(t.tolist(), float) * scaling)
            for b, t in zip(coeffs, tile, strict=True)])

    return product


def lora_delta(
    a_rows: DataFrame, b_rows: DataFrame, shapes: DataFrame, scaling: float,
    *, col_block: int = COL_BLOCK,
) -> DataFrame:
    """``B @ A * scaling`` in tiles (name, expert, row, col_block, values).

    ``a_rows``: (name, expert, k, values), ``b_rows``: (name, expert, row,
    coeffs), ``shapes``: (name, out_dim) with out_dim above every row number. Both
    may have a column ``pair``: pairs of one tensor are laid side by side, which
    adds their products. Rows of A that B does not count on fail the job.

    A's column tile, rank by at most ``col_block`` values, is sent once to each
    block of rows, about rank/1024 of the output's size. All rows of a block
    meet it there as one matrix; nothing is summed across rows, so nothing is
    shuffled after.
    """
    if "pair" not in a_rows.columns:
        a_rows, b_rows = a_rows.withColumn("pair", F.lit("")), b_rows.withColumn("pair", F.lit(""))
    tile = F.array_sort(F.collect_list(F.struct("pair", "k", "values")))
    last_block = F.floor((F.col("out_dim") - 1) / F.lit(ROW_BLOCK))
    a_tiles = (
        column_tiles(a_rows, col_block).groupBy("name", "expert", "col_block").agg(tile.alias("t"))
        .select("name", "expert", "col_block", F.transform("t", lambda s: s["values"]).alias("tile"),
                F.transform("t", lambda s: s["pair"]).alias("tile_pairs"))
        .join(shapes.select("name", "out_dim").distinct(), "name")
        .withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
        .drop("out_dim")
    )
    beside = F.array_sort(F.collect_list(F.struct("pair", "coeffs")))
    b_tiles = (
        b_rows.groupBy("name", "expert", "row").agg(beside.alias("p"))
        .select("name", "expert", "row", _row_block().alias("row_block"), F.flatten(F.transform("p", lambda s: s["coeffs"])).alias("coeffs"),
                F.flatten(F.transform("p", lambda s: F.array_repeat(s["pair"], F.size(s["coeffs"])))).alias("pairs"))
        .groupBy("name", "expert", "row_block", "pairs").agg(F.collect_list("row").alias("rows"), F.collect_list("coeffs").alias("coeffs")))
    checked = F.when(F.col("pairs") == F.col("tile_pairs"), F.col("tile")).otherwise(
        F.raise_error(F.concat(F.lit("factors of unequal rank for "), F.col("name"))).cast("array<array<double>>"))
    blocks = b_tiles.join(a_tiles, ["name", "expert", "row_block"]).select(
        "name", "expert", "col_block", "rows", _product(float(scaling))("coeffs", checked).alias("v"))
    return blocks.select("name", "expert", "col_block", F.inline(F.arrays_zip(F.col("rows").alias("row"), F.col("v").alias("values")))).select(
        "name", "expert", "row", "col_block", "values")


def apply_delta(
    base_rows: DataFrame, delta: DataFrame, *, dtype: str = "float", col_block: int = COL_BLOCK
) -> DataFrame:
    """Base plus delta in double precision, then cast; other tensors pass through."""
    keys = ["name", "expert", "row", "col_block"]
    joined = column_tiles(base_rows, col_block).join(
        delta.select(*keys, F.col("values").alias("__d")), keys, "left")
    summed = F.when(F.col("__d").isNull(), F.col("values")).otherwise(
        F.zip_with("values", "__d", lambda v, d: v + d))
    return joined.withColumn("values", summed.cast(f"array<{dtype}>")).drop("__d")


def delta_norm(delta: DataFrame) -> DataFrame:
    """Frobenius norm per tensor."""
    squares = F.aggregate("values", F.lit(0.0), lambda s, v: s + v * v)
    return delta.groupBy("name").agg(F.sqrt(F.sum(squares)).alias("norm"))


def tile_values(tiles: DataFrame, col_block: int = COL_BLOCK, carry: Sequence[str] = ()) -> DataFrame:
    """One row per value: (name, expert, row, col, value), after the columns ``carry``."""
    return tiles.select(
        *carry, "name", "expert", "row", "col_block", F.posexplode("values").alias("at", "value")
    ).select(
        *carry, "name", "expert", "row",
        (F.col("col_block") * col_block + F.col("at")).cast("bigint").alias("col"), "value")
