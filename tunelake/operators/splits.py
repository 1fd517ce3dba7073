"""Seeded train/eval splits that depend on ids only.

The order of examples is ``(md5(id:seed), id)``. A holdout is the head of that
order, so it is the same under any partitioning, and a smaller fraction's
holdout lies inside a larger one's. Ids must not be null; counts are exact when
they are unique.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.functions.hashing import hash_int, order_key

# Hash prefixes of four hex digits: at most 65,536 bins, whatever the row count.
_PREFIX = 4


def ceil_count(fraction: float) -> Callable[[Column], Column]:
    """Rows held out of n: n times the fraction, rounded up."""
    return lambda n: F.ceil(n * F.lit(float(fraction)))


def floor_count_min1(fraction: float) -> Callable[[Column], Column]:
    """Rows held out of n: n times the fraction, rounded down, at least one."""
    return lambda n: F.greatest(F.lit(1), F.floor(n * F.lit(float(fraction))))


def _cut_at_rank(df: DataFrame, id_col: str, seed, count: Callable[[Column], Column]) -> DataFrame:
    """One row: the last (hash, id) inside the holdout, null for an empty one.

    Counting by hash prefix finds the prefix that the cut falls into; only that
    prefix's ids, one in 65,536, are ranked. Rows sharing an id count first, so
    they are never sorted and stay on one side.
    """
    keyed = df.select(order_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    prefix = F.substring("h", 1, _PREFIX)
    counts = keyed.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("c"))
    everything = Window.partitionBy(F.lit(0))
    cut_bin = (
        counts.select(
            "p", "c",
            F.sum("c").over(everything.orderBy("p")).alias("upto"),
            count(F.sum("c").over(everything)).alias("n"))
        .filter((F.col("upto") - F.col("c") < F.col("n")) & (F.col("n") <= F.col("upto")))
        .select("p", (F.col("n") - F.col("upto") + F.col("c")).alias("need"))
    )
    in_bin = keyed.withColumn("p", prefix).join(F.broadcast(cut_bin), "p")  # one row at most
    reached = (
        in_bin.groupBy("h", "id", "need").agg(F.count(F.lit(1)).alias("c"))
        .withColumn("upto", F.sum("c").over(everything.orderBy("h", "id")))
        .filter(F.col("upto") >= F.col("need"))
    )
    return reached.agg(F.min(F.struct("h", "id")).alias("cut"))


def split_exact(
    df: DataFrame,
    id_col: str,
    *,
    fraction: float = 0.1,
    seed: int = 42,
    count: Callable[[Column], Column] | None = None,
    out: str = "split",
) -> DataFrame:
    """Add ``out``: 'eval' for exactly the counted number of rows, else 'train'.

    No eval rows for a fraction of 0 or less. The cut is one scalar, so the
    split itself is a comparison on each row with no shuffle.
    """
    if fraction <= 0 and count is None:
        return df.withColumn(out, F.lit("train"))
    cut = _cut_at_rank(df, id_col, seed, count or ceil_count(fraction))
    place = F.struct(order_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    return df.withColumn(out, F.when(place <= cut.scalar(), "eval").otherwise("train"))


def split_by_threshold(
    df: DataFrame, id_col: str, *, fraction: float = 0.1, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Add ``out`` by a hash threshold: about the fraction, no pass over the data
    first, and usable on a stream."""
    place = hash_int(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    return df.withColumn(
        out, F.when(place < F.lit(int(fraction * 2**32)), "eval").otherwise("train"))


def holdout(df: DataFrame, id_col: str, **kwargs) -> DataFrame:
    return split_exact(df, id_col, **kwargs, out="__split").filter(
        F.col("__split") == "eval").drop("__split")


def head_of_order(df: DataFrame, id_col: str, k: int, *, seed: int | str = 42) -> DataFrame:
    """First ``k`` rows of the seeded order; ``k`` is a report-sized number."""
    return (
        df.withColumn("__h", order_key(id_col, seed)).orderBy("__h", id_col).limit(k).drop("__h"))


def pick_subset(
    df: DataFrame, id_col: str, k: int = 100, *, fraction: float = 0.1, seed: int = 42,
    salt: str = "pick",
) -> DataFrame:
    """``k`` rows of the holdout, chosen by a second order that does not follow the first."""
    return head_of_order(
        holdout(df, id_col, fraction=fraction, seed=seed), id_col, k, seed=f"{seed}:{salt}")
