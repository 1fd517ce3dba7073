"""Ordered per-key computations that survive one key holding most rows.

A plain ``Window.partitionBy(key).orderBy(order)`` sorts a whole key in one
task. Here the key is cut into blocks of ``block_rows`` consecutive order
values. Each block is worked on alone, one summary row per block is carried
forward along the key, and the carry is joined back on (key, block). The only
window over a whole key sees one row per block.

``order`` must be an integer column, unique per key and not null; keys must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536
_BLK, _TOTAL, _CARRY = "__block", "__total", "__carry"


def _tag(df: DataFrame, order: str, block_rows: int) -> DataFrame:
    return df.withColumn(_BLK, F.floor(F.col(order) / F.lit(block_rows)))


def _along_blocks(keys: Sequence[str]):
    return (
        Window.partitionBy(*keys).orderBy(_BLK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    out: str,
    *,
    inclusive: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running integer sum of ``value`` along ``order`` within ``keys``."""
    tagged = _tag(df.withColumn(_TOTAL, value.cast("bigint")), order, block_rows)
    carry = (
        tagged.groupBy(*keys, _BLK).agg(F.sum(_TOTAL).alias(_TOTAL))
        .withColumn(_CARRY, F.coalesce(F.sum(_TOTAL).over(_along_blocks(keys)), F.lit(0)))
        .drop(_TOTAL)
    )
    local = (
        Window.partitionBy(*keys, _BLK).orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        tagged.join(carry, [*keys, _BLK])
        .withColumn(out, F.coalesce(F.sum(_TOTAL).over(local), F.lit(0)) + F.col(_CARRY))
        .drop(_BLK, _TOTAL, _CARRY)
    )


def last_before(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    out: str,
    *,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Latest non-null ``value`` on a row strictly before this one, per key."""
    tagged = _tag(df.withColumn(_TOTAL, value), order, block_rows)
    carry = (
        tagged.groupBy(*keys, _BLK)
        .agg(F.max_by(_TOTAL, F.when(F.col(_TOTAL).isNotNull(), F.col(order))).alias(_TOTAL))
        .withColumn(_CARRY, F.last(_TOTAL, ignorenulls=True).over(_along_blocks(keys)))
        .drop(_TOTAL)
    )
    local = (
        Window.partitionBy(*keys, _BLK).orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        tagged.join(carry, [*keys, _BLK])
        .withColumn(
            out,
            F.coalesce(F.last(_TOTAL, ignorenulls=True).over(local), F.col(_CARRY)),
        )
        .drop(_BLK, _TOTAL, _CARRY)
    )
