"""Numbers along a total order of all rows, without sorting them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.sinks.shared import shared_dir

_AT = "__at"
_PLACE_BITS = 33  # of monotonically_increasing_id, for the place within a partition


def row_numbers(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Add ``out``, the number of each row from 1 on along ``order``, as a long.

    The rows are sorted over range partitions and written to a reliable checkpoint
    with their partition and place; a partition's offset is the number of rows in those
    before it, one row per partition. Rows that are equal in ``order`` lie in one
    partition, so it should tell rows apart; which of equal rows comes first is open.
    """
    shared_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn(_AT, F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright(_AT, _PLACE_BITS)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
        .select("part", F.coalesce(before, F.lit(0)).alias("__offset")))
    numbered = placed.withColumn("__part", part).join(
        offsets.withColumnRenamed("part", "__part"), "__part")
    place = F.col(_AT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return numbered.withColumn(out, F.col("__offset") + place + 1).drop(_AT, "__part", "__offset")
