"""Choosing rows by an expensive expression without evaluating it twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_where(df: DataFrame, keep: Column, *columns: str | Column) -> DataFrame:
    """``filter(keep).select(columns)`` as one generator.

    A filter is pushed below the projections it reads, and then parses or
    matches the text again for every mention of a column. A generator stays
    where it is, so each expensive column is computed once per row.
    """
    return df.select(F.inline(F.when(keep, F.array(F.struct(*columns)))))
