"""Stable keys: the same value for the same row on any cluster layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(id_col: str | Column, seed: int | str = 42) -> Column:
    """Pseudo-random sort key of an id; ties only between equal ids."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed))))


def hash_int(text: Column) -> Column:
    """Non-negative integer below 2**32 from the leading bits of an md5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def bucket_of(id_col: str | Column, num_buckets: Column | int) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    n = num_buckets if isinstance(num_buckets, Column) else F.lit(num_buckets)
    return F.pmod(hash_int(F.coalesce(c.cast("string"), F.lit(""))), n.cast("bigint"))
