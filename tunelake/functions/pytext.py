"""Column expressions that follow Python's text rules, all JVM-side.

Python's ``str.strip``/``str.split`` treat more code points as white space than
Java's ``\\s`` does, so every helper names the full set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points for which Python's str.isspace() is true.
SPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
)
SPACE_CHARS = "".join(chr(c) for lo, hi in SPACE_RANGES for c in range(lo, hi + 1))
SPACE_CLASS = "[" + "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in SPACE_RANGES) + "]"

# The separators of str.splitlines(), CRLF first so it counts once.
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def squeeze(c: Column) -> Column:
    """``" ".join(s.split())``."""
    return strip(F.regexp_replace(c, SPACE_CLASS + "+", " "))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def truthy(c: Column) -> Column:
    """Non-null and non-empty; white space alone counts as present."""
    return F.coalesce(c != "", F.lit(False))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, null (not '') when there is none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def splitlines(c: Column) -> Column:
    """``str.splitlines()``: a final line break opens no empty last line."""
    parts = F.split(c, LINE_BREAK)
    ends_open = F.element_at(parts, -1) == ""
    return F.when(ends_open, F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def micro(c: Column) -> Column:
    """Fixed-point millionths, so sums do not depend on the order of rows."""
    return F.round(c * 1_000_000).cast("bigint")


def mean_of(c: Column) -> Column:
    """Mean through fixed-point millionths; null on no rows, nulls left out."""
    return F.sum(micro(c)) / (F.count(c) * F.lit(1e6))
