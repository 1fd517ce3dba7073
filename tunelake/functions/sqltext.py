"""Normalizing SQL text out of a model's answer, with native expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.functions.pytext import first_match, squeeze, strip, text_or_empty

# What ends a bare SELECT, and template tokens cut in this order.
TERMINATORS = (";", "```", "\n`", "\n\nNote", "\n\nThis ", "\n\nExplanation")
ARTIFACTS = ("<end_of_turn>", "<start_of_turn>", "<|im_end|>", "<|im_start|>")
ARTIFACT_WORDS = ("model", "user")

# The patterns that find fenced SQL and the last SELECT.
FENCED = r"(?isU)```(?:sql)?\s*\n?(.*?)```"
LAST_SELECT = r"(?isU)\A.*(\bSELECT\b.*)\z"


def with_normal_sql(
    df: DataFrame, column: str, out: str, *, compat: bool = True
) -> DataFrame:
    """Add ``out``, the comparable form of the SQL inside an answer; null gives ''.

    A closed code fence wins; otherwise the text from the last SELECT up to its
    first terminator; otherwise the whole text. ``compat`` also cuts at the bare
    words "model" and "user", which shortens SQL naming such columns; turn it
    off to cut at template tokens only.

    Each step is a column of its own, so a regex runs once per row and not once
    per mention of its result.
    """
    text, fenced, tail, cut, body = (f"__{out}_{s}" for s in ("text", "fenced", "tail", "cut", "body"))
    offsets = [F.locate(t, F.col(tail)) - 1 for t in TERMINATORS]
    until = F.when(F.col(cut).isNull(), F.col(tail)).otherwise(F.left(tail, F.col(cut)))
    tags = ARTIFACTS + (ARTIFACT_WORDS if compat else ())
    kept = reduce(lambda c, tag: F.substring_index(c, tag, 1), tags, F.col(body))
    tidy = strip(F.rtrim(F.rtrim(strip(kept), F.lit(";")), F.lit("`")))
    return (
        df.withColumn(text, strip(text_or_empty(F.col(column))))
        .withColumn(fenced, first_match(F.col(text), FENCED))
        .withColumn(tail, F.when(
            F.col(fenced).isNull(), first_match(F.col(text), LAST_SELECT)))
        # A terminator at the very start of the tail does not count.
        .withColumn(cut, F.least(*[F.when(o > 0, o) for o in offsets]))
        .withColumn(body, F.coalesce(
            strip(F.col(fenced)), strip(F.ltrim(strip(until), F.lit("`"))), F.col(text)))
        .withColumn(out, squeeze(F.lower(F.replace(tidy, F.lit("'"), F.lit('"')))))
        .drop(text, fenced, tail, cut, body)
    )
