"""Finding code and the names it calls inside a model's answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunelake.functions.pytext import first_match, strip, text_or_empty

# The patterns that find fenced code and called names.
PYTHON_FENCE = r"(?isU)```python\s*\n(.*?)\n```"
ANY_FENCE = r"(?sU)```(?:\w+)?\s*\n(.*?)\n```"
LOOSE_FENCE = r"(?sU)```(?:python)?\s*\n(.*?)```"
CALLED_NAME = r"(?U)\b([A-Z][a-zA-Z0-9_]*)\s*\("

# Words that mark unfenced text as code.
CODE_HINTS = ("build123d", "BuildPart", "root_part")


def extract_code(text: Column) -> Column:
    """Struct (code, has_python): a python fence, else any fence, else null."""
    t = text_or_empty(text)
    py = first_match(t, PYTHON_FENCE)
    return F.struct(
        F.coalesce(py, first_match(t, ANY_FENCE)).alias("code"),
        t.rlike(PYTHON_FENCE).alias("has_python"),
    )


def extract_code_block(text: Column) -> Column:
    """First python or bare fence; else the whole text if it looks like code; else ''.

    The fence may close on the code's own last line. A closing fence followed by
    a newline can itself open a match, so prose between two blocks may be taken.
    """
    t = text_or_empty(text)
    looks_like_code = F.lit(False)
    for hint in CODE_HINTS:
        looks_like_code = looks_like_code | t.contains(hint)
    return F.coalesce(
        first_match(t, LOOSE_FENCE), F.when(looks_like_code, t), F.lit(""))


def has_code(code: Column) -> Column:
    return strip(text_or_empty(code)) != ""


def called_names(code: Column) -> Column:
    """Distinct capitalised names that the code calls, sorted; [] for null."""
    return F.array_sort(F.array_distinct(
        F.regexp_extract_all(text_or_empty(code), F.lit(CALLED_NAME), F.lit(1))))


def length_sanity(generated: Column, reference: Column) -> Column:
    """Generated length between half and twice the reference's; false when that is empty."""
    gen, ref = F.length(text_or_empty(generated)), F.length(text_or_empty(reference))
    return F.when(ref == 0, False).otherwise((gen / ref).between(0.5, 2.0))
