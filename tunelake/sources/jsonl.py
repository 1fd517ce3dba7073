"""Tolerant reading of JSON lines, without schema inference.

Inference unions columns whose shape differs between rows and turns mixed
values into text; here each line is parsed on its own to VARIANT and only the
fields that training uses are taken out.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelake.functions.codetext import extract_code
from tunelake.functions.ordered import BLOCK_ROWS, running_sum
from tunelake.functions.pytext import is_blank, strip, text_or_empty
from tunelake.functions.rows import select_where

# The top-level fields a training example may carry.
TRAINING_FIELDS = (
    "conversations", "messages", "tools", "system", "question", "answer", "context",
    "instruction", "input", "output",
)
TEXT_FIELDS = ("system", "question", "answer", "context", "instruction", "input", "output")

CONVERSATIONS = "array<struct<from string, value string, role string, content string>>"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as (file, block, pos, value).

    ``pos`` only orders the lines of one block; :func:`number_lines` turns it
    into line numbers for the few rows that need them, which spares a shuffle
    of all the text.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def number_lines(wanted: DataFrame, lines: DataFrame) -> DataFrame:
    """Add ``line_no`` (from 1, blank lines counted) to some rows of ``lines``."""
    earlier = (
        Window.partitionBy("file").orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        lines.groupBy("file", "block")
        .agg(F.min("pos").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .drop("__n")
    )
    return (
        wanted.join(blocks, ["file", "block"])
        .withColumn("line_no", F.col("pos") - F.col("__first") + 1 + F.col("__before"))
        .drop("__first", "__before")
    )


def _has(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant").isNotNull()


def classify_lines(lines: DataFrame) -> DataFrame:
    """Add ``v``, the parsed line, and ``status``: blank, bad_json, not_object,
    unrecognized or ok. A key holding JSON null still counts as present."""
    parsed = lines.withColumn("v", F.try_parse_json(strip(F.col("value"))))
    v = F.col("v")
    known = _has(v, TRAINING_FIELDS[0])
    for key in TRAINING_FIELDS[1:]:
        known = known | _has(v, key)
    return parsed.withColumn(
        "status",
        F.when(is_blank(F.col("value")), "blank")
        .when(v.isNull(), "bad_json")
        .when(~F.schema_of_variant(v).startswith("OBJECT"), "not_object")
        .when(known, "ok").otherwise("unrecognized"),
    )


def _fields(v: Column) -> list[Column]:
    """The whitelisted fields of a parsed line; JSON null becomes null."""
    tools = F.try_variant_get(v, "$.tools", "variant")
    return [
        F.try_variant_get(v, "$.conversations", CONVERSATIONS).alias("conversations"),
        F.try_variant_get(v, "$.messages", "array<variant>").alias("messages"),
        F.when(~F.is_variant_null(tools), tools).alias("tools"),
        *[F.try_variant_get(v, f"$.{k}", "string").alias(k) for k in TEXT_FIELDS],
    ]


def training_fields(classified: DataFrame, *carry: str) -> DataFrame:
    """Accepted lines with the whitelisted fields only; JSON null becomes null."""
    return select_where(classified, F.col("status") == "ok", *carry, *_fields(F.col("v")))


def _unknown_keys() -> Column:
    return F.when(F.col("status") == "unrecognized", F.array_sort(F.json_object_keys(strip(F.col("value")))))


def written_lines(classified: DataFrame, *carry: str) -> DataFrame:
    """Every line that is not blank, with its fields, ``status`` and ``keys``, so that
    what is refused stays in sight; a refused line's fields are null."""
    return select_where(
        classified, F.col("status") != "blank", *carry, "status", _unknown_keys().alias("keys"),
        *_fields(F.when(F.col("status") == "ok", F.col("v"))))


def rejected_lines(classified: DataFrame, *carry: str) -> DataFrame:
    """Lines that a strict loader would refuse, with the reason and the sorted
    top-level keys of objects holding no known field. Blank lines are no errors."""
    return select_where(
        classified, ~F.col("status").isin("ok", "blank"),
        *carry,
        F.col("status").alias("reason"),
        _unknown_keys().alias("keys"),
    )


class Loaded(NamedTuple):
    """What a source holds: accepted rows, and the refused with their reasons, none where a table is read."""

    accepted: DataFrame
    rejected: DataFrame | None


def load_training_table(spark: SparkSession, path_or_name: str, *, strict: bool = False) -> Loaded:
    """Training fields of a JSON-lines path, a parquet path or a named table.

    Refused lines come with their file and place. ``strict`` fails the job at the
    first of them instead.
    """
    if path_or_name.endswith((".jsonl", ".json")):
        classified = classify_lines(read_lines(spark, path_or_name))
        if strict:
            refuse = F.raise_error(F.concat(
                F.lit("line refused: "), F.col("status"), F.lit(": "), F.left("value", F.lit(200))))
            classified = classified.withColumn(
                "status",
                F.when(F.col("status").isin("ok", "blank"), F.col("status"))
                .otherwise(refuse.cast("string")))
        return Loaded(training_fields(classified), rejected_lines(classified, "file", "block", "pos", "value"))
    if path_or_name.endswith(".parquet"):
        return Loaded(spark.read.parquet(path_or_name), None)
    return Loaded(spark.table(path_or_name), None)


def eval_window(
    lines: DataFrame, *, order: str = "line_no", limit: int = 0, start_from: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the non-blank lines from 0 and keep ``start_from <= idx < limit``.

    ``limit`` of 0 means no limit. Lines are counted per block of line numbers, and
    the blocks' running sum is taken over blocks of blocks. Only the range of ``order``
    that reaches into the window leaves the scan: its bounds are compared with the
    column itself, so that a file's statistics can rule it out.
    """
    block, before = "__at", "__before"
    filled = lines.filter(~is_blank(F.col("value")))
    at = F.floor(F.col(order) / F.lit(block_rows)).alias(block)
    counts = filled.groupBy(at).agg(F.count(F.lit(1)).alias("__n"))
    blocks = running_sum(counts, [], block, F.col("__n"), before, inclusive=False)
    reached = F.col(before) + F.col("__n") > start_from
    inside = F.col("idx") >= start_from
    if limit > 0:
        reached = reached & (F.col(before) < limit)
        inside = inside & (F.col("idx") < limit)
    in_block = F.row_number().over(Window.partitionBy(block).orderBy(order))
    within = blocks.filter(reached).drop("__n")
    low = within.agg(F.min(block) * block_rows).scalar()
    high = within.agg((F.max(block) + 1) * block_rows).scalar()
    return (
        filled.filter((F.col(order) >= low) & (F.col(order) < high)).select("*", at).join(within, block)
        .withColumn("idx", F.col(before) + in_block - 1)
        .filter(inside).drop(block, before)
    )


def sharegpt_eval_rows(classified: DataFrame, *carry: str) -> DataFrame:
    """System, human and answer text of ShareGPT lines plus the answer's code."""
    turns = F.try_variant_get(F.col("v"), "$.conversations", CONVERSATIONS)

    def first(role: str) -> Column:
        turn = F.try_element_at(
            F.filter("__turns", lambda t: t["from"] == role), F.lit(1))
        return text_or_empty(turn["value"])

    rows = select_where(
        classified.withColumn("__turns", turns),
        F.exists("__turns", lambda t: t["from"].isNotNull()),
        *carry,
        first("system").alias("system"),
        first("human").alias("human"),
        first("gpt").alias("gpt_full"),
    )
    return rows.withColumn(
        "reference_code", text_or_empty(extract_code(F.col("gpt_full"))["code"]))
