"""Training-log files, one per rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.sources.jsonl import number_lines, read_lines


def rank_of(file: Column) -> Column:
    """Rank from a log file's name; the first rank's log carries no number."""
    found = F.regexp_extract(file, r"train-rank(\d+)\.log", 1)
    return F.when(found == "", 0).otherwise(found.cast("int"))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files as (file, rank, line_no, value)."""
    lines = read_lines(spark, path)
    return number_lines(lines, lines).select(
        "file", rank_of(F.col("file")).alias("rank"), "line_no", "value")
