"""Metrics, eval phases and sessions from training-log lines.

Lines are (file, line_no, value). Line numbers are per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions.ordered import BLOCK_ROWS, last_before, running_sum
from tunelake.functions.pytext import first_match
from tunelake.functions.rows import select_where

# The line formats of the training log.
TRAIN_LINE = r"^\[TRAIN\] step=(\d+)/(\S+) loss=(\S+) lr=(\S+)"
EVAL_LINE = r"^\[EVAL\] eval_loss=(\S+)"
EVAL_MARKER = "[EVAL] Running evaluation..."
SESSION_LINE = r"^=== Rank (\d+): logging session started \((.*)\) ===$"


def metric_columns(value: Column) -> dict[str, Column]:
    """Metrics of one line; '?' for an unknown number becomes null."""
    def train(group: int, kind: str) -> Column:
        return first_match(value, TRAIN_LINE, group).try_cast(kind)

    return {
        "kind": F.when(value.rlike(TRAIN_LINE), "train").when(value.rlike(EVAL_LINE), "eval"),
        "step": train(1, "bigint"),
        "max_steps": train(2, "bigint"),
        "loss": train(3, "double"),
        "lr": train(4, "double"),
        "eval_loss": first_match(value, EVAL_LINE).try_cast("double"),
    }


def metrics(lines: DataFrame) -> DataFrame:
    """One row per metric line; works the same on a stream."""
    columns = metric_columns(F.col("value"))
    marked = lines.withColumn("kind", columns.pop("kind"))
    return select_where(
        marked, F.col("kind").isNotNull(), "file", "line_no", "kind",
        *[c.alias(n) for n, c in columns.items()])


def phase_event(value: Column) -> Column:
    """1 where an eval cycle may start, 0 where one ends, null elsewhere.

    The eval loss closes a cycle; a new session starts with none running.
    """
    return (
        F.when(value.startswith(EVAL_MARKER), 1)
        .when(value.rlike(EVAL_LINE) | value.rlike(SESSION_LINE), 0)
    )


def phases(lines: DataFrame, before: DataFrame | None = None, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``phase`` of each line and ``phase_start`` on the first marker of a cycle.

    Further markers inside a running cycle start nothing. The line with the eval
    loss still belongs to its cycle. ``before`` holds (file, event, sessions) of the
    lines that went before these, as :func:`carried` gives them.
    """
    event = phase_event(F.col("value"))
    running = F.col("__before") == 1
    known = last_before(lines, ["file"], "line_no", event, "__before", block_rows=block_rows)
    if before is not None:
        known = known.join(before.select("file", "event"), "file", "left").withColumn("__before", F.coalesce("__before", "event")).drop("event")
    return (
        known.withColumn("__before", F.coalesce("__before", F.lit(0)))
        .withColumn("phase_start", F.coalesce((event == 1) & ~running, F.lit(False)))
        .withColumn("phase", F.when(
            F.col("phase_start") | (running & ~F.col("value").rlike(SESSION_LINE)), "eval"
        ).otherwise("train"))
        .drop("__before")
    )


def sessions(lines: DataFrame, before: DataFrame | None = None, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``session``: how many session headers the file has had by this line."""
    header = F.when(F.col("value").rlike(SESSION_LINE), 1).otherwise(0)
    out = running_sum(lines, ["file"], "line_no", header, "session", block_rows=block_rows)
    if before is None:
        return out
    earlier = F.coalesce("sessions", F.lit(0))
    return out.join(before.select("file", "sessions"), "file", "left").withColumn("session", F.col("session") + earlier).drop("sessions")


def carried(lines: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(file, event, sessions) after these lines: the last phase event and the headers so far."""
    event = phase_event(F.col("value"))
    now = lines.groupBy("file").agg(
        F.max_by(event, F.when(event.isNotNull(), F.col("line_no"))).alias("event"),
        F.count_if(F.col("value").rlike(SESSION_LINE)).alias("sessions"))
    if before is None:
        return now
    old = before.select("file", F.col("event").alias("__event"), F.col("sessions").alias("__sessions"))
    return now.join(old, "file", "full").select(
        "file", F.coalesce("event", "__event").alias("event"),
        (F.coalesce("sessions", F.lit(0)) + F.coalesce("__sessions", F.lit(0))).alias("sessions"))
