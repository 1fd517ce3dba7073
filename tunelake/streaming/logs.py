"""Training logs as streams: metrics, phases and sessions while lines arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelake.functions.ordered import BLOCK_ROWS
from tunelake.functions.rows import select_where
from tunelake.operators.trainlog import carried, metric_columns, phases, sessions
from tunelake.sinks.shared import shared_dir
from tunelake.sources.logs import rank_of
from tunelake.streaming.run import run_batches


def stream_log_files(spark: SparkSession, path: str) -> DataFrame:
    """New log text as it lands, with the file it is from and its rank."""
    return spark.readStream.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        rank_of(F.col("_metadata.file_path")).alias("rank"), "value")


def stream_metrics(lines: DataFrame) -> DataFrame:
    """Metric lines of a stream; no state."""
    columns = metric_columns(F.col("value"))
    marked = lines.withColumn("kind", columns.pop("kind"))
    return select_where(
        marked, F.col("kind").isNotNull(), "file", "value", "kind",
        *[c.alias(n) for n, c in columns.items()])


def follow_phases(lines: DataFrame, path: str) -> DataFrame:
    """Phase and session of each line of a stream of (file, line_no, value), with all it holds now.

    A micro-batch is worked on block by block, as in one table, so a file may hold
    most lines; one row per file is carried to the next micro-batch. A file's lines
    must arrive in order across micro-batches; the source's rate limit bounds one.
    """
    def step(batch: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        return sessions(phases(batch, before), before), carried(batch, before)

    return run_batches(lines, path, step, carries=True)


def ready_upto(lines: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (file, upto): the first line number that is missing from ``next_no`` on.

    ``lines`` holds (file, line_no, next_no), each line once and none below next_no.
    Blocks of line numbers are counted, and only the first block that is not full is looked
    into, so a file may hold most lines.
    """
    place = F.col("line_no") - F.col("next_no")
    placed = lines.select("file", "next_no", place.alias("place"), F.floor(place / block_rows).alias("block"))
    along = Window.partitionBy("file").orderBy("block")
    counts = placed.groupBy("file", "next_no", "block").agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(along) - 1)
    full = (F.col("block") == F.col("rank")) & (F.col("n") == block_rows)
    border = counts.groupBy("file", "next_no").agg(F.coalesce(F.min(F.when(~full, F.col("rank"))), F.max("rank") + 1).alias("block"))
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("place")) - 1
    run = (
        placed.join(border.select("file", "block"), ["file", "block"])
        .withColumn("rank", within + F.col("block") * block_rows).filter("place = rank")
        .groupBy("file", "block").agg(F.count("*").alias("run")))
    return border.join(run, ["file", "block"], "left").select(
        "file", (F.col("next_no") + F.col("block") * block_rows + F.coalesce("run", F.lit(0))).alias("upto"))


def follow_phases_late(lines: DataFrame, path: str, *, first_no: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``follow_phases`` for lines that arrive in any order, with all that is settled now.

    Line numbers run from ``first_no`` without a gap in each file. A line is held until
    all before it are there, whichever micro-batch brings them; lines seen again
    are passed over. Held lines and one row per file are carried on; those of the last
    micro-batch are what :func:`held_lines` reads.
    """
    kept = [f.name for f in lines.schema.fields]
    kinds = {f.name: f.dataType for f in lines.schema.fields}

    def step(batch: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        state = None if before is None else before.filter("line_no is null").select("file", "event", "sessions", "next_no")
        waiting = batch if before is None else batch.unionByName(before.filter("line_no is not null").select(*kept))
        once = waiting.dropDuplicates(["file", "line_no"])
        if state is not None:
            once = once.join(state.select("file", "next_no"), "file", "left")
        else:
            once = once.withColumn("next_no", F.lit(None).cast("long"))
        due = once.withColumn("next_no", F.coalesce("next_no", F.lit(first_no).cast("long"))).filter("line_no >= next_no").checkpoint()
        due = due.join(ready_upto(due.select("file", "line_no", "next_no"), block_rows), "file")
        ready = due.filter("line_no < upto").select(*kept)
        held = due.filter("line_no >= upto").select(*kept)
        rows = sessions(phases(ready, state, block_rows=block_rows), state, block_rows=block_rows)
        reached = due.groupBy("file").agg(F.max("upto").alias("upto"))
        after = carried(ready, state).join(reached, "file", "full")
        if state is not None:
            after = after.join(state.select("file", "next_no"), "file", "left")
        else:
            after = after.withColumn("next_no", F.lit(None).cast("long"))
        after = after.select("file", "event", F.coalesce("sessions", F.lit(0).cast("long")).alias("sessions"), F.coalesce("upto", "next_no").alias("next_no"))
        carry = after.withColumns({c: F.lit(None).cast(kinds[c]) for c in kept if c != "file"}).unionByName(
            held.withColumns({"event": F.lit(None).cast("int"), "sessions": F.lit(None).cast("long"), "next_no": F.lit(None).cast("long")}))
        return rows, carry

    shared_dir(lines.sparkSession)
    return run_batches(lines, path, step, carries=True)


def held_lines(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """Lines that still waited for one before them after micro-batch number ``batch``."""
    return spark.read.parquet(f"{path}/carry/{batch}").filter("line_no is not null").drop("event", "sessions", "next_no")
