"""Layered scores of recorded executions, with resume and summaries.

Input rows describe one recorded run: ``idx, side, example_id, query_error,
skipped, code, syntax_ok, timed_out, returncode, stderr``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions.codetext import has_code
from tunelake.functions.exectext import categorize, error_line, parse_result
from tunelake.functions.pytext import truthy

LAYERS = ("L1_syntax_ok", "L2_api_ok", "L3_exec_ok", "L4_step_ok", "L5_invariants_ok")


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def score_layers(runs: DataFrame) -> DataFrame:
    """Add the category, the parsed result and layers 1 to 4.

    Nothing counts after a failed layer 1 or a failed query. Layer 2 fails on
    unknown names only; a timeout or another error still passes it.
    """
    called = ~_true(F.col("skipped")) & ~truthy(F.col("query_error"))
    category = F.col("exec_category")
    ran_ok = category == "ok"
    return (
        runs.withColumn("has_code_block", called & has_code(F.col("code")))
        .withColumn("L1_syntax_ok", F.col("has_code_block") & _true(F.col("syntax_ok")))
        .withColumn("exec_category", F.when(
            F.col("L1_syntax_ok"),
            categorize(F.col("code"), F.col("timed_out"), F.col("returncode"), F.col("stderr"))))
        .withColumn("result", F.when(ran_ok, parse_result(F.col("stderr"))))
        .withColumn("exec_error", F.when(
            category.isin("api_error", "syntax_error", "runtime"), error_line(F.col("stderr"))))
        .withColumn("L2_api_ok", _true(category != "api_error"))
        .withColumn("L3_exec_ok", _true(ran_ok & F.col("result.root_part_ok")))
        .withColumn("L4_step_ok", _true(F.col("result.step_export_ok")))
    )


def _close(got: Column, want: Column, tol: float) -> Column:
    return _true(F.abs(got - want) <= tol * F.greatest(F.abs(want), F.lit(1e-9)))


def compare_invariants(got: Column, want: Column, tol: float = 0.1) -> Column:
    """Struct (volume_ok, faces_ok, bbox_ok, ok) of two structs with ``volume``,
    ``face_count`` and ``bbox``; anything missing on either side fails."""
    def dims(c: Column) -> Column:
        return F.zip_with(c["bbox"][0], c["bbox"][1], lambda lo, hi: hi - lo)

    volume = _close(got["volume"], want["volume"], tol)
    faces = _true(got["face_count"] == want["face_count"])
    bbox = _true(F.forall(
        F.zip_with(dims(got), dims(want), lambda g, w: _close(g, w, tol)), lambda ok: ok))
    return F.struct(
        volume.alias("volume_ok"), faces.alias("faces_ok"), bbox.alias("bbox_ok"),
        (volume & faces & bbox).alias("ok"))


def attach_references(scored: DataFrame, references: DataFrame) -> DataFrame:
    """Add ``reference``, the invariants of the row's example, null when unknown.

    ``references`` has one row per ``example_id``. Many runs may share one example or
    have none; adaptive execution sends a small lookup to all tasks and splits such a
    key otherwise.
    """
    lookup = references.select(
        "example_id", F.struct("volume", "face_count", "bbox").alias("reference"))
    return scored.join(lookup, "example_id", "left")


def score_invariants(with_reference: DataFrame, tol: float = 0.1) -> DataFrame:
    """Add layer 5 and its reason; null without an example id or a passed layer 3."""
    due = F.col("L3_exec_ok") & truthy(F.col("example_id"))
    checked = with_reference.withColumn(
        "L5", F.when(due & F.col("reference").isNotNull(),
                     compare_invariants(F.col("result"), F.col("reference"), tol)))
    return checked.withColumn(
        "L5_invariants_ok", F.when(due, _true(F.col("L5.ok")))
    ).withColumn("L5_reason", F.when(due & F.col("reference").isNull(), "no_reference"))


def layer_counts(scored: DataFrame) -> DataFrame:
    """Per side: queried and failed calls, code blocks and each layer's passes.

    Skipped rows count nowhere, failed calls only as errors.
    """
    kept = ~_true(F.col("skipped"))
    failed = kept & truthy(F.col("query_error"))
    queried = kept & ~failed
    return scored.groupBy("side").agg(
        F.count_if(queried).alias("queried"),
        F.count_if(failed).alias("query_error"),
        F.count_if(queried & F.col("has_code_block")).alias("has_code_block"),
        *[F.count_if(queried & _true(F.col(c))).alias(f"L{i}") for i, c in enumerate(LAYERS, 1)],
    )


SUMMARY_METRICS = ("has_code_block", "L1", "L2", "L3", "L4", "L5", "query_error")


def summary_table(counts: DataFrame, base: str = "base", tuned: str = "tuned") -> DataFrame:
    """Metric by side with percentages of one shared total, the larger of the
    two sides' queried rows and at least 1."""
    long = counts.unpivot(["side", "queried"], list(SUMMARY_METRICS), "metric", "n")

    def of(side: str, c: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col(c))), F.lit(0))

    total = F.greatest(of(base, "queried"), of(tuned, "queried"), F.lit(1))
    return (
        long.groupBy("metric").agg(
            of(base, "n").alias("base_n"), of(tuned, "n").alias("tuned_n"), total.alias("total"))
        .withColumn("base_pct", F.col("base_n") * 100 / F.col("total"))
        .withColumn("tuned_pct", F.col("tuned_n") * 100 / F.col("total"))
        .withColumn("delta", F.col("tuned_n") - F.col("base_n"))
    )


def summary_document(
    counts: DataFrame, n_total: Column, config: dict[str, str | int | float] | None = None, wall_seconds: float | None = None,
) -> DataFrame:
    """One JSON document: rows in total, each side's counts, and the run's settings and seconds if given."""
    fields = F.struct(*[c for c in counts.columns if c != "side"])
    sides = F.map_from_entries(F.array_sort(F.collect_list(F.struct("side", fields.alias("v")))))
    more = [F.lit(wall_seconds).alias("wall_seconds")] if wall_seconds is not None else []
    if config:
        more.append(F.struct(*[F.lit(v).alias(k) for k, v in config.items()]).alias("config"))
    return counts.agg(sides.alias("sides")).select(
        F.to_json(F.struct(n_total.alias("n_total"), "sides", *more)).alias("document"))


def signature() -> Column:
    """Four marks for layers 1 to 4, ``----`` for skipped, ``QERR`` for a failed call."""
    marks = [F.when(_true(F.col(c)), "Y").otherwise(".") for c in LAYERS[:4]]
    return (
        F.when(_true(F.col("skipped")), "----")
        .when(truthy(F.col("query_error")), "QERR")
        .otherwise(F.concat(*marks))
    )


def readable_records(records: DataFrame) -> DataFrame:
    """Earlier records whose JSON still parses; a broken one counts as not done."""
    return records.filter(F.try_parse_json("record").isNotNull())


def pending(
    rows: DataFrame, records: DataFrame, *, limit: int = 0, start_from: int = 0, key: str = "idx"
) -> DataFrame:
    """Rows inside the window that no readable record covers."""
    inside = F.col(key) >= start_from
    if limit > 0:
        inside = inside & (F.col(key) < limit)
    return rows.filter(inside).join(readable_records(records).select(key), key, "left_anti")
