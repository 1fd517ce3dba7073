"""End-to-end evaluations over recorded or generated predictions."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.operators import codeeval, execeval, perf, report, splits, sqleval
from tunelake.sinks.records import path_exists, read_records, write_records
from tunelake.sinks.shared import shared_dir
from tunelake.sources.predictions import attach_predictions


@dataclass(frozen=True)
class SqlEvaluation:
    matched: DataFrame
    accuracy: DataFrame
    improvement: DataFrame
    errors: DataFrame
    fixed: DataFrame


def evaluate_sql(
    examples: DataFrame, predictions: DataFrame, *, sides=("base", "tuned"), num_examples: int = 100,
    fraction: float = 0.05, seed: int = 42, compat: bool = True,
) -> SqlEvaluation:
    """Exact match on the head of the holdout.

    ``examples``: example_id, truth; ``predictions``: example_id, side,
    prediction, error, latency_ms. The matched rows are fixed once, since every
    report reads them.
    """
    shared_dir(examples.sparkSession)
    test = splits.head_of_order(
        splits.holdout(examples, "example_id", fraction=fraction, seed=seed),
        "example_id", num_examples, seed=seed)
    attached = attach_predictions(test.select("example_id"), predictions, sides=sides)
    matched = sqleval.match_predictions(
        attached, test.select("example_id", "truth"), compat=compat).checkpoint()
    acc = sqleval.accuracy(matched)
    return SqlEvaluation(
        matched, acc, sqleval.accuracy_with_delta(acc), sqleval.error_counts(matched),
        sqleval.fixed_examples(matched))


@dataclass(frozen=True)
class StaticEvaluation:
    scored: DataFrame
    aggregate: DataFrame
    delta: DataFrame
    latency: DataFrame
    flips: DataFrame
    detail: DataFrame


def evaluate_static(
    examples: DataFrame, predictions: DataFrame, *, sides=("base", "tuned"), num_examples: int = 50,
    fraction: float = 0.1, seed: int = 42,
) -> StaticEvaluation:
    """Static code scores on the head of the holdout.

    The whitelist comes from the references of all ``examples`` (example_id,
    reference_code), held out or not.
    """
    whitelist = codeeval.fixed_whitelist(codeeval.api_whitelist(examples))
    held_out = splits.holdout(
        examples, "example_id", count=splits.floor_count_min1(fraction), seed=seed)
    test = splits.head_of_order(held_out, "example_id", num_examples, seed=seed)
    attached = attach_predictions(
        test.select("example_id", "reference_code"), predictions, sides=sides)
    scored = codeeval.score_static(attached, whitelist).checkpoint()
    aggregate = codeeval.aggregate_scores(scored)
    metrics = [*codeeval.FLAGS, "api_coverage_mean", "composite_mean"]
    return StaticEvaluation(
        scored, aggregate, report.metric_delta(aggregate, metrics),
        perf.latency_summary(attached), report.flips(scored), report.detail(attached, scored))


# What a record keeps of its run, where the run has it.
RECORD_FIELDS = (
    "orig_index", "category", "user_msg_preview", "system_msg_preview", "completion", "query_seconds", "syntax_error",
    "returncode", "timed_out",
)
STDERR_TAIL = 3_000


@dataclass(frozen=True)
class ExecutionEvaluation:
    records: DataFrame
    counts: DataFrame
    summary: DataFrame
    document: DataFrame


def evaluate_executions(
    runs: DataFrame, references: DataFrame, path: str, run_id: str, *, tol: float = 0.1,
    limit: int = 0, start_from: int = 0, config: dict[str, str | int | float] | None = None,
) -> ExecutionEvaluation:
    """Score the runs not yet recorded under ``path``, then sum up all records.

    A record holds the run's own fields, the tail of its error output, the measured
    and the reference invariants, and all layers, so every score can be worked out
    again from it. The document holds ``config`` and the seconds spent.

    Only runs from ``start_from`` on are scored; the summary covers every stored
    record below ``limit``, also earlier ones, whichever run wrote them.
    """
    began = time.monotonic()
    runs = runs.filter(F.col("idx") >= start_from)
    if limit > 0:
        runs = runs.filter(F.col("idx") < limit)
    keys = ["idx", "side"]
    spark = runs.sparkSession
    todo = runs
    if path_exists(spark, path):
        done = read_records(spark, path).filter(F.col("run_id") != run_id)
        todo = runs.join(done.select(*keys), keys, "left_anti")
    scored = execeval.score_invariants(
        execeval.attach_references(execeval.score_layers(todo), references), tol)
    kept = [c for c in RECORD_FIELDS if c in todo.columns]
    write_records(scored.select(
        *keys, "example_id", *kept, "skipped", "query_error", "has_code_block", *execeval.LAYERS,
        "exec_category", "exec_error", F.right("stderr", F.lit(STDERR_TAIL)).alias("stderr_tail"), "result", "reference", "L5", "L5_reason"), path, run_id)
    records = read_records(spark, path)
    if limit > 0:
        records = records.filter(F.col("idx") < limit)
    counts = execeval.layer_counts(records)
    total = records.agg(F.count_distinct("idx")).scalar()
    return ExecutionEvaluation(
        records, counts, execeval.summary_table(counts), execeval.summary_document(
            counts, total, {"tol": tol, **(config or {})}, round(time.monotonic() - began, 1)))

