"""Raw lines to a split, tokenized training table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.operators import chat, splits, tokens
from tunelake.sinks.shared import shared_dir
from tunelake.sources import jsonl


class Prepared(NamedTuple):
    """The training table, and (id, reason, keys) of every written line that made no example."""

    table: DataFrame
    rejected: DataFrame


def prepare_training_table(
    lines: DataFrame,
    id_col: str,
    max_len: int,
    *,
    eval_fraction: float = 0.1,
    seed: int = 42,
    template=None,
    tokenizer=None,
    aux: bool = True,
    exact: bool = True,
) -> Prepared:
    """Parse, normalize, render, tokenize and split lines of a ``value`` column.

    Every line is accepted, rejected with a reason, or blank. Texts are parsed once:
    the result is checkpointed, and the split's count, the table and the rejects
    read that. ``exact=False`` splits by threshold, without a count.
    """
    written = jsonl.written_lines(jsonl.classify_lines(lines), id_col)
    reason = F.when(F.col("status") != "ok", F.col("status")).otherwise(chat.reject_reason())
    judged = written.withColumn("reason", reason).drop("status")
    rendered = chat.render_with(chat.to_messages(judged), template)
    shared_dir(lines.sparkSession)
    staged = tokens.tokenize(rendered, max_len, tokenizer=tokenizer).checkpoint()
    out = staged.filter(F.col("reason").isNull()).drop("reason", "keys")
    if aux:
        out = tokens.add_aux(out)
    split = splits.split_exact if exact else splits.split_by_threshold
    rejected = staged.filter(F.col("reason").isNotNull()).select(id_col, "reason", "keys")
    return Prepared(split(out, id_col, fraction=eval_fraction, seed=seed), rejected)


def write_training_table(table: DataFrame, path: str) -> None:
    """One folder per split, shared by every reader."""
    table.drop("messages", "tools").write.mode("overwrite").partitionBy("split").parquet(path)
