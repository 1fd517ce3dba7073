"""Exact-match evaluation of generated SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions.pytext import truthy
from tunelake.functions.sqltext import with_normal_sql


def sides_from_columns(
    df: DataFrame, sides: dict[str, str], *, carry: list[str], out: str = "prediction"
) -> DataFrame:
    """Turn one prediction column per side into one row per (row, side)."""
    rows = F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(column).alias(out))
        for side, column in sides.items()
    ])
    return df.select(*carry, F.inline(rows))


def match_predictions(
    predictions: DataFrame, truths: DataFrame, *, key: str = "example_id", compat: bool = True
) -> DataFrame:
    """Join predictions to true answers and compare their normal forms.

    Both sides are normalized before the join. A report that needs no text moves
    only the normal forms.
    """
    left = with_normal_sql(predictions, "prediction", "prediction_norm", compat=compat)
    right = with_normal_sql(
        truths.select(key, "truth"), "truth", "truth_norm", compat=compat).drop("truth")
    return left.join(right, key).withColumn(
        "correct", F.col("prediction_norm") == F.col("truth_norm"))


def accuracy(matched: DataFrame) -> DataFrame:
    """Per side: examples, correct answers and percent correct."""
    return matched.groupBy("side").agg(
        F.count(F.lit(1)).alias("num"),
        F.count_if("correct").alias("correct"),
    ).withColumn("accuracy_pct", F.col("correct") / F.col("num") * 100)


def accuracy_with_delta(acc: DataFrame, base: str = "base", tuned: str = "tuned") -> DataFrame:
    """One row: both sides' accuracy and the tuned side's gain, null if a side is absent."""
    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    return acc.agg(
        of(base, "num").alias("base_num"), of(base, "correct").alias("base_correct"),
        of(base, "accuracy_pct").alias("base_accuracy_pct"),
        of(tuned, "num").alias("tuned_num"), of(tuned, "correct").alias("tuned_correct"),
        of(tuned, "accuracy_pct").alias("tuned_accuracy_pct"),
    ).withColumn(
        "improvement_pct", F.col("tuned_accuracy_pct") - F.col("base_accuracy_pct"))


def outcome_mark(correct: Column, error: Column) -> Column:
    """OK, ERR or MISS; an error wins over a match."""
    return F.when(truthy(error), "ERR").when(correct, "OK").otherwise("MISS")


def quality_mark(composite: Column) -> Column:
    return F.when(composite >= 0.7, "OK").otherwise("??")


def error_counts(predictions: DataFrame) -> DataFrame:
    """Per side: rows, and calls that failed."""
    return predictions.groupBy("side").agg(
        F.count(F.lit(1)).alias("num"), F.count_if(truthy(F.col("error"))).alias("errors"))


def fixed_examples(
    matched: DataFrame, *, key: str = "example_id", k: int = 5,
    base: str = "base", tuned: str = "tuned",
) -> DataFrame:
    """First ``k`` keys, in key order, that the base side failed and the tuned side passed.

    The keys are found from the marks alone; texts are fetched for ``k`` keys only.
    """
    def of(side: str, c: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(c)))

    keys = (
        matched.groupBy(key).agg(of(base, "correct").alias("b"), of(tuned, "correct").alias("t"))
        .filter(~F.col("b") & F.col("t")).orderBy(key).limit(k).select(key)
    )
    return matched.join(F.broadcast(keys), key).groupBy(key).agg(  # k rows at most
        of(base, "prediction").alias("base_prediction"),
        of(tuned, "prediction").alias("tuned_prediction"))
