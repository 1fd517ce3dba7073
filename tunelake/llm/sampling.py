"""Bounded samples of labelled documents, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, grade: Column, per_grade: int, n_grades: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, totals): at most ``per_grade`` documents of each label value, and how many labels there are of each.

    rows    (_id, _text, _label), the first of each value in the order of a hash of
            the id, so that a larger table is sampled evenly; no id or label, no place
    totals  (_label, n), over all labels
    """
    own = labels.select(F.col(id_col).alias("_id"), grade.cast("int").alias("_label")).dropna()
    own = own.filter(F.col("_label").between(0, n_grades - 1)).groupBy("_id").agg(F.max("_label").alias("_label"))
    totals = own.groupBy("_label").agg(F.count("*").alias("n"))
    chosen = None
    for g in range(n_grades):
        part = own.filter(F.col("_label") == g).orderBy(F.xxhash64("_id"), "_id").limit(per_grade)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    # No more than per_grade * n_grades rows, so every task can hold them.
    return texts.join(F.broadcast(chosen), "_id"), totals
