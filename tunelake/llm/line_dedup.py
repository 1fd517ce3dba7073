"""Line dedup over overlapping windows of three consecutive lines.

Every window is hashed, windows found more than once anywhere are known by their
first occurrence, and all later occurrences cover their lines. Covered lines,
merged over overlapping windows, are removed. Texts never leave their rows for
this: what is shuffled is a hash and a place for each line, summed up before the
shuffle, and the covered lines of the documents that have some.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm.rows import hash128, put_back, row_key, set_aside, text_of

BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """(place, trimmed line) of the lines that are not blank, places from 0."""
    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("i"), F.btrim(line, F.lit(BLANKS)).alias("t")))
    return F.filter(numbered, lambda s: s["t"] != "")


def windows_of(rows: DataFrame) -> DataFrame:
    """One row per window: its hashes, and where it starts and ends."""
    lines = rows.withColumn("_lines", lines_of(F.col("_text")))
    line = lambda j, k: F.get("_lines", j + k)
    window = lambda j: F.struct(
        line(j, 0)["i"].alias("_from"), line(j, 2)["i"].alias("_to"),
        *[h.alias(n) for h, n in zip(hash128(*(line(j, k)["t"] for k in range(3))), ("_w1", "_w2"), strict=True)])
    many = F.size("_lines") >= 3
    return lines.filter(many).select(
        "_id", "_k1", "_k2", F.inline(F.transform(F.sequence(F.lit(0), F.size("_lines") - 3), window)))


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (_k1, _k2, _covered): the lines that later occurrences cover, for documents that have some."""
    rows = text_of(docs, id_col, text_col)
    rows = rows.select("*", *row_key("_id", "_text"))
    windows = windows_of(rows)
    place = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.col("_from").alias("at"))
    known = (
        windows.groupBy("_w1", "_w2").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
        .filter("_first != _last").select("_w1", "_w2", "_first", F.col("_first.at").alias("_at")))
    later = windows.join(known, ["_w1", "_w2"]).filter(
        ~((F.col("_first.k1") == F.col("_k1")) & (F.col("_first.k2") == F.col("_k2")) & (F.col("_from") < F.col("_at") + 3)))
    spans = later.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("_from", "_to")).alias("_spans"))
    return spans.select("_k1", "_k2", F.array_distinct(F.flatten(
        F.transform("_spans", lambda s: F.sequence(s["_from"], s["_to"])))).alias("_covered"))


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove the lines of later occurrences from each text; add n_lines and n_removed.

    A window is three neighbouring lines with something on them, compared without
    white space at their ends; it covers what lies between its first and last line,
    blank lines too. Occurrences are ordered by id (null last), then by a hash of
    id and text, then by place. An occurrence that shares lines with the first one
    in the same text is not later than it. Rows alike in id and text count as one,
    and all of them get its result. Null texts stay null, with no lines; texts of
    fewer than three lines stay as they are. Columns of the input named n_lines or
    n_removed are replaced.
    """
    covered = covered_lines(docs, id_col, text_col)
    keyed = set_aside(docs, id_col, text_col).select("*", *row_key(id_col, text_col))
    joined = keyed.join(covered, ["_k1", "_k2"], "left").withColumn("_split", F.split(F.col(text_col), "\n"))
    # The places are told apart by hash, so a text of many lines takes time in proportion.
    places = F.array_except(F.sequence(F.lit(0), F.size("_split") - 1), "_covered")
    kept = F.array_join(F.transform(places, lambda i: F.get("_split", i)), "\n")
    gone = F.col("_covered").isNotNull()
    out = joined.select(
        id_col, F.when(gone, kept).otherwise(F.col(text_col)).alias(text_col), "_row",
        F.coalesce(F.size("_split"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(gone, F.size("_covered")).otherwise(0).cast("long").alias("n_removed"))
    counts = ("n_lines", "n_removed")
    return put_back(out, [*(c for c in docs.columns if c.lower() not in counts), *counts], id_col, text_col, *counts)
