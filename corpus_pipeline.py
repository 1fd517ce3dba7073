"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from tunelake.llm.rows import put_back, set_aside
from tunelake.sinks.shared import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of any grade of toxicity stays below the mark.

    Null and empty texts have the grades' base rates. Rows are judged one by one, so
    rows alike in text stay or go together; without labels all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own = ("doc_id", "text")
    return put_back(toxicity.grade_toxicity(set_aside(docs, *own), labels).filter(~F.col("toxic")), docs.columns, *own)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines seen before; a document goes if no line of it is left.

    Null and empty texts stay as they are. The first occurrence by id, null last,
    then by a hash of id and text, keeps its lines; rows alike in both keep them together.
    """
    own = ("doc_id", "text", "n_chars")
    out = line_dedup.remove_repeated_lines(set_aside(docs, *own))
    emptied = (F.col("n_removed") > 0) & (F.btrim("text", F.lit(line_dedup.BLANKS)) == "")
    kept = out.filter(~emptied).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")))
    return put_back(kept, docs.columns, *own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 and more hold together, the one with the least id.

    Null ids come last, then a hash of id and text decides. Null, empty and blank texts
    have no links and stay; of rows alike in id and text one stays.
    """
    return ngram_join.one_of_each_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of ten words, or a whole item of fewer.

    Null and empty texts hold none and stay. Rows are judged one by one; an empty
    benchmark, null items and items without a word take nothing away.
    """
    own = ("doc_id", "text")
    out = decontaminate.mark_contained(set_aside(docs, *own), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return put_back(out.filter(F.size("hit_words") == 0), docs.columns, *own)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept texts' tokens, dealt over sequences of 4096.

    A null or empty text is one piece of the end token alone; repeated rows are
    packed each for themselves, and no rows give none.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", remove_repeats),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]
ORACLE_SQL = None  # toxicity and packing have no SQL form; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
