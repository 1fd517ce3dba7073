"""Language of documents by Bayesian fusion of four kinds of evidence.

    text      likelihood of its letter triples under each language
    declared  the language that the page's markup declares, trusted as far as it is right
    suffix    the last part of the page's address
    host      what the other texts of the host are written in

Likelihoods of declarations and suffixes and the host priors are soft counts: sums
of the texts' own posteriors, grouped by Spark. Host priors are drawn toward those
of the host's domain, and these toward the global shares, each by a fixed number of
observations. All parts are added as logarithms.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.bytewords import LOWER, buffers, mix
from tunelake.llm.rows import cut, slices

BUCKETS = 1 << 15  # of letter triples
SAMPLE_PER_LANGUAGE = 2_000
EFFECTIVE_TRIPLES = 60.0  # neighbouring triples repeat each other; a long text counts as so many
PULL = 20.0  # observations that an upper level is worth
WORD = np.zeros(256, bool)  # digits and ASCII marks tell nothing
WORD[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class LanguageModel(NamedTuple):
    languages: list[str]
    log_likelihood: np.ndarray  # languages x BUCKETS


def triples(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every run of three bytes inside a text, all but letters read as blanks."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    data = np.where(WORD[data], data, 0x20).astype(np.uint64)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = data[:-2] << np.uint64(16) | data[1:-1] << np.uint64(8) | data[2:]
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    inside = np.flatnonzero((doc[:-2] == doc[2:]) & (key != 0x202020))
    return doc[inside], (mix(key[inside]) % np.uint64(BUCKETS)).astype(np.int64)


def language_sample(docs: DataFrame, number: Column, per_language: int, n_languages: int, id_col: str, text_col: str) -> DataFrame:
    """(_text, _label): of each label the first ``per_language`` documents in the order of a hash of the id.

    A mark for the hash, with some slack, leaves few rows to rank, however frequent a label is.
    """
    own = docs.select(F.col(id_col).alias("_id"), number.alias("_label")).dropna().groupBy("_id").agg(F.max("_label").alias("_label"))
    n = {r["_label"]: r["count"] for r in own.groupBy("_label").count().collect()}
    enough = per_language + 6 * per_language**0.5 + 50
    marks = F.array(*[F.lit(min(-(2.0**63) + 2.0**64 * enough / n.get(k, 1), 2.0**63)) for k in range(n_languages)])
    few = own.withColumn("_hash", F.xxhash64("_id")).filter(F.col("_hash") <= F.get(marks, F.col("_label")))
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_hash", "_id"))
    chosen = few.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).select("_id", "_label")
    # No more than per_language ids of each label, so every task can hold them.
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id").select("_text", "_label")


def fit_languages(docs: DataFrame, label_col: str, id_col: str, text_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Triple frequencies of at most ``per_language`` texts of every label, counted where the texts are."""
    labelled = docs.filter(F.col(label_col).isNotNull())
    languages = sorted(r["lang"] for r in labelled.select(F.col(label_col).alias("lang")).distinct().collect())
    if not languages:
        return LanguageModel([], np.zeros((0, BUCKETS)))
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col(label_col)).cast("int") - 1
    sample = language_sample(labelled, number, per_language, len(languages), id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The triples of a slice of texts at a time."""
        for batch in batches:
            texts, label = batch.column(0), batch.column(1).to_numpy().astype(np.int64)
            for a, b in slices(texts):
                doc, bucket = triples(texts[a:b])
                cell, n = np.unique(label[a:b][doc] * BUCKETS + bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n.astype(np.int64))], ["cell", "n"])

    cells = sample.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full(len(languages) * BUCKETS, 0.5)
    counts[cells.column("cell").to_numpy()] += cells.column("n").to_numpy()
    counts = counts.reshape(len(languages), BUCKETS)
    return LanguageModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))


def text_scores(model: LanguageModel, text: Column) -> Column:
    """Log likelihood of a text under each language, tempered to EFFECTIVE_TRIPLES; zeros without a triple."""
    n = len(model.languages)

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            texts, out = pa.array(series, pa.large_string()), []
            for a, b in slices(texts):
                doc, bucket = triples(texts[a:b])
                size = np.bincount(doc, minlength=b - a)
                sums = np.column_stack([np.bincount(doc, weights=row[bucket], minlength=b - a) for row in model.log_likelihood]) if n else np.zeros((b - a, 0))
                out.extend(sums * (np.minimum(size, EFFECTIVE_TRIPLES) / np.maximum(size, 1))[:, None])
            yield pd.Series(out, dtype=object)

    return score(text.cast("string"))


def softmax(scores: Column) -> Column:
    shifted = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, y: a + y))


def sums_of(posterior: str, n: int) -> list[Column]:
    return [F.sum(F.col(posterior)[k]).alias(f"s{k}") for k in range(n)]


def fused_languages(
    docs: DataFrame, sites: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
    model: LanguageModel | None = None,
) -> DataFrame:
    """Rows (id, language, probability), one per document.

    sites  (id, host, suffix, declared), one row per page of a document; each page
           counts for its host, suffix and declaration, and a document takes the
           mean of what its pages' hosts, suffixes and declarations say without
           what stands under its own id; a missing row, each null part, and a suffix
           or declaration that no other document has are no evidence
    model  a fitted one; without it, one is fitted on the labelled documents

    Null and empty texts are no evidence either: such a document gets what its site
    and the global shares say. Repeated rows count each. With no labelled document
    at all, language and probability are null. Ties go to the first in name order.
    """
    model = model or fit_languages(docs, label_col, id_col, text_col)
    n = len(model.languages)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    if not n:
        return rows.select(F.col("_id").alias(id_col), F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"))
    where = sites.select(F.col(id_col).alias("_id"), *[F.col(c).cast("string").alias(f"_{c}") for c in ("host", "suffix", "declared")]).dropna(subset=["_id"])
    domain = F.regexp_extract("_host", r"([^.]+\.[^.]+\.[^.]+|[^.]+\.[^.]+)$", 1)
    scored = rows.select("_id", text_scores(model, F.col("_text")).alias("_scores"))
    scored = cut(scored.withColumn("_own", softmax(F.col("_scores"))))
    total = scored.agg(*sums_of("_own", n)).first()
    shares = np.array([x or 0.0 for x in total]) + 1.0
    shares = (shares / shares.sum()).tolist()
    # What each document says of each of its hosts, domains, suffixes and declarations.
    fact = lambda kind, value, above=None: F.struct(F.lit(kind).alias("_kind"), value.alias("_value"), (above if above is not None else F.lit(None).cast("string")).alias("_above"))
    facts = where.select("_id", F.inline(F.array(
        fact("host", F.col("_host"), domain), fact("domain", domain), fact("suffix", F.col("_suffix")), fact("declared", F.col("_declared")))))
    facts = facts.filter("_value is not null").groupBy("_id", "_kind", "_value", "_above").agg(F.count("*").alias("_pages"))
    per_id = scored.groupBy("_id").agg(F.count("*").alias("_rows"), *sums_of("_own", n))
    mine = cut(facts.join(per_id, "_id").select(
        "_id", "_kind", "_value", "_above", "_pages", (F.col("_pages") * F.col("_rows")).alias("_n0"),
        F.array(*[F.col("_pages") * F.col(f"s{k}") for k in range(n)]).alias("_mine")))
    # Cut, so that the join below has two plain exchanges: adaptive execution then sends the small side or splits a hot value.
    groups = cut(mine.groupBy("_kind", "_value").agg(F.sum("_n0").alias("_n"), F.array(*[F.sum(F.col("_mine")[k]) for k in range(n)]).alias("_sums")))
    whole = {r["_kind"]: r["per"] for r in mine.groupBy("_kind").agg(F.array(*[F.sum(F.col("_mine")[k]) for k in range(n)]).alias("per")).collect()}
    # A document's own share leaves the sums it is judged by, as its text is evidence already.
    others = mine.join(groups, ["_kind", "_value"]).select(
        "_id", "_kind", "_value", "_above", "_pages", (F.col("_n") - F.col("_n0")).alias("_left"),
        F.zip_with("_sums", "_mine", lambda x, y: F.greatest(x - y, F.lit(0.0))).alias("_sums"))

    def sum_of(array: Column) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda a, y: a + y)

    def toward(sums: Column, above: Column) -> Column:
        """Shares of a group, drawn toward those above it."""
        return F.zip_with(sums, above, lambda x, y: (x + PULL * y) / (sum_of(sums) + PULL))

    def likelihood(kind: str) -> Column:
        """log P(value | language); null where no other document has the value."""
        per = whole.get(kind, [0.0] * n)
        drawn = sum_of(F.col("_sums")) / (sum(per) or 1.0)
        says = F.array(*[F.log((F.col("_sums")[k] + PULL * drawn) / (per[k] + PULL)) for k in range(n)])
        return F.when(F.col("_left") > 0, says)

    everywhere = F.array(*[F.lit(x) for x in shares])
    domains = others.filter("_kind = 'domain'").select("_id", F.col("_value").alias("_above"), toward(F.col("_sums"), everywhere).alias("_drawn"))
    hosts = others.filter("_kind = 'host'").join(domains, ["_id", "_above"]).select(
        "_id", "_kind", "_pages", F.transform(toward(F.col("_sums"), F.col("_drawn")), lambda x: F.log(x)).alias("_says"))
    rest = others.filter("_kind in ('suffix', 'declared')").select(
        "_id", "_kind", "_pages", F.when(F.col("_kind") == "suffix", likelihood("suffix")).otherwise(likelihood("declared")).alias("_says"))
    told = hosts.unionByName(rest).filter("_says is not null").groupBy("_id", "_kind").agg(
        F.array(*[F.sum(F.col("_pages") * F.col("_says")[k]) / F.sum("_pages") for k in range(n)]).alias("_says"))
    pages = told.groupBy("_id").agg(*[F.max(F.when(F.col("_kind") == kind, F.col("_says"))).alias(f"_{kind}_says") for kind in ("host", "suffix", "declared")])
    nothing = F.array(*[F.lit(0.0)] * n)
    joined = scored.join(pages, "_id", "left")
    parts = [F.col("_scores"), F.coalesce("_suffix_says", nothing), F.coalesce("_declared_says", nothing), F.coalesce("_host_says", F.transform(everywhere, lambda x: F.log(x)))]
    fused = joined.select("_id", F.array(*[sum((p[k] for p in parts), F.lit(0.0)) for k in range(n)]).alias("_fused"))
    final = fused.withColumn("_posterior", softmax(F.col("_fused"))).withColumn("_best", F.array_max("_posterior"))
    names = F.array(*[F.lit(x) for x in model.languages])
    return final.select(
        F.col("_id").alias(id_col), F.get(names, (F.array_position("_posterior", F.col("_best")) - 1).cast("int")).alias("language"), F.col("_best").alias("probability"))
