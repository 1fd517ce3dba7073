"""Document quality by hierarchical empirical Bayes over sites.

A classifier turns each text into evidence: the log odds of good quality beyond
the base rate. Sites get rates of their own from grouped sums of the classifier's
chances: a host's rate is drawn toward the global rate, a path's toward its
host's, and the strength of each draw is what the spread between sites calls for.
A document's posterior joins its path's rate and its own evidence, so a text that
says little is judged by where it stands, and a sparse site by what surrounds it.
What the document itself adds to its sites' sums is left out of the rates it is
joined with, so nothing is counted twice.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm.rows import cut
from tunelake.llm.sampling import labelled_sample
from tunelake.llm.textstats import text_stats

SAMPLE_PER_LABEL = 10_000
MIN_STRENGTH, MAX_STRENGTH = 1.0, 10_000.0


class Classifier(NamedTuple):
    weights: list[float]
    bias: float
    base: float  # share of good texts among all labels


def features(s: Column) -> list[Column]:
    words = F.greatest(s["n_words"], F.lit(1))
    lines = F.greatest(s["n_lines"], F.lit(1))
    letters = F.greatest(s["n_upper"] + s["n_lower"], F.lit(1))
    root = lambda c: F.sqrt(F.least(c, F.lit(4.0)))
    return [
        F.log1p(s["n_words"].cast("double")) / 5, s["word_chars"] / words / 10, root(s["n_symbols"] / words), root(s["n_dup_lines"] / lines),
        root(s["n_repeat_words"] / words), root(s["n_upper"] / letters), root(s["n_bangs"] / words), root(s["n_stops"] / words), root(s["n_digits"] / words)]


def fit_classifier(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int) -> Classifier:
    """Ridge logistic regression on at most ``per_label`` texts of each label, in one task."""
    sample, totals = labelled_sample(docs, labels, F.col(label_col), per_label, 2, id_col, text_col)
    n = {r["_label"]: r["n"] for r in totals.collect()}
    s = sample.select("_id", "_label", text_stats(F.col("_text")).alias("_stats"))
    rows = s.select("_id", "_label", F.array(*features(F.col("_stats"))).alias("x")).withColumn("_all", F.lit("all"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_id")
        y = pdf["_label"].to_numpy().astype(float)
        x = np.column_stack([np.stack(pdf["x"].to_numpy()), np.ones(len(y))])
        w = np.where(y == 1, n.get(1, 0) / max(1, y.sum()), n.get(0, 0) / max(1, (1 - y).sum()))
        w = w / w.mean()
        ridge = np.diag([*[0.5] * (x.shape[1] - 1), 1e-3])
        beta = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (y - p)) - ridge @ beta)
            beta = beta + step
            if np.abs(step).max() < 1e-8:
                break
        return pd.DataFrame({"beta": [beta.tolist()]})

    got = rows.groupBy("_all").applyInPandas(fit, "beta array<double>").first()
    total = n.get(0, 0) + n.get(1, 0)
    base = (n.get(1, 0) + 1) / (total + 2)
    if got is None:
        return Classifier([0.0] * len(features(F.col("_stats"))), math.log(base / (1 - base)), base)
    return Classifier(got.beta[:-1], got.beta[-1], base)


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(groups: DataFrame, n: str, s: str, around: Column) -> float:
    """How many observations the upper level is worth: moments of the groups' rates around ``around``.

    A binomial rate has the variance p(1-p)/n by itself; what the groups show beyond
    that is spread between them, and the wider it is, the weaker the draw.
    """
    rate = F.col(s) / F.col(n)
    m = groups.agg(
        F.sum(F.col(n) * (rate - around) ** 2).alias("spread"), F.sum(around * (1 - around)).alias("noise"),
        F.sum(F.col(n) * around * (1 - around)).alias("scale"), F.sum(n).alias("total"), F.count("*").alias("groups")).first()
    if not m.total or m.groups < 2:
        return MAX_STRENGTH
    between = max(m.spread - m.noise, 0.0)
    return float(np.clip(m.scale / between if between > 0 else MAX_STRENGTH, MIN_STRENGTH, MAX_STRENGTH))


def judge_sites(
    docs: DataFrame, labels: DataFrame, sites: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    per_label: int = SAMPLE_PER_LABEL, keep_at: float = 0.5,
) -> DataFrame:
    """Rows (id, evidence, host_rate, path_rate, posterior, kept), one per document.

    sites  (id, host, path), one row per page of a document; each page counts for
           its host and path, and a document takes the mean log odds of its pages'
           rates, from which everything under its own id is left out; documents
           without a page whose host is known are judged with the global rate

    Null and empty texts are classified by their counts, which are zero. Repeated
    rows count each. Null ids have no site. Other columns are left out.
    """
    model = fit_classifier(docs, labels, id_col, text_col, label_col, per_label)
    scored = docs.select(F.col(id_col).alias("_id"), text_stats(F.col(text_col)).alias("_stats"))
    odds = F.lit(model.bias)
    for w, x in zip(model.weights, features(F.col("_stats")), strict=True):
        odds = odds + F.lit(w) * x
    where = sites.select(F.col(id_col).alias("_id"), F.col("host").cast("string").alias("_host"), F.col("path").cast("string").alias("_path")).dropna(subset=["_id"])
    rows = cut(scored.select("_id", odds.alias("_odds")).withColumn("_chance", 1 / (1 + F.exp(-F.col("_odds")))))
    pages = where.filter("_host is not null").withColumn("_path", F.coalesce("_path", F.lit("")))
    whole = rows.agg(F.avg("_chance")).first()[0]
    top = F.lit(float(np.clip(0.5 if whole is None else whole, 1e-6, 1 - 1e-6)))
    mine = rows.join(pages, "_id").groupBy("_id", "_host", "_path").agg(F.count("*").alias("_n0"), F.sum("_chance").alias("_s0"))
    mine = cut(mine)
    paths = mine.groupBy("_host", "_path").agg(F.sum("_n0").alias("_n"), F.sum("_s0").alias("_s"))
    hosts = paths.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_s").alias("_hs"))
    pull = strength(hosts, "_hn", "_hs", top)
    paths = paths.join(hosts, "_host")
    path_pull = strength(paths, "_n", "_s", (F.col("_hs") + pull * top) / (F.col("_hn") + pull))
    base_odds = math.log(model.base / (1 - model.base))
    bounded = lambda c: F.greatest(F.least(c, F.lit(1 - 1e-9)), F.lit(1e-9))
    # What a document says itself comes as evidence, so its own chances leave the sums it is judged by.
    own_host = mine.groupBy("_id", "_host").agg(F.sum("_n0").alias("_hn0"), F.sum("_s0").alias("_hs0"))
    others = mine.join(own_host, ["_id", "_host"]).join(paths, ["_host", "_path"])
    rate = lambda s, s0, n, n0, k, above: (F.greatest(F.col(s) - F.col(s0), F.lit(0.0)) + k * above) / (F.col(n) - F.col(n0) + k)
    others = others.withColumn("host_rate", rate("_hs", "_hs0", "_hn", "_hn0", pull, top))
    others = others.withColumn("path_rate", rate("_s", "_s0", "_n", "_n0", path_pull, F.col("host_rate")))
    mean = lambda c: 1 / (1 + F.exp(-F.sum(F.col("_n0") * logit(bounded(F.col(c)))) / F.sum("_n0")))
    own = others.groupBy("_id").agg(mean("host_rate").alias("host_rate"), mean("path_rate").alias("path_rate"))
    out = rows.join(own, "_id", "left").select(
        F.col("_id").alias(id_col), (F.col("_odds") - base_odds).alias("evidence"),
        F.coalesce("host_rate", top).alias("host_rate"), F.coalesce("path_rate", top).alias("path_rate"))
    return out.withColumn("posterior", 1 / (1 + F.exp(-(F.col("evidence") + logit(bounded(F.col("path_rate"))))))).withColumn("kept", F.col("posterior") >= keep_at)
