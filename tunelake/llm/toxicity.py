"""Toxicity grades by cumulative-link ordinal regression.

One weight for each text feature is shared by all thresholds: the chance that a
text's grade exceeds ``k`` is ``sigmoid(score - threshold[k])``, and thresholds
ascend. Features are the words of a text and the first bytes of its words, each
counted once per text, so that neither length nor repetition shifts the score.
Expected severity is the sum of the chances over the thresholds.

Labels say only whether a text is toxic. Severity grades come from them by a
written rule: words that labels tie to toxic texts form a lexicon, and a toxic
text's grade is one more than the number of ``GRADE_SHARES`` that its share of
such words reaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.bytewords import mix, words
from tunelake.llm.rows import field_type, replace_columns, slices, stored
from tunelake.llm.sampling import labelled_sample

GRADE_SHARES = (0.02, 0.05)  # of a toxic text's words in the lexicon: grades 2 and 3
PREFIX_BYTES = 5
MIN_DOCUMENTS = 4  # of the sample that must hold a feature
MIN_ASSOCIATION = 15.0  # chi-square of a feature with the label, one degree of freedom
SAMPLE_PER_LABEL = 4_000
REJECT_AT = 0.3  # chance of any grade above 0; the README gives recall on held-out labels
EDGES = np.zeros(256, bool)  # white space and marks of ASCII end a word here
EDGES[:128] = True
EDGES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


class OrdinalModel(NamedTuple):
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray


def features_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature) pairs without repeats, by text, and the number of words of each text."""
    w = words(texts, EDGES)
    stems = mix(w.prefix_hash(PREFIX_BYTES) + np.uint64(1))
    long_words = w.end - w.start > PREFIX_BYTES
    doc = np.concatenate([w.doc, w.doc[long_words]])
    feature = np.concatenate([w.hash, stems[long_words]])
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])
    return doc[fresh], feature[fresh], np.diff(w.first)


def grades_of(toxic: np.ndarray, doc: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """The written rule: 0 for texts that are not toxic, else by share of lexicon features."""
    n = len(toxic)
    names, place = np.unique(feature, return_inverse=True)
    total = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    bad = np.bincount(place, weights=toxic[doc], minlength=len(names))
    good = np.bincount(place, minlength=len(names)) - bad
    odds = np.log((bad + 0.5) / (total[0] + 1)) - np.log((good + 0.5) / (total[1] + 1))
    lexicon = (odds > 3) & (bad >= MIN_DOCUMENTS)
    share = np.bincount(doc, weights=lexicon[place], minlength=n) / np.maximum(np.bincount(doc, minlength=n), 1)
    return np.where(toxic, 1 + sum((share >= s).astype(int) for s in GRADE_SHARES), 0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_ordinal(doc: np.ndarray, column: np.ndarray, n_features: int, grade: np.ndarray, sample_weight: np.ndarray, n_grades: int, l2: float = 1.0, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by Adam over the whole sample.

    Thresholds are the first one and the logarithms of the steps between them, so
    they stay in order.
    """
    n = len(grade)
    weights, free = np.zeros(n_features), np.zeros(n_grades - 1)
    above = np.array([np.average(grade > k, weights=sample_weight) for k in range(n_grades - 1)])
    start = -np.log(np.clip(above, 1e-4, 1 - 1e-4) / np.clip(1 - above, 1e-4, 1))
    free[0], free[1:] = start[0], np.log(np.maximum(np.diff(start), 0.05))
    moment = [np.zeros(n_features + len(free)), np.zeros(n_features + len(free))]
    for step in range(1, rounds + 1):
        thresholds = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
        score = np.bincount(doc, weights=weights[column], minlength=n)
        chance = np.column_stack([np.ones(n), *(sigmoid(score - t) for t in thresholds), np.zeros(n)])
        upper, lower = chance[np.arange(n), grade], chance[np.arange(n), grade + 1]
        own = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / own, lower * (1 - lower) / own
        d_score = -sample_weight * (d_upper - d_lower)
        d_threshold = np.zeros(n_grades - 1)
        for k in range(n_grades - 1):
            d_threshold[k] = (sample_weight * d_upper)[grade == k + 1].sum() - (sample_weight * d_lower)[grade == k].sum()
        d_free = np.empty_like(free)
        d_free[0] = d_threshold.sum()
        for k in range(1, len(free)):
            d_free[k] = d_threshold[k:].sum() * np.exp(free[k])
        gradient = np.concatenate([np.bincount(column, weights=d_score[doc], minlength=n_features) + l2 * weights, d_free])
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.99 * moment[1] + 0.01 * gradient**2
        move = 0.1 * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
        weights, free = weights - move[:n_features], free - move[n_features:]
    return weights, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = SAMPLE_PER_LABEL) -> OrdinalModel:
    """Fit on at most ``per_label`` toxic and as many other labelled texts, in one task.

    The sample's rows are weighted back to the shares among all labels. Without
    any labelled text the model has no features and one high threshold per grade.
    """
    sample, totals = labelled_sample(docs, labels, F.col(label_col), per_label, 2, id_col, text_col)
    n = {r["_label"]: r["n"] for r in totals.collect()}
    n_grades = len(GRADE_SHARES) + 2

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(_id, _row, _label, feature) without repeats, and one row without a feature for each text."""
        for batch in batches:
            for a, b in slices(batch.column(3)):
                doc, feature, _ = features_of(batch.column(3)[a:b])
                row = pa.array(np.concatenate([np.arange(a, b), a + doc]))
                found = pa.array(np.concatenate([np.zeros(b - a, np.uint64), feature]).view(np.int64), mask=np.arange(b - a + len(doc)) < b - a)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(row) for i in range(3)), found], ["_id", "_row", "_label", "feature"])

    kind = field_type(sample, "_id").simpleString()
    rows = sample.select("_id", F.monotonically_increasing_id().alias("_row"), "_label", "_text")
    pairs = stored(rows.mapInArrow(pairs_of, f"_id {kind}, _row long, _label int, feature long"), "toxicity-pairs")
    size, n_toxic = pairs.filter("feature is null").agg(F.count("*"), F.sum("_label")).first()
    size, n_toxic = float(size), float(n_toxic or 0)
    seen, bad = F.col("seen").cast("double"), F.col("bad").cast("double")
    spread = seen * (size - seen) * n_toxic * (size - n_toxic)
    common = (
        pairs.filter("feature is not null").groupBy("feature").agg(F.count("*").alias("seen"), F.sum("_label").alias("bad"))
        .filter((F.col("seen") >= MIN_DOCUMENTS) & (spread > 0) & (size * F.pow(bad * size - seen * n_toxic, F.lit(2.0)) >= MIN_ASSOCIATION * spread)))
    kept = pairs.filter("feature is null").unionByName(pairs.join(common.select("feature"), "feature", "left_semi"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        docs = pdf[pdf["_whole"]].sort_values(["_id", "_row"]).reset_index(drop=True)
        own = pdf[~pdf["_whole"]]
        doc = pd.Series(np.arange(len(docs)), index=docs["_row"]).reindex(own["_row"]).to_numpy(np.int64)
        names, column = np.unique(own["feature"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        order = np.lexsort((column, doc))
        doc, column = doc[order], column[order]
        toxic = docs["_label"].to_numpy() == 1
        grade = grades_of(toxic, doc, column)
        share = {k: n[k] / max(1, int((toxic == bool(k)).sum())) for k in n}
        weight = np.where(toxic, share.get(1, 1.0), share.get(0, 1.0))
        weight = weight / weight.mean()
        weights, thresholds = fit_ordinal(doc, column, len(names), grade, weight, n_grades)
        return pd.DataFrame({"kind": ["w"] * len(weights) + ["t"] * len(thresholds),
                             "key": [*names.view(np.int64).tolist(), *range(len(thresholds))],
                             "value": [*weights, *thresholds]})

    # One task, which gets no text: pairs of at most 2 * per_label texts with the features kept.
    kept = kept.select("_id", "_row", "_label", F.col("feature").isNull().alias("_whole"), F.coalesce("feature", F.lit(0)).alias("feature"))
    fitted = kept.withColumn("_all", F.lit("all")).groupBy("_all").applyInPandas(
        fit, "kind string, key long, value double").toPandas()
    w, t = fitted[fitted.kind == "w"], fitted[fitted.kind == "t"].sort_values("key")
    thresholds = t["value"].to_numpy() if len(t) else np.full(n_grades - 1, 35.0)
    return OrdinalModel(w["key"].to_numpy().astype(np.int64).view(np.uint64), w["value"].to_numpy(), thresholds)


def severity_at(model: OrdinalModel, chance: float) -> float:
    """The expected severity of a text whose chance of a grade above 0 is ``chance``."""
    score = model.thresholds[0] + np.log(chance / (1 - chance))
    return float(sigmoid(score - model.thresholds).sum())


def score_toxicity(docs: DataFrame, model: OrdinalModel, text_col: str = "text", reject_at: float = REJECT_AT) -> DataFrame:
    """Add expected_severity (0 to the highest grade) and toxic (whether the chance of a grade above 0 is at least ``reject_at``).

    Severity and that chance rise together with the score, so the mark for the
    chance is applied as the severity that goes with it.

    Null, empty and unknown texts get the score 0, hence the grades' base rates.
    Rows are independent, so repeated rows score alike. Columns of the input that
    have one of these names are replaced.
    """
    @F.pandas_udf("double")
    def severity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            texts = pa.array(series, pa.large_string())
            out = []
            for a, b in slices(texts):
                doc, feature, _ = features_of(texts[a:b])
                score = np.zeros(b - a)
                if len(model.features):
                    at = np.minimum(np.searchsorted(model.features, feature), len(model.features) - 1)
                    hit = model.features[at] == feature
                    score = np.bincount(doc[hit], weights=model.weights[at[hit]], minlength=b - a)
                out.append(sigmoid(score[:, None] - model.thresholds).sum(axis=1))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    out = replace_columns(docs, {"expected_severity": severity(F.col(text_col).cast("string"))})
    return replace_columns(out, {"toxic": F.col("expected_severity") >= F.lit(severity_at(model, reject_at))})


def grade_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", reject_at: float = REJECT_AT, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """Fit on the labelled documents and score all documents."""
    return score_toxicity(docs, fit_toxicity(docs, labels, id_col, text_col, label_col, per_label), text_col, reject_at)
