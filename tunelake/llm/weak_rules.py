"""Quality by weak supervision: rules vote or abstain, and agreement tells how far to trust each.

A rule says good (1), bad (-1) or nothing (0). Expectation-maximisation estimates
from the votes alone how often each rule is right when it says good and when it says
bad. All documents
take part: the votes of a text are one of ``3 ** rules`` patterns, and counts of
patterns, summed up by Spark, are all that the estimate needs. A text's posterior
is then a sum over its votes, each weighted by how much oftener good texts get it than bad
ones.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm.rows import replace_columns
from tunelake.llm.textstats import text_stats


def share(a: str, b: str) -> Column:
    return F.col(f"_stats.{a}") / F.greatest(F.col(f"_stats.{b}"), F.lit(1))


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes of the rules in use."""
    n_words = F.col("_stats.n_words")
    letters = F.greatest(F.col("_stats.n_upper") + F.col("_stats.n_lower"), F.lit(1))
    upper = F.col("_stats.n_upper") / letters
    return {
        "length": vote(n_words >= 30, n_words < 10),
        "word_length": vote(share("word_chars", "n_words").between(3, 10), ~share("word_chars", "n_words").between(2, 15)),
        "symbols": vote(share("n_symbols", "n_words") <= 0.03, share("n_symbols", "n_words") > 0.1),
        "symbol_chars": vote(share("n_symbols", "word_chars") <= 0.01, share("n_symbols", "word_chars") > 0.05),
        "same_lines": vote((F.col("_stats.n_dup_lines") == 0) & (F.col("_stats.n_lines") > 1), share("n_dup_lines", "n_lines") > 0.3),
        "repeats": vote(share("n_repeat_words", "n_words") <= 0.05, share("n_repeat_words", "n_words") > 0.2),
        "capitals": vote(upper <= 0.15, upper > 0.5),
        "shouting": vote(share("n_bangs", "n_words") <= 0.02, share("n_bangs", "n_words") > 0.1),
        "sentences": vote(share("n_stops", "n_words").between(0.02, 0.3), (n_words >= 30) & (share("n_stops", "n_words") < 0.005)),
    }


class RuleModel(NamedTuple):
    prior: float  # share of good texts
    says_bad: np.ndarray  # chance that each rule, when it speaks, says bad: of bad texts, and of good ones (2 x rules)

    def weights(self) -> np.ndarray:
        """Log odds that a bad and a good vote of each rule add for a good text: rules x 2. Silence adds nothing."""
        bad, good = self.says_bad
        return np.column_stack([np.log(good / bad), np.log((1 - good) / (1 - bad))])

    def accuracy(self) -> np.ndarray:
        """How often each rule is right when it speaks."""
        return (1 - self.prior) * self.says_bad[0] + self.prior * (1 - self.says_bad[1])


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> RuleModel:
    """Accuracies by expectation-maximisation over vote patterns and their counts.

    The start doubts every text by its bad votes. No rule turns against its own
    meaning: one that the data would have say bad of good texts more often than of
    bad ones gets the same chance for both, and so no weight.
    """
    counts = counts.astype(float)
    bad, good_vote = (patterns == -1).astype(float), (patterns == 1).astype(float)
    good = 1 / (1 + np.exp(2 * bad.sum(axis=1) - 1.5))
    model = RuleModel(0.5, np.full((2, patterns.shape[1]), 0.5))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        said, spoken = weight @ bad, weight @ (bad + good_vote)
        chance = (said + 0.5) / (spoken + 1)
        wrong = chance[1] > chance[0]
        chance[:, wrong] = ((said.sum(axis=0) + 0.5) / (spoken.sum(axis=0) + 1))[wrong]
        prior = float(np.clip((weight[1].sum() + 1) / (counts.sum() + 2), 0.05, 0.95))
        model = RuleModel(prior, chance)
        says = model.weights()
        odds = np.log(prior / (1 - prior)) + bad @ says[:, 0] + good_vote @ says[:, 1]
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -35, 35)))
        if np.abs(before - good).max(initial=0) < 1e-9:
            break
    return model


def fit_rules(docs: DataFrame, text_col: str = "text") -> RuleModel:
    votes = rules()
    cast = docs.select(text_stats(F.col(text_col)).alias("_stats")).select(*[v.cast("tinyint").alias(k) for k, v in votes.items()])
    rows = cast.groupBy(*votes).agg(F.count("*").alias("n")).collect()  # at most 3 ** rules rows
    patterns = np.array([[r[k] for k in votes] for r in rows], float).reshape(len(rows), len(votes))
    return estimate(patterns, np.array([r["n"] for r in rows], float))


def judge_quality(docs: DataFrame, text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """Add the counts of ``text_stats``, base_failed, quality (posterior chance of good) and kept.

    base_failed  fewer than 10 words, or more than a fifth of them in repeated windows
    kept         not base_failed, and quality at least ``keep_at``

    Null and empty texts have no words and fail the base rule. Rows are independent;
    repeated rows all count in the estimate. Columns of the input that have one of
    these names are replaced.
    """
    model = fit_rules(docs, text_col)
    odds = F.lit(float(np.log(model.prior / (1 - model.prior))))
    for v, (bad, good) in zip(rules().values(), model.weights().tolist(), strict=True):
        odds = odds + F.when(v == -1, bad).when(v == 1, good).otherwise(0.0)
    out = replace_columns(docs, {"_stats": text_stats(F.col(text_col))})
    n_words, repeated = F.col("_stats.n_words"), F.col("_stats.n_repeat_words")
    failed = (n_words < 10) | (100 * repeated > 20 * n_words)
    quality = 1 / (1 + F.exp(-odds))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return replace_columns(out, {
        **{c: F.col(f"_stats.{c}") for c in counts}, "base_failed": failed, "quality": quality,
        "kept": ~failed & (quality >= keep_at)}).drop("_stats")
