"""The backoff model against brute-force recursion over words."""

import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import backoff, katz, queries
from tunelake.sinks.shared import shared_dir

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def test_keys_are_those_of_spark(spark):
    pairs = [(0, 0), (1, -1), (-5, 7), (2**62, -(2**63))]
    got = [r.k for r in spark.createDataFrame(pairs, "a long, b long").select(F.xxhash64("a", "b").alias("k")).collect()]
    a, b = np.array(pairs, np.int64).T.copy().view(np.uint64)
    assert backoff.pair_key(a, b).view(np.int64).tolist() == got


@pytest.mark.parametrize("order, hot", [(2, 1 << 19), (2, 300), (3, 300)])
def test_every_ngram_counts(spark, sf_dir, monkeypatch, order, hot):
    """n-grams seen once and those of rare words too, whatever the cache holds."""
    monkeypatch.setattr(backoff, "PART_TOKENS", 20_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in backoff.score_backoff(docs, backoff.train_backoff(docs.filter(~katz.held_out("doc_id")), order=order, hot=hot)).collect()}
    check(docs, got, order)


def test_the_query_has_no_cut(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), {r.doc_id: r for r in queries.op3_lm_scoring(spark, sf_dir).collect()}, backoff.ORDER)


def check(docs, got, order):
    tokens = {r.doc_id: (..., *SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text)), None) for r in docs.collect()}
    train = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    count = {1: Counter((w,) for t in train for w in t[1:])}
    for k in range(2, order + 1):
        count[k] = Counter(t[i:i + k] for t in train for i in range(len(t) - k + 1))
    n, v = sum(count[1].values()), len(count[1])
    d = {k: katz.discounts(Counter(c.values())) for k, c in count.items()}
    mass = lambda g: (d[len(g)][count[len(g)][g]] if count[len(g)][g] <= 5 else 1) * count[len(g)][g]
    seen = sum(map(mass, count[1])) / n
    rest = max(1 - seen, 1 / (n + 1))
    total, own, lower, scale = Counter(), defaultdict(float), defaultdict(float), {}

    def chance(g):
        if len(g) == 1:
            return mass(g) / n * (1 - rest) / seen if g in count[1] else rest
        h = g[:-1]
        if g in count[len(g)]:
            return scale[h] * mass(g) / total[h]
        return (bow(h) if h in total else 1) * chance(g[1:])

    def bow(h):
        return (1 - scale[h] * own[h] / total[h]) / (1 - lower[h])

    for k in range(2, order + 1):
        for g, c in count[k].items():
            total[g[:-1]] += c
            own[g[:-1]] += mass(g)
            lower[g[:-1]] += chance(g[1:])
        scale |= {h: min(1, total[h] / (total[h] + 1) / (own[h] / total[h])) for h in total if len(h) == k - 1}
    assert len(got) == len(tokens)
    for i, t in tokens.items():
        assert (got[i].n_tokens, got[i].n_known) == (len(t) - 1, sum((w,) in count[1] for w in t[1:]))
        assert got[i].base_score == pytest.approx(sum(math.log10((count[1][w,] + 1) / (n + v + 1)) for w in t[1:]))
        assert got[i].score == pytest.approx(sum(math.log10(chance(t[max(0, j - order + 1):j + 1])) for j in range(1, len(t))), rel=1e-6)


@pytest.mark.parametrize("order", [3, 4])
def test_training_texts_sent_once_or_twice(spark, sf_dir, monkeypatch, order):
    """Longer n-grams, parts of frequent words cut, and texts marked as those of training, which are then sent once."""
    monkeypatch.setattr(backoff, "PART_TOKENS", 1_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = backoff.train_backoff(docs.filter(~katz.held_out("doc_id")), order=order, hot=300)
    assert len(model.split)
    got = backoff.score_backoff(docs, model, trained=~katz.held_out("doc_id")).collect()
    check(docs, {r.doc_id: r for r in got}, order)
    again = {r.doc_id: r for r in backoff.score_backoff(docs, model).collect()}
    assert all(again[r.doc_id].score == pytest.approx(r.score, abs=1e-6) and again[r.doc_id][:3] == r[:3] for r in got)


def test_little_is_stored_and_sent(spark, sf_dir):
    """The shared folder holds less than the input, and a token goes to its part in a few bytes."""
    shared = Path(shared_dir(spark).removeprefix("file:"))
    stored = lambda: sum(p.stat().st_size for p in shared.rglob("*.parquet"))
    path, before = f"{sf_dir}/documents.parquet", stored()
    docs = spark.read.parquet(path)
    model = backoff.train_backoff(docs)
    backoff.score_backoff(docs, model).collect()
    assert 0 < stored() - before < Path(path).stat().st_size
    sent = backoff.training_blocks(model.rows, model.sent()).agg(F.sum(F.length("data"))).first()[0]
    assert sent < 8 * model.train_tokens


def test_odd_rows(spark):
    rows = [(1, None), (None, "a b c"), (2, ""), (2, ""), (3, " \n "), (4, " ".join(f"w{i}" for i in range(9_000))), (8, "never seen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for train in (docs.filter("doc_id is null or doc_id <> 8"), docs.limit(0)):
        got = [(r.doc_id, r.n_tokens, r.score) for r in backoff.score_backoff(docs, backoff.train_backoff(train)).collect()]
        assert sorted((str(i), n) for i, n, _ in got) == [("1", 1), ("2", 1), ("2", 1), ("3", 1), ("4", 9_001), ("8", 3), ("None", 4)]
        assert all(math.isfinite(s) and s <= 0 for _, _, s in got)
