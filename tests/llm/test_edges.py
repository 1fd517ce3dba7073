"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import math

import pytest
from pyspark.sql import functions as F

import public_tokenizers
import corpus_pipeline
from tunelake.llm import backoff, decontaminate, katz, language, line_dedup, ngram_join, packing, site_quality, token_counts, toxicity, weak_rules

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i}x" for i in range(30_000)) + "\n" + "z" * 50_000
COPY = "one two three four five six seven\neight nine ten\neleven twelve"
ROWS = [
    (1, None), (None, "a b c"), (None, None), (2, ""), (2, ""), (3, " \n\t\n "), (4, LONG), (5, COPY), (6, COPY), (6, COPY),
    (7, "é ñ 日本 🙂 <|endoftext|> Ünïcode ΣΑΣ"), (8, "stupid idiot words here"),
]
CLASHES = ("n_words", "n_lines", "n_removed", "n_tokens", "hit_words", "found_items", "toxic", "kept", "quality", "_k1", "class_id", "value")


@pytest.fixture(scope="module", params=["rows", "none"])
def docs(spark, request):
    rows = ROWS if request.param == "rows" else []
    df = spark.createDataFrame([(i, t, "en" if i != 7 else None, "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    return df.withColumns({c: F.lit("other") for c in CLASHES}).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(8, 1, 0), (5, 0, 1), (None, 1, 0), (4, None, None), (99, 1, 1)], "doc_id long, toxic int, quality int")


@pytest.fixture(scope="module")
def sites(spark):
    return spark.createDataFrame(
        [(5, "a.example.org", "en", "org", "en"), (6, None, None, None, None), (None, "b", "", "x", "fr")],
        "doc_id long, host string, path string, suffix string, declared string")


def by_row(df, *columns):
    return sorted(((r.doc_id, *(r[c] for c in columns)) for r in df.collect()), key=str)


def test_stages(spark, sf_dir, docs):
    """All but the last stage give back every column, those with an operator's names too."""
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, sf_dir)
        assert rows.columns == docs.columns and rows.filter("n_removed <> 'other' or toxic <> 'other' or _k1 <> 'other'").count() == 0
    if docs.count():
        assert {r.doc_id for r in rows.collect()} == {1, None, 2, 3, 4, 5, 7, 8}
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).select("doc_id").distinct().count() == (8 if docs.count() else 0)


def test_line_dedup(docs):
    out = line_dedup.remove_repeated_lines(docs)
    assert out.count() == docs.count() and set(out.columns) == {*docs.columns}
    if docs.count():
        got = by_row(out, "text", "n_removed")
        assert (5, COPY, 0) in got and got.count((6, "", 3)) == 2 and (1, None, 0) in got and got.count((2, "", 0)) == 2


def test_token_counts(docs):
    out = token_counts.token_prefix_counts(docs, BYTES, limit=5)
    assert out.count() == docs.count()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    for r in out.collect():
        text = r.text or ""
        assert r.n_tokens == len(tok.encode(text, add_special_tokens=False).ids) and r.n_bytes == len(text.encode())
        assert r.over_limit == (r.n_tokens > 5)
        if len(text) < 100:
            counts = [len(tok.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
            assert counts == [token_counts.count_at(r.prefix_table, i) for i in range(len(text) + 1)]
            assert r.cut_chars == max(i for i, n in enumerate(counts) if n <= 5)


def test_language_model(docs):
    model = katz.train_katz(docs.filter("doc_id is null or doc_id <> 8"))
    out = katz.score_katz(docs, model)
    assert out.count() == docs.count()
    got = {r.doc_id: r for r in out.collect()}
    if docs.count():
        assert (got[1].n_tokens, got[8].n_known, got[4].n_tokens) == (1, 1, 30_002)
        assert all(r.score < 0 and r.base_score < 0 for r in got.values())


@pytest.mark.parametrize("seen", ["all but one", "none"])
def test_backoff_model(docs, seen):
    """The model of the query: clashing names, no rows to learn from, a text of 30,001 words, nulls and repeats."""
    clashing = docs.withColumns({c: F.lit("other") for c in ("score", "base_score", "n_known", "gram", "key", "part", "n", "context")})
    model = backoff.train_backoff(clashing.filter("doc_id is null or doc_id <> 8" if seen != "none" else "false"))
    out = backoff.score_backoff(clashing, model)
    assert out.count() == docs.count()
    rows = out.collect()
    got = {r.doc_id: r for r in rows}
    if docs.count():
        assert (got[1].n_tokens, got[4].n_tokens) == (1, 30_002)
        # Where nothing was learnt, every token has the chance 1: c, N and V are 0.
        assert all((r.score < 0 and r.base_score < 0) if seen != "none" else (r.n_known, r.base_score) == (0, 0) for r in rows)
        assert all(math.isfinite(r.score) for r in rows)
        assert seen == "none" or (got[8].n_known, got[1].n_known) == (1, 1)


def test_site_quality(docs, labels, sites):
    out = site_quality.judge_sites(docs, labels, sites)
    assert out.count() == docs.count()
    assert all(0 <= r.posterior <= 1 and r.kept == (r.posterior >= 0.5) for r in out.collect())


def test_decontamination(docs, spark):
    items = spark.createDataFrame([("b", "Eight, nine ten ELEVEN"), ("a", None), (None, "one two"), ("c", "!!"), ("d", "x y z"), ("b", "six seven")], "item_id string, text string")
    out = decontaminate.mark_contained(docs, items)
    assert out.count() == docs.count()
    found = [r for r in out.collect() if r.found_items]
    assert {(r.doc_id, r.n_words, tuple(r.hit_words), tuple(r.found_items)) for r in found} <= {(i, 12, (5, 6, 7, 8, 9, 10), ("b",)) for i in (5, 6)}
    assert len(found) == (3 if docs.count() else 0)
    assert decontaminate.mark_contained(docs, items.limit(0)).filter(F.size("hit_words") > 0).count() == 0


def test_quality_rules(docs):
    out = weak_rules.judge_quality(docs)
    assert out.count() == docs.count()
    assert all(r.base_failed and not r.kept for r in out.collect() if r.n_words < 10)


def test_packing(docs):
    rows = packing.pack_documents(docs, WORDS, capacity=64, node_rows=300, fan_in=2, keep_ids=True).collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.start == 0 for r in rows) == docs.count()
    assert len(places) <= 1.05 * sum(r.length for r in rows) / 64 + 1


def test_language(docs, sites):
    out = language.fused_languages(docs, sites)
    assert out.count() == docs.count()
    assert {r.language for r in out.collect()} <= {"en"}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language.fused_languages(unlabelled, sites).filter("language is not null").count() == 0


def test_ngram_join(docs):
    got = by_row(ngram_join.linked_documents(docs), "class_id", "n_links")
    assert len(got) == docs.count()
    if docs.count():
        assert (5, 5, 2) in got and got.count((6, 5, 2)) == 2 and got.count((2, 2, 0)) == 2
        assert [r[1:] for r in got if r[0] is None] == [(None, 0)] * 2
    kept = ngram_join.one_of_each_class(docs)
    assert kept.columns == docs.columns
    assert kept.count() == (9 if docs.count() else 0)


def test_toxicity(docs, labels):
    out = toxicity.grade_toxicity(docs, labels)
    assert out.count() == docs.count()
    assert all(0 <= r.expected_severity <= 3 for r in out.collect())
    assert toxicity.grade_toxicity(docs, labels.limit(0)).filter("toxic").count() == 0
