"""Operators against brute force on the smallest tables and on planted cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tunelake.llm import components, katz, language, ngram_join, packing, queries, textstats, token_counts, toxicity, weak_rules

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_prefix_tables_of_odd_texts():
    counter = token_counts.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    parts = ["a", "b", "'", " ", "  ", "\n", "s", "re", "1", "23", ".", "é", "ñ", "<|endoftext|>", "日", "ll", "\t", "!", "x" * 60, "\x85", "🙂"]
    odd = ["", "don't 'Re 're \n're", "abc.<|endoftext|> x<|endo", "| " * 90, *("".join(rng.choices(parts, k=rng.randint(1, 20))) for _ in range(150))]
    for text, table in zip(odd, counter.tables(odd), strict=True):
        want = [len(counter.tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert np.cumsum(np.frombuffer(table, np.int8)).tolist() == want


def test_tokens_of_whole_texts(spark, sf_dir, texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op2_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


@pytest.mark.parametrize("vocabulary, hot", [(1 << 18, 1 << 19), (2_000, 300)])
def test_katz_model_and_scores(docs, texts, monkeypatch, vocabulary, hot):
    monkeypatch.setattr(katz, "PART_TOKENS", 20_000)
    model = katz.train_katz(docs.filter(~katz.held_out("doc_id")), vocabulary=vocabulary, hot_bigrams=hot)
    got = {r.doc_id: r for r in katz.score_katz(docs, model).collect()}
    tokens = {i: [*SPACE.findall(lowered(t)), None] for i, t in texts.items()}
    train = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    code = {w: int(katz.END) if w is None else int(katz.tokens_of(pa.array([w], pa.large_string()))[0][0]) for w in count}
    known, size = dict(zip(model.hashes.tolist(), model.ids.tolist(), strict=True)), len(model.hashes)
    number = lambda w: known.get(code.get(w, -1), size)
    d1 = katz.discounts(Counter(count.values()))
    p = {number(w): (d1[c] if c <= 5 else 1) * c / n for w, c in count.items() if number(w) < size}
    rest = max(1 - sum(p.values()), 1 / (n + 1))
    p = {k: x * (1 - rest) / sum(p.values()) for k, x in p.items()} | {size: rest}
    pairs = Counter((size + 1 if a is ... else number(a), number(b)) for t in train for a, b in zip([..., *t], t, strict=False))
    d2, total, mass, lower = katz.discounts(Counter(pairs.values())), Counter(), defaultdict(float), defaultdict(float)
    for (a, b), c in pairs.items():
        total[a] += c
        if c > 1:
            mass[a] += (d2[c] if c <= 5 else 1) * c
            lower[a] += p[b]
    scale = {a: min(1, total[a] / (total[a] + 1) / (mass[a] / total[a])) for a in mass}
    bow = {a: (1 - scale[a] * mass[a] / total[a]) / (1 - lower[a]) for a in mass}
    for a in list(mass)[:30]:  # every context sums to one
        kept = sum(scale[a] * (d2[c] if c <= 5 else 1) * c / total[a] for (x, _), c in pairs.items() if x == a and c > 1)
        assert kept + bow[a] * (1 - lower[a]) == pytest.approx(1)
    unseen = [c for w, c in count.items() if number(w) == size]

    def log_p(a, w):
        x, y = size + 1 if a is ... else number(a), number(w)
        c = pairs[x, y]
        q = scale[x] * (d2[c] if c <= 5 else 1) * c / total[x] if c > 1 else bow.get(x, 1) * p[y]
        return math.log10(q * ((count[w] + 1) / (sum(unseen) + len(unseen) + 1) if y == size else 1))

    for i, t in tokens.items():
        assert (got[i].n_tokens, got[i].n_known) == (len(t), sum(count[w] > 0 for w in t))
        assert got[i].base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t))
        assert got[i].score == pytest.approx(sum(log_p(a, w) for a, w in zip([..., *t], t, strict=False)))
    if vocabulary > 2_000:
        held = [r for i, r in got.items() if zlib.crc32(str(i).encode()) % 7 == 2]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_site_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op4_quality_classifier(spark, sf).join(labels, "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.95


def test_rule_counts(spark, sf_dir, texts):
    for r in queries.op6_quality_rules(spark, sf_dir).collect():
        words = SPACE.findall(texts[r.doc_id])
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        times = Counter(grams)
        inside = {j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 5)}
        lines = [x for x in texts[r.doc_id].split("\n") if SPACE.search(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(inside))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", texts[r.doc_id]))
        assert r.base_failed == (len(words) < 10 or 100 * len(inside) > 20 * len(words)) and not (r.base_failed and r.kept)


def test_rule_accuracies_are_found():
    """Votes drawn from known accuracies; a rule that guesses gets no weight."""
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.85, 0.5]
    votes = np.column_stack([np.where(rng.random(20_000) < a, good, ~good) * 2 - 1 for a in accuracy])
    votes[rng.random(votes.shape) < 0.3] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak_rules.estimate(patterns.astype(float), counts)
    assert model.prior == pytest.approx(0.8, abs=0.03)
    assert model.accuracy()[:3] == pytest.approx(accuracy[:3], abs=0.03) and abs(model.weights()[3]).max() < 0.3


def test_packing_round_trip(spark, sf_dir, texts):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=512, node_rows=50, fan_in=2, keep_ids=True).collect()
    whole, sequences = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.length, r.ids_crc32, r.start) == (len(ids), zlib.crc32(r.ids), len(whole[r.doc_id]))
        whole[r.doc_id] += ids
        sequences[r.sequence_id].append((r.offset, r.length))
    assert dict(whole) == {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    for own in sequences.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert ends[-1] <= 512 and [o for o, _ in sorted(own)] == [0, *ends[:-1]]
    assert len(sequences) <= math.ceil(sum(r.length for r in rows) / 512) * 1.02 + 1


def test_language_of_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit_languages(docs.filter("doc_id % 3 <> 0"), "lang", "doc_id", "text", 100)
    out = language.fused_languages(docs, queries.page_sites(spark.read.parquet(f"{sf}/pages.parquet")), model=model)
    rows = out.join(docs.filter("doc_id % 3 = 0").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.language == r.lang for r in rows]) > 0.99


def test_sites_speak_for_texts_that_say_nothing(spark):
    docs = spark.createDataFrame(
        [(i, "der die und ist nicht" if i < 20 else "the and of is not", "de" if i < 20 else "en") for i in range(40)] + [(100, "123 456", None)],
        "doc_id long, text string, lang string")
    sites = spark.createDataFrame([(i, "h.example.de" if i < 20 else "h.example.com", "de" if i < 20 else "com", None) for i in range(40)]
                                  + [(100, "h.example.de", "de", "de")], "doc_id long, host string, suffix string, declared string")
    got = {r.doc_id: r.language for r in language.fused_languages(docs, sites).collect()}
    assert got[100] == "de" and got[0] == "de" and got[30] == "en"


def similar(texts, n=5):
    sets = []
    for t in texts:
        w = SPACE.findall(lowered(t or ""))
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return {(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}


@pytest.mark.parametrize("members", [1024, 7])
def test_ngram_join_finds_all_links(spark, monkeypatch, members):
    """A large group of near copies, in one block and in many."""
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", members)
    rng = random.Random(11)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts = []
    for _ in range(60):
        own = base[:]
        for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
            own[rng.randrange(120)] = f"x{rng.randrange(9999)}"
        texts.append(" ".join(own))
    texts += [" ".join(f"y{rng.randrange(5000)}" for _ in range(80)) for _ in range(30)] + [texts[0].upper(), "a b", "A  b"]
    rows = ngram_join.linked_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    links, lead = Counter(), list(range(len(texts)))
    for i, j in sorted(similar(texts)):
        links[i] += 1
        links[j] += 1
        a, b = lead[i], lead[j]
        lead = [min(a, b) if x in (a, b) else x for x in lead]
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == {i: (lead[i], links[i]) for i in range(len(texts))}


def test_band_plan_reaches_the_recall():
    for recall in (0.9, 0.99, 0.999):
        bands, rows = ngram_join.band_plan(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= ngram_join.MAX_HASHES


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100 + i, 100) for i in range(30)] + [(7, 7)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(51)} | {100 + i: 100 for i in range(30)}


def test_toxic_texts_of_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels.filter("doc_id % 3 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    scored = toxicity.score_toxicity(docs, model).join(labels.filter("doc_id % 3 = 0").withColumnRenamed("toxic", "label"), "doc_id")
    n = {(r.label, r.toxic): r["count"] for r in scored.groupBy("label", "toxic").count().collect()}
    assert n[1, True] > 0.85 * (n[1, True] + n.get((1, False), 0)) and n.get((0, True), 0) <= 0.005 * n[0, False]


def test_grades_rise_with_severity():
    rng = np.random.default_rng(1)
    grade = rng.integers(0, 4, 400)
    doc = np.concatenate([np.arange(400), np.flatnonzero(grade >= 1), np.flatnonzero(grade >= 2), np.flatnonzero(grade >= 3)])
    column = np.repeat([0, 1, 2, 3], [400, (grade >= 1).sum(), (grade >= 2).sum(), (grade >= 3).sum()])
    weights, thresholds = toxicity.fit_ordinal(doc, column, 4, grade, np.ones(400), 4, l2=0.01)
    score = np.bincount(doc, weights=weights[column], minlength=400)
    severity = toxicity.sigmoid(score[:, None] - thresholds).sum(axis=1)
    assert [round(severity[grade == g].mean()) for g in range(4)] == [0, 1, 2, 3]
