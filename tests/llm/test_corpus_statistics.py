"""Collocations, source divergence and mixing against plain computations and on edge cases."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunelake.llm import collocations, divergence, mixing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "Lorem ipsum dolor. " * 300 + "x" * 100_000 + " " + " ".join(f"w{i}" for i in range(500))
# Two words that a polynomial hash modulo 2**64 takes for one.
SWAP = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
SWAPPED = SWAP.translate(str.maketrans("ab", "ba"))
ROWS = [
    (1, None, None, None), (2, "", "", ""), (2, "", "", ""), (3, " .,; \n\t ", "en", "a"), (4, LONG, "en", "a"), (4, LONG, "en", "a"),
    (5, "The red fox; the red fox. THE RED FOX runs", "en", "b"), (6, "the red\tfox the red fox runs", "en", "b"), (None, "the red fox", "en", None),
    (7, "Ä ö ä é ä ö straße straße", "de", "b"), (8, "ä ö ä ö straße Straße abcdefghijklmnopq", "de", "c"), (9, "Ä ö abcdefghijklmnopq abcdefghi", "de", "c"),
    (10, f"{SWAP} {SWAPPED} {SWAP} {SWAPPED} {SWAP}", "xx", "a"), (11, f"{SWAPPED} {SWAPPED}", "xx", "b"), (12, f"{SWAP} abcdefghi", "xx", "b"),
    (13, "one two", "und", "b"), (14, "one two", None, "a"), (15, "alone", "zz", "only"),
]
CLASHES = ("k", "n", "a", "phrase", "size", "target", "taken", "rank", "part", "item", "value", "_id", "_size", "term")


@pytest.fixture(scope="module", params=["rows", "none"])
def docs(spark, request):
    rows = ROWS if request.param == "rows" else []
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("other") for c in CLASHES}).repartition(3).cache()


def plain_collocations(rows, least, top):
    grams, total = {}, Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                grams.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in grams.items():
        good = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        best = []
        for g, a in good.items():
            if any(b >= a and len(h) > len(g) and any(h[i:i + len(g)] == g for i in range(len(h))) for h, b in good.items()):
                continue
            score, cut = min((1000 * a * total[lang] // (f[g[:c]] * f[g[c:]]), c) for c in range(1, len(g)))
            best.append((-score, -a, " ".join(g).encode(), lang, a, f[g[:cut]], f[g[cut:]], total[lang]))
        out += [(x[3], i, x[2].decode(), x[4], x[5], x[6], x[7], -x[0]) for i, x in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("budget", [2_000_000, 100])
def test_collocations(docs, budget):
    """A budget of 100 extends prefixes to their full length, so counts of shorter phrases meet from several groups."""
    rows = ROWS if docs.count() else []
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=2, top=30, budget=budget).collect())
    assert got == plain_collocations(rows, 2, 30)


def plain_audit(rows, top, least):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x60\x7b-\x7f]+", (text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        whole = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for s, c in counts.items():
            pairs = [(-sum((share(c, t) - share(d, t)) ** 2 // share(d, t) for t in kept), o.encode()) for o, d in counts.items() if o != s]
            terms = [(-((share(c, t) - share(whole, t)) ** 2 // share(whole, t)), t.encode()) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def test_audit(docs):
    got = sorted(tuple(r) for r in divergence.audit(docs, top=3, least_docs=2).collect())
    assert got == plain_audit(ROWS if docs.count() else [], 3, 2)


def test_shares_of_large_counts():
    import numpy as np

    n, total = np.array([[9 * 10**12, 0, 5]]), np.array([[10**13]])
    assert divergence.shares(n, total, 77).tolist() == [[1 + 10**9 * (x + 1) // (10**13 + 77) for x in n[0].tolist()]]


def plain_targets(sizes, cap=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, full = sum(sizes.values()), {}
    while True:
        rest = {s: w for s, w in weight.items() if s not in full}
        over = {s: cap * sizes[s] for s, w in rest.items() if cap * sizes[s] * sum(rest.values()) < w * (left - sum(full.values()))}
        if not over:
            return {s: full[s] if s in full else (left - sum(full.values())) * w / max(1, sum(rest.values())) for s, w in weight.items()}
        full |= over


def check_mix(rows, got, slack):
    """Sizes, targets, whole copies below the cap, and sums near the targets."""
    sizes, source_of, taken = Counter(), {}, Counter()
    for i, text, _, source in rows:
        n = len(re.findall("[^\x20\x09-\x0d]+", text or ""))
        sizes[source] += n
        source_of[i, n] = source
    want = plain_targets(sizes) if rows else {}
    assert len(got) == len(rows)
    for r in got:
        source = source_of[r.doc_id, r.size]
        assert r.source_size == sizes[source] and abs(r.target - want[source]) <= 1e-9 * max(1, r.target)
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        taken[source] += r.taken
    for source, t in want.items():
        assert abs(taken[source] - t) <= slack(source), source


@pytest.mark.parametrize("node_rows", [20_000, 2])
def test_mixing_edges(docs, node_rows):
    rows = ROWS if docs.count() else []
    largest = {s: max(len((t or "").split()) for _, t, _, x in rows if x == s) for s in {r[3] for r in rows}}
    got = mixing.mix_sources(docs, node_rows=node_rows, fan_in=2)
    check_mix(rows, got.collect(), lambda s: largest[s] / 2 + 1e-6)
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix_sources(docs.repartition(5), node_rows=node_rows, fan_in=2).collect()))


def test_mixing_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in docs.collect()]
    largest = {s: max(len(t.split()) for _, t, _, x in rows if x == s) for s in {r[3] for r in rows}}
    check_mix(rows, mixing.mix_sources(docs, node_rows=30, fan_in=3).collect(), lambda s: largest[s] / 2 + 1e-6)


def test_many_rows_alike(spark):
    """Rows alike beyond a chunk; each source's words are exact but for half a row."""
    rows = [(1, "a b c", None, "x")] * 2_500 + [(2, "a b", None, "y")] * 700 + [(3, "a " * i, None, "z") for i in range(1, 60)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), node_rows=10).collect()
    check_mix(rows, got, lambda s: {"x": 1.5, "y": 1, "z": 30}[s] + 1e-6)


def test_settling_keeps_expectations():
    """Over many draws each item is rounded up about as often as its part says, and the words taken stay the same."""
    import numpy as np

    rng = np.random.default_rng(5)
    size, part = np.array([9.0, 7.0, 4.0, 4.0, 2.0, 1.0]), np.array([0.3, 0.3, 0.6, 0.1, 0.5, 0.9])
    mean = np.zeros(len(size))
    for _ in range(4_000):
        up, held, have = mixing.settle(size, part, rng.random(len(size)))
        mean += up if held < 0 else np.where(np.arange(len(size)) == held, have, up)
        assert abs((up * size).sum() + (have * size[held] if held >= 0 else 0) - (size * part).sum()) < 1e-6
    assert np.abs(mean / 4_000 - part).max() < 0.03
