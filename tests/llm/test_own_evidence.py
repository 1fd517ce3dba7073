"""Site posteriors against plain computations in which a document's own part is left out."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tunelake.llm import language, site_quality

GOOD = "The house is on the hill and it was built of stone by the people of the town. "
TEXTS = {"de": "der hund und die katze sind nicht im haus ", "en": "the dog and the cat are not in the house ", "none": "123 456 "}


def corpus(seed):
    """Documents, some ids twice, with none to three pages on hosts of one to many documents."""
    rnd = random.Random(seed)
    docs = [(i, rnd.choice(list(TEXTS))) for i in range(70)] + [(3, "de"), (3, "en"), (None, "en")]
    pages = []
    for i in range(75):
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            k = min(int(rnd.expovariate(0.5)), 9)
            host = rnd.choice([f"h{k}.site{k % 3}.de", f"h{k}.site{k % 2}.com", f"only{i}.net", None])
            pages.append((i, host, rnd.choice(["a", "b", None]), host and host.rsplit(".")[-1], rnd.choice(["de", "en", None])))
    return docs, [*pages, pages[0], pages[0], (None, "h1.site1.de", "a", "de", "de")]


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def pulled(groups, around):
    """Strength of a draw: what the groups' rates spread beyond a binomial's noise."""
    spread = sum(n * (s / n - around[g]) ** 2 for g, (n, s) in groups.items())
    noise = sum(around[g] * (1 - around[g]) for g in groups)
    scale = sum(n * around[g] * (1 - around[g]) for g, (n, _) in groups.items())
    between = max(spread - noise, 0)
    if len(groups) < 2:
        return site_quality.MAX_STRENGTH
    return min(max(scale / between if between > 0 else site_quality.MAX_STRENGTH, site_quality.MIN_STRENGTH), site_quality.MAX_STRENGTH)


@pytest.mark.parametrize("seed", [1, 2])
def test_site_quality(spark, seed):
    rnd = random.Random(seed)
    kinds, pages = corpus(seed)
    docs = [(i, (GOOD if k == "de" else "$$ BUY!!! %% || ") * rnd.randint(1, 3)) for i, k in kinds]
    labels = [(i, int(k == "de")) for i, k in kinds[:50]]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = site_quality.judge_sites(
        frame(docs, "doc_id long, text string"), frame(labels, "doc_id long, quality int"),
        frame([(i, h, p) for i, h, p, _, _ in pages], "doc_id long, host string, path string")).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in docs)
    base = (sum(q for _, q in labels) + 1) / (len(labels) + 2)
    chances = [(r.doc_id, sigmoid(r.evidence + math.log(base / (1 - base)))) for r in got]
    top = np.mean([c for _, c in chances])
    entries = [(i, h, p or "", c) for i, h, p, _, _ in pages if h and i is not None for j, c in chances if j == i]
    sums = lambda key, rows: {k: (len(v), sum(v)) for k, v in grouped(key, rows).items()}

    def grouped(key, rows):
        out = defaultdict(list)
        for e in rows:
            out[key(e)].append(e[3])
        return out

    hosts, paths = sums(lambda e: e[1], entries), sums(lambda e: e[1:3], entries)
    pull = pulled(hosts, dict.fromkeys(hosts, top))
    rate = lambda rows, k, above: (sum(e[3] for e in rows) + k * above) / (len(rows) + k)
    host_rate = {h: (s + pull * top) / (n + pull) for h, (n, s) in hosts.items()}
    path_pull = pulled(paths, {g: host_rate[g[0]] for g in paths})
    odds = lambda p: math.log(p / (1 - p))
    for r in got:
        own = [(h, p or "") for i, h, p, _, _ in pages if i == r.doc_id and h and i is not None]
        want = (top, top)
        if own:
            others = [e for e in entries if e[0] != r.doc_id]
            per_host = [rate([e for e in others if e[1] == h], pull, top) for h, _ in own]
            per_path = [rate([e for e in others if e[1:3] == hp], path_pull, above) for hp, above in zip(own, per_host, strict=True)]
            want = tuple(sigmoid(np.mean([odds(x) for x in rates])) for rates in (per_host, per_path))
        assert (r.host_rate, r.path_rate) == pytest.approx(want, rel=1e-6)
        assert r.posterior == pytest.approx(sigmoid(r.evidence + odds(want[1])), rel=1e-6)


@pytest.mark.parametrize("seed", [1, 2])
def test_language(spark, seed):
    rnd = random.Random(seed)
    kinds, pages = corpus(seed)
    rows = [(i, TEXTS[k] * rnd.randint(1, 2), k if k != "none" else None) for i, k in kinds]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_languages(docs, "lang", "doc_id", "text", 1_000)
    scores = [(r.doc_id, np.array(r.s)) for r in docs.select("doc_id", language.text_scores(model, docs["text"]).alias("s")).collect()]
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    sites = spark.createDataFrame([(i, h, s, d) for i, h, _, s, d in pages], "doc_id long, host string, suffix string, declared string")
    got = Counter((r.doc_id, r.language, round(r.probability, 6)) for r in language.fused_languages(docs, sites, model=model).collect())

    shares = sum(soft(s) for _, s in scores) + 1
    shares /= shares.sum()
    domain = lambda h: ".".join(h.split(".")[-3:])
    value = {"host": lambda p: p[1], "domain": lambda p: p[1] and domain(p[1]), "suffix": lambda p: p[3], "declared": lambda p: p[4]}

    def others(kind, v, i):
        """Posteriors of other documents with a value, one for each page, or those of all values if none is given."""
        return [soft(s) for p in pages for j, s in scores if p[0] is not None and j == p[0] and j != i and value[kind](p) is not None and v in (None, value[kind](p))]

    def says(kind, p):
        v, i = value[kind](p), p[0]
        if v is None:
            return None
        own = sum(others(kind, v, i), np.zeros(2))
        if kind == "host":
            above = sum(others("domain", domain(v), i), np.zeros(2))
            above = (above + language.PULL * shares) / (above.sum() + language.PULL)
            return np.log((own + language.PULL * above) / (own.sum() + language.PULL))
        every = sum(others(kind, None, object()), np.zeros(2))
        if not others(kind, v, i):
            return None
        return np.log((own + language.PULL * own.sum() / every.sum()) / (every + language.PULL))

    want = Counter()
    for i, s in scores:
        total = s
        for kind in ("host", "suffix", "declared"):
            heard = [x for p in pages if i is not None and p[0] == i and (x := says(kind, p)) is not None]
            total = total + (np.mean(heard, axis=0) if heard else np.log(shares) if kind == "host" else 0)
        p = soft(total)
        want[i, model.languages[int(p.argmax())], round(float(p.max()), 6)] += 1
    assert got == want
