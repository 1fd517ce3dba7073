"""Documents that stand on several pages."""

import pytest

from tunelake.llm import language, queries, site_quality


def test_every_page_is_a_row(spark):
    pages = spark.createDataFrame([(1, "https://a.de/x/7", "<html lang=de>"), (2, "https://b.org/y/7.html", ""), (3, "https://b.org/about", "")], "page_id long, url string, html string")
    assert sorted(map(tuple, queries.page_sites(pages).collect()), key=str) == [(7, "a.de", "x", "de", "de"), (7, "b.org", "y", "org", None)]


def test_later_pages_speak_too(spark):
    """A text that says nothing; only its second page declares a language and has a host with other texts."""
    docs = spark.createDataFrame(
        [(i, "der die und ist nicht" if i < 20 else "the and of is not", "de" if i < 20 else "en") for i in range(50)] + [(100, "123 456", None)],
        "doc_id long, text string, lang string")
    sites = spark.createDataFrame(
        [(i, "h.example.de" if i < 20 else "h.example.com", None, None) for i in range(50)] + [(100, None, None, None), (100, "h.example.de", None, None)],
        "doc_id long, host string, suffix string, declared string")
    assert {r.doc_id: r.language for r in language.fused_languages(docs, sites).collect()}[100] == "de"


def test_a_document_takes_the_mean_log_odds_of_its_pages(spark):
    good, bad = "The house is on the hill and it was built of stone by the people. " * 5, "$$ ## BUY!!! %% || "
    docs = spark.createDataFrame([(i, good if i < 30 or i == 60 else bad * (i % 3 + 1)) for i in range(61)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id < 30 or doc_id = 60 as int) quality")
    sites = [(i, "good" if i < 30 else "bad", None) for i in range(61)]
    got = {r.doc_id: r for r in site_quality.judge_sites(docs, labels, spark.createDataFrame([*sites, (0, "bad", "p")], "doc_id long, host string, path string")).collect()}
    assert len(got) == 61 and got[40].host_rate < got[0].host_rate < got[1].host_rate
    odds = lambda p: p / (1 - p)
    # 1 has the text of 0 and stands on the one host, 60 on the other; each is judged by the others there.
    assert odds(got[0].host_rate) ** 2 == pytest.approx(odds(got[1].host_rate) * odds(got[60].host_rate))
