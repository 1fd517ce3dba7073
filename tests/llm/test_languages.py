"""More languages than any fixed number of them."""

from tunelake.llm import language


def test_every_labelled_language_can_be_found(spark):
    names = [f"l{k:02}" for k in range(70)]
    word = lambda k: " ".join(chr(97 + k // 26) + chr(97 + k % 26) + c for c in "qrst")
    rows = [(3 * k + i, word(k), names[k]) for k in range(70) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_languages(docs, "lang", "doc_id", "text", 2)
    assert model.languages == names
    for r in docs.select("lang", language.text_scores(model, docs["text"]).alias("s")).collect():
        assert model.languages[max(range(70), key=lambda k: r.s[k])] == r.lang
