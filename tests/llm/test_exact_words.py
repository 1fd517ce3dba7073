"""Words that weak hashes take for one, and every code point, against the libraries."""

import numpy as np
import pyarrow as pa
import pytest

import public_tokenizers
from tunelake.llm import bytewords, decontaminate, ngram_join, packing, textstats, token_counts

SWAP = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
SWAPPED = SWAP.translate(str.maketrans("ab", "ba"))
POINTS = [chr(i) for i in range(0x40000) if not 0xD800 <= i < 0xE000]


@pytest.fixture(scope="module")
def libraries():
    from tokenizers import Tokenizer

    return [Tokenizer.from_file(public_tokenizers.path(f"{x}.json")) for x in ("byte_bpe_50k", "word_bpe_49k")]


@pytest.mark.parametrize("shape", ["a{0}b", " {0}'re"])
def test_every_code_point(libraries, shape):
    texts = [shape.format("".join(x)) for x in np.array_split(np.array(POINTS, dtype=object), 30_000)] + [shape.format(c) for c in POINTS[:0x3000]]
    counts = token_counts.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json")).tables(texts)
    ids = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json")).encode(texts)
    for text, table, own, a, b in zip(texts, counts, ids, *(t.encode_batch(texts, add_special_tokens=False) for t in libraries), strict=True):
        assert token_counts.count_at(table, len(text)) == len(a.ids), text
        assert np.frombuffer(own, "<u4").tolist() == b.ids, text


def test_exchanged_letters(spark, libraries):
    ids = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json")).encode([SWAP, SWAPPED])
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [libraries[1].encode(x, add_special_tokens=False).ids for x in (SWAP, SWAPPED)]
    stats = dict(zip(textstats.NAMES, textstats.stats_of(pa.array([f"{SWAP}\n{SWAPPED}"])), strict=True))
    assert stats["n_dup_lines"].tolist() == [0]
    docs = spark.createDataFrame([(1, SWAP), (2, SWAPPED)], "doc_id long, text string")
    marked = decontaminate.mark_contained(docs, docs.filter("doc_id = 1").withColumnRenamed("doc_id", "item_id"))
    assert {r.doc_id: len(r.hit_words) for r in marked.collect()} == {1: 1, 2: 0}
    assert ngram_join.linked_documents(docs).filter("n_links > 0").count() == 0


def test_spans_under_one_key():
    """Different contents with one key, or one content of two kinds, are told apart by comparison."""
    data = np.frombuffer(b"abcabdabc" + b"q" * 100 + b"q" * 99 + b"r" + b"q" * 100, np.uint8)
    start, size = np.array([0, 3, 6, 9, 109, 209]), np.array([3, 3, 3, 100, 100, 100])
    for kind, want in ((None, [0, 1, 0, 2, 3, 2]), (np.array([0, 0, 1, 0, 0, 0]), [0, 1, 2, 3, 4, 3])):
        one, which = bytewords.distinct_spans(data, start, start + size, np.zeros(6, np.uint64), kind)
        names: dict = {}
        assert [names.setdefault(int(w), len(names)) for w in which] == want
        assert all(which[i] == k for k, i in enumerate(one))


def test_line_dedup_of_many_lines(spark):
    """Two texts of 60,000 lines, one a copy: time in proportion to the lines."""
    import time

    from tunelake.llm import line_dedup

    text = "\n".join(f"line {i}" for i in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, text + "\nlast"), (3, "line 7\nline 8\nline 9\nown")], "doc_id long, text string")
    began = time.monotonic()
    got = {r.doc_id: r for r in line_dedup.remove_repeated_lines(docs).collect()}
    assert time.monotonic() - began < 30
    assert got[1].text == text and (got[2].text, got[2].n_removed) == ("last", 60_000) and got[3].text == "own"


def test_packing_does_not_depend_on_room_in_nodes(spark, sf_dir):
    """Small nodes deal what they cannot hold over more nodes: few more sequences than one node needs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    n = {rows: packing.pack_documents(docs, vocabulary, capacity=512, node_rows=rows).select("sequence_id").distinct().count() for rows in (20_000, 60)}
    assert n[20_000] <= n[60] <= 1.03 * n[20_000]
