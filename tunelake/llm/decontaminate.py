"""Benchmark passages inside documents: a prefix-filtered containment join.

A window is a run of item words, and a document holds it only if it holds all of
its words in order. So one word of each window is enough to find candidates: the
rarest. Words of the benchmark are counted over all documents, each window is
entered under its rarest word (its necessary prefix at full containment), and a
document's words are looked up among these words alone. A hit at word p, for a
window whose rarest word stands at place o, can only start at p - o and must end
within the document; there, and only there, the window is compared word by word.

The benchmark is the query set. It is taken in blocks of bounded size; every block
is sent to all tasks and meets all documents in the same scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.bytewords import NOT_ALNUM, words
from tunelake.llm.rows import slices

BLOCK_BYTES = 8 << 20  # benchmark text in one block


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    w = words(pa.array(texts, pa.large_string()), NOT_ALNUM)
    return np.split(w.hash, w.first[1:-1])


def blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[str], list[np.ndarray]]]:
    """(ids, word hashes) of the items, block by block. Items without id or text are left out."""
    own = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).dropna()
    size = own.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // block_bytes)
    for i in range(n):
        rows = own.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).collect()
        yield [r.id for r in rows], item_words([r.text for r in rows])


def count_words(docs: DataFrame, text_col: str, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences of each word of a sorted vocabulary in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(texts):
                h = words(texts[a:b], NOT_ALNUM).hash
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["word", "n"])

    partial = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word long, n long")
    out = np.zeros(len(vocabulary), np.int64)
    for r in partial.groupBy("word").agg(F.sum("n").alias("n")).collect():  # no more rows than the block has words
        out[r.word] = r.n
    return out


class Windows:
    """The windows of one block of items, entered under their rarest words."""

    def __init__(self, items: list[np.ndarray], width: int, vocabulary: np.ndarray, frequency: np.ndarray):
        whole: dict[tuple[int, ...], set[int]] = {}
        for item, h in enumerate(items):
            size = min(width, len(h))
            for i in range(len(h) - size + 1 if size else 0):
                whole.setdefault(tuple(h[i:i + size].tolist()), set()).add(item)
        self.owners = [sorted(v) for v in whole.values()]
        rank = dict(zip(vocabulary.tolist(), frequency.tolist(), strict=True))
        self.size = np.array([len(t) for t in whole], np.int64)
        self.place = np.array([min(range(len(t)), key=lambda i: (rank[t[i]], i)) for t in whole], np.int64)
        self.words = np.zeros((len(whole), width), np.uint64)
        for i, t in enumerate(whole):
            self.words[i, :len(t)] = t
        rarest = self.words[np.arange(len(whole)), self.place] if whole else np.zeros(0, np.uint64)
        order = np.argsort(rarest, kind="stable")
        self.prefix, first = np.unique(rarest[order], return_index=True)
        self.first = np.append(first, len(order))
        self.order = order

    def find(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, window) of all occurrences in texts whose words lie between the entries of ``first``."""
        if not len(self.prefix) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.prefix, h), len(self.prefix) - 1)
        where = np.flatnonzero(self.prefix[at] == h)
        at = at[where]
        n = self.first[at + 1] - self.first[at]
        window = self.order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[at], n)]
        start = np.repeat(where, n) - self.place[window]
        doc = np.repeat(np.searchsorted(first, where, side="right") - 1, n)
        fits = (start >= first[doc]) & (start + self.size[window] <= first[doc + 1])
        start, window = start[fits], window[fits]
        for i in range(self.words.shape[1]):
            same = (i >= self.size[window]) | (h[np.minimum(start + i, len(h) - 1)] == self.words[window, i])
            start, window = start[same], window[same]
        return start, window


def mark_contained(
    docs: DataFrame, items: DataFrame, width: int = 10, text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add to each document which of its words lie in a window of an item, and of which items.

    n_words      words of the text: digits, letters a-z after lowering A-Z, and all beyond ASCII
    hit_words    places, from 0, of the words inside any occurrence of a window
    found_items  ids, as strings in order, of the items that own such a window

    An item of fewer words than ``width`` is one window. Null texts have no words;
    items without id or text and items without a word match nothing; items repeated
    under one id count once. Rows are independent, so repeated rows are each marked.
    Columns of the input that have one of these names are replaced.
    """
    taken = {"n_words", "hit_words", "found_items"}
    rows = docs.select(*[docs[c] for c in docs.columns if c.lower() not in taken])
    text = F.col(text_col).cast("string")
    out = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("hit_words"), F.array().cast("array<string>").alias("found_items"))
    schema = out.schema
    text_at = schema.fieldNames().index(text_col)
    if not str(schema[text_col].dataType).startswith("StringType"):
        raise TypeError(f"{text_col} must be a string column, not {text}")
    chunks = list(blocks(items, item_id_col, item_text_col, block_bytes)) or [([], [])]
    for ids, hashes in chunks:
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
        frequency = count_words(docs, text_col, vocabulary) if len(vocabulary) else np.zeros(0, np.int64)
        out = out.mapInArrow(marker(Windows(hashes, width, vocabulary, frequency), ids, text_at), schema)
    return out


def marker(windows: Windows, ids: list[str], text_at: int):
    """A pass over batches that adds one block's findings to the last three columns."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(text_at)):
                part = batch.slice(a, b - a)
                w = words(part.column(text_at), NOT_ALNUM)
                start, window = windows.find(w.hash, w.first)
                cover = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + windows.size[window] if len(start) else start, -1)
                hit = np.flatnonzero(np.cumsum(cover)[:-1])
                doc = w.doc[hit]
                place = hit - w.first[doc]
                hits = np.split(place, np.searchsorted(doc, np.arange(1, b - a)))
                owners = pd.Series([o for x in window for o in windows.owners[x]], dtype="int64").groupby(
                    np.repeat(w.doc[start], [len(windows.owners[x]) for x in window]) if len(start) else []).unique()
                found = {int(d): {ids[o] for o in own} for d, own in owners.items()}
                before_hits, before_found = part.column(len(part.schema) - 2).to_pylist(), part.column(len(part.schema) - 1).to_pylist()
                all_hits = [np.union1d(x, y) if y else x for x, y in zip(hits, before_hits, strict=True)]
                all_found = [sorted({*found.get(i, ()), *y}) for i, y in enumerate(before_found)]
                columns = part.columns[:-3] + [
                    pa.array(np.diff(w.first).astype(np.int64)), pa.array(all_hits, pa.list_(pa.int32())), pa.array(all_found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return mark
