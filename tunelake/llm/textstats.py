"""Counts of a text that quality rules and classifiers read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tunelake.llm.bytewords import SPACE, buffers, rolling, words
from tunelake.llm.rows import slices

NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_bangs", "n_stops", "n_digits")
WINDOW = 5
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True


def class_of(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


SYMBOLS = class_of("#*$%&|<>")
UPPER, LOWER = class_of("".join(map(chr, range(65, 91)))), class_of("".join(map(chr, range(97, 123))))
BANGS, STOPS, DIGITS = class_of("!"), class_of(".?"), class_of("0123456789")


def repeats(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: how often its (doc, key) occurs, and whether it is the first of them."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    group = np.cumsum(new) - 1
    times = np.bincount(group) if len(group) else np.zeros(0, np.int64)
    count, first = np.empty(len(d), np.int64), np.empty(len(d), bool)
    count[order], first[order] = times[group], new
    return count, first


def stats_of(texts: pa.Array) -> list[np.ndarray]:
    """One array per name in NAMES."""
    n = len(texts)
    data, offsets = buffers(texts)
    w = words(texts, SPACE, lower=False)

    def per_text(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    solid = ~SPACE[data]
    lines = words(texts, NEWLINE, lower=False)
    solid_sums = np.concatenate([[0], np.cumsum(solid)])
    full = solid_sums[lines.end] > solid_sums[lines.start]
    line_doc = lines.doc[full]
    _, first_line = repeats(line_doc, lines.hash[full])
    grams = rolling(w.hash, WINDOW)
    own = w.doc[:len(grams)]
    inside = np.flatnonzero(np.arange(len(grams)) + WINDOW <= w.first[own + 1])
    times, _ = repeats(own[inside], grams[inside])
    cover = np.zeros(len(w.hash) + 1, np.int64)
    starts = inside[times > 1]
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    repeated = np.cumsum(cover)[:-1] > 0
    return [
        np.diff(w.first), per_text(solid & ((data & 0xC0) != 0x80)), per_text(SYMBOLS[data]), np.bincount(line_doc, minlength=n),
        np.bincount(line_doc[~first_line], minlength=n), np.bincount(w.doc[repeated], minlength=n),
        *(per_text(table[data]) for table in (UPPER, LOWER, BANGS, STOPS, DIGITS))]


def _counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        parts = [stats_of(texts[a:b]) for a, b in slices(texts)]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64) for _ in NAMES]
        yield pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], list(NAMES))


def text_stats(text: Column) -> Column:
    """A struct of all counts; null counts as empty.

    Words are runs without white space of ASCII. n_lines counts lines with a word,
    n_dup_lines those equal to an earlier one of the text, n_repeat_words the words
    inside 5-word windows that the text has twice or more.
    """
    return arrow_udf(_counted, T.StructType([T.StructField(n, T.LongType()) for n in NAMES]))(text.cast("string"))
