"""Splitting many texts into the words of a public vocabulary, over NumPy arrays.

Both vocabularies in use split text into letter runs, digits, runs of other
marks and white space, and cut off English contractions. Here the rule is applied
to whole arrays of code points instead of one match after another.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from tunelake.llm.rows import worker_cache

BLANK, LETTER, DIGIT, MARK = range(4)
QUOTE = ord("'")
LAST_LETTER = 0x40000  # the planes from here on hold no letters, digits or blanks
# The vocabularies' contractions.
SHORT_TAILS, LONG_TAILS = ("s", "t", "m", "d"), ("re", "ve", "ll")


def classes() -> np.ndarray:
    """Class of every code point, as the library that the vocabularies are for sees it."""
    cache = worker_cache()
    if "classes" not in cache:
        from tokenizers import Regex, pre_tokenizers

        table = np.full(0x110000, MARK, np.uint8)
        for kind, pattern in ((BLANK, r"\s+"), (LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
            split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
            for block in range(0, LAST_LETTER, 0x800):
                if not 0xD800 <= block < 0xE000:
                    for _, (a, b) in split.pre_tokenize_str("".join(map(chr, range(block, block + 0x800)))):
                        table[block + a:block + b] = kind
        cache["classes"] = table
    return cache["classes"]


class Runs(NamedTuple):
    points: np.ndarray  # code points of all texts
    offsets: np.ndarray  # first code point of each text, and the end
    byte_at: np.ndarray  # byte of each code point, and the end
    data: bytes  # UTF-8 of all texts
    start: np.ndarray  # code point where each run starts; the next run starts where it ends
    kind: np.ndarray  # class of each run
    contraction: np.ndarray  # whether it is one


def runs(texts: list[str], single_digits: bool, blank_joins: bool) -> Runs:
    """Runs of one class, with contractions apart and texts never joined.

    single_digits  every digit is a run of its own
    blank_joins    a space before a quote keeps it from starting a contraction
    """
    joined = "".join(texts)
    data = joined.encode("utf-8", "replace")
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    byte_at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    n = len(points)
    kinds = classes()[points]
    new = np.ones(n + 1, bool)
    new[1:n] = kinds[1:] != kinds[:-1]
    new[offsets] = True
    if single_digits:
        new[:n] |= kinds == DIGIT
    marked = np.zeros(n + 1, bool)
    quotes = np.flatnonzero((points == QUOTE) & new[:n])
    if blank_joins:
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        quotes = quotes[first[quotes] | (points[quotes - 1] != 0x20)]
    ends_at = offsets[np.searchsorted(offsets, quotes, side="right")] if quotes.size else quotes
    padded = np.concatenate([points, np.zeros(3, np.uint32)])
    one = np.isin(padded[quotes + 1], [ord(c) for c in SHORT_TAILS]) & (quotes + 2 <= ends_at)
    two = np.zeros(len(quotes), bool)
    for a, b in LONG_TAILS:
        two |= (padded[quotes + 1] == ord(a)) & (padded[quotes + 2] == ord(b)) & (quotes + 3 <= ends_at)
    for chosen, size in ((quotes[one], 2), (quotes[two], 3)):
        marked[chosen] = True
        new[chosen + 1] = False
        new[chosen + size] = True
    start = np.flatnonzero(new[:n])
    return Runs(points, offsets, byte_at, data, start, kinds[start], marked[start])
