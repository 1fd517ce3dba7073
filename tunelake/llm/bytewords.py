"""Words of many texts at once, as NumPy arrays over their UTF-8 bytes.

A word is a longest run of bytes outside a separator class. ``lower`` maps A-Z
to a-z only. Words have a 64-bit hash of their bytes, taken eight at a time; where
a result must be exact, ``distinct_spans`` and ``same_spans`` compare the bytes too.
"""

from __future__ import annotations

from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)  # all of ASCII but digits and a-z, after lowering
NOT_ALNUM[:128] = True
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

BASE = np.uint64(0x9E6C63D0876A3F35)  # odd, so that it has an inverse modulo 2**64
BASE_INVERSE = np.uint64(pow(0x9E6C63D0876A3F35, -1, 1 << 64))
BYTE_CODES = np.random.Generator(np.random.PCG64(20240917)).integers(0, 1 << 64, 256, dtype=np.uint64)


class Words(NamedTuple):
    start: np.ndarray  # byte where each word starts
    end: np.ndarray
    doc: np.ndarray  # row of each word
    hash: np.ndarray
    first: np.ndarray  # index of each row's first word, and the number of words at the end
    data: np.ndarray  # the bytes, lowered where asked
    offsets: np.ndarray  # of the rows in data

    def prefix_hash(self, n_bytes: int) -> np.ndarray:
        """Hash of each word's first bytes, the whole word where it is shorter."""
        return span_hash(self.data, self.start, np.minimum(self.start + n_bytes, self.end))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A finishing step that spreads all bits (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


STEP = np.uint64(0xD6E8FEB86659FD93)
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_SPAN = 64  # bytes; longer spans are hashed one by one


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one integer; zeros stand behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes: every eight of them are mixed into what stands before."""
    view, size = eights(data), end - start
    out = mix(size.astype(np.uint64) + STEP)
    live = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    at = 0
    while live.size:
        left = size[live] - at
        out[live] = mix((out[live] ^ (view[start[live] + at] & MASKS[np.minimum(left, 8)])) * STEP)
        live = live[left > 8]
        at += 8
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        out[i] = int.from_bytes(blake2b(data[start[i]:end[i]], digest_size=8).digest(), "little")
    return out


def same_spans(data: np.ndarray, start: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of equal size hold the same bytes."""
    view = eights(data)
    same = start == other
    live = np.flatnonzero(~same & (size > 0))
    same |= size == 0
    at = 0
    while live.size and at < LONG_SPAN:
        left = size[live] - at
        equal = ((view[start[live] + at] ^ view[other[live] + at]) & MASKS[np.minimum(left, 8)]) == 0
        same[live[equal & (left <= 8)]] = True
        live = live[equal & (left > 8)]
        at += 8
    for i in live.tolist():
        same[i] = np.array_equal(data[start[i]:start[i] + size[i]], data[other[i]:other[i] + size[i]])
    return same


def distinct_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray, kind: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(one, which): a span of each distinct content, and the number of each span's content.

    ``keys`` are hashes of the contents and steer the search only: spans with one key
    are compared byte by byte, and by ``kind`` if given.
    """
    found = pa.array(keys).dictionary_encode()
    which = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    one = np.zeros(len(found.dictionary), np.int64)
    one[which[::-1]] = np.arange(len(keys))[::-1]
    first, size = one[which], end - start
    same = size == size[first]
    if kind is not None:
        same &= kind == kind[first]
    same[same] = same_spans(data, start[same], start[first[same]], size[same])
    others: dict[tuple, int] = {}
    more = []
    for i in np.flatnonzero(~same).tolist():  # another content under the same key
        content = (data[start[i]:end[i]].tobytes(), None if kind is None else int(kind[i]))
        if content not in others:
            others[content] = len(one) + len(more)
            more.append(i)
        which[i] = others[content]
    return np.concatenate([one, np.array(more, np.int64)]), which


def spans_array(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as strings."""
    size = end - start
    ends = np.cumsum(size)
    place = np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[place])))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string array; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    o = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    d = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None and o[-1] > o[0] else np.zeros(0, np.uint8)
    return d, o - o[0]


def words(texts: pa.Array, separators: np.ndarray = SPACE, lower: bool = True) -> Words:
    data, offsets = buffers(texts)
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separators[data]
    # A row's first byte starts a new word even if the row before ends in one.
    breaks = offsets[1:-1]
    breaks = breaks[(breaks > 0) & (breaks < n)]
    starts = inside[1:] & ~inside[:-1]
    ends = ~inside[1:] & inside[:-1]
    both = breaks[inside[breaks] & inside[breaks + 1]]
    starts[both] = True
    ends[both] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, doc, span_hash(data, start, end), first, data, offsets)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours, over the whole array."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        out = out * BASE + h[i:len(h) - width + 1 + i]
    return mix(out)
