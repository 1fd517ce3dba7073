"""A Katz backoff language model of any order from 2 on in which every word has its own n-grams.

All n-grams up to the order are counted, those seen once too. Counts up to ``GT_MAX``
are discounted by Good and Turing's formula for their order. A context's backoff weight
is what is left of its mass over what is left of its successors' mass one order below,
so every context sums to one. Evaluation is recursive: ``p*(w|h)`` where the n-gram was
seen, else the context's weight times the chance one order below.

All n-grams that end in w after v, and all their contexts, hold v. Tokens go with the
words before them to the part of v, where every order but the first is counted, fitted
and evaluated in one place; parts of very frequent v are cut by the word before v, and
then share the counts of v's pairs. Tokens travel as packed blocks of sorted n-grams,
once to count how often n-grams occur once, twice and so on, and once to be evaluated.
The most frequent words are known to every task by number; the counts of others are
joined by a hash. That bounds memory and changes no result. Only sums per document and
block come back, in billionths, so they do not depend on the order of adding.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm import katz
from tunelake.llm.bytewords import mix
from tunelake.llm.katz import GT_MAX, SLICE_BYTES, SUMS, columns_of, discounts, most_frequent, tokens_of
from tunelake.llm.rows import give_back, row_key, slices, stored

ORDER = 3
HOT = 1 << 19  # most frequent words, known to every task
PART_TOKENS = 2_000_000  # training tokens behind one part
PIECES = 4  # in which a part is fitted, one after the other, to hold less at once
CHUNK = 1 << 19  # tokens sorted into blocks at once
UNIT = 1e9  # of the sums that come back
TOP = np.uint64(1 << 63)  # marks the hash of a word that has no number
START = np.uint64(1 << 62)
NONE = np.uint64((1 << 62) + 1)  # what stands before the start
LOW = np.int64(0xFFFFFFFF)
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
COUNTED = "part int, data binary"
FOUND = "k int, a long, b long, n long"
TABLE = "part int, kind int, a long, b long, n long, word_n long"
SENT = "slice long, part int, kind int, docs binary, data binary"
BACK = "slice long, kind int, docs binary, data binary"


class Backoff(NamedTuple):
    hashes: np.ndarray  # sorted, of the words with a number
    ids: np.ndarray  # their numbers, by place in hashes
    counts: np.ndarray  # by number, falling
    split: np.ndarray  # over how many parts the words of the lowest numbers are dealt
    factors: list[np.ndarray]  # of each order, by count
    log_unit: float  # log10 of a discounted count's unigram chance
    log_rest: float  # log10 of the unigram chance of all unknown words
    order: int
    train_tokens: int
    train_words: int  # distinct
    parts: int
    rows: DataFrame  # the training texts
    words: DataFrame  # (word, n) of the words without a number
    pairs: DataFrame  # (a, b, n, word_n): a before b; n where a's parts are cut, word_n where b has no number

    def mass(self, k: int, n: np.ndarray) -> np.ndarray:
        """n after the discount of its order."""
        return n * self.factors[k][np.minimum(n, GT_MAX + 1)]

    def log_p1(self, n: np.ndarray) -> np.ndarray:
        """log10 of the unigram chance of words by their count."""
        with np.errstate(divide="ignore"):
            return np.where(n > 0, np.log10(self.mass(1, n)) + self.log_unit, self.log_rest)

    def sent(self) -> Backoff:
        return self._replace(rows=None, words=None, pairs=None)


class Level(NamedTuple):
    keys: np.ndarray  # sorted, of the n-grams
    contexts: np.ndarray  # sorted
    log_p: np.ndarray
    log_bow: np.ndarray


def rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def hashed(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    h = rotated((seed + P5 + np.uint64(8)) ^ rotated(x * P2, 31) * P1, 27) * P1 + P4
    h = (h ^ h >> np.uint64(33)) * P2
    h = (h ^ h >> np.uint64(29)) * P3
    return h ^ h >> np.uint64(32)


def pair_key(context: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What ``F.xxhash64(context, low)`` gives."""
    return hashed(low, hashed(context, np.full(len(context), 42, np.uint64)))


def packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers from 0 on, each array in as few bytes a number as it needs, low bytes first, compressed."""
    out, head = [], [len(arrays)]
    for x in arrays:
        width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
        head += [len(x), width]
        out.append(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    raw = b"".join(out)
    return np.array([*head, len(raw)], "<u4").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    """The arrays of :func:`packed`, in the smallest type that holds their bytes."""
    n = int.from_bytes(data[:4], "little")
    head = np.frombuffer(data, "<u4", 2 * n + 2)[1:].tolist()
    raw, at, out = np.frombuffer(pa.decompress(data[8 * n + 8:], head[-1], codec="zstd", asbytes=True), np.uint8), 0, []
    for size, width in zip(head[:-1:2], head[1::2], strict=False):
        wide = 1 << (width - 1).bit_length()
        x = np.zeros((size, wide), np.uint8)
        x[:, :width] = raw[at:at + size * width].reshape(width, size).T
        out.append(x.view(f"<u{wide}").ravel())
        at += size * width
    return out


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each value's place among them."""
    found = pa.array(x).dictionary_encode()
    values = found.dictionary.to_numpy()
    order = np.argsort(values)
    place = np.empty(len(order), np.uint64)
    place[order] = np.arange(len(order), dtype=np.uint64)
    return values[order], place[found.indices.to_numpy()]


def pair_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Two places as one key."""
    return first.astype(np.int64) << 32 | second.astype(np.int64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and each one's place among them: ``np.unique`` in less memory."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return keys[new], place


def found_at(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each value among sorted keys, -1 if it is not there."""
    if not len(keys):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, at, -1)


def grams_of(texts: pa.Array, m: Backoff) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """All codes in order; by place among them the word before each token, its own and those further before; each text's first token and the end.

    A word's code is its number, or its marked hash where it has none. A text's first
    word follows the start; no longer n-gram begins before it.
    """
    tokens, first = tokens_of(texts)
    found = pa.array(tokens | TOP).dictionary_encode()
    words = found.dictionary.to_numpy()
    at = found_at(m.hashes, words)
    codes = np.append(np.where(at >= 0, m.ids[at], words) if len(m.ids) else words, [START, NONE])
    order = np.argsort(codes)
    number = np.empty(len(codes), np.uint64)
    number[order] = np.arange(len(codes), dtype=np.uint64)
    code = number[found.indices.to_numpy()]
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    out = []
    for k in range(1, m.order):
        before = np.full(len(code), number[-1])
        before[k:] = code[:-k]
        before[place == k - 1] = number[-2]
        before[place < k - 1] = number[-1]
        out.append(before)
    return codes[order], [out[0], code, *out[1:]], first


def parts_of(codes: np.ndarray, columns: list[np.ndarray], m: Backoff) -> np.ndarray:
    """The part of each token: that of the word before it, cut by the one before that where it is very frequent."""
    mixed, n_parts = mix(codes), np.uint64(m.parts)
    part = (mixed % n_parts)[columns[0]]
    at = np.flatnonzero(columns[0] < np.uint64(np.searchsorted(codes, np.uint64(len(m.split)))))
    if len(at):
        part[at] = (part[at] + mixed[columns[2][at]] % m.split[codes[columns[0][at]].astype(np.int64)]) % n_parts
    return part


def blocks_of(codes: np.ndarray, columns: list[np.ndarray], part: np.ndarray, n_parts: int, owner: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """For each part the distinct rows of codes in order, how often each occurs, and the owners of all."""
    bits = len(codes).bit_length()
    for start in range(0, len(part), CHUNK):
        own = [c[start:start + CHUNK] for c in columns]
        key, width = own[0], bits
        for x in own[1:]:
            if width + bits > 64:
                values, key = distinct(key)
                key, width = key.astype(np.uint64), len(values).bit_length()
            key, width = key << np.uint64(bits) | x, width + bits
        deal = part[start:start + CHUNK].astype(np.uint16 if n_parts < 1 << 16 else np.int64)
        order = np.argsort(key)
        order = order[np.argsort(deal[order], kind="stable")]
        bounds = np.searchsorted(deal[order], np.arange(n_parts + 1))
        for i in range(n_parts):
            at = order[bounds[i]:bounds[i + 1]]
            if len(at):
                sorted_key = key[at]
                begin = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1]))
                used, rows = numbered(np.concatenate([c[at[begin]] for c in own]))
                rows = rows.reshape(len(own), -1)
                yield i, packed(
                    np.diff(codes[used], prepend=np.uint64(0)), np.diff(rows[0], prepend=np.uint64(0)), *rows[1:], np.diff(begin, append=len(at)) - 1,
                    *([] if owner is None else [owner[start:start + CHUNK][at]]))


class Block(NamedTuple):
    place: np.ndarray  # of the block's codes among all
    columns: list[np.ndarray]  # places among the block's codes
    more: np.ndarray  # how often each row occurs, less one
    owner: np.ndarray | None

    def sums_of(self, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums of these rows' values over the block's owners."""
        inside = np.zeros(len(self.more), bool)
        inside[rows] = True
        own = self.owner[np.repeat(inside, self.more.astype(np.int32) + 1)]
        return np.bincount(own, weights=np.repeat(values, self.more[rows].astype(np.int32) + 1), minlength=int(self.owner.max()) + 1)


def read_blocks(data: list[bytes], k: int, *more: np.ndarray) -> tuple[np.ndarray, list[Block]]:
    """All codes in order, those in ``more`` too, and the blocks."""
    blocks = []
    for x in data:
        own, first, *rest = unpacked(x)
        first = np.cumsum(first, dtype=np.min_scalar_type(len(own)))
        blocks.append(Block(np.cumsum(own, dtype=np.uint64), [first, *rest[:k - 1]], rest[k - 1], rest[k] if len(rest) > k else None))
    codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *more, *(b.place for b in blocks)]))
    return codes, [b._replace(place=np.searchsorted(codes, b.place).astype(np.int32)) for b in blocks]


def pieces_of(codes: np.ndarray, *groups: list[Block]) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each piece which codes are in it, and each block's rows: all that follow the same word are in one."""
    piece = ((mix(codes) >> np.uint64(40)) % np.uint64(PIECES)).astype(np.uint8)
    own = [[piece[b.place][b.columns[0]] for b in blocks] for blocks in groups]
    for i in range(PIECES):
        yield piece == i, *([np.flatnonzero(x == i) for x in pieces] for pieces in own)


def rows_of(blocks: list[Block], rows: list[np.ndarray], k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of these rows of all blocks, as places among all codes, and how often each row occurs."""
    none = np.zeros(0, np.int32)
    columns = [np.concatenate([none, *(b.place[b.columns[i][at]] for b, at in zip(blocks, rows, strict=True))]) for i in range(k)]
    return columns, np.concatenate([none, *(b.more[at].astype(np.int32) + 1 for b, at in zip(blocks, rows, strict=True))])


def longer(at: np.ndarray, x: np.ndarray, rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, keys, place): the rows that have one more word before them, and their n-grams with it."""
    has = codes[x] != NONE
    return rows[has], *distinct(pair_of(at[has], x[has]))


def training_blocks(rows: DataFrame, m: Backoff) -> DataFrame:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(0), SLICE_BYTES):
                codes, columns, _ = grams_of(batch.column(0)[a:b], m)
                parts, data = zip(*blocks_of(codes, columns, parts_of(codes, columns, m), m.parts), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(data, pa.binary())], ["part", "data"])

    return rows.select("_text").mapInArrow(gather, COUNTED)


def counted(rows: DataFrame, m: Backoff) -> DataFrame:
    """Rows (k, a, b, n): of each order k how many n-grams (n) occur how often (a), up to GT_MAX + 1; and as order 0 pairs of words.

    Those are all pairs whose first word's parts are cut, with their counts in one part, and
    other pairs whose second word has no number, with a count of 0.
    """
    def count(blocks: pd.DataFrame) -> pd.DataFrame:
        codes, own = read_blocks(blocks["data"], m.order)
        out = [count_piece(codes, *rows_of(own, rows, m.order)) for _, rows in pieces_of(codes, own)]
        give_back()
        return pd.concat(out)

    def count_piece(codes: np.ndarray, columns: list[np.ndarray], n: np.ndarray) -> pd.DataFrame:
        keys, at = distinct(pair_of(*columns[:2]))
        c = np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)
        first, second = codes[keys >> 32], codes[keys & LOW]
        cut = first < np.uint64(len(m.split))
        sent = cut | (second >= TOP)
        out = [pd.DataFrame({"k": 0, "a": first[sent].view(np.int64), "b": second[sent].view(np.int64), "n": np.where(cut, c, 0)[sent]})]
        c, rows = c[~cut], np.arange(len(n), dtype=np.int32)
        for k in range(2, m.order + 1):
            times = np.bincount(c[c <= GT_MAX + 1], minlength=GT_MAX + 2)
            out.append(pd.DataFrame({"k": k, "a": np.arange(1, GT_MAX + 2), "b": 0, "n": times[1:]}))
            if k < m.order:
                rows, keys, at = longer(at, columns[k][rows], rows, codes)
                c = np.bincount(at, weights=n[rows], minlength=len(keys)).astype(np.int64)
        return pd.concat(out)

    return training_blocks(rows, m).groupBy("part").applyInPandas(count, FOUND)


def train_backoff(docs: DataFrame, text_col: str = "text", order: int = ORDER, hot: int = HOT) -> Backoff:
    """Count all texts. Null counts as an empty text; no text at all gives an empty model.

    ``hot`` bounds what tasks hold in memory and changes no result. One task holds
    all tokens after the same two words, in packed form, and the distinct words after
    one word; the model's n-grams are fitted where they are used, from the training texts.
    """
    if order < 2:
        raise ValueError("the order must be at least 2")
    rows = docs.select(F.col(text_col).cast("string").alias("_text"))
    words = stored(katz.counted(rows, lambda texts: (tokens_of(texts)[0] | TOP).view(np.int64), "word"), "backoff-words")
    small = words.groupBy(F.least("n", F.lit(GT_MAX + 2)).alias("n")).agg(F.count("*").alias("m"), F.sum("n").alias("t")).collect()
    times = {k: {} for k in range(1, order + 1)}
    times[1] = {r["n"]: r["m"] for r in small if r["n"] <= GT_MAX + 1}
    n_tokens, n_words = sum(r["t"] for r in small), sum(r["m"] for r in small)
    top, n = columns_of(most_frequent(words, hot), "word", "n")  # bounded by hot
    by_count = np.lexsort((top, -n))
    top, n = top[by_count].view(np.uint64), n[by_count]
    by_hash = np.argsort(top)
    lost = sum((1 - d) * r * times[1].get(r, 0) for r, d in enumerate(discounts(times[1])))
    seen = 1 - lost / max(n_tokens, 1) if n_tokens else 0.0
    rest = max(1 - seen, 1 / (n_tokens + 1))
    log_unit = float(np.log10((1 - rest) / max(seen * n_tokens, 1e-300))) if n_tokens else 0.0
    parts = max(1, -(-n_tokens // PART_TOKENS))
    split = np.minimum(-(-2 * n[2 * n > PART_TOKENS] // PART_TOKENS), parts) if order > 2 else n[:0]
    m = Backoff(
        top[by_hash], by_hash.astype(np.uint64), n.astype(np.int64), split.astype(np.uint64), [], log_unit, float(np.log10(rest)), order,
        n_tokens, n_words, parts, None, None, None)
    found = stored(counted(rows, m), "backoff-found", "k")
    pairs = found.filter("k = 0 and n = 0").select("a", "b", "n")
    if len(split):
        cut = stored(found.filter("k = 0 and n > 0").groupBy("a", "b").agg(F.sum("n").alias("n")), "backoff-pairs")
        times[2] = {r["n"]: r["m"] for r in cut.filter(F.col("n") <= GT_MAX + 1).groupBy("n").agg(F.count("*").alias("m")).collect()}
        pairs = pairs.unionByName(cut)
    for r in found.filter("k > 0").groupBy("k", "a").agg(F.sum("n").alias("m")).collect():
        times[r["k"]][r["a"]] = times[r["k"]].get(r["a"], 0) + r["m"]
    rare = words.filter(F.col("n") < int(n[-1])) if len(n) else words
    pairs = pairs.join(rare.select(F.col("word").alias("b"), F.col("n").alias("word_n")), "b", "left").select("a", "b", "n", "word_n")
    factors = [np.ones(0), *(np.array([*discounts(times[k]), 1.0]) for k in range(1, order + 1))]
    return m._replace(factors=factors, rows=rows, words=rare, pairs=pairs)


class Fitted(NamedTuple):
    word_n: np.ndarray  # of each pair's second word
    levels: list[Level]
    values: np.ndarray  # of the training rows


def fitted(codes: np.ndarray, columns: list[np.ndarray], n: np.ndarray, table: pd.DataFrame, m: Backoff) -> Fitted:
    """The model's n-grams of one piece. ``values`` leave out the unigram chance of words without a number, which their own parts add."""
    a, b = (table[c].to_numpy(np.int64).view(np.uint64) for c in "ab")
    keys, place = distinct(np.concatenate([pair_of(*columns[:2]), pair_of(np.searchsorted(codes, a), np.searchsorted(codes, b))]))
    at, given = place[:len(n)], place[len(n):]
    c = np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)
    whole = table["n"].to_numpy(np.int64)
    c[given[whole > 0]] = whole[whole > 0]
    second = codes[keys & LOW]
    word_n = np.zeros(len(keys), np.int64)
    numbers = second < np.uint64(len(m.counts))
    word_n[numbers] = m.counts[second[numbers].astype(np.int64)]
    rare = b >= TOP
    word_n[given[rare]] = table["word_n"].to_numpy(np.int64)[rare]
    low_p = 10.0 ** m.log_p1(word_n)
    contexts, h = distinct(keys >> 32)
    own = np.where(second >= TOP, m.log_p1(word_n), 0.0)[at]
    levels, rows, values = [], np.arange(len(n), dtype=np.int32), np.zeros(len(n))
    for k in range(2, m.order + 1):
        mass = m.mass(k, c)
        total, all_mass, lower = (np.bincount(h, weights=x, minlength=len(contexts)) for x in (c, mass, low_p))
        # At least one part in total + 1 is left for what a context has not been seen with.
        scale = np.minimum(1.0, total / (total + 1) / (all_mass / total))
        p = mass * scale[h] / total[h]
        bow = (1 - scale * all_mass / total) / np.maximum(1 - lower, 1e-12)
        levels.append(Level(keys, contexts, np.log10(p), np.log10(bow)))
        values[rows] = levels[-1].log_p[at]
        if k < m.order:
            rows, keys, at = longer(at, columns[k][rows], rows, codes)
            c = np.bincount(at, weights=n[rows], minlength=len(keys)).astype(np.int64)
            low_p = p[keys >> 32]
            contexts, h = distinct(pair_of(h[keys >> 32], keys & LOW))
    return Fitted(word_n, levels, values - own)


def evaluated(codes: np.ndarray, columns: list[np.ndarray], f: Fitted, m: Backoff) -> np.ndarray:
    """The values of rows, in training or not."""
    v, w, *before = columns
    second = codes[w]
    rare = second >= TOP
    values = np.zeros(len(w))
    values[~rare] = m.log_p1(m.counts[second[~rare].astype(np.int64)]) if len(m.counts) else 0.0
    at, context = pair_of(v, w), v
    for k, level in enumerate(f.levels):
        if k:
            x = before[k - 1]
            at = np.where(at >= 0, pair_of(at, x), -1)
            context = np.where(context >= 0, pair_of(context, x), -1)
        at, context = found_at(level.keys, at), found_at(level.contexts, context)
        if len(level.keys):
            if not k:
                own = np.where(rare & (at >= 0), m.log_p1(f.word_n[at]), 0.0)
            values = np.where(at >= 0, level.log_p[at] - own, values + np.where(context >= 0, level.log_bow[context], 0.0))
    return values


def score_backoff(docs: DataFrame, model: Backoff, id_col: str = "doc_id", text_col: str = "text", trained: Column | None = None) -> DataFrame:
    """Rows (id, n_tokens, n_known, base_score, score), one per document.

    n_tokens    words and the end token; a null or empty text has the end alone
    n_known     tokens that the training texts hold
    base_score  log10 of the add-one unigram chance; one share is left for all unknown words
    score       log10 of the backoff model's chance

    Rows alike in id and text have the same scores, and each is returned. Other
    columns are left out. ``trained`` says which rows of ``docs`` are the model's
    training texts, if it holds exactly them: their tokens are then sent only once.
    """
    m = model.sent()
    per_base = np.log10(model.train_tokens + model.train_words + 1.0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        number = 0
        for batch in batches:
            for a, b in slices(batch.column(2), SLICE_BYTES):
                docs = np.column_stack([batch.column(i)[a:b].to_numpy() for i in (0, 1)])
                number += 1
                own_slice = int.from_bytes(blake2b(f"{place} {number} ".encode() + docs.tobytes(), digest_size=8).digest(), "little", signed=True)
                in_training = batch.column(3)[a:b].to_numpy(zero_copy_only=False).astype(bool)
                codes, columns, first = grams_of(batch.column(2)[a:b], m)
                owner, code = np.repeat(np.arange(b - a), np.diff(first)), codes[columns[1]]
                known, rare = np.flatnonzero(code < TOP), np.flatnonzero(code >= TOP)
                count = m.counts[code[known].astype(np.int64)] if len(known) else np.zeros(0)
                base = np.bincount(owner[known], weights=np.log10(count + 1), minlength=b - a)
                sums = np.column_stack([np.diff(first), np.bincount(owner[known], minlength=b - a), np.rint(base * UNIT)]).astype(np.int64)
                rows = [(own_slice % m.parts, 0, docs.tobytes(), sums.tobytes())]
                rows += [(i, 1, b"", x) for i, x in blocks_of(codes, [columns[1][rare]], mix(code[rare]) % np.uint64(m.parts), m.parts, owner[rare])]
                part, kinds = parts_of(codes, columns, m), in_training[owner]
                for kind, at in ((2, np.flatnonzero(kinds)), (3, np.flatnonzero(~kinds))):
                    rows += [(i, kind, b"", x) for i, x in blocks_of(codes, [c[at] for c in columns], part[at], m.parts, owner[at])]
                parts, kind, keys, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own_slice] * len(rows)), pa.array(parts, pa.int32()), pa.array(kind, pa.int32()), pa.array(keys, pa.binary()), pa.array(data, pa.binary())],
                    ["slice", "part", "kind", "docs", "data"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The table's rows to their parts, to each of them where a word's parts are cut."""
        for batch in batches:
            kind, a, b, n, word_n = (x.fill_null(0).to_numpy() for x in batch.columns)
            code = a.view(np.uint64)
            times = np.ones(len(a), np.int64)
            cut = np.flatnonzero((kind == 2) & (code < np.uint64(len(m.split))))
            times[cut] = m.split[a[cut]]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            part = (np.repeat(mix(code) % np.uint64(m.parts), times).astype(np.int64) + step) % m.parts
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), *(pa.array(np.repeat(x, times)) for x in (kind, a, b, n, word_n))], [f.split()[0] for f in TABLE.split(", ")])

    def signed(x: np.ndarray) -> np.ndarray:
        return (x << 1 ^ x >> 63).view(np.uint64)

    def unsigned(x: np.ndarray) -> np.ndarray:
        return (x >> np.uint64(1)).view(np.int64) ^ -(x & np.uint64(1)).view(np.int64)

    def answer(blocks: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        """Each block's sums per document, from the part's n-grams or counts of words."""
        out = []

        def put(own_slice: int, *sums: np.ndarray) -> None:
            owners = np.flatnonzero(np.any([x != 0 for x in sums], axis=0))
            out.append((own_slice, len(sums), b"", packed(owners, *(signed(np.rint(x[owners]).astype(np.int64)) for x in sums))))

        rows = {k: own for k, own in blocks.groupby("kind")}
        none = blocks[:0]
        words = table[table["kind"] == 1].sort_values("a")
        word, count = words["a"].to_numpy(np.int64).view(np.uint64), words["n"].to_numpy(np.int64)
        for own_slice, docs, data in rows.get(0, none)[["slice", "docs", "data"]].itertuples(index=False):
            out.append((own_slice, 0, docs, data))
        for own_slice, data in rows.get(1, none)[["slice", "data"]].itertuples(index=False):
            codes, (block,) = read_blocks([data], 1)
            at = found_at(word, codes)
            n = np.where(at >= 0, count[at], 0) if len(word) else np.zeros(len(at), np.int64)
            n = n[block.columns[0]]
            put(own_slice, *(block.sums_of(np.arange(len(n)), x) for x in (n > 0, np.log10(n + 1) * UNIT, m.log_p1(n) * UNIT)))
        trained = pd.concat([rows.get(2, none), rows.get(4, none)])
        others = rows.get(3, none)
        pairs = table[table["kind"] == 2]
        first = pairs["a"].to_numpy(np.int64).view(np.uint64)
        codes, all_blocks = read_blocks([*trained["data"], *others["data"]], m.order, first, pairs["b"].to_numpy(np.int64).view(np.uint64))
        own, other = all_blocks[:len(trained)], all_blocks[len(trained):]
        sums = [0.0] * len(all_blocks)
        for inside, at, other_at in pieces_of(codes, own, other):
            f = fitted(codes, *rows_of(own, at, m.order), pairs[inside[np.searchsorted(codes, first)]], m)
            found = np.append(f.values, evaluated(codes, rows_of(other, other_at, m.order)[0], f, m)) * UNIT
            begin = 0
            for i, (block, x) in enumerate(zip(all_blocks, at + other_at, strict=True)):
                if block.owner is not None:
                    sums[i] = sums[i] + block.sums_of(x, found[begin:begin + len(x)])
                begin += len(x)
        for own_slice, block, x in zip([*trained["slice"], *others["slice"]], all_blocks, sums, strict=True):
            if block.owner is not None:
                put(own_slice, x)
        give_back()
        return pd.DataFrame(out, columns=["slice", "kind", "docs", "data"])

    def total(blocks: pd.DataFrame) -> pd.DataFrame:
        """Sums per document over the blocks of one slice of texts, no more of them than the slice has n-grams."""
        own = blocks[blocks["kind"] == 0].iloc[0]
        docs = np.frombuffer(own["docs"], np.int64).reshape(-1, 2)
        known = np.frombuffer(own["data"], np.int64).reshape(-1, 3)
        sums = np.column_stack([known[:, 1], known[:, 2], np.zeros(len(docs), np.int64)])
        for kind, data in blocks[["kind", "data"]].itertuples(index=False):
            if kind:
                owners, *found = unpacked(data)
                sums[owners, 3 - kind:] += np.column_stack([unsigned(x.astype(np.uint64)) for x in found])
        return pd.DataFrame({
            "_k1": docs[:, 0], "_k2": docs[:, 1], "rows": 1, "n_tokens": known[:, 0], "n_known": sums[:, 0], "base": sums[:, 1] / UNIT, "score": sums[:, 2] / UNIT})

    in_training = F.lit(False) if trained is None else F.coalesce(trained, F.lit(False))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), in_training.alias("_trained"))
    rows = rows.select("*", *row_key("_id", "_text"))
    sent = rows.select("_k1", "_k2", "_text", "_trained").mapInArrow(send, SENT)
    if trained is None:
        nothing = F.lit(b"")
        sent = sent.unionByName(training_blocks(model.rows, m).select(F.lit(0).cast("long").alias("slice"), "part", F.lit(4).alias("kind"), nothing.alias("docs"), "data"))
    zero = F.lit(0).cast("long")
    table = model.pairs.select(F.lit(2).alias("kind"), "a", "b", "n", "word_n").unionByName(
        model.words.select(F.lit(1).alias("kind"), F.col("word").alias("a"), zero.alias("b"), "n", zero.alias("word_n"))).mapInArrow(deal, TABLE)
    partial = sent.groupBy("part").cogroup(table.groupBy("part")).applyInPandas(answer, BACK).groupBy("slice").applyInPandas(total, SUMS)
    sums = partial.groupBy("_k1", "_k2").agg(*[F.sum(c).alias(c) for c in ("rows", "n_tokens", "n_known", "base", "score")])
    found = rows.select("_id", "_k1", "_k2").join(sums, ["_k1", "_k2"])
    each = lambda c: F.col(c) / F.col("rows")
    n_tokens = each("n_tokens")
    return found.select(
        F.col("_id").alias(id_col), n_tokens.cast("long").alias("n_tokens"), each("n_known").cast("long").alias("n_known"),
        (each("base") - n_tokens * F.lit(float(per_base))).alias("base_score"), each("score").alias("score"))
