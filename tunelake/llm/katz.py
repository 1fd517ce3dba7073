"""A Katz backoff language model over all documents, and their scores under it.

Words are counted exactly, all of them. At most ``vocabulary`` most frequent ones get
ids; other words share one, told apart below it by their own counts. Bigrams are
counted over ids. Counts up to ``GT_MAX`` are discounted by Good and Turing's
formula, bigrams seen once are left to the backoff, and each context's backoff
weight is what is left of its mass over what is left of its successors' unigram
mass, so every context sums to one. The tables lie in the shared folder, bigrams
partitioned by a hash of their key.

A token is evaluated by ``log p(w|h) = log p*(w|h)`` for a kept bigram and
``log bow(h) + log p(w)`` otherwise. The second form is read from arrays bounded by
the vocabulary. What a kept bigram adds to it comes from a bounded broadcast for
the most frequent bigrams, which keeps them out of the shuffle, and from a join
with the partitioned table for all others; so do the counts of words without id.
Tasks send what they need looked up as sorted key blocks and get sums per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tunelake.llm.bytewords import SPACE, words
from tunelake.llm.rows import row_key, slices, stored, text_of

VOCABULARY = 1 << 18  # words with an id of their own
HOT_BIGRAMS = 1 << 18  # most frequent bigrams, known to every task
GT_MAX = 5
KEY_BITS = np.int64(20)
PART_TOKENS = 6_000_000  # training tokens behind one part of the tables
SLICE_BYTES = 2 << 20
MERGED = 1 << 20  # distinct keys a task gathers before it sends them on
END = np.uint64(0x5EED0E4D0F7E87)


class Katz(NamedTuple):
    """Bounded arrays by id; the id after the words is for those without one, then comes the start of a text."""

    hashes: np.ndarray  # sorted, of the words with ids
    ids: np.ndarray  # their ids, by place in hashes
    counts: np.ndarray
    log_p: np.ndarray  # log10 of the unigram chance, of the whole class for words without id
    log_bow: np.ndarray  # log10 of each context's backoff weight
    hot_keys: np.ndarray
    hot_gains: np.ndarray
    train_tokens: int
    train_words: int  # distinct
    rest_tokens: int  # training tokens without id
    rest_words: int
    parts: int
    word_table: DataFrame  # (word, n)
    bigram_table: DataFrame  # (key, n, log_p, gain), partitioned by part


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token, each text closed by the end token, and each text's first token and the end."""
    w = words(texts, SPACE)
    return np.insert(w.hash, w.first[1:], END), w.first + np.arange(len(w.first))


def ids_of(tokens: np.ndarray, hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
    return np.where(hashes[at] == tokens, ids[at], len(hashes)) if len(hashes) else np.zeros(len(tokens), np.int64)


def keys_of(ids: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[first[:-1]] = start
    return before << KEY_BITS | ids


def counted(rows: DataFrame, keys, name: str) -> DataFrame:
    """(key, n) over all texts; ``keys`` makes int64 keys from an array of texts."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0), SLICE_BYTES):
                key, n = np.unique(keys(batch.column(0)[a:b]), return_counts=True)
                both = np.concatenate([known, key])
                known, place = np.unique(both, return_inverse=True)
                times = np.bincount(place, weights=np.concatenate([times, n]), minlength=len(known)).astype(np.int64)
                if len(known) >= MERGED:
                    yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(times)], [name, "n"])
                    known, times = known[:0], times[:0]
        if len(known):
            yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(times)], [name, "n"])

    return rows.select("_text").mapInArrow(gather, f"{name} long, n long").groupBy(name).agg(F.sum("n").alias("n"))


def discounts(counts_of_counts: dict[int, int]) -> list[float]:
    """Katz's factors for the counts 0 to GT_MAX; 1 where the counts of counts allow none below it."""
    n = [counts_of_counts.get(r, 0) for r in range(GT_MAX + 2)]
    out = [1.0] * (GT_MAX + 1)
    tail = (GT_MAX + 1) * n[GT_MAX + 1] / n[1] if n[1] else 1.0
    for r in range(1, GT_MAX + 1):
        if n[r] and n[r + 1] and tail < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
            out[r] = d if 0 < d <= 1 else 1.0
    return out


def columns_of(df: DataFrame, *names: str) -> list[np.ndarray]:
    """Columns of a table of bounded size, sent to the driver as Arrow and not as rows."""
    table = df.select(*names).toArrow()
    return [table.column(n).to_numpy() for n in names]


def most_frequent(table: DataFrame, limit: int) -> DataFrame:
    """Rows with the highest ``n``, at most ``limit``: all above a mark, so that no ties are cut.

    The mark comes from a histogram over 64 steps to each doubling of n, a few thousand rows at most.
    """
    step = F.floor(F.log2("n") * 64)
    bins = table.groupBy(step.alias("step")).agg(F.count("*").alias("m")).orderBy(F.desc("step")).collect()
    taken, mark = 0, None
    for b in bins:
        taken += b["m"]
        if taken > limit:
            break
        mark = b["step"]
    return table.filter(step >= mark) if mark is not None else table.limit(0)


def counts_of_counts(table: DataFrame) -> dict[int, int]:
    small = table.filter(F.col("n") <= GT_MAX + 1).groupBy("n").agg(F.count("*").alias("m")).collect()
    return {r["n"]: r["m"] for r in small}


def train_katz(docs: DataFrame, text_col: str = "text", vocabulary: int = VOCABULARY, hot_bigrams: int = HOT_BIGRAMS) -> Katz:
    """Count all texts and store the model's tables. Null counts as an empty text; no text at all gives an empty model."""
    if vocabulary + 2 >= 1 << int(KEY_BITS):
        raise ValueError("the vocabulary does not fit into bigram keys")
    rows = docs.select(F.col(text_col).cast("string").alias("_text"))
    word_table = stored(counted(rows, lambda texts: tokens_of(texts)[0].view(np.int64), "word"), "katz-words")
    sums = word_table.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_tokens, n_words = sums["n"] or 0, sums["v"]
    d1 = discounts(counts_of_counts(word_table))
    top, counts = columns_of(most_frequent(word_table, vocabulary), "word", "n")
    by_count = np.lexsort((top, -counts))
    top, counts = top[by_count], counts[by_count]
    size = len(top)
    order = np.argsort(top.view(np.uint64))
    hashes, ids = top.view(np.uint64)[order], np.arange(size)[order]
    p = np.where(counts <= GT_MAX, np.array(d1)[np.minimum(counts, GT_MAX)], 1.0) * counts / max(n_tokens, 1)
    rest = max(1 - p.sum(), 1 / (n_tokens + 1))
    p = np.append(p * ((1 - rest) / p.sum() if size else 1.0), rest)
    parts = max(1, -(-n_tokens // PART_TOKENS))

    once = Observation()
    bigrams = counted(rows, lambda texts: id_keys(texts, hashes, ids), "key").observe(once, F.count_if(F.col("n") == 1).alias("n"))
    kept = stored(bigrams.filter("n > 1"), "katz-bigrams")
    d2 = discounts({1: once.get["n"], **counts_of_counts(kept)})
    # Every word but the end is followed once; texts that end are texts that start.
    end = word_table.filter(F.col("word") == int(END.view(np.int64))).first()
    follows = np.concatenate([counts, [n_tokens - counts.sum(), end["n"] if end else 0]])
    spark = docs.sparkSession
    by_id = spark.createDataFrame(pa.table({"w": np.arange(size + 1), "p": p}))  # bounded by the vocabulary
    factor = F.element_at(F.array(*[F.lit(x) for x in [*d2[1:], 1.0]]), F.least("n", F.lit(GT_MAX + 1)).cast("int"))
    split = kept.withColumn("h", F.shiftright("key", int(KEY_BITS))).withColumn("w", F.col("key").bitwiseAND((1 << int(KEY_BITS)) - 1))
    seen = split.select("key", "n", "h", "w", (factor * F.col("n")).alias("mass"))
    kept_mass = seen.join(F.broadcast(by_id), "w").groupBy("h").agg(F.sum("mass").alias("mass"), F.sum("p").alias("lower"))
    context, mass, lower = columns_of(kept_mass, "h", "mass", "lower")  # bounded by the vocabulary
    total = follows[context].astype(float)
    # At least one part in total + 1 is left for what a context has not been seen with.
    scale = np.minimum(1.0, (total / (total + 1)) / np.maximum(mass / np.maximum(total, 1), 1e-300))
    left, left_lower = 1 - scale * mass / np.maximum(total, 1), 1 - lower
    bow = np.ones(size + 2)
    bow[context] = left / np.maximum(left_lower, 1e-12)
    log_bow, log_p = np.log10(bow), np.log10(p)
    per_context = spark.createDataFrame(pa.table({"h": context, "unit": scale / np.maximum(total, 1), "log_bow": log_bow[context]}))
    model = seen.join(F.broadcast(by_id), "w").join(F.broadcast(per_context), "h").withColumn("log_p", F.log10(F.col("mass") * F.col("unit")))
    part = F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
    bigram_table = stored(model.select(
        "key", "n", "log_p", (F.col("log_p") - F.col("log_bow") - F.log10("p")).alias("gain"), part.alias("part")).repartition(parts, "part"), "katz-model", "part")
    hot_keys, hot_gains = columns_of(most_frequent(bigram_table, hot_bigrams), "key", "gain")
    by_key = np.argsort(hot_keys)
    return Katz(
        hashes, ids, counts, log_p, log_bow, hot_keys[by_key], hot_gains[by_key], n_tokens, n_words,
        n_tokens - int(counts.sum()), n_words - size, parts, word_table, bigram_table)


def id_keys(texts: pa.Array, hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    tokens, first = tokens_of(texts)
    return keys_of(ids_of(tokens, hashes, ids), first, len(hashes) + 1)


PARTIAL = "slice long, docs binary, sums binary"
SUMS = "_k1 long, _k2 long, rows long, n_tokens long, n_known long, base double, score double"
BLOCK = "slice long, part int, kind int, docs binary, keys binary, sizes binary, owners binary, sums binary"


def blocks_of(part: np.ndarray, kind: int, keys: np.ndarray, owner: np.ndarray, docs: np.ndarray, n_parts: int) -> Iterator[tuple]:
    """One block per part: distinct keys in order, how many entries each has, and the entries' documents."""
    order = np.lexsort((owner, keys, part))
    part, keys, owner = part[order], keys[order], owner[order]
    bounds = np.searchsorted(part, np.arange(n_parts + 1))
    for i in range(n_parts):
        a, b = bounds[i], bounds[i + 1]
        if a < b:
            distinct, sizes = np.unique(keys[a:b], return_counts=True)
            used, own = np.unique(owner[a:b], return_inverse=True)
            yield (i, kind, docs[used].tobytes(), np.diff(distinct, prepend=np.int64(0)).tobytes(), sizes.astype("<u4").tobytes(), own.astype("<u4").tobytes(), b"")


def score_katz(docs: DataFrame, model: Katz, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_tokens, n_known, base_score, score), one per document.

    n_tokens    words and the end token; a null or empty text has the end alone
    n_known     tokens that the training texts hold
    base_score  log10 of the add-one unigram chance; one share is left for all unknown words
    score       log10 of the backoff model's chance

    Rows alike in id and text have the same scores, and each is returned. Other
    columns are left out.
    """
    m = model._replace(word_table=None, bigram_table=None)
    n_parts, size = model.parts, len(model.hashes)
    per_base = np.log10(model.train_tokens + model.train_words + 1.0)
    known_log = np.append(np.log10(m.counts + 1.0), 0.0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(2), SLICE_BYTES):
                docs = np.column_stack([batch.column(i)[a:b].to_numpy() for i in (0, 1)])
                tokens, first = tokens_of(batch.column(2)[a:b])
                ids = ids_of(tokens, m.hashes, m.ids)
                owner = np.repeat(np.arange(b - a), np.diff(first))
                has_id = ids < size
                key = keys_of(ids, first, size + 1)
                at = np.minimum(np.searchsorted(m.hot_keys, key), max(len(m.hot_keys) - 1, 0))
                hot = m.hot_keys[at] == key if len(m.hot_keys) else np.zeros(len(key), bool)
                gain = np.where(hot, m.hot_gains[at], 0.0) if len(m.hot_keys) else np.zeros(len(key))
                per_token = m.log_p[ids] + m.log_bow[key >> KEY_BITS] + gain
                total = lambda x: np.bincount(owner, weights=x, minlength=b - a)
                sums = np.column_stack([np.diff(first), total(has_id), total(known_log[ids]), total(per_token)]).astype(float)
                rows = [(-1 - (int(docs[0, 0]) & 0xFFFF), 0, docs.tobytes(), b"", b"", b"", sums.tobytes())]
                cold = np.flatnonzero(~hot)
                rows += blocks_of(part_of(key[cold], n_parts), 2, key[cold], owner[cold], docs, n_parts)
                lone = np.flatnonzero(~has_id)
                word = tokens[lone].view(np.int64)
                rows += blocks_of(part_of(word, n_parts), 1, word, owner[lone], docs, n_parts)
                columns = [pa.array([int(docs[0, 0])] * len(rows))]
                columns += [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] * 2 + [pa.binary()] * 5, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in BLOCK.split(", ")])

    rest_log = np.log10(model.rest_tokens + model.rest_words + 1.0)

    def answer(blocks: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        """Each block's sums per document, still one row, from the part's table rows (kind, key, value)."""
        by_kind = {}
        for kind, own in table.groupby("kind"):
            own = own.sort_values("key")
            by_kind[kind] = own["key"].to_numpy(np.int64), own["value"].to_numpy(float)
        out = []
        for own_slice, kind, d, k, sizes, owners, sums in zip(*(blocks[c] for c in ("slice", "kind", "docs", "keys", "sizes", "owners", "sums")), strict=True):
            docs = np.frombuffer(d, np.int64).reshape(-1, 2)
            if kind == 0:
                part = np.column_stack([np.ones(len(docs)), np.frombuffer(sums, float).reshape(-1, 4)])
            else:
                keys, size_of = np.cumsum(np.frombuffer(k, np.int64)), np.frombuffer(sizes, "<u4")
                known, values = by_kind.get(kind, (np.zeros(0, np.int64), np.zeros(0)))
                value = np.zeros(len(keys))
                if len(known):
                    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    value = np.where(known[at] == keys, values[at], 0.0)
                value, owner = np.repeat(value, size_of), np.frombuffer(owners, "<u4")
                total = lambda x: np.bincount(owner, weights=x, minlength=len(docs))
                zero = np.zeros(len(docs))
                if kind == 1:  # value: training count of a word without id
                    part = np.column_stack([zero, zero, total(value > 0), total(np.log10(value + 1)), total(np.log10(value + 1) - rest_log)])
                else:
                    part = np.column_stack([zero, zero, zero, zero, total(value)])
            out.append((own_slice, d, np.ascontiguousarray(part, float).tobytes()))
        return pd.DataFrame(out, columns=["slice", "docs", "sums"])

    def total(blocks: pd.DataFrame) -> pd.DataFrame:
        """Sums per document over the blocks of one slice of texts, no more of them than the slice has tokens."""
        found = np.concatenate([np.frombuffer(d, np.int64).reshape(-1, 2) for d in blocks["docs"]])
        sums = np.concatenate([np.frombuffer(x, float).reshape(-1, 5) for x in blocks["sums"]])
        columns = {"_k1": found[:, 0], "_k2": found[:, 1], **{n: sums[:, i] for i, n in enumerate(("rows", "n_tokens", "n_known", "base", "score"))}}
        return pd.DataFrame(columns).groupby(["_k1", "_k2"], as_index=False).sum().astype({"rows": "int64", "n_tokens": "int64", "n_known": "int64"})

    rows = text_of(docs, id_col, text_col).select("_id", "_text", *row_key("_id", "_text"))
    sent = rows.select("_k1", "_k2", "_text").mapInArrow(send, BLOCK)
    bigrams = model.bigram_table.select(F.lit(2).alias("kind"), "key", F.col("gain").alias("value"))
    singles = model.word_table.select(F.lit(1).alias("kind"), F.col("word").alias("key"), F.col("n").cast("double").alias("value"))
    table = bigrams.unionByName(singles).withColumn("part", part_column(F.col("key"), n_parts))
    partial = sent.groupBy("part").cogroup(table.groupBy("part")).applyInPandas(answer, PARTIAL).groupBy("slice").applyInPandas(total, SUMS)
    sums = partial.groupBy("_k1", "_k2").agg(*[F.sum(c).alias(c) for c in ("rows", "n_tokens", "n_known", "base", "score")])
    found = rows.select("_id", "_k1", "_k2").join(sums, ["_k1", "_k2"])
    each = lambda c: F.col(c) / F.col("rows")
    return found.select(
        F.col("_id").alias(id_col), each("n_tokens").cast("long").alias("n_tokens"), each("n_known").cast("long").alias("n_known"),
        (each("base") - each("n_tokens") * F.lit(float(per_base))).alias("base_score"), each("score").alias("score"))


def part_of(keys: np.ndarray, n_parts: int) -> np.ndarray:
    """The part of each key: a mixing hash that ``part_column`` repeats in Spark."""
    return (mix_low(keys) % np.int64(n_parts)).astype(np.int64)


def mix_low(keys: np.ndarray) -> np.ndarray:
    return (keys ^ (keys >> np.int64(29)) ^ (keys >> np.int64(47))) & np.int64(0x7FFFFFFF)


def part_column(key: Column, n_parts: int) -> Column:
    mixed = key.bitwiseXOR(F.shiftright(key, 29)).bitwiseXOR(F.shiftright(key, 47)).bitwiseAND(0x7FFFFFFF)
    return F.pmod(mixed, F.lit(n_parts)).cast("int")


def held_out(id_col: str) -> Column:
    """Whether a document is kept out of training: one in seven, by the checksum of its id."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2
