"""Phrases that stand together: counts from depth-truncated suffix subtrees, built group by group.

Every place of a text starts a suffix of at most ``MAX_WORDS`` words. Suffixes are
partitioned vertically, by their first words, and the prefixes are dealt over so many
groups that a group's suffixes fill half the memory budget. A prefix with more
occurrences than a quarter of the budget is extended by further words. A group's subtree is built
alone, level by level: a node's children are its suffixes' next words, its count is the
sum of the leaves below it, and a node below the least count is not extended.

This is done twice: first to a depth of two words, under prefixes of one, then to the
full depth, under prefixes of two. A phrase is frequent only if all words and all
neighbours in it are, so in either pass suffixes end before the first word that cannot
go on, and places where nothing frequent starts are not sent. Phrases shorter than an extended prefix have
leaves in several groups, and their counts are summed up afterwards.

Words are sent as bytes, once for each block of suffixes, and compared as bytes.
Bitmaps of fixed size are known to all tasks: of words and pairs that may be frequent
and of prefixes to be extended. They are filled by hashes; a chance hit sends a suffix
that is not needed or cuts a group finer, and changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.bytewords import STEP, distinct_spans, mix, spans_array, words
from tunelake.llm.rows import slices, stored

MAX_WORDS = 5
BLANK = pa.scalar(" ", pa.large_string())
BUDGET = 4_000_000  # suffixes of a group that a task can hold
BITS = 24  # each bitmap has 2**BITS bits, two megabytes
SLICE_BYTES = 6 << 20
MERGED = 1 << 20  # distinct words a task gathers before it sends them on
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
SEPARATOR = BREAK.copy()
SEPARATOR[[0x20, 0x09]] = True
BLOCK = "part long, words binary, sizes binary, wide boolean, ids binary, partial binary, n binary"


class Words(NamedTuple):
    """The words of a slice of texts; an entry is a word in a language."""

    entries: pa.Array  # "word lang"
    keys: np.ndarray  # hash of each entry
    which: np.ndarray  # entry of each word
    hash: np.ndarray  # of each word alone
    piece: np.ndarray  # grows where a new piece starts
    sizes: list  # (lang, number of words)


def lang_keys(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], np.uint64)


def words_of(langs: pa.Array, texts: pa.Array) -> Words:
    w = words(texts, SEPARATOR)
    found = langs.dictionary_encode()
    names = found.dictionary.to_pylist()
    code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)[w.doc] if len(w.doc) else np.zeros(0, np.int64)
    keys = mix(w.hash ^ lang_keys(names)[code])
    one, which = distinct_spans(w.data, w.start, w.end, keys, code)
    entries = pc.binary_join_element_wise(
        spans_array(w.data, w.start[one], w.end[one]), pa.array(names, pa.large_string()).take(pa.array(code[one])), BLANK)
    piece = np.searchsorted(np.flatnonzero(BREAK[w.data]), w.start) + w.doc
    sizes = np.bincount(code, minlength=len(names))
    return Words(entries, keys[one], which, w.hash, piece, list(zip(names, sizes.tolist(), strict=True)))


def split_entries(entries: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(lang, word); a word holds no space, so the first one ends it."""
    lists = pc.split_pattern(entries, " ", max_splits=1)
    return pc.list_element(lists, 1), pc.list_element(lists, 0)


def has_bit(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - BITS)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """Bits of the leading digits of a column ``key``: 2**BITS at most, however many keys there are."""
    place = F.shiftrightunsigned("key", 64 - BITS) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(place).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for at, bits in maps.collect():
        out[(at - 1) * 4096:at * 4096] = np.frombuffer(bits, np.uint8)
    return out


def count_words(rows: DataFrame) -> DataFrame:
    """(lang, word, n): how often each word occurs; a null word stands for all words of a language."""

    def merge(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by("entry").aggregate([("n", "sum")]).rename_columns(["entry", "n"])

    def send(table: pa.Table) -> Iterator[pa.RecordBatch]:
        lang, word = split_entries(table["entry"].combine_chunks())
        yield pa.RecordBatch.from_arrays([lang.cast(pa.string()), word.cast(pa.string()), table["n"].combine_chunks()], ["lang", "word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                w = words_of(batch.column(0)[a:b], batch.column(1)[a:b])
                for lang, n in w.sizes:
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([n])], ["lang", "word", "n"])
                held.append(pa.table([w.entries, pa.array(np.bincount(w.which, minlength=len(w.keys)))], ["entry", "n"]))
                if sum(map(len, held)) >= 2 * MERGED:
                    held = [merge(held)]
                    if len(held[0]) >= MERGED:
                        yield from send(held.pop())
        if held:
            yield from send(merge(held))

    return rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def entry_keys(table: DataFrame) -> DataFrame:
    """(key) of the words of rows (lang, word), or of the pairs of rows (lang, word, next)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(256, bool)
        for batch in batches:
            found = batch.column(0).dictionary_encode()
            code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            key = mix(words(batch.column(1), none, lower=False).hash ^ lang_keys(found.dictionary.to_pylist())[code])
            if batch.num_columns > 2:
                key = mix(key * STEP + words(batch.column(2), none, lower=False).hash)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

    return table.select(*[c for c in ("lang", "word", "next") if c in table.columns]).mapInArrow(hashed, "key long")


class Suffixes(NamedTuple):
    ids: np.ndarray  # (words, n): entry + 1 of each word, 0 behind the end; sorted
    prefix: np.ndarray  # hash of the words that decide the group
    partial: np.ndarray  # whether the prefix was extended
    n: np.ndarray  # how often each occurs
    entries: pa.Array


def suffixes_of(langs: pa.Array, texts: pa.Array, frequent: np.ndarray, pairs: np.ndarray | None, extended: np.ndarray) -> Suffixes:
    """Distinct suffixes of a slice of texts.

    Without ``pairs``: of two words, under prefixes of one. With it: of three words or
    more, under prefixes of two, as long as neighbours may be frequent.
    """
    w = words_of(langs, texts)
    depth, short = (2, 1) if pairs is None else (MAX_WORDS, 2)
    id_ = np.where(has_bit(frequent, w.keys), np.arange(1, len(w.keys) + 1), 0).astype(np.uint32)[w.which]
    goes_on = np.zeros(len(id_) + MAX_WORDS, bool)
    goes_on[:max(len(id_) - 1, 0)] = (w.piece[1:] == w.piece[:-1]) & (id_[1:] > 0) & (id_[:-1] > 0)
    if len(id_) > 1 and pairs is not None:
        linked = np.flatnonzero(goes_on)
        goes_on[linked] = has_bit(pairs, mix(w.keys[w.which[linked]] * STEP + w.hash[linked + 1]))
    starts = goes_on.copy()
    for k in range(1, short):
        starts[:-k] &= goes_on[k:]
    at = np.flatnonzero(starts)
    ids, live = np.zeros((depth, len(at)), np.uint32), np.ones(len(at), bool)
    ids[0] = id_[at]
    for k in range(1, depth):
        live &= goes_on[at + k - 1]
        ids[k, live] = id_[at[live] + k]
    order = np.lexsort(ids[::-1])
    ids = ids[:, order]
    new = np.ones(len(at), bool)
    new[1:] = (ids[:, 1:] != ids[:, :-1]).any(axis=0)
    begin = np.flatnonzero(new)
    n, ids, at = np.diff(np.append(begin, len(order))), ids[:, begin], at[order[begin]]
    prefix = w.keys[w.which[at]]
    if pairs is not None:
        prefix = mix(prefix * STEP + w.hash[at + 1])
    partial = has_bit(extended, prefix)
    own = np.flatnonzero(partial)
    for k in range(short, depth):  # an extended prefix is the whole suffix
        there = ids[k, own] > 0
        prefix[own] = mix(prefix[own] * STEP + np.where(there, w.hash[np.minimum(at[own] + k, len(id_) - 1)], np.uint64(0)))
    return Suffixes(ids, prefix, partial, n, w.entries)


def dealt_suffixes(rows: DataFrame, frequent: np.ndarray, pairs: np.ndarray | None, extended: np.ndarray, parts: int) -> DataFrame:
    """One row per slice of texts and group: the slice's suffixes with the group's prefixes, and their words."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                s = suffixes_of(batch.column(0)[a:b], batch.column(1)[a:b], frequent, pairs, extended)
                part = ((mix(s.prefix + STEP) >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                bounds = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1)) if len(order) else []
                made = []
                local = np.zeros(len(s.entries) + 1, np.uint32)
                for x, y in zip(bounds[:-1], bounds[1:], strict=True):
                    own = order[x:y]
                    ids = s.ids[:, own]
                    used = np.flatnonzero(np.bincount(ids.reshape(-1), minlength=len(local))[1:])
                    local[used + 1] = np.arange(1, len(used) + 1)
                    texts = s.entries.take(pa.array(used))
                    wide = len(used) >= 0xFFFF
                    made.append((
                        int(part[own[0]]), b"".join(t.as_buffer() for t in texts), pc.binary_length(texts).to_numpy().astype("<u4").tobytes(), wide,
                        local[ids].astype("<u4" if wide else "<u2").tobytes(), s.partial[own].tobytes(), s.n[own].astype("<u4").tobytes()))
                    local[used + 1] = 0
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
                columns = list(zip(*made, strict=True)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [f.split()[0] for f in BLOCK.split(", ")])

    return rows.mapInArrow(deal, BLOCK)


def subtree(least: int, depth: int, short: int):
    """Builds one group's subtree: rows (lang, phrase, k, n) of its nodes of more than ``short`` words."""

    def build(blocks: pa.Table) -> pa.Table:
        views = lambda c, kind: [np.frombuffer(x.as_buffer(), kind) for x in blocks[c]]
        lengths = views("sizes", "<u4")
        sizes = np.concatenate(lengths).astype(np.int64)
        ends = np.cumsum(sizes)
        names = spans_array(np.concatenate(views("words", np.uint8)), ends - sizes, ends).dictionary_encode()
        number = names.indices.to_numpy(zero_copy_only=False).astype(np.int32) + np.int32(1)
        partial, n = np.concatenate(views("partial", bool)), np.concatenate(views("n", "<u4"))
        # Entries of all blocks under one number each, 0 still behind the end.
        ids, at, row = np.zeros((depth, len(n)), np.int32), 0, 0
        for own, wide, x in zip(lengths, blocks["wide"].to_pylist(), blocks["ids"], strict=True):
            local = np.frombuffer(x.as_buffer(), "<u4" if wide else "<u2").reshape(depth, -1)
            ids[:, row:row + local.shape[1]] = np.concatenate([[0], number[at:at + len(own)]]).astype(np.int32)[local]
            at, row = at + len(own), row + local.shape[1]
        lang, word = split_entries(names.dictionary)
        root, node = np.unique(ids[0], return_inverse=True)
        phrase, lang = word.take(pa.array(root - 1)), lang.take(pa.array(root - 1))
        out = []
        for k in range(2, depth + 1):
            live = np.flatnonzero(ids[k - 1] > 0)
            ids, partial, n, node = ids[:, live], partial[live], n[live], node[live]
            child, node = np.unique(node << 32 | ids[k - 1], return_inverse=True)
            times = np.bincount(node, weights=n, minlength=len(child)).astype(np.int64)
            stays = times >= least
            if k < depth:
                stays[node[partial]] = True  # other leaves of these lie in other groups
            kept = np.flatnonzero(stays)
            phrase = pc.binary_join_element_wise(
                phrase.take(pa.array(child[kept] >> 32)), word.take(pa.array((child[kept] & 0xFFFFFFFF) - 1)), BLANK)
            lang = lang.take(pa.array(child[kept] >> 32))
            if k > short:
                out.append(pa.table([lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(np.full(len(kept), k, np.int32)), pa.array(times[kept])], ["lang", "phrase", "k", "n"]))
            renumbered = np.cumsum(stays) - 1
            on = stays[node]
            ids, partial, n, node = ids[:, on], partial[on], n[on], renumbered[node[on]]
        return pa.concat_tables(out)

    return build


PHRASES = "lang string, phrase string, k int, n long"


def mined_phrases(docs: DataFrame, least: int = 100, budget: int = BUDGET, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(phrases, words): (lang, phrase, k, n) of all phrases of 2 to MAX_WORDS words, and (lang, word, n), that occur ``least`` times or more.

    A row of ``words`` without a word has the number of all words of its language.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    vocabulary = stored(count_words(rows).filter(F.col("word").isNull() | (F.col("n") >= least)), "phrase-words")
    known = vocabulary.filter("word is not null")
    frequent = bitmap_of(entry_keys(known))
    parts = lambda total: max(1, -(-2 * (total or 0) // budget))
    many = F.col("n") > budget // 4

    total = known.agg(F.sum("n")).first()[0]
    dealt = dealt_suffixes(rows, frequent, None, bitmap_of(entry_keys(known.filter(many))), parts(total))
    pairs = stored(dealt.groupBy("part").applyInArrow(subtree(least, 2, 1), PHRASES), "phrase-pairs")

    two = pairs.select("lang", F.substring_index("phrase", " ", 1).alias("word"), F.substring_index("phrase", " ", -1).alias("next"), "n")
    total = pairs.agg(F.sum("n")).first()[0]
    dealt = dealt_suffixes(rows, frequent, bitmap_of(entry_keys(two)), bitmap_of(entry_keys(two.filter(many))), parts(total))
    found = dealt.groupBy("part").applyInArrow(subtree(least, MAX_WORDS, 2), PHRASES)
    longer = stored(found.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrases")
    return pairs.unionByName(longer), vocabulary


def exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def collocations(
    docs: DataFrame, least: int = 100, top: int = 2000, budget: int = BUDGET, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the phrases of each language that hold together most.

    Texts are lowered (A-Z), split into pieces at ``.,;:!?`` and line ends, and these
    into words at spaces and tabs. A phrase is 2 to 5 words of one piece; a counts all
    its occurrences, n all words of the language. Cutting it in two gives l and r, the
    counts of its parts, and floor(1000 * a * n / (l * r)); the cut with the least of
    these is taken, the first of several. A phrase is left out if a longer one with as
    many occurrences holds it. Ties are ordered by a, the larger first, then by phrase.

    A null text is empty, a null language is ``und`` and meets texts labelled so. Every
    row counts, repeated ones and those without an id too. Without phrases there are
    no rows. Other columns are not read.
    """
    phrases, vocabulary = mined_phrases(docs, least, budget, lang_col, text_col)
    counts = phrases.select("lang", "phrase", "n").unionByName(
        vocabulary.filter("word is not null").select("lang", F.col("word").alias("phrase"), "n"))
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', cut)"), "right": F.expr("substring_index(phrase, ' ', cut - k)")})
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    total = vocabulary.filter("word is null").select("lang", F.col("n").alias("n"))
    scored = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(total, "lang")
    scored = scored.withColumns({"_above": exact(F.lit(1000)) * exact(F.col("a")) * exact(F.col("n")), "_below": exact(F.col("l")) * exact(F.col("r"))})
    scored = scored.withColumn("score", F.expr("_above div _below"))
    worst = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_cut"))
    # A longer phrase with as many occurrences has one of one word more, so those are enough.
    inner = phrases.filter("k > 2").select("lang", "n", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("n").alias("_longer"))
    kept = worst.join(longer, ["lang", "phrase"], "left").filter(F.col("_longer").isNull() | (F.col("_longer") < F.col("a")))
    kept = kept.select("lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
