"""Where the sources of a language differ: term shares, their divergence, and the terms that mark a source.

Terms are counted in NumPy, slice by slice, without a dictionary. They are bucketed
by length: up to eight bytes are one 64-bit word, up to sixteen two, and the places
of a slice's terms are radix-sorted by these words, sixteen bits a pass. The passes
are stable and begin with the group of each text, so a run of equal words and groups
is one count, and changes of the text inside a run count its documents. Longer terms
have a bucket for each length, sorted by their bytes. Only counts are shuffled.

A language's divergences are summed over its terms in blocks. A block is a dense
table of counts, terms by sources, in which a term that a source does not have still
has its share, and is worked on in strips of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.bytewords import MASKS, eights, spans_array, words
from tunelake.llm.rows import slices, stored

SLICE_BYTES = 8 << 20
LEAST_DOCS = 3
UNIT = 1_000_000_000
BLOCK_TERMS = 20_000  # terms of a block, on average
STRIP_CELLS = 1 << 20
NOT_TERM = np.zeros(256, bool)  # after lowering: all of ASCII but a-z
NOT_TERM[:128] = True
NOT_TERM[0x61:0x7B] = False
COUNTS = "lang string, source string, term string, n long, docs long"
PAIRS = "lang string, source string, item string, value long"


def radix_order(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """``order`` sorted stably by ``key``, unsigned, sixteen bits a pass; a digit that all share is passed over."""
    for digit in range(0, 8 * key.dtype.itemsize, 16):
        d = (key >> key.dtype.type(digit)).astype(np.uint16)
        if len(d) and (d != d[0]).any():
            order = order[np.argsort(d[order], kind="stable")]  # NumPy's stable sort of 16-bit integers is a radix sort
    return order


def runs_of(order: np.ndarray, keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, n, docs) of each run of equal keys along ``order``, in which a run's documents ascend."""
    if not len(order):
        return order, order, order
    new = np.ones(len(order), bool)
    new[1:] = False
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    d = doc[order]
    fresh = new.copy()
    fresh[1:] |= d[1:] != d[:-1]
    begin = np.flatnonzero(new)
    return order[begin], np.diff(np.append(begin, len(order))), np.add.reduceat(fresh.astype(np.int64), begin)


def term_runs(w, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, n, docs) of every term in every group of a slice."""
    view, size = eights(w.data), w.end - w.start
    found = []
    for own in (np.flatnonzero(size <= 8), np.flatnonzero((size > 8) & (size <= 16))):
        # No term holds a zero byte, so the zeros behind a term tell its length.
        parts = [view[w.start[own]] & MASKS[np.minimum(size[own], 8)]]
        if own.size and size[own[0]] > 8:
            parts.append(view[w.start[own] + 8] & MASKS[size[own] - 8])
        code = group[w.doc[own]]
        order = np.arange(len(own))
        for key in (code, *parts):
            order = radix_order(order, key)
        first, n, docs = runs_of(order, [code, *parts], w.doc[own])
        found.append((own[first], n, docs))
    for length in np.unique(size[size > 16]).tolist():
        own = np.flatnonzero(size == length)
        for part in np.array_split(own, -(-len(own) * length // SLICE_BYTES)):  # a copy of the bytes, a slice of them at a time
            text = w.data[w.start[part][:, None] + np.arange(length)].view(f"S{length}").reshape(-1)
            code = group[w.doc[part]]
            order = radix_order(np.arange(len(part)), code)
            order = order[np.argsort(text[order], kind="stable")]
            first, n, docs = runs_of(order, [code, text], w.doc[part])
            found.append((part[first], n, docs))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def counted(rows: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): partial counts, one row for each slice of texts that has the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(2), SLICE_BYTES):
                labels = [batch.column(i)[a:b].dictionary_encode() for i in (0, 1)]
                lang, source = (x.indices.to_numpy(zero_copy_only=False).astype(np.uint64) for x in labels)
                both, group = np.unique(lang << np.uint64(32) | source, return_inverse=True)
                w = words(batch.column(2)[a:b], NOT_TERM)
                first, n, docs = term_runs(w, group.astype(np.uint32))
                own = both[group[w.doc[first]]] if len(first) else both[:0]
                yield pa.RecordBatch.from_arrays([
                    labels[0].dictionary.take(pa.array(own >> np.uint64(32))), labels[1].dictionary.take(pa.array(own & np.uint64(0xFFFFFFFF))),
                    spans_array(w.data, w.start[first], w.end[first]).cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64))],
                    [f.split()[0] for f in COUNTS.split(", ")])

    return rows.mapInArrow(count, COUNTS)


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + size)), as a long."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", above, (total + size).cast("decimal(20,0)")) + 1


def gain(p: Column, q: Column) -> Column:
    """floor((p - q) * (p - q) / q); shares are at most UNIT + 1, so it fits into a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def shares(n: np.ndarray, total: np.ndarray, size: int) -> np.ndarray:
    """What :func:`share` gives, three digits at a time, so that no product passes 64 bits."""
    below = total + size
    digits, rest = np.zeros(np.broadcast_shapes(n.shape, below.shape), np.int64), n + 1
    for _ in range(3):
        whole, rest = rest // below, rest % below
        digits, rest = (digits + whole) * 1000, rest * 1000
    return 1 + digits + rest // below


def divergences(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Sums of gains over a block of one language's terms, for all its pairs of sources."""
    right = right.sort_values("source", kind="stable").reset_index(drop=True)
    names, total, n_sources = right["source"].to_numpy(), right["total"].to_numpy(np.int64), len(right)
    size = int(right["size"].iloc[0]) if n_sources else 0
    sums = np.zeros((n_sources, n_sources), np.int64)
    place = {s: i for i, s in enumerate(names)}
    strip = max(1, STRIP_CELLS // max(1, n_sources))
    entries = list(zip(left["sources"], left["counts"], strict=True))
    for a in range(0, len(entries), strip):
        own = entries[a:a + strip]
        n = np.zeros((n_sources, len(own)), np.int64)
        for j, (sources, counts) in enumerate(own):
            n[[place[s] for s in sources], j] = counts
        p = shares(n, total[:, None], size)
        for i in range(n_sources):
            apart = p[i] - p
            sums[i] += (apart * apart // p).sum(axis=1)
    rest = ~np.eye(n_sources, dtype=bool)
    for i in range(n_sources):
        yield pd.DataFrame({"lang": right["lang"].iloc[0], "source": names[i], "item": names[rest[i]], "value": sums[i][rest[i]]})


def audit(
    docs: DataFrame, top: int = 200, least_docs: int = LEAST_DOCS, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how far sources of a language differ, and by which terms.

    Terms are runs of letters a-z, after lowering A-Z, and of all beyond ASCII. A
    language keeps those in ``least_docs`` of its documents. With p and q the shares
    of a term in a billion, every kept term given one occurrence more, a gain is
    floor((p - q)**2 / q). Part ``pair``: the gains of a source against each other
    source of its language, summed over all kept terms, 0 if there are none. Part
    ``term``: the terms a source has more of than its language, by their gain,
    ``top`` at most. Ranks run from 1, larger values first, then by item.

    Null texts, languages and sources count as empty strings. Every row is a document,
    repeated rows and those without an id too; an empty table gives no rows. Other
    columns are not read. The pairs of a language's sources are the result, so rows
    grow with the square of their number.
    """
    own = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    rows = docs.select(own(lang_col, "lang"), own(source_col, "source"), own(text_col, "text"))
    # One exchange by (lang, term) serves both sums.
    dealt = counted(rows).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = dealt.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    terms = stored(terms.filter(F.col("docs") >= least_docs).drop("docs"), "terms")
    languages = terms.groupBy("lang").agg(F.count("*").alias("size"), F.sum("lang_n").alias("lang_total"))
    totals = terms.select("lang", F.inline("sources")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    groups = stored(groups.fillna(0, ["total", "size", "lang_total"]), "groups")

    marked = terms.select("lang", "term", "lang_n", F.inline("sources")).join(groups, ["lang", "source"])
    marked = marked.withColumns({"p": share(F.col("n"), F.col("total"), F.col("size")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("size"))})
    marked = marked.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gain(F.col("p"), F.col("q")).alias("value"))

    blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    left = terms.select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"), F.col("sources.source").alias("sources"), F.col("sources.n").alias("counts"))
    right = groups.select("lang", "source", "total", "size", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    sums = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInPandas(
        lambda a, b: pd.concat([pd.DataFrame({"lang": [], "source": [], "item": [], "value": []}), *divergences(a, b)]), PAIRS)
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(best)
    return marked.withColumn("rank", rank).filter(F.col("rank") <= top).unionByName(pairs.withColumn("rank", rank)).select(
        "lang", "source", "part", "item", "value", "rank")
