"""Near-duplicate documents: a Jaccard join on word n-grams with MinHash bands.

Documents with the same n-gram set are one class, found by a hash of the set, so
copies are never compared. Classes that share a band of MinHashes are candidates.
Bands are not joined with themselves: each band ties its classes to the least of
them, and the connected groups of these ties are families. A family holds all
candidate pairs among its members, and is verified where they lie together: their
full n-gram sets meet in tasks of bounded size, a large family as pairs of blocks.
A task returns each member's number of links and a spanning tree of them, so its
output grows with the members and not with the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.bytewords import BASE, SPACE, mix, rolling, words
from tunelake.llm.components import components
from tunelake.llm.rows import cut, field_type, put_back, row_key, set_aside, slices, text_of

MAX_HASHES = 192
BLOCK_GRAMS = 1 << 18  # n-grams in one block of a family
BLOCK_MEMBERS = 1 << 10
CHUNK = 1 << 20  # pairs or cells held at once while counting


def band_plan(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have while a pair at the threshold shares one with the recall asked."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("the recall needs more hashes than allowed")
    return best


def gram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts in a row, and where each text's begin.

    Words are split at white space and A-Z lowered. A text of fewer than ``n``
    words has one n-gram, of all its words; one without words has none.
    """
    w = words(texts, SPACE)
    grams = rolling(w.hash, n)
    inside = np.arange(len(grams)) + n <= w.first[w.doc[:len(grams)] + 1]
    grams, doc = grams[inside], w.doc[:len(grams)][inside]
    sizes = np.diff(w.first)
    few = np.flatnonzero((sizes > 0) & (sizes < n))
    if few.size:
        grams = np.concatenate([grams, [rolling(w.hash[w.first[d]:w.first[d + 1]], int(sizes[d]))[0] for d in few]])
        doc = np.concatenate([doc, few])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[fresh], doc[fresh]
    return grams, np.searchsorted(doc, np.arange(len(texts) + 1))


def set_keys(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash per set, 0 for the empty one."""
    full = np.flatnonzero(np.diff(first))
    out = np.zeros(len(first) - 1, np.uint64)
    if full.size:
        out[full] = mix(np.add.reduceat(mix(grams ^ BASE), first[full]) + np.diff(first)[full].astype(np.uint64))
    return out.view(np.int64)


def band_keys(grams: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) of hashes; sets must not be empty."""
    rng = np.random.Generator(np.random.PCG64(97))
    factors = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    low = (grams >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(first), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(first), band, np.uint64)
        for i in range(band * rows, (band + 1) * rows):
            key = key * BASE + np.minimum.reduceat(low * factors[i] + shifts[i], first)
        out[:, band] = mix(key)
    return out.view(np.int64)


def sketched(rows: DataFrame, n: int, bands: int, band_rows: int) -> DataFrame:
    """Rows (_id, _k1, _k2, _set, _grams, _bands), one per document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(3)):
                grams, first = gram_sets(batch.column(3)[a:b], n)
                sizes = np.diff(first)
                full = np.flatnonzero(sizes)
                keys = band_keys(grams, first[full], bands, band_rows) if full.size else np.zeros((0, bands), np.int64)
                lengths = np.zeros(b - a + 1, np.int64)
                lengths[1:] = np.cumsum((sizes > 0) * bands)
                listed = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i)[a:b] for i in range(3)), pa.array(set_keys(grams, first)), pa.array(sizes.astype(np.int64)), listed],
                    names=["_id", "_k1", "_k2", "_set", "_grams", "_bands"])

    kind = field_type(rows, "_id").simpleString()
    keyed = rows.select("_id", *row_key("_id", "_text"), "_text")
    return keyed.mapInArrow(sketch, f"_id {kind}, _k1 long, _k2 long, _set long, _grams long, _bands array<long>")


def keyed_texts(rows: DataFrame, n: int) -> DataFrame:
    """Rows (_set, _text); texts of one set in the same slice are given once."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(0)):
                texts = batch.column(0)[a:b]
                grams, first = gram_sets(texts, n)
                keys, one = np.unique(set_keys(grams, first), return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), texts.take(pa.array(one))], names=["_set", "_text"])

    return rows.select("_text").mapInArrow(key, "_set long, _text string")


def shared_counts(member: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
    """Matrix of the number of n-grams that each two of ``n`` members have in common."""
    order = np.argsort(gram, kind="stable")
    member, gram = member[order], gram[order]
    begin = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(gram)))
    out = np.zeros((n, n), np.float32)
    rare = max(2, n // 12)
    for c in np.unique(count[(count > 1) & (count <= rare)]).tolist():  # pair by pair where few share an n-gram
        left, right = np.triu_indices(c, 1)
        rows = begin[count == c]
        step = max(1, CHUNK // len(left))
        for k in range(0, len(rows), step):
            own = member[rows[k:k + step, None] + np.arange(c)]
            pair = np.minimum(own[:, left], own[:, right]) * n + np.maximum(own[:, left], own[:, right])
            where, times = np.unique(pair, return_counts=True)
            out.reshape(-1)[where] += times
    common = np.flatnonzero(count > rare)
    step = max(1, CHUNK // max(n, 1))
    for k in range(0, len(common), step):  # by a matrix product where many do
        own = common[k:k + step]
        cells = np.zeros((n, len(own)), np.float32)
        cells[member[np.concatenate([np.arange(begin[g], begin[g] + count[g]) for g in own])], np.repeat(np.arange(len(own)), count[own])] = 1
        out += np.triu(cells @ cells.T, 1)
    return out


def least_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n places the least one that links lead to."""
    least = np.arange(n)
    while True:
        before = least.copy()
        low = np.minimum(least[left], least[right])
        np.minimum.at(least, left, low)
        np.minimum.at(least, right, low)
        least = least[least]
        if (least == before).all():
            return least


def verifier(n: int, threshold: float):
    """Verify all pairs of each family in a task, or those between its two blocks."""

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_root", "_set"], kind="stable").reset_index(drop=True)
        texts = pa.array(pdf.pop("_text"), pa.large_string())
        sets = [gram_sets(texts[a:b], n) for a, b in slices(texts)]
        del texts
        grams = np.concatenate([g for g, _ in sets])
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(f) for _, f in sets]))])
        keys, weight, block = pdf["_set"].to_numpy(), pdf["_rows"].to_numpy(), pdf["_block"].to_numpy()
        apart = pdf["_i"].iloc[0] != pdf["_j"].iloc[0]
        links, least = np.zeros(len(pdf), np.int64), keys.copy()
        bounds = np.flatnonzero(np.diff(pdf["_root"].to_numpy(), prepend=pdf["_root"].iloc[0] - 1, append=pdf["_root"].iloc[-1] + 1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            size = np.diff(first[a:b + 1])
            shared = shared_counts(np.repeat(np.arange(b - a), size), grams[first[a]:first[b]], b - a)
            left, right = np.nonzero(shared)
            common = shared[left, right].astype(np.float64)
            near = common >= threshold * (size[left] + size[right] - common) - 1e-9
            if apart:
                near &= block[a:b][left] != block[a:b][right]
            left, right = left[near], right[near]
            np.add.at(links, a + left, weight[a:b][right])
            np.add.at(links, a + right, weight[a:b][left])
            least[a:b] = keys[a:b][least_linked(b - a, left, right)]
        return pd.DataFrame({"_set": keys, "_links": links, "_least": least})

    return verify


def classified(docs: DataFrame, n: int, threshold: float, recall: float, id_col: str, text_col: str) -> DataFrame:
    """Rows (_id, _k1, _k2, _root, class_id, n_links), one per document; _root names the class, null without n-grams."""
    bands, band_rows = band_plan(threshold, recall)
    rows = text_of(docs, id_col, text_col)
    sketches = cut(sketched(rows, n, bands, band_rows))
    classes = cut(
        sketches.filter("_grams > 0").groupBy("_set")
        .agg(F.count("*").alias("_rows"), F.min("_id").alias("_least_id"), F.first("_grams").alias("_grams"), F.first("_bands").alias("_bands")))
    banded = classes.select("_set", F.explode("_bands").alias("_band"))
    heads = banded.groupBy("_band").agg(F.min("_set").alias("_head"), F.max("_set").alias("_last")).filter("_head != _last")
    ties = banded.join(heads, "_band").filter("_set != _head").select(F.col("_set").alias("a"), F.col("_head").alias("b"))
    families = cut(components(ties).select(F.col("node").alias("_set"), F.col("root").alias("_root")).join(
        classes.select("_set", "_rows", "_grams"), "_set"))
    size = families.groupBy("_root").agg(F.sum("_grams").alias("g"), F.count("*").alias("m")).select(
        "_root", "g", F.greatest(F.ceil(F.col("g") / BLOCK_GRAMS), F.ceil(F.col("m") / BLOCK_MEMBERS)).cast("int").alias("_blocks"))
    small_grams = size.filter("_blocks = 1").agg(F.sum("g")).first()[0] or 0
    tasks = max(1, -(-4 * small_grams // BLOCK_GRAMS))  # dealt by hash, so a quarter of a block each leaves room for uneven ones
    block = F.pmod(F.xxhash64("_set"), F.col("_blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda k: F.struct(
        F.least(k, "_block").alias("_i"), F.greatest(k, "_block").alias("_j")))
    placed = families.join(size.drop("g"), "_root").withColumn("_block", block).select(
        "_set", "_root", "_rows", "_block",
        F.when(F.col("_blocks") > 1, F.col("_root")).otherwise(F.pmod(F.xxhash64("_root"), F.lit(tasks))).alias("_task"),
        F.inline(pairs))
    texts = keyed_texts(rows, n).join(families.select("_set"), "_set").groupBy("_set").agg(F.first("_text").alias("_text"))
    verified = cut(placed.join(texts, "_set").groupBy("_task", "_i", "_j").applyInPandas(
        verifier(n, threshold), "_set long, _links long, _least long"))
    grouped = components(verified.filter("_set != _least").select(F.col("_set").alias("a"), F.col("_least").alias("b")))
    named = classes.select("_set", "_rows", "_least_id").join(grouped.withColumnRenamed("node", "_set"), "_set", "left")
    named = named.withColumn("_root", F.coalesce("root", "_set"))
    least = named.groupBy("_root").agg(F.min("_least_id").alias("class_id"))
    links = verified.groupBy("_set").agg(F.sum("_links").alias("_links"))
    known = named.join(least, "_root").join(links, "_set", "left").select(
        "_set", "_root", "class_id", (F.col("_rows") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"))
    joined = sketches.select("_id", "_k1", "_k2", F.when(F.col("_grams") > 0, F.col("_set")).alias("_set")).join(known, "_set", "left")
    return joined.select(
        "_id", "_k1", "_k2", "_root", F.when(F.col("_set").isNull(), F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def linked_documents(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows (id, class_id, n_links), one per document.

    Two documents are linked if the Jaccard similarity of their n-gram sets is at
    least ``threshold``. n_links counts the other rows linked to a row, copies among
    them. class_id is the least id of the documents that links lead to, over any
    number of steps. ``recall`` is the least chance of finding a pair right at the
    threshold; copies and pairs in one family are all found.

    Null, empty and blank texts have no n-grams, no links, and their own id as
    class. Repeated rows are copies of each other. Null ids are not least unless a
    class has no other; then its class_id is null.
    """
    return classified(docs, n, threshold, recall, id_col, text_col).select(F.col("_id").alias(id_col), "class_id", "n_links")


def one_of_each_class(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents, all columns, without near duplicates: of each class only the row with the least id stays.

    Null ids come last; then a hash of id and text decides. Of rows alike in id and
    text one stays, also where they have no n-grams; other such texts all stay.
    """
    found = classified(docs, n, threshold, recall, id_col, text_col)
    place = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_k1").alias("k1"), F.col("_k2").alias("k2"))
    grouped = found.filter("_root is not null").groupBy("_root").agg(F.min(place).alias("p")).select("p.k1", "p.k2")
    stay = grouped.unionByName(found.filter("_root is null").select(F.col("_k1").alias("k1"), F.col("_k2").alias("k2")))
    keyed = set_aside(docs, id_col, text_col).select("*", *row_key(id_col, text_col))
    kept = keyed.join(stay.distinct().toDF("_k1", "_k2"), ["_k1", "_k2"], "left_semi")
    return put_back(kept.dropDuplicates(["_k1", "_k2"]), docs.columns, id_col, text_col)
