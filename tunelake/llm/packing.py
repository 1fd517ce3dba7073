"""Packing documents into sequences: best fit in each partition, then a tree of merges.

A document's tokens, closed by an end token, are cut only where they exceed a
sequence. The pieces are dealt by hash over nodes of bounded size. Each node packs
its pieces best fit, longest first; sequences that are nearly full are finished.
What is left underfull goes up a tree as items of its own: nodes meet in groups of
``fan_in``, their sequences are packed into each other, and again only underfull
ones go on, up to a root. Pieces are shuffled once; only (sequence, size) rows
climb the tree.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tunelake.llm.bytewords import distinct_spans, span_hash
from tunelake.llm.charruns import BLANK, runs
from tunelake.llm.rows import cut, row_key, slices, stored, text_of, worker_cache

SIMPLE_END = "\u0250"  # characters below it are composed and have one lower case everywhere
WORD_MEMORY = 150_000  # encoded words a worker remembers, dropped together when full


class WordEncoder:
    """Ids of whole texts under a lower-casing word vocabulary, word by word."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, normalizers

        self.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.known: dict[bytes, bytes] = {}

    def word(self, word: str) -> bytes:
        text = self.tokenizer.pre_tokenizer.pre_tokenize_str(word)
        ids = [t.id for part, _ in text for t in self.tokenizer.model.tokenize(part)]
        return np.array(ids, "<u4").tobytes()

    def normal(self, text: str) -> str:
        """The vocabulary's normal form: composed and in lower case, one character at a time."""
        if text.isascii() or max(text) < SIMPLE_END:
            return text.lower()
        return self.normalizer.normalize_str(text)

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit bytes, for texts without special tokens."""
        r = runs([self.normal(t) for t in texts], single_digits=True, blank_joins=False)
        start, stop = r.byte_at[r.start], r.byte_at[np.append(r.start[1:], len(r.points))]
        word = r.kind != BLANK
        start, stop = start[word], stop[word]
        raw = np.frombuffer(r.data, np.uint8)
        one, which = distinct_spans(raw, start, stop, span_hash(raw, start, stop))
        known = self.known
        if len(known) > WORD_MEMORY:
            known.clear()
        made = []
        for a, b in zip(start[one].tolist(), stop[one].tolist(), strict=True):
            own = r.data[a:b]
            ids = known.get(own)
            if ids is None:
                ids = known[own] = self.word(own.decode())
            made.append(ids)
        flat = np.frombuffer(b"".join(made), "<u4")
        sizes = np.array([len(m) // 4 for m in made], np.int64)
        begin = np.cumsum(sizes) - sizes
        size = sizes[which]
        ends = np.cumsum(size)
        source = np.repeat(begin[which] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        ids = flat[source].tobytes()
        first_word = np.searchsorted(start, r.byte_at[r.offsets])
        at = np.concatenate([[0], ends])[first_word] * 4
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def with_specials(self, text: str) -> bytes:
        parts, at = [], 0
        while True:
            found = [(text.find(s, at), s) for s in self.specials if text.find(s, at) >= 0]
            if not found:
                return b"".join([*parts, *self.plain([text[at:]])])
            where, special = min(found)
            parts += [*self.plain([text[at:where]]), np.array([self.specials[special]], "<u4").tobytes()]
            at = where + len(special)

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [i for i, t in enumerate(texts) if not any(s in t for s in self.specials)]
        made = dict(zip(plain, self.plain([texts[i] for i in plain]), strict=True))
        return [made[i] if i in made else self.with_specials(t) for i, t in enumerate(texts)]


def encoder(vocabulary: str) -> WordEncoder:
    cache = worker_cache()
    key = f"word_encoder:{vocabulary}"
    if key not in cache:
        cache[key] = WordEncoder(vocabulary)
    return cache[key]


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str, text_col: str, keep_ids: bool = False) -> DataFrame:
    """Rows (_k1, _k2, _id, piece, start, length, ids_crc32[, ids]); each row's own tokens and the end token."""
    kinds = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    kinds += [("ids", pa.binary())] * keep_ids
    item = pa.struct(kinds)

    @arrow_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long" + ",ids:binary" * keep_ids + ">>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for texts in batches:
            rows, sizes = [[] for _ in kinds], []
            for a, b in slices(texts):
                for ids in words.encode([t or "" for t in texts[a:b].to_pylist()]):
                    ids += end
                    parts = [ids[i:i + 4 * capacity] for i in range(0, len(ids), 4 * capacity)]
                    sizes.append(len(parts))
                    for i, p in enumerate(parts):
                        values = (i, i * capacity, len(p) // 4, zlib.crc32(p), p)
                        for column, v in zip(rows, values[:len(kinds)], strict=True):
                            column.append(v)
            values = pa.StructArray.from_arrays([pa.array(c, k) for c, (_, k) in zip(rows, kinds, strict=True)], fields=list(item))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.ListArray.from_arrays(offsets, values)

    rows = text_of(docs, id_col, text_col)
    return rows.select(*row_key("_id", "_text"), "_id", F.inline(pieces("_text")))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, and the filling of each bin: best fit, longest first."""
    place, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    free: list[int] = []  # distinct free spaces, ascending
    bins: dict[int, list[int]] = {}
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect_left(free, size)
        if at == len(free):
            b, space = len(filled), capacity
            filled.append(0)
        else:
            space = free[at]
            b = bins[space].pop()
            if not bins[space]:
                del bins[space]
                free.pop(at)
        place[i], offset[i] = b, filled[b]
        filled[b] += size
        space -= size
        if space in bins:
            bins[space].append(b)
        elif space:
            bins[space] = [b]
            insort(free, space)
    return place, offset, filled


def pack_pieces(pieces: DataFrame, capacity: int, nearly_full: int, node_rows: int, fan_in: int) -> DataFrame:
    """Add (sequence_id, offset) to pieces: rows with _k1, _k2, piece, length.

    nearly_full  sequences with at least so many tokens are finished
    node_rows    pieces that a node packs, on average
    """
    n_nodes = max(1, -(-pieces.count() // node_rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_k1", "_k2", "piece"], kind="stable").reset_index(drop=True)
        place, offset, filled = best_fit(pdf["length"].to_numpy(), capacity)
        filled = np.array(filled, np.int64)
        return pdf.assign(_bin=(pdf["_node"].iloc[0] << 32) + place, offset=offset, _filled=filled[place])

    # The piece takes part, so that even copies of one long document are dealt apart.
    node = F.pmod(F.xxhash64("_k1", "piece", F.monotonically_increasing_id() % node_rows), F.lit(n_nodes))
    dealt = pieces.withColumn("_node", node)
    fields = T.StructType([*dealt.schema.fields, *(T.StructField(n, T.LongType()) for n in ("_bin", "offset", "_filled"))])
    packed = stored(dealt.groupBy("_node").applyInPandas(pack, fields), "packed-pieces")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.drop_duplicates("_now").sort_values("_now", kind="stable")
        place, offset, filled = best_fit(own["_filled"].to_numpy(), capacity)
        first = own["_now"].to_numpy()
        lead = np.zeros(len(filled), np.int64)
        lead[place[::-1]] = first[::-1]  # a merged sequence goes on under its first one's name
        at = place[np.searchsorted(first, pdf["_now"].to_numpy())]
        shift = offset[np.searchsorted(first, pdf["_now"].to_numpy())]
        out = pdf.assign(_now=lead[at], _shift=pdf["_shift"] + shift, _filled=np.array(filled, np.int64)[at])
        return out.assign(_done=out["_filled"] >= nearly_full)

    open_bins = (
        packed.filter(F.col("_filled") < nearly_full).select("_bin", "_node", "_filled").distinct()
        .select("_bin", F.col("_bin").alias("_now"), F.lit(0).cast("long").alias("_shift"), "_filled", "_node", F.lit(False).alias("_done")))
    finished = []
    nodes = n_nodes
    while nodes > 1:
        nodes = -(-nodes // fan_in)
        up = open_bins.withColumn("_node", (F.col("_node") / fan_in).cast("long"))
        # More sequences than a node holds are dealt over several; none is finished for lack of room.
        seats = up.groupBy("_node").agg(F.ceil(F.count("*") / node_rows).alias("_seats"))
        seat = F.pmod(F.xxhash64("_now"), F.col("_seats")).cast("long")
        merged = cut(up.join(seats, "_node").withColumn("_seat", seat).drop("_seats").groupBy("_node", "_seat").applyInPandas(
            lambda pdf: merge(pdf.drop(columns="_seat")), up.schema))
        finished.append(merged.filter("_done"))
        open_bins = merged.filter("not _done")
    moved = reduce(DataFrame.unionByName, [*finished, open_bins]).select("_bin", "_now", "_shift")
    return (
        packed.join(moved, "_bin", "left")
        .withColumn("sequence_id", F.coalesce("_now", "_bin"))
        .withColumn("offset", F.col("offset") + F.coalesce("_shift", F.lit(0)))
        .drop("_now", "_shift", "_bin", "_filled", "_node"))


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
    nearly_full: float = 0.98, node_rows: int = 20_000, fan_in: int = 8, keep_ids: bool = False,
) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32, sequence_id, offset[, ids]), one per piece.

    Every row of the input is packed, repeated rows and ids each for themselves; a
    null or empty text is one piece that holds the end token alone. Offsets run from
    0 without a gap in every sequence. Other columns of the input are left out.
    """
    pieces = stored(cut_pieces(docs, vocabulary, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    packed = pack_pieces(pieces, capacity, int(nearly_full * capacity), node_rows, fan_in)
    columns = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return packed.select(F.col("_id").alias(id_col), *columns)
