"""Exact token counts at every prefix of a text, by dynamic programming.

Byte-pair encoding has one property that makes this possible: the tokens of a
text, cut after any token, are the tokens of the shorter text. So each prefix has
one last token, and ``count(prefix) = count(prefix without its last token) + 1``.
A token may be last where it can follow the last token of what stands before it,
that is, where the two together encode to themselves.

The vocabulary encodes words apart from each other (a letter run, a digit run, a
run of other marks, each with one space before it), so the programme runs over the
distinct words of many texts at once, and a text's table is put together from
them. The table has one signed byte for each character: the change of the count.
Any question about a budget is then a running sum, never another encoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tunelake.llm.bytewords import BASE, BASE_INVERSE, BYTE_CODES, distinct_spans, mix, powers, span_hash
from tunelake.llm.charruns import BLANK, runs
from tunelake.llm.rows import replace_columns, slices, worker_cache

LONG_WORD = 48  # bytes; longer words are followed one by one
PAIR_MEMORY = 2_000_000  # remembered token pairs of a worker, dropped together when full
WORD_MEMORY = 400_000  # remembered words of a worker, likewise
SLOT_BITS = 22
SLOT_SHIFT = np.uint64(64 - SLOT_BITS)
SLICE_BYTES = 2 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PrefixCounter:
    """Prefix tables of texts under one byte-level vocabulary file."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        symbols = byte_symbols()
        back = {s: b for b, s in enumerate(symbols)}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.symbols = {i: t for t, i in vocab.items()}
        self.ids = {bytes(back[c] for c in t): i for t, i in vocab.items()}
        self.lengths = sorted({len(t) for t in self.ids})
        keys, ids = [], []
        for n in self.lengths:
            own = [(t, i) for t, i in self.ids.items() if len(t) == n]
            raw = np.frombuffer(b"".join(t for t, _ in own), np.uint8).reshape(-1, n)
            keys.append(mix((BYTE_CODES[raw] * powers(BASE, n)[:n]).sum(axis=1, dtype=np.uint64) + np.uint64(n)))
            ids.append(np.array([i for _, i in own], np.int64))
        order = np.argsort(np.concatenate(keys))
        self.keys, self.key_ids = np.concatenate(keys)[order], np.concatenate(ids)[order]
        # A slot of a key's leading bits holds the one key there; slots with several are looked up in the sorted keys.
        slots = (self.keys >> SLOT_SHIFT).astype(np.int64)
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slots[slots] = np.arange(len(slots))
        again = slots[1:][slots[1:] == slots[:-1]]
        self.slots[again] = -2
        self.words = np.zeros(0, np.uint64)  # remembered words, sorted by their hash
        self.word_counts = np.zeros((0, LONG_WORD + 1), np.int8)
        self.pairs = np.zeros(0, np.int64)
        self.fit = np.zeros(0, bool)

    def tokenizes_apart(self, left: int, right: int) -> bool:
        text = self.symbols[left] + self.symbols[right]
        return [t.id for t in self.tokenizer.model.tokenize(text)] == [left, right]

    def follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether tokens side by side stay as they are."""
        keys = left << 20 | right
        wanted, place = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.pairs, wanted)
        known = np.zeros(len(wanted), bool)
        if len(self.pairs):
            known = self.pairs[np.minimum(at, len(self.pairs) - 1)] == wanted
        fresh = wanted[~known]
        if fresh.size:
            fits = np.array([self.tokenizes_apart(k >> 20, k & 0xFFFFF) for k in fresh.tolist()], bool)
            if len(self.pairs) > PAIR_MEMORY:
                self.pairs, self.fit = self.pairs[known[:0]], self.fit[known[:0]]
                return self.follows(left, right)
            merged = np.concatenate([self.pairs, fresh])
            order = np.argsort(merged, kind="stable")
            self.pairs, self.fit = merged[order], np.concatenate([self.fit, fits])[order]
            at = np.searchsorted(self.pairs, wanted)
        return self.fit[at][place]

    def token_at(self, key: np.ndarray) -> np.ndarray:
        """Index of the token with each hash, -1 where there is none."""
        found = self.slots[(key >> SLOT_SHIFT).astype(np.int64)]
        several = np.flatnonzero(found == -2)
        if several.size:
            found[several] = np.minimum(np.searchsorted(self.keys, key[several]), len(self.keys) - 1)
        wrong = np.flatnonzero(found >= 0)
        wrong = wrong[self.keys[found[wrong]] != key[wrong]]
        found[wrong] = -1
        return found

    def word_tables(self, keys: np.ndarray, sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Token count at every byte prefix of distinct words no longer than LONG_WORD; one row per word."""
        out = np.zeros((len(keys), LONG_WORD + 1), np.int8)
        known = np.zeros(len(keys), bool)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
            known = self.words[at] == keys
            out[known] = self.word_counts[at[known]]
        fresh = np.flatnonzero(~known)
        out[fresh] = self.fresh_tables(sums, inverse, start[fresh], size[fresh])
        if len(self.words) + len(fresh) > WORD_MEMORY:
            self.words, self.word_counts = keys[:WORD_MEMORY], out[:WORD_MEMORY].copy()
        else:
            self.words = np.concatenate([self.words, keys[fresh]])
            order = np.argsort(self.words, kind="stable")
            self.words = self.words[order]
            self.word_counts = np.concatenate([self.word_counts, out[fresh]])[order]
        return out

    def fresh_tables(self, sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        counts = np.zeros((len(size), LONG_WORD + 1), np.int8)
        last = np.zeros((len(size), LONG_WORD + 1), np.int32)
        most = int(size[0]) if len(size) else 0
        live_at = np.searchsorted(-size, -np.arange(most + 1), side="right")
        for end in range(1, most + 1):
            rows = np.arange(live_at[end])
            for n in reversed([n for n in self.lengths if n <= end]):
                a = start[rows] + (end - n)
                token = self.token_at(mix((sums[a + n] - sums[a]) * inverse[a] + np.uint64(n)))
                hit = np.flatnonzero(token >= 0)
                if not hit.size:
                    continue
                token = self.key_ids[token[hit]]
                if n < end:
                    fits = self.follows(last[rows[hit], end - n].astype(np.int64), token)
                    hit, token = hit[fits], token[fits]
                done = rows[hit]
                last[done, end] = token
                counts[done, end] = counts[done, end - n] + 1
                keep = np.ones(len(rows), bool)
                keep[hit] = False
                rows = rows[keep]
                if not rows.size:
                    break
        out = np.empty_like(counts)
        out[order] = counts
        return out

    def long_word(self, word: bytes) -> list[int]:
        """The same for one word of any length."""
        last, counts = [-1], [0]
        for end in range(1, len(word) + 1):
            for n in reversed([n for n in self.lengths if n <= end]):
                token = self.ids.get(word[end - n:end])
                if token is not None and (n == end or self.follows(np.array([last[end - n]]), np.array([token]))[0]):
                    last.append(token)
                    counts.append(counts[end - n] + 1)
                    break
        return counts

    def plain(self, texts: list[str]) -> np.ndarray:
        """Count at each character's end within its own text, for all texts in a row."""
        r = runs(texts, single_digits=False, blank_joins=True)
        n_points = len(r.points)
        if not n_points:
            return np.zeros(0, np.int64)
        start, stop = r.start, np.append(r.start[1:], n_points)
        blank = r.kind == BLANK
        # A run after white space of its own text: what is taken over from the white space.
        after_blank = np.zeros(len(start), bool)
        after_blank[1:] = blank[:-1] & ~blank[1:] & ~np.isin(start[1:], r.offsets)
        takes_space = after_blank & ~r.contraction
        takes_space[takes_space] = r.points[start[takes_space] - 1] == 0x20
        first = start - takes_space  # a joined space is part of the word that is encoded
        # White space that stands apart before a run, without its last character.
        loose = np.flatnonzero(after_blank & ~takes_space)
        spans_a = np.concatenate([r.byte_at[first], r.byte_at[start[loose] - 1]])
        spans_b = np.concatenate([r.byte_at[stop], r.byte_at[start[loose]]])
        size = spans_b - spans_a
        raw = np.frombuffer(r.data, np.uint8)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTE_CODES[raw] * powers(BASE, len(raw))[:len(raw)], out=sums[1:])
        inverse = powers(BASE_INVERSE, len(sums))
        keys = span_hash(raw, spans_a, spans_b)
        one, which = distinct_spans(raw, spans_a, spans_b, keys)
        short = size[one] <= LONG_WORD
        rows = np.cumsum(short) - 1
        table = self.word_tables(keys[one[short]], sums, inverse, spans_a[one[short]], size[one[short]])
        long_tables = {int(u): np.array(self.long_word(r.data[spans_a[one[u]]:spans_b[one[u]]])) for u in np.flatnonzero(~short)}

        def counts_at(span: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
            u = which[span]
            out = np.zeros(len(span), np.int64)
            ok = short[u]
            out[ok] = table[rows[u[ok]], n_bytes[ok]]
            for i in np.flatnonzero(~ok):
                out[i] = long_tables[int(u[i])][n_bytes[i]]
            return out

        n_runs = len(start)
        ids = np.arange(n_runs)
        whole = counts_at(ids, size[:n_runs])
        before = np.zeros(n_runs, np.int64)  # added by the run up to its own first character
        carried = np.flatnonzero(after_blank)
        last_blank = r.byte_at[start[carried] - 1] - r.byte_at[start[carried - 1]]
        before[carried] = counts_at(carried - 1, last_blank)
        before[loose] += counts_at(n_runs + np.arange(len(loose)), size[n_runs:])
        # White space before a word counts with the word, so it adds nothing to the running total itself.
        adds = whole + before
        adds[np.append(after_blank[1:], False)] = 0
        total = np.concatenate([[0], np.cumsum(adds)])
        # Each character's place in the flat tables: its word's row, then its byte within the word.
        u = which[:n_runs]
        chars = stop - start
        place = np.repeat(np.where(short[u], rows[u], 0) * table.shape[1] - r.byte_at[first], chars) + r.byte_at[1:]
        is_long = np.flatnonzero(~short[u])
        for i in is_long:
            place[start[i]:stop[i]] = 0
        counts = table.reshape(-1)[place].astype(np.int64) if len(table) else np.zeros(n_points, np.int64)
        for i in is_long:
            counts[start[i]:stop[i]] = long_tables[int(u[i])][r.byte_at[start[i] + 1:stop[i] + 1] - r.byte_at[first[i]]]
        return counts + np.repeat(total[:-1] + before, chars)

    def tables(self, texts: list[str]) -> list[bytes]:
        """For each text one signed byte per character: how the count changes with it."""
        out: list[bytes] = []
        plain = [i for i, t in enumerate(texts) if not any(s in t for s in self.specials)]
        chosen = [texts[i] for i in plain]
        counts = self.plain(chosen)
        ends = np.cumsum([len(t) for t in chosen]).astype(np.int64)
        steps = np.diff(counts, prepend=0)
        firsts = np.concatenate([[0], ends[:-1]])[np.array([len(t) > 0 for t in chosen], bool)] if chosen else np.zeros(0, int)
        firsts = firsts.astype(np.int64)
        steps[firsts] = counts[firsts] - np.where(firsts > 0, counts[firsts - 1], 0)
        packed = to_bytes(steps)
        made = dict(zip(plain, (packed[e - len(t):e] for t, e in zip(chosen, ends.tolist())), strict=True))
        for i, t in enumerate(texts):
            out.append(made[i] if i in made else self.with_specials(t))
        return out

    def with_specials(self, text: str) -> bytes:
        """A text that holds a special token, which is ordinary text until its last character."""
        parts, at, before = [], 0, 0
        while True:
            found = [(text.find(s, at), s) for s in self.specials if text.find(s, at) >= 0]
            if not found:
                break
            where, special = min(found)
            end = where + len(special)
            open_part = self.plain([text[at:end - 1]])
            whole = (self.plain([text[at:where]])[-1] if where > at else 0) + 1
            parts += [before + open_part, [before + whole]]
            at, before = end, before + whole
        parts.append(before + self.plain([text[at:]]))
        return to_bytes(np.diff(np.concatenate(parts), prepend=0))


def to_bytes(steps: np.ndarray) -> bytes:
    if steps.size and np.abs(steps).max() > 127:
        raise OverflowError("a character changes the count by more than a signed byte holds")
    return steps.astype(np.int8).tobytes()


def counter(vocabulary: str) -> PrefixCounter:
    cache = worker_cache()
    key = f"prefix_counter:{vocabulary}"
    if key not in cache:
        cache[key] = PrefixCounter(vocabulary)
    return cache[key]


def count_at(table: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters."""
    return int(np.frombuffer(table, np.int8)[:n_chars].sum(dtype=np.int64))


def longest_prefix(table: bytes, max_tokens: int) -> int:
    """Characters of the longest prefix that has at most ``max_tokens`` tokens."""
    counts = np.cumsum(np.frombuffer(table, np.int8), dtype=np.int64)
    fitting = np.flatnonzero(counts <= max_tokens)
    return int(fitting[-1]) + 1 if fitting.size else 0


def token_prefix_counts(
    docs: DataFrame, vocabulary: str, limit: int = 512, text_col: str = "text", keep_table: bool = True,
) -> DataFrame:
    """Add each whole text's token counts to its row.

    n_bytes, n_tokens  of the whole text; null counts as empty
    over_limit         whether n_tokens is above ``limit``
    cut_chars          characters of the longest prefix within ``limit``
    prefix_table       with ``keep_table``: the table itself, for ``count_at`` and ``longest_prefix``

    Rows are independent: repeated rows and ids are counted each. Columns of the
    input that have one of these names are replaced.
    """
    names = ["n_tokens", "cut_chars", *(["prefix_table"] if keep_table else [])]
    kinds = [pa.int64(), pa.int64(), pa.binary()]

    @arrow_udf("n_tokens long, cut_chars long" + ", prefix_table binary" * keep_table)
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = counter(vocabulary)
        for texts in batches:
            parts = [[], [], []]
            for a, b in slices(texts, SLICE_BYTES):
                made = tables.tables([t or "" for t in texts[a:b].to_pylist()])
                ends = np.concatenate([[0], np.cumsum([len(t) for t in made])]).astype(np.int64)
                runs_ = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(made), np.int8), dtype=np.int64)])
                totals = np.diff(runs_[ends])
                cuts = np.diff(ends)
                for i in np.flatnonzero(totals > limit):
                    cuts[i] = longest_prefix(made[i], limit)
                for part, values in zip(parts, (totals, cuts, made), strict=True):
                    part.extend(values)
            yield pa.StructArray.from_arrays([pa.array(p, k) for p, k in list(zip(parts, kinds, strict=True))[:len(names)]], names)

    text = F.col(text_col).cast("string")
    n_bytes = F.octet_length(F.coalesce(text, F.lit(""))).cast("long")
    out = replace_columns(docs, {"_counts": counted(text), "n_bytes": n_bytes})
    got = {name: F.col(f"_counts.{name}") for name in names}
    got["over_limit"] = F.col("_counts.n_tokens") > limit
    return replace_columns(out, got).drop("_counts")
