"""Token sequences: truncation, padding to batches, packing."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.functions.hashing import bucket_of, hash_int, order_key
from tunelake.functions.numbering import row_numbers
from tunelake.functions.ordered import BLOCK_ROWS, running_sum
from tunelake.functions.pytext import SPACE_CLASS
from tunelake.sinks.shared import shared_dir

PIECE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_" + SPACE_CLASS[1:]
VOCAB_SIZE = 32_768
PAD_ID = 0
IGNORE_LABEL = -100
AUX_FIELDS = ("token_type_ids", "mm_token_type_ids")

Tokenizer = Callable[[Column], Column]


def pieces(text: Column) -> Column:
    """Words and single marks of a text, in order."""
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def piece_ids(words: Column, vocab_size: int = VOCAB_SIZE) -> Column:
    """Ids from 1 on by hash, so no vocabulary has to be built or joined."""
    return F.transform(
        words, lambda w: (F.pmod(hash_int(w), F.lit(vocab_size - 1)) + 1).cast("int"))


def tokenize(
    df: DataFrame, max_len: int | None, *, text: str = "text", tokenizer: Tokenizer | None = None
) -> DataFrame:
    """Add ``n_tokens``, the full length, and ``input_ids``, cut at ``max_len`` if given.

    ``tokenizer`` maps a text column to an array of ints, for example a pandas
    UDF that loads a model's tokenizer once per worker. The default stays in the
    JVM and hashes only the pieces it keeps.
    """
    whole = df.withColumn("__ids", (tokenizer or pieces)(F.col(text)))
    kept = F.col("__ids") if max_len is None else F.slice("__ids", 1, max_len)
    if tokenizer is None:
        kept = piece_ids(kept)
    return whole.withColumn("n_tokens", F.size("__ids")).withColumn("input_ids", kept).drop("__ids")


def add_aux(df: DataFrame) -> DataFrame:
    """Attention mask of ones and the two all-zero arrays some models ask for."""
    def fill(v: int) -> Column:
        return F.transform("input_ids", lambda _: F.lit(v))

    return df.withColumn("attention_mask", fill(1)).withColumns({f: fill(0) for f in AUX_FIELDS})


def drop_aux(df: DataFrame) -> DataFrame:
    return df.drop(*AUX_FIELDS)


def bucketed(df: DataFrame, id_col: str, num_buckets: int) -> DataFrame:
    """Add ``bucket`` by a hash of the id, so that a new row never moves another one."""
    return df.withColumn("bucket", bucket_of(id_col, num_buckets))


def cut_to(df: DataFrame, max_len: int | None) -> DataFrame:
    """Cut ``input_ids`` at ``max_len`` if given, and add ``tokens_cut``, how many that left out."""
    if max_len is None:
        return df.withColumn("tokens_cut", F.lit(0))
    gone = F.greatest(F.size("input_ids") - max_len, F.lit(0))
    return df.withColumn("tokens_cut", gone).withColumn("input_ids", F.slice("input_ids", 1, max_len))


def seeded_order(df: DataFrame, id_col: str, num_buckets: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(rows, order): the rows with a key of their own, ``__uid``, and (__uid, bucket, row, size) for each.

    ``row`` numbers all rows from 1 on, by bucket, then in seeded order; rows alike
    in id are ordered by a hash of their ids. Only keys and sizes are sorted, over
    range partitions, so a bucket may hold most rows.
    """
    shared_dir(df.sparkSession)
    rows = bucketed(df, id_col, num_buckets).withColumn("__uid", F.monotonically_increasing_id()).checkpoint()
    keys = rows.select(
        "__uid", "bucket", order_key(id_col, seed).alias("__h"), F.col(id_col).alias("__id"),
        F.xxhash64("input_ids").alias("__t"), F.size("input_ids").alias("size"))
    order = row_numbers(keys, ["bucket", "__h", "__id", "__t"], "row")
    return rows, order.select("__uid", "bucket", "row", "size")


def collate(
    df: DataFrame, id_col: str, batch_size: int, *, num_buckets: int | None = None, max_len: int | None = None,
    pad_id: int = PAD_ID, seed: int = 42,
) -> DataFrame:
    """Group examples into batches and pad each to its batch's longest.

    Labels are the ids with every padded position ignored; a real token equal to
    ``pad_id`` keeps its label. Auxiliary arrays are cut or zero-padded to the
    same width, a missing one is all zeros. Examples longer than ``max_len`` are
    cut, and ``tokens_cut`` says by how much. With ``num_buckets``, each bucket is
    batched for itself, in one window, and ends in a batch of what is left. Without,
    batches run over all rows in seeded order, numbered over range partitions, so only the last one
    is not full, and ``bucket`` is 0.
    """
    cut = cut_to(df, max_len)
    if num_buckets is None:
        rows, order = seeded_order(cut, id_col, 1, seed)
        numbered = rows.drop("bucket").join(order.drop("size"), "__uid").drop("__uid").withColumn("__at", F.col("row") - 1).drop("row")
    else:
        in_bucket = Window.partitionBy("bucket").orderBy(order_key(id_col, seed), id_col)
        numbered = bucketed(cut, id_col, num_buckets).withColumn("__at", F.row_number().over(in_bucket) - 1)
    batched = (
        numbered
        .withColumn("batch", F.floor(F.col("__at") / F.lit(batch_size)))
        .withColumn("row_in_batch", (F.col("__at") % batch_size).cast("int"))
        .withColumn("width", F.max(F.size("input_ids")).over(
            Window.partitionBy("bucket", "batch")))
        .drop("__at")
    )
    width, length = F.col("width"), F.size("input_ids")

    def padded(ids: Column, with_: int) -> Column:
        gap = F.greatest(width - F.size(ids), F.lit(0))
        return F.slice(F.concat(ids, F.array_repeat(F.lit(with_), gap)), F.lit(1), width)

    aux = {
        f: padded(F.coalesce(F.col(f), F.array().cast("array<int>")), 0)
        for f in AUX_FIELDS if f in df.columns
    }
    mask = F.concat(
        F.transform("input_ids", lambda _: F.lit(1)), F.array_repeat(F.lit(0), width - length))
    return batched.withColumns({
        "labels": padded(F.col("input_ids"), IGNORE_LABEL), "attention_mask": mask, **aux,
    }).withColumn("input_ids", padded(F.col("input_ids"), pad_id))


def pack_wrapped(
    df: DataFrame, id_col: str, max_len: int, *, num_buckets: int, seed: int = 42, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Concatenate a bucket's examples and cut the stream every ``max_len`` tokens.

    Examples are sliced at block borders, so whole slices move and not single
    tokens. Places in the stream are running sums over blocks of rows.
    """
    rows, order = seeded_order(df.select(id_col, "input_ids"), id_col, num_buckets, seed)
    starts = running_sum(order, ["bucket"], "row", F.col("size"), "__start", inclusive=False, block_rows=block_rows)
    size = F.size("input_ids")
    placed = rows.drop("bucket").join(starts.select("__uid", "bucket", "__start"), "__uid")
    first = F.floor(F.col("__start") / F.lit(max_len))
    last = F.floor((F.col("__start") + size - 1) / F.lit(max_len))
    # An empty example has no block; exploding null leaves it out.
    cuts = placed.select("*", F.explode(F.when(size > 0, F.sequence(first, last))).alias("block"))
    lo = F.greatest(F.col("block") * max_len, F.col("__start"))
    hi = F.least((F.col("block") + 1) * max_len, F.col("__start") + size)
    slices = cuts.select(
        "bucket", "block", lo.alias("at"),
        F.slice("input_ids", (lo - F.col("__start") + 1).cast("int"), (hi - lo).cast("int"))
        .alias("ids"))
    joined = F.array_sort(F.collect_list(F.struct("at", "ids")))
    return slices.groupBy("bucket", "block").agg(
        F.flatten(F.transform(joined, lambda s: s["ids"])).alias("input_ids"))


class NextFit:
    """Next fit over one run of lengths, whatever state it is entered in.

    The state is how much of the open pack is used. A run turns the state it is
    entered in into the one it is left in, and all that the first depends on is the
    example that starts the first new pack; from there on every run is alike.
    """

    def __init__(self, lengths: np.ndarray, max_len: int):
        if len(lengths) and lengths.max() > max_len:
            raise ValueError(f"example of {lengths.max()} tokens does not fit into {max_len}")
        self.max_len = max_len
        self.ends = np.cumsum(lengths.astype(np.int64))
        self.begins = self.ends - lengths
        # The example that starts the next pack if this one starts one.
        self.next = np.searchsorted(self.ends, self.begins + max_len, side="right")

    def first_new(self, used: int) -> int:
        return int(np.searchsorted(self.ends, self.max_len - used, side="right"))

    def outcomes(self) -> tuple[list[int], list[int], list[int]]:
        """(reach, packs, used) of each example that may start the first new pack.

        ``reach`` is what the examples up to it need; it starts a pack where less is left.
        """
        n = len(self.ends)
        packs, used = [0] * (n + 1), [0] * (n + 1)
        last, total = self.next.tolist(), int(self.ends[-1])
        begins = self.begins.tolist()
        for i in range(n - 1, -1, -1):
            ended = last[i] == n
            packs[i], used[i] = (1, total - begins[i]) if ended else (packs[last[i]] + 1, used[last[i]])
        border = self.first_new(0) + 1  # later examples start no first pack
        own = [i for i in range(min(border, n)) if self.ends[i] > self.begins[i]]
        return [int(self.ends[i]) for i in own], [packs[i] for i in own], [used[i] for i in own]

    def places(self, pack: int, used: int) -> tuple[np.ndarray, np.ndarray]:
        """(pack, start) of each example, entered with ``used`` tokens in pack number ``pack``."""
        starts, at = [], self.first_new(used)
        while at < len(self.ends):
            starts.append(at)
            at = int(self.next[at])
        number = np.searchsorted(np.array(starts, np.int64), np.arange(len(self.ends)), side="right")
        base = np.concatenate([[-used], self.begins[starts]])
        return pack + number, self.begins - base[number]


def next_fit(order: DataFrame, max_len: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (__uid, row, pack, start) for rows (__uid, bucket, row, size): next fit along ``row`` in each bucket.

    Blocks of rows are folded at once into maps from the state they are entered in to
    the one they are left in. The maps, one row for each block, are applied one after
    another along a bucket; with the state each block is entered in, all blocks are packed at once.
    """
    blocks = order.withColumn("block", F.floor(F.col("row") / block_rows))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        run = NextFit(pdf.sort_values("row")["size"].to_numpy(), max_len)
        reach, packs, used = run.outcomes()
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "block": pdf["block"].iloc[:1], "total": run.ends[-1:], "reach": [reach], "packs": [packs], "used": [used]})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        pack, state, entered = 0, 0, []
        for total, reach, packs, used in zip(pdf["total"], pdf["reach"], pdf["packs"], pdf["used"], strict=True):
            entered.append((pack, state))
            at = int(np.searchsorted(np.asarray(reach, np.int64), max_len - state, side="right"))
            pack, state = (pack + packs[at], used[at]) if at < len(reach) else (pack, state + total)
        return pdf[["bucket", "block"]].assign(pack=[p for p, _ in entered], used=[u for _, u in entered])

    def place(rows: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        pack, start = NextFit(rows["size"].to_numpy(), max_len).places(int(entered["pack"].iloc[0]), int(entered["used"].iloc[0]))
        return rows[["__uid", "row"]].assign(pack=pack, start=start)

    maps = blocks.select("bucket", "block", "row", "size").groupBy("bucket", "block").applyInPandas(
        fold, "bucket bigint, block bigint, total bigint, reach array<bigint>, packs array<bigint>, used array<bigint>")
    entered = maps.groupBy("bucket").applyInPandas(chain, "bucket bigint, block bigint, pack bigint, used bigint")
    return blocks.groupBy("bucket", "block").cogroup(entered.groupBy("bucket", "block")).applyInPandas(
        place, "__uid bigint, row bigint, pack bigint, start bigint")


def pack_examples(
    df: DataFrame, id_col: str, max_len: int, *, num_buckets: int, cut_long: bool = False, seed: int = 42, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Put whole examples together, in seeded order, as long as they fit.

    One row per pack: the ids in order, where each example starts, the example ids,
    and how many tokens were cut. An example longer than ``max_len`` fails the job
    unless ``cut_long`` has it cut. Only places and lengths go through Python, in
    blocks of ``block_rows``, so a bucket may hold most rows; ids may repeat.
    """
    cut = cut_to(df.select(id_col, "input_ids"), max_len if cut_long else None).withColumnRenamed(id_col, "id")
    rows, order = seeded_order(cut, "id", num_buckets, seed)
    joined = F.array_sort(F.collect_list(F.struct("row", "start", "id", "input_ids", "tokens_cut")))
    return (
        rows.join(next_fit(order, max_len, block_rows), "__uid")
        .groupBy("bucket", "pack").agg(joined.alias("__rows"))
        .select(
            "bucket", "pack",
            F.flatten(F.transform("__rows", lambda r: r["input_ids"])).alias("input_ids"),
            F.transform("__rows", lambda r: r["start"]).alias("starts"),
            F.transform("__rows", lambda r: r["id"]).alias("example_ids"),
            F.aggregate("__rows", F.lit(0), lambda n, r: n + r["tokens_cut"]).alias("tokens_cut"))
    )


def profile(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, token totals and turns the template leaves out, per group."""
    unseen = F.size(F.filter(
        "messages", lambda m: ~F.coalesce(m["role"].isin("user", "assistant", "system"), F.lit(False))))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum("n_tokens").alias("tokens"),
        F.min("n_tokens").alias("min_tokens"),
        F.max("n_tokens").alias("max_tokens"),
        F.avg("n_tokens").alias("mean_tokens"),
        F.sum(unseen).alias("turns_left_out"),
    )
