"""Mixing sources to target weights: how many times each document is taken, by pivotal rounding.

A source's target over its size is the number of copies each of its documents should
have. The whole part is taken; what is left is a chance below one, rounded to 0 or 1
so that the words taken hardly change: two documents are paired, and words move from
one to the other until one has a whole number of copies. Which way they move is drawn
so that no document's expectation changes. The other one stays open and is paired with the next.

Documents are dealt by hash over nodes of bounded size; each leaves at most one open
document per source. These climb a tree: nodes meet in groups of ``fan_in``, their
open documents are paired by the same rule, down to one for each source, which goes
to the nearer whole number. So a source misses its target by at most half the size
of one document. Draws are hashes of the rows, and reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions.numbering import row_numbers
from tunelake.llm.rows import stored

WORD = r"[^\x20\x09-\x0D]+"
WHOLE = 1e-9  # closer to a whole number than this is whole
ALIKE = 1_000  # rows alike in id, source and size that are settled together
SOURCES = 10_000  # sources of a node in the tree, on average


def settle(size: np.ndarray, part: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int, float]:
    """(up, open, part): 0 or 1 for each item, and the one still open (-1: none) with what it has.

    Items are paired in the order given, the larger ones first, so that what stays open is small.
    """
    up = np.zeros(len(size), np.int64)
    held, have = -1, 0.0
    for i, (words, own, u) in enumerate(zip(size.tolist(), part.tolist(), draw.tolist(), strict=True)):
        if held < 0:
            held, have, held_words = i, own, words
        else:
            gives, takes = own * words, (1 - own) * words  # to the held one until this is 0; from it until this is 1
            needs, has = (1 - have) * held_words, have * held_words
            to_held, from_held = min(needs, gives), min(has, takes)
            if u * (to_held + from_held) < from_held:
                if needs <= gives:
                    up[held] = 1
                    held, have, held_words = i, own - needs / words, words
                else:
                    have += gives / held_words
            elif has <= takes:
                held, have, held_words = i, own + has / words, words
            else:
                up[i] = 1
                have -= takes / held_words
        if have < WHOLE or have > 1 - WHOLE:
            up[held] = round(have)
            held = -1
    return up, held, have


def settled(pdf: pd.DataFrame) -> pd.DataFrame:
    """One node: ``_up`` of every item, and ``_open`` for the one of each source that goes on, with what it has as its ``_part``."""
    pdf = pdf.sort_values(["_rank", "_size", "_draw"], ascending=[True, False, True], kind="stable").reset_index(drop=True)
    size, part = pdf["_size"].to_numpy(float), pdf["_part"].to_numpy(float)
    draw = (pdf["_draw"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)) / 2.0**53
    up, still = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), bool)
    rank = pdf["_rank"].to_numpy()
    bounds = np.flatnonzero(np.diff(rank, prepend=rank[0] - 1, append=rank[-1] + 1))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        up[a:b], held, have = settle(size[a:b], part[a:b], draw[a:b])
        if held >= 0:
            still[a + held], part[a + held] = True, have
    return pdf.assign(_up=up, _open=still, _part=part)


def fixed(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def level_of(sources: DataFrame, cap: int) -> tuple[int, int]:
    """(words, weights): words left for the sources below their cap, and their weights. One row comes back for each round."""
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weights = int(total or 0), int(weights or 1)
    words, below, full = total, weights, -1
    while True:
        over = (F.col("source_size") * cap).cast("decimal(38,0)") * fixed(below) < F.col("weight").cast("decimal(38,0)") * fixed(words)
        n, capped, taken = sources.filter(over).agg(F.count("*"), F.sum(F.col("source_size") * cap), F.sum("weight")).first()
        if n == full:
            return words, below
        full, words, below = n, total - int(capped or 0), max(1, weights - int(taken or 0))


def targets(sources: DataFrame, cap: int, weights: Sequence[int]) -> DataFrame:
    """Add rank, target, and the copies of each document as a whole number and a part, to rows (source, source_size)."""
    ranked = row_numbers(sources, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weight.cast("long")), "mix-sources")
    words, below = level_of(ranked, cap)
    most = F.col("source_size") * cap
    above, under = F.col("weight").cast("decimal(38,0)") * fixed(words), F.col("source_size").cast("decimal(38,0)") * fixed(below)
    full = under * F.lit(cap) <= above
    whole = F.when(full, F.lit(cap).cast("long")).otherwise(F.call_function("div", above, under))
    rest = above - whole.cast("decimal(38,0)") * under
    return ranked.select(
        "source", "source_size", "_rank", F.when(full, most.cast("double")).otherwise(F.col("weight") * F.lit(float(words)) / F.lit(float(below))).alias("target"),
        F.when(F.col("source_size") > 0, whole).otherwise(0).alias("_whole"),
        F.when(full | (F.col("source_size") == 0), 0.0).otherwise(rest.cast("double") / under.cast("double")).alias("_share"))


def climb(open_: DataFrame, nodes: int, fan_in: int, buckets: int) -> DataFrame:
    """(_node, _rank, _up) of the items that nodes left open, settled up the tree."""
    now = open_.select("_node", "_rank", "_size", "_part", "_draw", F.col("_node").alias("_at"), F.pmod(F.xxhash64("_rank"), F.lit(buckets)).alias("_bucket"))
    done = []
    while nodes > 1:
        nodes = -(-nodes // fan_in)
        up = now.select(
            "_node", "_rank", "_size", "_part", F.xxhash64(F.lit(nodes), "_draw").alias("_draw"), F.floor(F.col("_at") / fan_in).alias("_at"), "_bucket")
        kind = ", ".join(f"{n} {t}" for n, t in up.dtypes) + ", _up long, _open boolean"
        met = stored(up.groupBy("_at", "_bucket").applyInPandas(settled, kind), "mix-level")
        done.append(met.filter("not _open").select("_node", "_rank", "_up"))
        now = met.filter("_open").drop("_up", "_open")
    last = now.select("_node", "_rank", F.when(F.col("_part") >= 0.5, 1).otherwise(0).cast("long").alias("_up"))
    return reduce(DataFrame.unionByName, done, last)


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: int = 42, node_rows: int = 20_000, fan_in: int = 8,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """Rows (id, size, source_size, target, taken), one per document, all in words.

    Sources in order of their names by code point, null last, have the weights in
    turn and share the words of all documents; a target ends at ``cap`` times its
    source's size, and what is over goes to the others by weight. ``taken`` is the
    size times a whole number of copies, at most ``cap``; all documents of a source have the same
    expectation, and a source's ``taken`` add up to its target but for half a document.

    Null and empty texts have size 0 and are taken 0 times; a source of such texts has
    target 0. Every row counts, repeated ones too; rows alike in id, source and size are
    settled together, and so many of them get one copy more. Null ids are kept. Other columns are not read.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"), size.alias("_size"))
    alike = stored(rows.groupBy("_id", "source", "_size").agg(F.count("*").alias("_rows")), "mix-rows")
    sources = targets(alike.groupBy("source").agg(F.sum(F.col("_size") * F.col("_rows")).alias("source_size")), cap, weights)
    own = sources.withColumnRenamed("source", "_source")
    known = alike.join(own, alike["source"].eqNullSafe(own["_source"])).drop("_source", "source")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_rows") - 1) / ALIKE)))
    items = known.withColumn("_chunk", chunk).withColumn("_rows", F.least(F.lit(ALIKE), F.col("_rows") - F.col("_chunk") * ALIKE))
    # Rows alike pair among themselves: so many are rounded up, and one at most stays open.
    share = F.when(F.col("_size") > 0, F.col("_share")).otherwise(0.0) * F.col("_rows")
    ups = F.floor(share + WHOLE)
    items = items.withColumns({"_ups": ups, "_part": F.greatest(share - ups, F.lit(0.0)), "_draw": F.xxhash64(F.lit(seed), "_id", "_rank", "_size", "_chunk")})
    n_rows, n_sources = alike.agg(F.sum(F.ceil(F.col("_rows") / ALIKE))).first()[0] or 0, sources.count()
    nodes, buckets = max(1, -(-n_rows // node_rows)), max(1, -(-n_sources // SOURCES))
    items = items.withColumn("_node", F.pmod(F.xxhash64("_draw"), F.lit(nodes)).cast("long"))
    open_part = F.col("_part") > WHOLE
    kind = ", ".join(f"{n} {t}" for n, t in items.dtypes) + ", _up long, _open boolean"
    met = stored(items.filter(open_part).groupBy("_node").applyInPandas(settled, kind), "mix-nodes")
    left = met.filter("_open")
    decided = left.drop("_up").join(climb(left, nodes, fan_in, buckets), ["_node", "_rank"])
    all_items = items.filter(~open_part).withColumn("_up", F.lit(0).cast("long")).unionByName(
        met.filter("not _open").drop("_open")).unionByName(decided.drop("_open"))
    each = all_items.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    copies = F.col("_whole") + (F.col("_i") <= F.col("_ups") + F.col("_up")).cast("long")
    return each.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * copies).alias("taken"))
