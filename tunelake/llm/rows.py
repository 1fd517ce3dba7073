"""Rows, keys and stored tables shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.sinks.shared import shared_dir

SLICE_BYTES = 2 << 20  # text handled at once inside a task


def cut(df: DataFrame) -> DataFrame:
    """The same rows read from a reliable checkpoint, for tables read more than once."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The same rows written to and read from a Parquet table in the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under names no other column can clash with."""
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))


def hash128(*cols: Column) -> list[Column]:
    """Two 64-bit hashes over the same values in different order."""
    return [F.xxhash64(*cols).alias("_k1"), F.xxhash64(F.lit("other"), *reversed(cols), F.lit(7)).alias("_k2")]


def row_key(id_col: str, text_col: str) -> list[Column]:
    """A key of id and text without nulls. Rows alike in both have the same key."""
    parts = [F.col(id_col), F.col(id_col).isNull(), F.col(text_col), F.col(text_col).isNull()]
    return hash128(*parts)


def replace_columns(docs: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``withColumns`` that lets a new column take the place of one of the same name."""
    taken = {c.lower() for c in new}
    return docs.select(*[docs[c] for c in docs.columns if c.lower() not in taken], *[v.alias(k) for k, v in new.items()])


def set_aside(docs: DataFrame, *own: str) -> DataFrame:
    """Only the columns ``own``, and all others inside one struct, where their names meet no other."""
    others = [docs[c] for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(*(others or [F.lit(0).alias("none")])).alias("_row"))


def put_back(df: DataFrame, columns: list[str], *own: str) -> DataFrame:
    """The columns of a table that :func:`set_aside` took apart, in their order."""
    return df.select(*[F.col(c) if c in own else F.col("_row").getField(c).alias(c) for c in columns])


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def worker_cache() -> dict:
    """Values that live as long as the Python worker, such as an opened tokenizer."""
    return sys.modules.setdefault("_corpus_worker_cache", types.ModuleType("_corpus_worker_cache")).__dict__


def give_back() -> None:
    """Return memory that a worker has freed to the system: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """(start, stop) of runs of rows with about ``limit`` bytes of text, one row at least."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop
    give_back()
