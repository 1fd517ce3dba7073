"""Tensor tables in the base model's shard layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_shards(
    tiles: DataFrame, manifest: DataFrame, path: str, *, dtype: str = "float", partitions: int | None = None, row_block: int = 1_024,
) -> None:
    """Write tiles of one dtype into a folder per shard of the manifest.

    Tiles are dealt by shard, tensor and block of rows, so a large shard is shared by
    many tasks; ``partitions`` sets their number, else the session does. Dealing by
    hash needs no sample of the tiles, which would compute them twice.
    """
    rows = tiles.join(manifest.select("name", "shard"), "name").withColumn("values", F.col("values").cast(f"array<{dtype}>"))
    by = [F.col("shard"), F.col("name"), F.floor(F.col("row") / row_block)]
    dealt = rows.repartition(partitions, *by) if partitions else rows.repartition(*by)
    dealt.write.mode("overwrite").partitionBy("shard").parquet(path)
