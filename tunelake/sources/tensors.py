"""Tensor manifests, adapter settings and snapshot listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON documents, one per file, as (file, value)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value")


def tensor_index(documents: DataFrame, *carry: str) -> DataFrame:
    """Tensor to shard, one row per tensor, from index documents in ``value``."""
    weight_map = F.from_json("value", "weight_map map<string,string>")["weight_map"]
    return documents.select(*carry, F.explode(weight_map).alias("name", "shard"))


def adapter_scaling(documents: DataFrame, *carry: str) -> DataFrame:
    """Rank, alpha and their ratio from adapter settings in ``value``."""
    config = F.from_json("value", "r int, lora_alpha int")
    return documents.select(*carry, config.alias("c")).select(
        *carry, F.col("c.r").alias("r"), F.col("c.lora_alpha").alias("lora_alpha"),
        (F.col("c.lora_alpha") / F.col("c.r")).alias("scaling"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, mtime) of all files under a folder, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("modificationTime").alias("mtime"))


def latest_valid_snapshot(files: DataFrame, suffix: str = ".safetensors") -> DataFrame:
    """Per model, the newest snapshot that holds a weight file.

    ``files``: model, snapshot, path, mtime. A snapshot is as new as its newest
    file; equal times go to the last name.
    """
    snapshots = files.groupBy("model", "snapshot").agg(
        F.max("mtime").alias("mtime"),
        F.max(F.col("path").endswith(suffix)).alias("usable"))
    newest = F.max(F.when(F.col("usable"), F.struct("mtime", "snapshot")))
    return snapshots.groupBy("model").agg(newest.alias("s")).filter(
        F.col("s").isNotNull()).select("model", "s.snapshot", "s.mtime")
