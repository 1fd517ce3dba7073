"""Keyed record tables that a rerun leaves unchanged, and tables of committed runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_records(records: DataFrame, path: str, run_id: str) -> None:
    """Write one run's records; writing the same run again replaces it."""
    (
        records.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder is there, asked of the folder's own file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def append_new(records: DataFrame, path: str, run_id: str, keys: list[str]) -> None:
    """Write, as a run of its own, the records whose keys no other run holds yet."""
    spark = records.sparkSession
    if path_exists(spark, path):
        done = read_records(spark, path).filter(F.col("run_id") != run_id)
        records = records.join(done.select(*keys), keys, "left_anti")
    write_records(records, path, run_id)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def commit_records(records: DataFrame, path: str, run_id: str) -> None:
    """Write one run's records into a folder of their own, then enter it in the table's manifest.

    The manifest row is written last and by one task, so a run that fails before leaves
    nothing that :func:`committed_records` reads. Committing a run again replaces it.
    """
    spark, folder = records.sparkSession, uuid.uuid4().hex
    records.write.parquet(f"{path}/data/{folder}")
    earlier = 0
    if path_exists(spark, f"{path}/manifest"):
        earlier = spark.read.parquet(f"{path}/manifest").agg(F.max("seq")).first()[0] or 0
    entry = spark.range(1).select(F.lit(earlier + 1).cast("long").alias("seq"), F.lit(run_id).alias("run_id"), F.lit(folder).alias("folder"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def committed_records(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest record of each key over the last commit of every run, with its ``run_id``.

    Runs committed at the same time may share a number; the folder's name then decides.
    A null in a key is a value like any other. Runs may differ in their columns; a
    record has null in those that its run lacks.
    """
    runs = spark.read.parquet(f"{path}/manifest").groupBy("run_id").agg(F.max(F.struct("seq", "folder")).alias("__last"))
    last = runs.select(F.struct("__last.seq", "__last.folder").alias("__at"), "run_id")
    folders = [r[0]["folder"] for r in last.collect()]  # one row per run
    read = spark.read.option("mergeSchema", "true").option("basePath", f"{path}/data")
    rows = read.parquet(*[f"{path}/data/{f}" for f in folders])
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    rows = rows.withColumn("__folder", name).join(F.broadcast(last), F.col("__folder") == F.col("__at.folder")).drop("__folder")
    kept = [c for c in rows.columns if c not in keys and c != "__at"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*kept), "__at").alias("__row"))
    return newest.select(*keys, "__row.*")


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row document table as text."""
    document.select("document").coalesce(1).write.mode("overwrite").text(path)
