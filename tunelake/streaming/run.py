"""Running a stream over what its source holds now."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tunelake.sinks.shared import shared_dir

Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame | None]]


def new_path(stream: DataFrame, name: str) -> str:
    return f"{shared_dir(stream.sparkSession)}/{name}-{uuid.uuid4().hex}"


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Within it, streams start with the state store that keyed state with timers needs."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def run_to_table(stream: DataFrame, path: str) -> DataFrame:
    """Process all available input into a parquet table and read that back.

    Output and checkpoint lie under ``path``, so a restarted query goes on where it
    stopped; the folder is the caller's to remove.
    """
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{path}/table").option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True).start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/table")


def run_batches(stream: DataFrame, path: str, step: Step, *, carries: bool = False) -> DataFrame:
    """Process all available input by ``step``, one micro-batch at a time, and read the results.

    ``step`` gets a micro-batch and, where it ``carries``, the carry of the one before,
    and returns its rows and its own carry or None. A micro-batch writes folders of its
    own, so one that is run again replaces what it had written.
    """
    def each(batch: DataFrame, number: int) -> None:
        carried = carries and number > 0
        before = batch.sparkSession.read.parquet(f"{path}/carry/{number - 1}") if carried else None
        rows, carry = step(batch, before)
        rows.write.mode("overwrite").parquet(f"{path}/table/batch={number}")
        if carry is not None:
            carry.write.mode("overwrite").parquet(f"{path}/carry/{number}")

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return stream.sparkSession.read.parquet(f"{path}/table").drop("batch")
