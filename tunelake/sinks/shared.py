"""Where jobs may write intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which every executor can reach.

    Where it is unset, a checkpoint folder set on the context is used. Without
    either, a session that runs in one process sets a temporary folder of its own,
    and any other is refused: its executors share no local folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tunelake-"))
        path = sc.getCheckpointDir()
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")
