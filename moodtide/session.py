"""Session settings: the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, as set in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="moodtide-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured
