"""The folder for intermediate tables, which all machines of a cluster share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Makes sure that checkpoints go to the folder the cluster names, and are removed once nothing refers to them.

    Only a local session without spark.checkpoint.dir gets a folder of its own; a cluster without one is refused, as its
    machines share no other.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusloom-"))
    sc._jsc.sc().conf().setIfMissing("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return sc._jsc.sc().getCheckpointDir().get()
