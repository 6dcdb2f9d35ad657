"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; leave sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def is_one_process(master: str) -> bool:
    """Whether driver and executors are one process: ``local`` or ``local[n]``."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for stage tables: ``spark.checkpoint.dir`` as the session names it.

    Only a session in one process (tests, a notebook) gets a folder of its own; on a cluster
    every executor would write its own disk, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_one_process(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reviewlab-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root
