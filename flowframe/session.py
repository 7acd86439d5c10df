"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split one hot reducer partition of a rebalance/repartition as well
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "flowframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory under the cluster's shared `spark.checkpoint.dir`.

    Only a session in one process, as in tests, may fall back to a machine-local folder: on a
    cluster, also one of several processes on one machine, it would be lost with its executor.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="flowframe-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative operators a checkpoint folder where the cluster names none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))
