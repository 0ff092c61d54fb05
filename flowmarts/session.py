"""Session factory and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that hold at any cluster size.  Master, memory, executor counts and
# the number of shuffle partitions belong to the submitter, not to this library.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the call site of every column expression doubles plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app: str = "flowmarts", **conf: str) -> SparkSession:
    """Session with ``DEFAULTS``; settings given as ``**{"spark.x": "y"}`` win."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A fresh temporary folder stands in only for a local master without the
    setting; anywhere else its absence is an error, because a table on one
    machine's disk is lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="flowmarts-")
