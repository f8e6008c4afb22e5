"""Session settings the library is tuned for, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Calendar days are UTC days everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: split hot join partitions, merge tiny ones, and turn
    # a shuffled join into a broadcast one when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where an aggregation by the join key follows: an extra shuffle of what it
    # counted is cheap next to a task that holds a third of all plays.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Above 2,000 partitions only sizes of blocks that stand out are reported exactly. By
    # default a block has to reach 100 MB for that, and hot keys would go unnoticed.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins carry no broadcast hints. Catalyst broadcasts a reference table only
    # while its size is within this bound; a larger one is joined by shuffle.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    # Recording a call site for every column expression slows down plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "spinledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Without that setting it lies below the warehouse, which all executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
