"""Session settings the jobs are written for, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Join strategy is left to Spark: a side is broadcast only where its measured size allows it,
    # and a shuffled join splits a hot key's partition, even if that costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Pages can be large: bound Arrow batches by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "skytally", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``.

    Only a session that names none (a local test) falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/skytally-{purpose}-{uuid.uuid4().hex}"
