"""SparkSession helpers.

Library code never creates its own session; it takes the caller's.  These
helpers exist for tests, the benchmark and the command line.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "newsfunnel", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder
    and is used as is (an unset value is an error there).  Only a local-mode
    session without the setting (tests) gets a scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        # never a machine-local folder on a cluster: lineage cuts must survive executor loss
        raise ValueError("spark.checkpoint.dir is unset; point it at a shared folder (HDFS/S3/...)")
    path = tempfile.mkdtemp(prefix="newsfunnel-ckpt-", dir=os.environ.get("NEWSFUNNEL_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path
