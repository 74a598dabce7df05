"""Session construction and the shared work folder.

The library never invents storage locations on a cluster: scratch output (drained
facts, checkpoints, position logs of the catalogue queries) goes below the folder
the cluster names in ``spark.checkpoint.dir``.  Only when that setting is missing
(local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library relies on.  AQE re-plans joins from real sizes (the
# size check behind every broadcast we do not hint ourselves), splits skewed
# partitions, and coalesces small shuffle partitions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "factline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if none is configured."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        # Tests and local runs only: a cluster names its shared folder in spark.checkpoint.dir.
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="factline-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for one run of ``name``."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/factline/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
