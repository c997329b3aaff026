"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings the operators count on. All can be set on a running session.
RUNTIME_CONF = {
    # INFO text may repeat a key: the last one wins instead of failing the job.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Sizes are known only at run time: let Spark pick the join and split hot partitions,
    # also where that costs another exchange further up.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A table in buckets of (CHROM, POS) also serves joins on these and more columns.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Lists of genes and sites are often tens of MB when stored; below this size the other side,
    # which may hold all genotypes, need not be shuffled.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Where every partition of the smaller side turns out small, hash it instead of sorting both.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "varloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a configured session; ``master`` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # Otherwise the call site of every column is sent to the JVM.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; on a cluster that would lose
    data, so it is an error there.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not path:
        path = context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="varloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
