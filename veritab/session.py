"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: the
checkpoint directory comes from ``spark.checkpoint.dir`` when the cluster
sets it; only a local session (tests, bench) gets a fresh temp folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: the rule that moves an anti-join below a grouping when the other side is small: rows
#: would then meet that side before copies are merged
ANTI_JOIN_RULE = "org.apache.spark.sql.catalyst.optimizer.PushDownLeftSemiAntiJoin"
EXCLUDED_RULES = "spark.sql.optimizer.excludedRules"

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    EXCLUDED_RULES: ANTI_JOIN_RULE,
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # one aggregate holds a table's column rules: keep it compiled for tables of several hundred columns
    "spark.sql.codegen.maxFields": "1000",
    # no Python call-site capture per Column call: plans with hundreds of
    # rule expressions are built several times faster (only error messages
    # lose the Python line that built the failing expression)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "veritab", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  A local session without it (tests) gets a fresh temp folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="veritab-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
