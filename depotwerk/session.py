"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.scheduler.mode": "FAIR",  # source systems load side by side
    "spark.ui.enabled": "false",
    # the JIT compiler skips methods above 8000 bytecodes: wide projections run
    # faster as several small methods than as one that is never compiled
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # without call-site capture plans are built about ten times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "depotwerk", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    ``master`` stays unset on a cluster, where the submit command names it.
    Extra settings are passed with dots written as double underscores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    The shared folder named in ``spark.checkpoint.dir`` wins.  Where nothing is
    set, a local session takes a folder of its own; on a cluster that would be
    a machine-local folder, so the setting is asked for.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="depotwerk-checkpoint-"))
    return context.getCheckpointDir()
