"""Session builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; everything else is left to the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, as in
    tests, may fall back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-"))
    return sc.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder; nothing is created yet."""
    return f"{scratch_root(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)
