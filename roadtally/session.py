"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "roadtally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and skew handling on.

    On a cluster `master` and sizes come from spark-submit; only settings that
    the engine's results or plans depend on are fixed here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for `purpose` below the cluster's shared checkpoint folder.

    The folder is read from the session. Only a local session may fall back to
    a temporary folder of this machine: on a cluster the executors could not
    see it, so an unset value is an error there.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or os.environ.get("ROADTALLY_SCRATCH")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="roadtally-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table in the shared folder: what makes it runs once, however often its rows are read, and survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
