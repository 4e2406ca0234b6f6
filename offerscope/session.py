"""Session defaults and the scratch location shared by executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "offerscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; a cluster passes no master and brings its own settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the checkpoint location the cluster names.

    Only in a local session without such a setting, as in tests, a temporary folder stands in for it; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = os.path.join(tempfile.gettempdir(), "offerscope")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, large_rows: bool = False) -> DataFrame:
    """Write a table below the shared folder and read it back, so that what is derived from it several times is computed once.

    Row groups are small enough that a table of few files still spreads over the cores; large rows may make one each.
    """
    path = shared_dir(df.sparkSession, purpose)
    writer = df.write.option("parquet.block.size", str(8 << 20))
    if large_rows:  # else sizes are not looked at before 100 rows
        writer = writer.option("parquet.block.size.row.check.min", "1").option("parquet.page.size.row.check.min", "1")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
