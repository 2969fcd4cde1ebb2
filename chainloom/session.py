"""Session helpers.

``configure`` sets only run-time SQL options, so it also works on a session a cluster hands us.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SQL_OPTIONS = {
    # every calendar rule here is a UTC rule
    "spark.sql.session.timeZone": "UTC",
    # overflow and bad casts raise instead of wrapping; expected bad text goes through try_cast
    "spark.sql.ansi.enabled": "true",
    # a repeated JSON attribute key keeps its last value
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # broadcast choice, partition coalescing and skew splitting are made on run-time sizes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL options the operators rely on."""
    for key, value in _SQL_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "chainloom", master: str | None = None, **options: str) -> SparkSession:
    """A session for tests, benches and scripts; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        cores = master[master.find("[") + 1 : -1] if "[" in master else "1"
        n = str(os.cpu_count() or 1) if cores == "*" else cores
        builder = (
            builder.master(master)
            .config("spark.sql.shuffle.partitions", n)
            .config("spark.default.parallelism", n)
            .config("spark.driver.memory", os.environ.get("CHAINLOOM_DRIVER_MEMORY", "8g"))
        )
    for key, value in options.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, for tables written between steps.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/chainloom-{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step out and read it back: computed once, short lineage, safe when executors go."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
