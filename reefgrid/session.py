"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins followed by a grouping on the same key would otherwise keep a hot
    # partition whole, because splitting it costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job in this package relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    shared_dir(spark)
    return spark


def local_session(cores: str | int = "*", app: str = "reefgrid") -> SparkSession:
    """A single-machine session for tests and benches."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session on one machine may leave it out; a scratch folder of our own
    is set there. On a cluster it must be named, for other executors would not
    see a machine's own folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if named:
        if not current:
            sc.setCheckpointDir(named)
        return named
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="reefgrid-"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for a written intermediate table."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage and cut its lineage.

    Used where several branches must see the very same rows and partitions, and
    between rounds of an iterative job.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
