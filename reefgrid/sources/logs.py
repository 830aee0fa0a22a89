"""Logs, metric logs, GPU samples and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reefgrid import schemas
from reefgrid.functions.names import METRIC_PATTERNS, metric
from reefgrid.sources.lines import read_lines


def read_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Stage logs: path, time and whole text of each log file."""
    files = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_modification_time").alias("mtime"), F.col("value").alias("content"),
    )
    return files.filter(F.col("name").endswith(".log") | F.col("name").contains(".log.INFO.")).drop("name")


def read_log_lines(spark: SparkSession, folder: str, named: bool = True) -> DataFrame:
    """Lines of the stage logs with their place, ``(path, mtime, block, seq, line)``; large logs are read in many tasks.

    Files are taken by their names as logs unless ``named`` is false.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_modification_time").alias("mtime"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"),
    )
    return (lines.filter(F.col("name").endswith(".log") | F.col("name").contains(".log.INFO.")) if named else lines).drop("name")


def read_metric_log(spark: SparkSession, path: str) -> DataFrame:
    """Training-log lines with the metrics each states."""
    lines = read_lines(spark, path)
    return lines.withColumns({name: metric(F.col("line"), name) for name in METRIC_PATTERNS})


def read_gpu_samples(spark: SparkSession, path: str) -> DataFrame:
    """Memory samples; header lines repeated inside the file are dropped."""
    rows = spark.read.schema(schemas.GPU_SAMPLES).option("mode", "PERMISSIVE").csv(path)
    return rows.filter(F.col("timestamp").isNotNull()).withColumn("ts", F.timestamp_seconds("timestamp"))


def read_cleaning(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schemas.CLEANING).csv(path)
    return rows.filter(F.col("input_splats").isNotNull())


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per run of each benchmark file."""
    files = spark.read.schema(schemas.RUN_FILE).option("multiLine", "true").json(path)
    return files.select("timestamp", "dataset", "gpu", "baseline_vram_mib", "resize_factor", F.inline("runs"))
