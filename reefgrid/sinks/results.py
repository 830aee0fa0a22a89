"""Pose priors, run results and cleaning results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_priors(priors: DataFrame, out: str) -> None:
    """Replaces the whole table."""
    priors.write.mode("overwrite").parquet(out)


def append_result(rows: DataFrame, out: str, run: str) -> None:
    """Adds the rows of the runs named in column ``run``, a folder for each.

    A run written before is replaced, so a job that runs twice leaves one set of its rows.
    """
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(out)
