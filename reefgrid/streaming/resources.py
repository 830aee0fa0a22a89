"""GPU samples per time window, and training logs as they grow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.functions.sizing import eta_seconds, percent
from reefgrid.operators.report import last_metrics
from reefgrid.streaming.run import WATERMARK


def gpu_windows(
    samples: DataFrame, window: str = "1 minute", slide: str | None = None, watermark: str = WATERMARK
) -> DataFrame:
    """Peak and mean memory per label and window."""
    if samples.isStreaming:
        samples = samples.withWatermark("ts", watermark)
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    return samples.groupBy(span.alias("w"), "label").agg(
        F.max("used_mib").alias("peak_mib"), F.avg("used_mib").alias("mean_mib"), F.count(F.lit(1)).alias("n_samples")
    ).select("label", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "peak_mib", "mean_mib", "n_samples")


def training_progress(lines: DataFrame) -> DataFrame:
    """Latest metrics, percent done and seconds left of each run."""
    names = ["iteration", "total_iterations", "loss", "psnr", "ssim", "gaussians", "it_per_sec"]
    last = last_metrics(lines, ["run_id"], "line_no", names)
    return last.withColumns({
        "pct": F.floor(percent(F.col("iteration"), F.col("total_iterations"))),
        "eta_sec": eta_seconds(F.col("total_iterations"), F.col("iteration"), F.col("it_per_sec")),
    })
