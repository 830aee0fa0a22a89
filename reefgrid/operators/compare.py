"""Run comparison: memory peaks, progressive against single pass, preset sizing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.functions import sizing


def peak_by_label(samples: DataFrame, baseline_mib: int = 0) -> DataFrame:
    """Highest memory use per label and what exceeds the baseline."""
    return samples.groupBy("label").agg(F.max("used_mib").alias("peak_mib")).withColumn(
        "net_mib", F.col("peak_mib") - baseline_mib
    )


def compare_runs(runs: DataFrame, keys: list[str], progressive: list[str], baseline: list[str]) -> DataFrame:
    """Total time of the progressive stages against that of the single pass."""
    total = lambda labels: F.coalesce(F.sum(F.when(F.col("label").isin(*labels), F.col("time_sec"))), F.lit(0))
    return runs.groupBy(*keys).agg(
        total(progressive).alias("progressive_sec"), total(baseline).alias("baseline_sec")
    ).withColumn("diff_sec", F.col("progressive_sec") - F.col("baseline_sec"))


def plan_sizing(datasets: DataFrame) -> DataFrame:
    """Every dataset (``width, height, images, points``) under every preset."""
    presets = F.array(*[
        F.struct(
            F.lit(name).alias("preset"), F.lit(iters).alias("iterations"), F.lit(mult).alias("multiplier"),
            F.lit(resize).alias("resize_factor"), F.lit(share).alias("share"),
        )
        for name, (iters, mult, resize, share) in sizing.PRESETS.items()
    ])
    planned = datasets.select("*", F.inline(presets))
    w, h, resize = F.col("width"), F.col("height"), F.col("resize_factor")
    limit = sizing.max_cap(w, h, resize, F.lit(sizing.VRAM_USABLE_GB) * F.col("share"))
    capped = planned.withColumn(
        "max_cap", sizing.scene_cap(F.col("points"), F.col("images"), F.col("multiplier"), limit)
    )
    cap = F.col("max_cap")
    return capped.withColumns({
        "vram_gb": sizing.est_vram(cap, w, h, resize),
        "minutes": sizing.est_minutes(F.col("iterations"), cap, w, h, resize),
    }).withColumn("band", sizing.vram_band(F.col("vram_gb"))).drop("multiplier", "share")
