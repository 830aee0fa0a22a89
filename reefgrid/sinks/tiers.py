"""Tier datasets, analysis results and the tier manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reefgrid.operators import quality, tiers
from reefgrid.sources.lines import POSITION, read_lines
from reefgrid.sources.text_model import read_points_raw, rewrite_image_lines


def write_tier(tiered: DataFrame, out: str) -> None:
    """Points by exclusive tier; a dataset is the tiers up to its number, pruned at read."""
    tiered.write.mode("overwrite").partitionBy("tier").parquet(out)


def read_tier(spark: SparkSession, out: str, dataset: int) -> DataFrame:
    return spark.read.parquet(out).filter(F.col("tier").between(1, dataset))


def _write_ordered(lines: DataFrame, order: list[str], out: str) -> None:
    """Text whose part files, in name order, are in the given order."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(out)


def export_tier_text(spark: SparkSession, model_dir: str, tiered: DataFrame, dataset: int, out: str) -> None:
    """A model folder of one dataset: header and kept points by id, cameras as they are,
    images with references to other points set to -1."""
    kept = tiered.filter(F.col("tier").between(1, dataset)).select("point_id")
    header, lines = read_points_raw(spark, f"{model_dir}/points3D.txt")
    body = lines.join(kept, "point_id").select(
        F.lit(1).alias("body"), F.col("point_id").alias("place"), F.lit(0).cast("bigint").alias("seq"), "line"
    )
    head = header.select(F.lit(0).alias("body"), F.col("block").alias("place"), "seq", "line")
    _write_ordered(head.unionByName(body), ["body", "place", "seq"], f"{out}/points3D.txt")
    images = rewrite_image_lines(spark, f"{model_dir}/images.txt", kept)
    _write_ordered(images, [*POSITION, "part"], f"{out}/images.txt")
    cameras = read_lines(spark, f"{model_dir}/cameras.txt")
    _write_ordered(cameras, POSITION, f"{out}/cameras.txt")


def write_manifest(tiered: DataFrame, out: str, th: tiers.TierThresholds = tiers.TierThresholds()) -> None:
    tiers.tier_manifest(tiered, th).coalesce(1).write.mode("overwrite").json(out)


def write_analysis(points: DataFrame, tiered: DataFrame, image_quality: DataFrame, out: str) -> None:
    """The four result tables; the two one-row ones also as JSON."""
    stats, counts = quality.point_stats(points), tiers.tier_counts(tiered)
    tiered.select("point_id", "tier").write.mode("overwrite").parquet(f"{out}/point_tiers")
    image_quality.write.mode("overwrite").parquet(f"{out}/image_quality")
    stats.write.mode("overwrite").json(f"{out}/point_stats")
    counts.write.mode("overwrite").json(f"{out}/tier_counts")
