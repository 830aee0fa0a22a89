"""The whole model analysis: read, repair errors, rate images, tier points."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reefgrid.operators import quality, tiers
from reefgrid.session import pin
from reefgrid.sources.text_model import read_cameras, read_images, read_points


@dataclass
class Analysis:
    points: DataFrame
    tiered: DataFrame
    image_quality: DataFrame
    errors_computed: bool


def analyze_model(
    spark: SparkSession, model_dir: str, report: DataFrame | None = None,
    th: tiers.TierThresholds = tiers.TierThresholds(),
) -> Analysis:
    """Analyse a text model. Stored errors that are all zero are computed from the cameras."""
    cameras = read_cameras(spark, f"{model_dir}/cameras.txt")
    images, obs = read_images(spark, f"{model_dir}/images.txt")
    points = pin(read_points(spark, f"{model_dir}/points3D.txt"))
    missing = quality.errors_missing(points).first()["errors_missing"]
    if missing:
        points = pin(quality.with_errors(points, quality.reprojection_errors(images, obs, points, cameras)))
    rated = quality.image_quality(images, obs, points)
    if report is not None:
        rated = quality.merge_report(rated, report)
    return Analysis(points, tiers.point_tiers(points, th), rated, missing)

