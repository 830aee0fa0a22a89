"""Nav log to image matching and pose priors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefgrid.functions import geometry
from reefgrid.functions.names import CARTESIAN, basename, camera_tag
from reefgrid.operators.ranks import number_rows

DEFAULT_ACCURACY = {"x_acc": 10.0, "y_acc": 10.0, "alt_acc": 1.0}
SENSOR_CAMERA = 0


def name_index(images: DataFrame) -> DataFrame:
    """Image by full name and by base name; a full name wins, then the last image."""
    fields = F.struct("image_id", "camera_id")
    full = images.select(F.col("name").alias("key"), F.lit(1).alias("rank"), fields.alias("hit"))
    base = images.select(basename(F.col("name")).alias("key"), F.lit(0).alias("rank"), fields.alias("hit"))
    best = full.unionByName(base).groupBy("key").agg(
        F.max_by(F.struct("rank", "hit"), F.struct("rank", "hit.image_id")).alias("best")
    )
    return best.select(
        "key", "best.hit.image_id", "best.hit.camera_id",
        F.when(F.col("best.rank") == 1, "full").otherwise("basename").alias("matched_by"),
    )


def match_nav(nav: DataFrame, images: DataFrame) -> DataFrame:
    """Nav rows with their image."""
    index = name_index(images)
    return nav.join(index, nav["name"] == index["key"]).drop("key")


def nav_without_image(nav: DataFrame, images: DataFrame) -> DataFrame:
    index = name_index(images).select(F.col("key").alias("name"))
    return nav.join(index, "name", "left_anti")


def images_without_nav(matched: DataFrame, images: DataFrame) -> DataFrame:
    """Images no nav row matched, counted once per image."""
    return images.join(matched.select("image_id").distinct(), "image_id", "left_anti")


def first_names(df: DataFrame, position: str, n: int = 5) -> DataFrame:
    """The first ``n`` names, and how many more there are."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.orderBy(position).limit(n).select(
        "name", F.greatest(total - n, F.lit(0)).cast("bigint").alias("n_more")
    )


def accuracy(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(DEFAULT_ACCURACY[name]))


def build_priors(
    matched: DataFrame, position: list[str], coordinate_system: int = CARTESIAN, use_gravity: bool = True
) -> DataFrame:
    """One pose prior per matched nav row, numbered in nav order."""
    g = geometry.gravity(F.col("pitch"), F.col("roll")) if use_gravity else F.lit(None).cast("array<double>")
    numbered = number_rows(matched, position, "pose_prior_id")
    return numbered.select(
        "pose_prior_id", "image_id", "camera_id", F.lit(SENSOR_CAMERA).alias("sensor_type"),
        F.array("x", "y", "alt").alias("position"),
        geometry.cov_diag(accuracy("x_acc"), accuracy("y_acc"), accuracy("alt_acc")).alias("covariance"),
        g.alias("gravity"), F.lit(coordinate_system).alias("coordinate_system"),
    )


def nav_stats(nav: DataFrame, matched: DataFrame) -> DataFrame:
    """One row of counts and ranges over the matched nav rows."""
    spans = []
    for c in ("x", "y", "alt"):
        spans += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), (F.max(c) - F.min(c)).alias(f"{c}_span")]
    for c in ("pitch", "roll"):
        spans += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return matched.agg(
        F.count(F.lit(1)).alias("n_matched"), *spans,
        F.min(accuracy("x_acc")).alias("acc_min"), F.max(accuracy("x_acc")).alias("acc_max"),
    ).withColumn("n_nav", nav.agg(F.count(F.lit(1))).scalar())


def prior_positions(priors: DataFrame, images: DataFrame) -> DataFrame:
    """Position and camera tag of each prior whose image exists."""
    at = priors.select("pose_prior_id", "image_id", *[F.col("position")[i].alias(c) for i, c in enumerate("xyz")])
    return at.filter(F.col("x").isNotNull()).join(images.select("image_id", "name"), "image_id").select(
        "pose_prior_id", "image_id", "x", "y", "z", camera_tag(F.col("name")).alias("camera")
    )


def step_for(priors: DataFrame, target: int = 5000) -> Column:
    """The step that leaves about ``target`` of the priors, as a scalar."""
    total = priors.agg(F.count(F.lit(1))).scalar()
    return F.greatest(F.lit(1), F.floor(total / target)).cast("bigint")


def every_nth(priors: DataFrame, step: Column | int) -> DataFrame:
    """Every prior whose id ``step`` divides."""
    return priors.filter(F.col("pose_prior_id") % step == 0)


def survey_extent(priors: DataFrame) -> DataFrame:
    """Bounds, spans and area of the prior positions."""
    at = priors.select(*[F.col("position")[i].alias(c) for i, c in enumerate("xyz")])
    bounds = []
    for c in "xyz":
        bounds += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    area = (F.col("x_max") - F.col("x_min")) * (F.col("y_max") - F.col("y_min"))
    return at.agg(*bounds).select("*", area.alias("area_m2"), (area / 10000.0).alias("hectares"))
