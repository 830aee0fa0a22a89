"""Reprojection error, point statistics and image quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.functions import geometry
from reefgrid.functions.sizing import ratio
from reefgrid.operators.ranks import grouped_median, last_by_key, median_literal, middle, middle_integers
from reefgrid.session import pin

MIN_DEPTH = 1e-6


def obs_points(obs: DataFrame, points: DataFrame) -> DataFrame:
    """Observations of existing points, with the point's columns."""
    return obs.filter(F.col("point_id").isNotNull()).join(points, "point_id")


def images_cameras(images: DataFrame, cameras: DataFrame) -> DataFrame:
    """Images with usable intrinsics; others have no reprojection error."""
    lens = cameras.select("camera_id", geometry.intrinsics(F.col("model"), F.col("params")).alias("k"))
    return images.join(lens.filter(F.col("k").isNotNull()), "camera_id")


def observation_errors(images: DataFrame, obs: DataFrame, points: DataFrame, cameras: DataFrame) -> DataFrame:
    """Every valid observation with its camera-frame position and pixel error.

    The poses come first: they shrink the observations to images with a usable
    camera before the wide join on points.
    """
    poses = images_cameras(images, cameras).select("image_id", "camera_id", "qvec", "tvec", "k")
    seen = obs.filter(F.col("point_id").isNotNull()).select("image_id", "point_id", "px", "py")
    joined = seen.join(poses, "image_id").join(points.select("point_id", "x", "y", "z"), "point_id")
    cam_x, cam_y, cam_z = geometry.to_camera(
        F.col("qvec"), F.col("tvec"), F.col("x"), F.col("y"), F.col("z")
    )
    framed = joined.select(
        "image_id", "camera_id", "point_id", "px", "py", "k",
        cam_x.alias("cam_x"), cam_y.alias("cam_y"), cam_z.alias("cam_z"),
    ).filter(F.col("cam_z") > MIN_DEPTH)
    return framed.withColumn(
        "obs_error",
        geometry.reproj_error(
            F.col("k"), F.col("cam_x"), F.col("cam_y"), F.col("cam_z"), F.col("px"), F.col("py")
        ),
    ).drop("k")


def reprojection_errors(images: DataFrame, obs: DataFrame, points: DataFrame, cameras: DataFrame) -> DataFrame:
    """Mean pixel error and number of valid observations per point."""
    return observation_errors(images, obs, points, cameras).groupBy("point_id").agg(
        F.avg("obs_error").alias("point_error"), F.count(F.lit(1)).alias("n_obs")
    )


def with_errors(points: DataFrame, errors: DataFrame) -> DataFrame:
    """Computed errors in place of stored ones; unseen points keep theirs."""
    joined = points.join(errors.select("point_id", "point_error"), "point_id", "left")
    return joined.withColumn("error", F.coalesce("point_error", "error")).drop("point_error")


def errors_missing(points: DataFrame) -> DataFrame:
    """One row: the number of points, and whether all their stored errors are zero (or there are none)."""
    return points.agg(
        F.count(F.lit(1)).alias("probed"),
        F.coalesce(F.max(F.abs("error")) == 0.0, F.lit(True)).alias("errors_missing"),
    )


def point_stats(points: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row of error and track-length statistics; an empty cloud has count 0.

    ``errors`` may name a cheaper table with the same ``error`` values, for the median.
    """
    middles = [
        median_literal(middle(points if errors is None else errors, "error")).alias("error_median"),
        median_literal(middle_integers(points, "track_length")).alias("track_median"),
    ]
    sums = points.agg(
        F.count(F.lit(1)).alias("count"),
        F.min("error").alias("error_min"),
        F.max("error").alias("error_max"),
        F.avg("error").alias("error_mean"),
        F.when(F.count(F.lit(1)) > 1, F.stddev_samp("error"))
        .when(F.count(F.lit(1)) == 1, F.lit(0.0)).alias("error_stdev"),
        F.min("track_length").cast("bigint").alias("track_min"),
        F.max("track_length").cast("bigint").alias("track_max"),
        F.avg("track_length").alias("track_mean"),
    )
    return sums.select("*", *middles)


def image_quality(images: DataFrame, obs: DataFrame, points: DataFrame) -> DataFrame:
    """Observation counts, match ratio and errors of the seen points per image.

    Matched counts every observation with a point id, also when that point is
    not in the cloud; errors use existing points only. The observations are
    joined once; all figures come from the pinned join.
    """
    seen = pin(obs.select("image_id", "point_id").join(points.select("point_id", "error"), "point_id", "left").select(
        "image_id", F.col("point_id").isNotNull().alias("matched"), "error"))
    counts = seen.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("total_observations"), F.count_if("matched").alias("matched_3d_points"),
        F.avg("error").alias("avg_point_error"),
    )
    medians = grouped_median(seen, ["image_id"], "error", "median_point_error")
    total, matched = F.coalesce("total_observations", F.lit(0)), F.coalesce("matched_3d_points", F.lit(0))
    return (
        images.select("image_id", "name").join(counts, "image_id", "left").join(medians, "image_id", "left")
        .select(
            "name", "image_id",
            total.alias("total_observations"), matched.alias("matched_3d_points"),
            ratio(matched, total).alias("match_ratio"),
            F.coalesce("avg_point_error", F.lit(0.0)).alias("avg_point_error"),
            F.coalesce("median_point_error", F.lit(0.0)).alias("median_point_error"),
        )
    )


def merge_report(quality: DataFrame, report: DataFrame) -> DataFrame:
    """Add the external report's figures to the images it names.

    ``report`` has one row per camera entry: ``image, num_points,
    image_coverage, reproj_median, reproj_mean``. Missing figures of a matched
    image become 0; unmatched images keep NULL. With an ``entry`` column the last
    entry of a name counts.
    """
    if "entry" in report.columns:
        report = last_by_key(report, ["image"], ["entry"])
    named = report.select(
        F.col("image").alias("name"),
        F.coalesce("num_points", F.lit(0)).alias("ext_num_points"),
        F.coalesce("image_coverage", F.lit(0.0)).alias("ext_image_coverage"),
        F.coalesce("reproj_median", F.lit(0.0)).alias("ext_reproj_median"),
        F.coalesce("reproj_mean", F.lit(0.0)).alias("ext_reproj_mean"),
    )
    return quality.join(named, "name", "left")


def merge_summary(merged: DataFrame) -> DataFrame:
    """One row: how many images the report named, and whether to warn."""
    hits = F.count("ext_num_points")
    return merged.agg(
        F.count(F.lit(1)).alias("images"), hits.alias("merged"), (hits == 0).alias("warn_no_match")
    )


def points_per_image(tracks: DataFrame) -> DataFrame:
    """Points seen by each image and how often others see them too.

    ``tracks`` holds ``(point_id, image_id)``. The co-visibility of an image is
    the number of other sightings of its points, found from track lengths, so
    no image pairs are listed.
    """
    lengths = tracks.groupBy("point_id").agg(F.count(F.lit(1)).alias("track_length"))
    return tracks.join(lengths, "point_id").groupBy("image_id").agg(
        F.count(F.lit(1)).alias("points_seen"),
        F.sum(F.col("track_length") - 1).alias("covisible_sightings"),
        F.max("track_length").alias("longest_track"),
    )
