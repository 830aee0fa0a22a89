"""Queries on the sparse model: errors, quality, tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from reefgrid.operators import quality, tiers
from reefgrid.operators.ranks import grouped_median, middle
from reefgrid.plans.base import Registry, rnd
from reefgrid.plans.oracle_views import with_views
from reefgrid.plans.views import Survey
from reefgrid.session import pin

query = Registry()
r = rnd


def _tiered(s: Survey):
    return tiers.point_tiers(s.tracked_points(), errors=s.points())


@query("point_stats", with_views("tracked") + """
    SELECT count(*) AS count, min(error) AS error_min, max(error) AS error_max, round(avg(error), 6) AS error_mean,
           round(median(error), 6) AS error_median, round(stddev_samp(error), 6) AS error_stdev,
           min(track_length) AS track_min, max(track_length) AS track_max, round(avg(track_length), 6) AS track_mean,
           median(track_length) AS track_median FROM tracked""")
def point_stats(s: Survey):
    return quality.point_stats(s.tracked_points(), s.points()).select(
        "count", "error_min", "error_max", r("error_mean"), r("error_median"), r("error_stdev"),
        "track_min", "track_max", r("track_mean"), "track_median",
    )


@query("upper_median", with_views("points") + """
    SELECT n AS n_points, error AS upper_median FROM (SELECT error, row_number() OVER (ORDER BY error) AS rn, count(*) OVER () AS n FROM points)
    WHERE rn = n // 2 + 1""")
def upper_median(s: Survey):
    found = middle(s.points(), "error")
    return s.points().agg(F.count("error").alias("n_points")).withColumn("upper_median", F.lit(None if found is None else found.upper).cast("double"))


@query("track_lengths", with_views("tracked") + """
    SELECT track_length, count(*) AS n_points FROM tracked GROUP BY 1""")
def track_lengths(s: Survey):
    return s.tracked_points().groupBy("track_length").agg(F.count(F.lit(1)).alias("n_points"))


@query("tier_assign", with_views("tiered") + "SELECT point_id, tier FROM tiered")
def tier_assign(s: Survey):
    return _tiered(s).select("point_id", "tier")


@query("tier_counts", with_views("tiered") + """
    SELECT t.tier, count(p.tier) AS n_points, (SELECT count(*) FROM tiered) AS total,
           round(count(p.tier) * 100.0::DOUBLE / (SELECT count(*) FROM tiered), 6) AS pct
    FROM (VALUES (0), (1), (2), (3)) t(tier) LEFT JOIN tiered p ON p.tier = t.tier GROUP BY t.tier""")
def tier_counts(s: Survey):
    return tiers.tier_counts(_tiered(s)).select("tier", "n_points", "total", r("pct"))


@query("tier_counts_cum", with_views("tiered") + """
    SELECT 'tier' || d.n AS label, count(*) AS n_points FROM tiered p JOIN (VALUES (1), (2), (3)) d(n) ON p.tier BETWEEN 1 AND d.n GROUP BY d.n
    UNION ALL SELECT 'dropped', count(*) FROM tiered WHERE tier = 0""")
def tier_counts_cum(s: Survey):
    return tiers.tier_counts_cum(tiers.tier_counts(_tiered(s)))


@query("tier_members", with_views("tiered") + """
    SELECT point_id, d.n AS dataset FROM tiered p JOIN (VALUES (1), (2), (3)) d(n) ON p.tier BETWEEN 1 AND d.n""")
def tier_members(s: Survey):
    return tiers.tier_members(_tiered(s)).select("point_id", "dataset")


@query("tier_summary", with_views("tiered") + """
    SELECT d.n AS dataset, count(*) AS n_points, round(avg(error), 6) AS avg_error, round(avg(track_length), 6) AS avg_track
    FROM tiered p JOIN (VALUES (1), (2), (3)) d(n) ON p.tier BETWEEN 1 AND d.n GROUP BY 1""")
def tier_summary(s: Survey):
    return tiers.tier_summary(_tiered(s)).select(
        "dataset", "n_points", r("avg_error"), r("avg_track")
    )


CUSTOM = tiers.TierThresholds(6, 80.0, 4, 150.0, 250.0)


@query("tier_custom", with_views("tracked", "med") + """
    SELECT point_id, CASE WHEN track_length >= 6 AND error < m * (80.0::DOUBLE / 100) THEN 1
           WHEN track_length >= 4 AND error < m * (150.0::DOUBLE / 100) THEN 2
           WHEN error < m * (250.0::DOUBLE / 100) THEN 3 ELSE 0 END AS tier FROM tracked, med""")
def tier_custom(s: Survey):
    return tiers.point_tiers(s.tracked_points(), CUSTOM, s.points()).select("point_id", "tier")


@query("tier_manifest", with_views("tiered") + """
    SELECT round(median(error), 6) AS median_error, round(2 * median(error), 6) AS t2_max_error,
           count(*) FILTER (tier BETWEEN 1 AND 2) AS tier2, count(*) FILTER (tier > 0) AS tier3,
           count(*) FILTER (tier = 0) AS dropped FROM tiered""")
def tier_manifest(s: Survey):
    m = tiers.tier_manifest(_tiered(s))
    return m.select(
        r("median_error"), F.round("thresholds.t2_max_error", 6).alias("t2_max_error"),
        "tier_counts.tier2", "tier_counts.tier3", "tier_counts.dropped",
    )


@query("dropped_points", with_views("tiered") + "SELECT point_id, error, track_length FROM tiered WHERE tier = 0")
def dropped_points(s: Survey):
    return tiers.dropped_points(_tiered(s)).select("point_id", "error", "track_length")


@query("reproj_camera_frame", with_views("framed") + """
    SELECT camera_id, count(*) AS n_obs, round(avg(cam_z), 4) AS mean_depth, round(max(abs(cam_x)), 4) AS max_side
    FROM framed WHERE cam_z > 1e-6 GROUP BY 1""")
def reproj_camera_frame(s: Survey):
    errors = quality.observation_errors(s.images(), s.observations(), s.points(), s.cameras())
    return errors.groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("n_obs"), F.round(F.avg("cam_z"), 4).alias("mean_depth"),
        F.round(F.max(F.abs("cam_x")), 4).alias("max_side"),
    )


@query("reproj_point_error", with_views("obs_err") + """
    SELECT point_id, round(avg(obs_error), 3) AS point_error, count(*) AS n_obs FROM obs_err GROUP BY 1""")
def reproj_point_error(s: Survey):
    errors = quality.reprojection_errors(s.images(), s.observations(), s.points(), s.cameras())
    return errors.select("point_id", r("point_error", 3), "n_obs")


@query("points_with_errors", with_views("obs_err") + """
    SELECT p.point_id, round(coalesce(e.pe, 0), 3) AS error FROM points p
    LEFT JOIN (SELECT point_id, avg(obs_error) AS pe FROM obs_err GROUP BY 1) e ON e.point_id = p.point_id""")
def points_with_errors(s: Survey):
    blank = s.points().withColumn("error", F.lit(0.0))
    errors = quality.reprojection_errors(s.images(), s.observations(), blank, s.cameras())
    return quality.with_errors(blank, errors).select("point_id", r("error", 3))


@query("errors_missing", with_views("points") + """
    SELECT count(*) AS probed, coalesce(max(abs(error)) = 0, true) AS errors_missing FROM points""")
def errors_missing(s: Survey):
    return quality.errors_missing(s.points())


IMAGE_QUALITY_SQL = with_views("images", "obs", "points") + """
    , q AS (SELECT i.name, i.image_id, count(o.image_id) AS total_observations, count(o.point_id) AS matched_3d_points,
       round(CASE WHEN count(o.image_id) > 0 THEN count(o.point_id) / count(o.image_id)::DOUBLE ELSE 0 END, 6) AS match_ratio,
       round(coalesce(avg(p.error), 0), 6) AS avg_point_error, round(coalesce(median(p.error), 0), 6) AS median_point_error
    FROM images i LEFT JOIN obs o ON o.image_id = i.image_id LEFT JOIN points p ON p.point_id = o.point_id GROUP BY 1, 2)
"""


def _quality(s: Survey):
    return quality.image_quality(s.images(), s.observations(), s.points()).select(
        "name", "image_id", "total_observations", "matched_3d_points",
        r("match_ratio"), r("avg_point_error"), r("median_point_error"),
    )


@query("image_quality", IMAGE_QUALITY_SQL + "SELECT * FROM q")
def image_quality(s: Survey):
    return _quality(s)


@query("image_median_hot_path", with_views("obs", "points") + """
    SELECT image_id, round(median(error), 6) AS median FROM obs JOIN points USING (point_id) GROUP BY 1""")
def image_median_hot_path(s: Survey):
    """The grouped median by itself."""
    seen = quality.obs_points(s.observations(), s.points())
    return grouped_median(pin(seen.select("image_id", "error")), ["image_id"], "error").select("image_id", r("median"))


@query("obs_invalidated", with_views("tiered", "obs") + """
    SELECT o.image_id, count(*) AS n_obs, count(t.point_id) AS n_kept FROM obs o
    LEFT JOIN (SELECT point_id FROM tiered WHERE tier = 1) t ON t.point_id = o.point_id GROUP BY 1""")
def obs_invalidated(s: Survey):
    kept = _tiered(s).filter(F.col("tier") == 1)
    return tiers.invalidate_obs(s.observations(), kept).groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n_obs"), F.count("point_id").alias("n_kept")
    )


@query("max_error_filter", with_views("points") + "SELECT point_id, error FROM points WHERE error <= 4.0")
def max_error_filter(s: Survey):
    return tiers.filter_max_error(s.points()).select("point_id", "error")


@query("covisibility", """
    SELECT l_partkey AS image_id, count(*) AS points_seen, CAST(sum(n - 1) AS BIGINT) AS covisible_sightings, max(n) AS longest_track
    FROM lineitem l JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) t ON t.k = l.l_orderkey GROUP BY 1""")
def covisibility(s: Survey):
    return quality.points_per_image(s.tracks())
