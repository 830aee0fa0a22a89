"""Queries on logs, timings, metrics, sizing and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from reefgrid.functions import names, sizing
from reefgrid.operators import compare, quality, report
from reefgrid.operators.nav import match_nav
from reefgrid.plans.base import Registry, rnd
from reefgrid.plans.model_queries import IMAGE_QUALITY_SQL
from reefgrid.plans.oracle_views import with_views
from reefgrid.plans.views import Survey
from reefgrid.sources.reports import parse_reports, report_cameras

query = Registry()


@query("feature_stats", with_views("keypoints") + """
    SELECT count(*) AS images_with_features, CAST(coalesce(sum(rows), 0) AS BIGINT) AS total_features,
           CAST(floor(avg(rows)) AS BIGINT) AS avg_features, min(rows) AS min_features, max(rows) AS max_features FROM keypoints WHERE rows > 0""")
def feature_stats(s: Survey):
    return report.feature_stats(s.keypoints())


@query("db_counts", with_views("nav_hit", "matches") + """
    SELECT (SELECT count(*) FROM images) AS images, (SELECT count(*) FROM matches) AS matches,
           (SELECT count(*) FROM matches WHERE verified > 0) AS verified_pairs,
           (SELECT count(*) FROM nav_hit WHERE image_id IS NOT NULL) AS pose_priors, CAST(4 AS BIGINT) AS rigs""")
def db_counts(s: Survey):
    return report.db_counts(s.images(), s.matches(), s.two_view(), match_nav(s.nav(), s.images()), s.cameras())


@query("model_stats", with_views("points", "images") + """
    SELECT (SELECT count(*) FROM images) AS registered_images, count(*) AS total_points, round(avg(error), 6) AS error_mean,
           max(error) AS error_max, (SELECT error FROM (SELECT error, row_number() OVER (ORDER BY error) AS rn FROM points)
           WHERE rn = (SELECT count(*) FROM points) // 2 + 1) AS error_median FROM points""")
def model_stats(s: Survey):
    return report.model_stats(s.images(), s.points()).select(
        "registered_images", "total_points", rnd("error_mean"), "error_max", "error_median"
    )


@query("log_timings", with_views("logs") + "SELECT run_id, mtime, stage, minutes FROM logs")
def log_timings(s: Survey):
    return report.log_timings(s.stage_logs())


@query("stage_timings_rollup", with_views("logs") + """
    SELECT coalesce(stage, 'TOTAL') AS stage, round(sum(minutes), 4) AS minutes, round(sum(minutes) / 60, 4) AS hours, count(*) AS n_logs
    FROM logs GROUP BY ROLLUP (stage)""")
def stage_timings_rollup(s: Survey):
    return report.stage_timings(report.log_timings(s.stage_logs())).select("stage", rnd("minutes", 4), rnd("hours", 4), "n_logs")


@query("stage_first", with_views("logs") + """
    SELECT run_id, min(mtime) AS mtime, arg_min(minutes, mtime) AS minutes FROM logs WHERE stage = 'Feature Extraction' GROUP BY 1""")
def stage_first(s: Survey):
    return report.first_stage(report.log_timings(s.stage_logs()), "Feature Extraction", ["run_id"])


@query("latest_log", "SELECT user_id % 10 AS run_id, max(event_id) AS mtime, 'run/' || max(event_id) || '.log' AS path FROM events GROUP BY 1")
def latest_log(s: Survey):
    logs = s.stage_logs().withColumn("path", F.concat(F.lit("run/"), F.col("mtime").cast("string"), F.lit(".log")))
    return report.latest(logs, ["run_id"])


@query("log_tail", "SELECT event_id AS line_no, user_id % 10 AS run_id FROM events ORDER BY event_id DESC LIMIT 100")
def log_tail(s: Survey):
    return report.tail(s.metric_lines(), "line_no", 100).select("line_no", "run_id")


@query("last_metric", """
    SELECT user_id % 10 AS run_id, max(event_id)::DOUBLE AS iteration,
           CAST('0.' || lpad(CAST(max(event_id) * 7 % 1000 AS VARCHAR), 3, '0') AS DOUBLE) AS loss,
           CAST((20 + max(event_id) FILTER (event_id % 4 = 0) % 15) || '.' || lpad(CAST(max(event_id) FILTER (event_id % 4 = 0) % 997 AS VARCHAR), 3, '0') AS DOUBLE) AS psnr,
           CAST('0.' || lpad(CAST(max(event_id) FILTER (event_id % 6 = 0) % 991 AS VARCHAR), 3, '0') AS DOUBLE) AS ssim,
           max(event_id)::DOUBLE * 10000 AS gaussians FROM events GROUP BY 1""")
def last_metric(s: Survey):
    return report.last_metrics(s.metric_lines(), ["run_id"], "line_no", ["iteration", "loss", "psnr", "ssim", "gaussians"])


@query("training_eta", """
    SELECT user_id % 10 AS run_id, round((99999999999 - max(event_id)) / (max(event_id) % 150 + 1.5::DOUBLE), 2) AS eta_sec FROM events GROUP BY 1""")
def training_eta(s: Survey):
    last = report.last_metrics(s.metric_lines(), ["run_id"], "line_no", ["iteration", "total_iterations", "it_per_sec"])
    eta = sizing.eta_seconds(F.col("total_iterations"), F.col("iteration"), F.col("it_per_sec"))
    return last.select("run_id", F.round(eta, 2).alias("eta_sec"))


@query("line_counts", """
    SELECT user_id % 10 AS run_id, count(*) FILTER (event_type NOT IN ('error', 'view')) AS n_lines FROM events GROUP BY 1""")
def line_counts(s: Survey):
    lines = s.table("events").select(
        (F.col("user_id") % 10).alias("run_id"),
        F.when(F.col("event_type") == "error", "  # comment").when(F.col("event_type") == "view", "   ").otherwise("1 2 3").alias("line"),
    )
    return report.line_counts(lines, "run_id")


@query("stage_progress", with_views("stage_events") + """
    SELECT stage, CASE stage WHEN 'INITIALIZING' THEN 0 WHEN 'FEATURE_EXTRACTION' THEN 17 WHEN 'MATCHING' THEN 50
           WHEN 'RECONSTRUCTION' THEN 67 WHEN 'COMPLETE' THEN 100 END::BIGINT AS pct, count(*) AS n FROM stage_events GROUP BY 1""")
def stage_progress(s: Survey):
    return s.stage_events().groupBy("stage").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "pct", names.stage_progress(F.col("stage"))
    )


@query("peak_by_label", with_views("gpu") + "SELECT label, max(used_mib) AS peak_mib, max(used_mib) - 500 AS net_mib FROM gpu GROUP BY 1")
def peak_by_label(s: Survey):
    return compare.peak_by_label(s.gpu_samples(), 500)


@query("compare_runs", """
    SELECT user_id % 10 AS run_id, CAST(coalesce(sum(floor(value)) FILTER (event_type IN ('view', 'click', 'purchase')), 0) AS BIGINT) AS progressive_sec,
           CAST(coalesce(sum(floor(value)) FILTER (event_type = 'signup'), 0) AS BIGINT) AS baseline_sec,
           CAST(coalesce(sum(floor(value)) FILTER (event_type IN ('view', 'click', 'purchase')), 0) - coalesce(sum(floor(value)) FILTER (event_type = 'signup'), 0) AS BIGINT) AS diff_sec
    FROM events GROUP BY 1""")
def compare_runs(s: Survey):
    runs = s.table("events").select(
        (F.col("user_id") % 10).alias("run_id"), F.col("event_type").alias("label"), F.floor("value").cast("bigint").alias("time_sec")
    )
    return compare.compare_runs(runs, ["run_id"], ["view", "click", "purchase"], ["signup"])


METRICS_SQL = """
    WITH m AS (SELECT user_id % 10 AS run_id, count(*) AS images, avg(value) AS feature_minutes, count(*) FILTER (event_type <> 'error') AS registered,
        avg(value) / 30 AS error_mean, count(*) FILTER (event_type = 'click') AS verified_pairs, count(*) FILTER (event_type IN ('click', 'view', 'signup')) AS matches,
        max(value) / 3 AS db_gb FROM events GROUP BY 1),
    d AS (SELECT *, images / feature_minutes AS speed, registered * 100.0::DOUBLE / images AS reg, verified_pairs * 100.0::DOUBLE / matches AS ver FROM m)
"""


def _metrics(s: Survey):
    kind = F.col("event_type")
    rows = s.table("events").groupBy((F.col("user_id") % 10).alias("run_id")).agg(
        F.count(F.lit(1)).alias("images"), F.avg("value").alias("feature_minutes"),
        F.count_if(kind != "error").alias("registered"), (F.avg("value") / 30).alias("error_mean"),
        F.count_if(kind == "click").alias("verified_pairs"), F.count_if(kind.isin("click", "view", "signup")).alias("matches"),
        (F.max("value") / 3).alias("db_gb"),
    )
    return report.survey_metrics(rows)


@query("recommendations", METRICS_SQL + """
    SELECT run_id, 'extraction' AS topic, CASE WHEN speed < 50 THEN 'slow' ELSE 'healthy' END AS note FROM d
    UNION ALL SELECT run_id, 'registration', CASE WHEN reg < 80 THEN 'low' WHEN reg < 95 THEN 'good' ELSE 'excellent' END FROM d
    UNION ALL SELECT run_id, 'error', CASE WHEN error_mean > 2 THEN 'high' WHEN error_mean > 1 THEN 'acceptable' ELSE 'excellent' END FROM d
    UNION ALL SELECT run_id, 'verification', 'low' FROM d WHERE verified_pairs > 0 AND ver < 30
    UNION ALL SELECT run_id, 'database', 'large' FROM d WHERE db_gb > 100
    UNION ALL SELECT run_id, 'mapper', 'gravity priors constrain rotations' FROM d
    UNION ALL SELECT run_id, 'features', 'learned features suit low contrast' FROM d""")
def recommendations(s: Survey):
    return report.recommendations(_metrics(s), ["run_id"])


@query("health", METRICS_SQL + """,
    hm AS (SELECT user_id % 10 AS run_id, CASE WHEN user_id % 10 <> 3 THEN count(*) FILTER (event_type = 'purchase') * 400.0::DOUBLE / count(*) END AS mem,
                 count(*) FILTER (event_type = 'view') * 200.0::DOUBLE / count(*) AS gpu, count(*) FILTER (event_type IN ('view', 'signup')) * 100.0::DOUBLE / count(*) AS seen,
                 max(value) / 3 / (count(*) / 1000.0::DOUBLE) AS per FROM events GROUP BY 1)
    SELECT run_id, 'memory_pct' AS metric, round(mem, 4) AS value, CASE WHEN mem IS NULL THEN 'missing' WHEN mem > 90 THEN 'alarm' WHEN mem > 80 THEN 'watch' ELSE 'ok' END AS status FROM hm
    UNION ALL SELECT run_id, 'gpu_pct', round(gpu, 4), CASE WHEN gpu < 10 THEN 'alarm' WHEN gpu < 50 THEN 'watch' ELSE 'ok' END FROM hm
    UNION ALL SELECT run_id, 'points_seen_pct', round(seen, 4), CASE WHEN seen < 30 THEN 'alarm' WHEN seen < 50 THEN 'watch' ELSE 'ok' END FROM hm
    UNION ALL SELECT run_id, 'db_gb_per_1000', round(per, 4), CASE WHEN per > 2 THEN 'watch' ELSE 'ok' END FROM hm
    UNION ALL
    SELECT run_id, 'images_per_min' AS metric, round(speed, 4) AS value, CASE WHEN speed < 5 THEN 'alarm' WHEN speed > 50 THEN 'watch' ELSE 'ok' END AS status FROM d
    UNION ALL SELECT run_id, 'verification_pct', round(ver, 4), CASE WHEN ver < 30 THEN 'alarm' WHEN ver < 50 THEN 'watch' ELSE 'ok' END FROM d
    UNION ALL SELECT run_id, 'error_mean', round(error_mean, 4), CASE WHEN error_mean > 4 THEN 'alarm' WHEN error_mean > 2 THEN 'watch' ELSE 'ok' END FROM d""")
def health(s: Survey):
    """All seven ranges; one run has no memory figure."""
    kind, n, run = F.col("event_type"), F.count(F.lit(1)), (F.col("user_id") % 10).alias("run_id")
    more = s.table("events").groupBy(run).agg(
        (F.count_if(kind == "purchase") * 400.0 / n).alias("memory_pct"), (F.count_if(kind == "view") * 200.0 / n).alias("gpu_pct"),
        (F.count_if(kind.isin("view", "signup")) * 100.0 / n).alias("points_seen_pct"), (F.max("value") / 3 / (n / 1000.0)).alias("db_gb_per_1000"),
    ).withColumn("memory_pct", F.when(F.col("run_id") != 3, F.col("memory_pct")))
    return report.health(_metrics(s).join(more, "run_id"), ["run_id"]).withColumn("value", F.round("value", 4))


def _datasets(s: Survey):
    """One dataset per customer: its orders are the points, its priciest order gives the image count."""
    return s.table("orders").groupBy(F.col("o_custkey").alias("dataset_id")).agg(
        (F.count(F.lit(1)) * 250000 * (F.col("o_custkey") % 3)).alias("points"),
        F.floor(F.max("o_totalprice") / 100).cast("bigint").alias("images"),
        F.when(F.col("o_custkey") % 2 == 0, 4032).otherwise(3840).alias("width"),
        F.when(F.col("o_custkey") % 2 == 0, 3024).otherwise(2160).alias("height"),
    )


@query("plan_sizing", """
    WITH ds AS (SELECT o_custkey AS dataset_id, count(*) * 250000 * (o_custkey % 3) AS points, CAST(floor(max(o_totalprice) / 100) AS BIGINT) AS images,
        CASE WHEN o_custkey % 2 = 0 THEN 4032.0::DOUBLE ELSE 3840 END AS w, CASE WHEN o_custkey % 2 = 0 THEN 3024.0::DOUBLE ELSE 2160 END AS h FROM orders GROUP BY o_custkey),
    p AS (SELECT * FROM (VALUES ('preview', 3000, 1.0::DOUBLE, 4, 0.80::DOUBLE), ('medium', 7000, 1.5, 2, 0.85), ('high', 30000, 2.0, 2, 0.90), ('max-quality', 30000, 3.0, 1, 0.92))
        v(preset, iters, mult, resize, share)),
    a AS (SELECT *, (w / resize) * (h / resize) * 48 / 1073741824 AS render FROM ds, p),
    b AS (SELECT *, CASE WHEN 30 * share - 3.5 - render <= 0 THEN 0 ELSE floor((30 * share - 3.5 - render) * 1073741824 / 760) END AS lim,
                 floor((CASE WHEN points > 0 THEN points ELSE greatest(images, 1) * 300 END) * mult) AS need FROM a),
    c AS (SELECT *, greatest(100000, floor(least(need, lim) / 100000) * 100000) AS cap FROM b),
    d AS (SELECT *, 3.5 + render + cap * 760 / 1073741824 AS vram, iters * (3 + 22 * power(cap / 1e6::DOUBLE, 0.8) * power((w / resize) * (h / resize) / 1e6::DOUBLE, 0.5)) / 60000.0::DOUBLE AS minutes FROM c)
    SELECT dataset_id, preset, CAST(cap AS BIGINT) AS max_cap, round(vram, 4) AS vram_gb, round(minutes, 3) AS minutes,
           CASE WHEN vram / 32 > 0.95 THEN 'DANGER' WHEN vram / 32 > 0.85 THEN 'TIGHT' WHEN vram / 32 > 0.70 THEN 'OK' ELSE 'SAFE' END AS band FROM d""")
def plan_sizing(s: Survey):
    return compare.plan_sizing(_datasets(s)).select("dataset_id", "preset", "max_cap", rnd("vram_gb", 4), rnd("minutes", 3), "band")


@query("resource_estimates", """
    SELECT p_brand, count(*) AS n_images, CAST(floor(count(*)::DOUBLE * 100000 * 16384 * 128 * 2 / 1073741824) AS BIGINT) AS db_gb,
           CAST(floor(floor(count(*)::DOUBLE * 100000 * 16384 * 128 / 1073741824) * 3 / 2) AS BIGINT) AS vocab_gb,
           CASE WHEN count(*) * 100000 > 10000000 THEN 15 WHEN count(*) * 100000 > 5000000 THEN 10 ELSE 5 END AS keep_components
    FROM part GROUP BY 1""")
def resource_estimates(s: Survey):
    n = F.col("n_images") * 100000
    return s.table("part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_images")).select(
        "p_brand", "n_images", sizing.est_db_gb(n, F.lit(16384)).alias("db_gb"),
        sizing.est_desc_gb(n * 16384).alias("vocab_gb"), sizing.keep_components(n).alias("keep_components"),
    )


REPORT_SQL = with_views("images") + """
    , rep AS (SELECT name AS image, image_id * 3 AS num_points, CAST('0.' || lpad(CAST(image_id % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS image_coverage,
           image_id % 7 + 0.5::DOUBLE AS reproj_median, image_id % 9 + 0.25::DOUBLE AS reproj_mean FROM images WHERE p_size % 3 = 0)
"""


@query("json_repair", REPORT_SQL + "SELECT * FROM rep")
def json_repair(s: Survey):
    return report_cameras(parse_reports(s.quality_reports())).select(
        "image", "num_points", "image_coverage", "reproj_median", "reproj_mean"
    )


@query("image_quality_report_left", IMAGE_QUALITY_SQL.rstrip() + """
    , rep AS (SELECT name, image_id * 3 AS num_points, image_id % 7 + 0.5::DOUBLE AS reproj_median FROM images WHERE p_size % 3 = 0)
    SELECT q.name, q.total_observations, q.median_point_error, rep.num_points AS ext_num_points, rep.reproj_median AS ext_reproj_median
    FROM q LEFT JOIN rep ON rep.name = q.name""")
def image_quality_report_left(s: Survey):
    base = quality.image_quality(s.images(), s.observations(), s.points())
    merged = quality.merge_report(base, report_cameras(parse_reports(s.quality_reports())))
    return merged.select("name", "total_observations", rnd("median_point_error"), "ext_num_points", "ext_reproj_median")


@query("report_merge_summary", with_views("images") + """
    SELECT count(*) AS images, count(*) FILTER (p_size % 3 = 0) AS merged, count(*) FILTER (p_size % 3 = 0) = 0 AS warn_no_match FROM images""")
def report_merge_summary(s: Survey):
    named = report_cameras(parse_reports(s.quality_reports()))
    return quality.merge_summary(quality.merge_report(s.images().select("name"), named))
