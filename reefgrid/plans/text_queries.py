"""Queries that read survey files written from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from reefgrid.functions.names import coord_system
from reefgrid.operators import report
from reefgrid.operators.analysis import analyze_model
from reefgrid.operators.ranks import number_rows
from reefgrid.plans import text_files as files
from reefgrid.plans.base import Registry
from reefgrid.plans.oracle_views import with_views
from reefgrid.plans.views import Survey
from reefgrid.session import scratch_path
from reefgrid.sinks import tiers as sink
from reefgrid.sources import logs, nav, text_model
from reefgrid.sources.lines import POSITION, read_lines

query = Registry()

#: The lines of the model's points and images.
_POINT_LINES = """
    WITH t AS (SELECT l_orderkey AS k, string_agg(' ' || l_partkey || ' ' || l_linenumber, '' ORDER BY l_linenumber, l_partkey) AS track FROM lineitem GROUP BY 1),
    p AS (SELECT o_orderkey AS id, o_orderkey || ' ' || o_custkey % 1000 || '.5 ' || o_orderkey % 977 || '.25 ' || (o_orderkey * 31 % 613 + 5) || ' ' || o_orderkey % 256 || ' ' ||
                 o_custkey % 256 || ' ' || (o_orderkey + o_custkey) % 256 || ' ' || o_orderkey % 40 || '.125' || coalesce(track, '') AS line FROM orders LEFT JOIN t ON k = o_orderkey)"""
_SIGHTINGS = with_views("images") + """,
    o AS (SELECT l_partkey AS image_id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_quantity, l_returnflag <> 'R') - 1 AS obs_idx,
                 CAST(l_quantity * 40 AS BIGINT) AS q, l_linenumber AS n, CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS point_id FROM lineitem),
    b AS (SELECT * FROM o UNION ALL SELECT image_id, 0, 0, 0, NULL FROM images WHERE image_id NOT IN (SELECT l_partkey FROM lineitem))"""


@query("model_points", """
    SELECT o_orderkey AS point_id, o_custkey % 1000 + 0.5::DOUBLE AS x, o_orderkey % 977 + 0.25::DOUBLE AS y, (o_orderkey * 31 % 613 + 5)::DOUBLE AS z,
           (o_orderkey % 256)::INTEGER AS r, (o_custkey % 256)::INTEGER AS g, ((o_orderkey + o_custkey) % 256)::INTEGER AS b, o_orderkey % 40 + 0.125::DOUBLE AS error,
           coalesce(n, 0)::INTEGER AS track_length FROM orders LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) ON k = o_orderkey""")
def model_points(s: Survey):
    """Points of a text model; of repeated ids the last line counts."""
    return text_model.read_points(s.spark, f"{files.write_model(s)}/points3D.txt").drop("track", *POSITION)


@query("model_tracks", "SELECT l_orderkey AS point_id, l_partkey AS image_id, l_linenumber::INTEGER AS point2d_idx FROM lineitem")
def model_tracks(s: Survey):
    return text_model.tracks(text_model.read_points(s.spark, f"{files.write_model(s)}/points3D.txt"))


@query("model_images", with_views("images") + """
    SELECT image_id, name, camera_id, 1::DOUBLE AS qw, (image_id % 17) + 0.5::DOUBLE AS tx, (p_size % 13) + 0.25::DOUBLE AS ty, (40 + p_size)::DOUBLE AS tz FROM images""")
def model_images(s: Survey):
    """Poses of a text model, found among observation, stray and comment lines."""
    images, _ = text_model.read_images(s.spark, f"{files.write_model(s)}/images.txt")
    return images.select("image_id", "name", "camera_id", F.col("qvec")[0].alias("qw"), *[F.col("tvec")[i].alias(c) for i, c in enumerate(("tx", "ty", "tz"))])


@query("model_observations", _SIGHTINGS + "SELECT image_id, obs_idx::INTEGER AS obs_idx, q + 0.5::DOUBLE AS px, n::DOUBLE AS py, point_id FROM b")
def model_observations(s: Survey):
    """Sightings from the lines after the poses; those of outdated poses do not count."""
    _, seen = text_model.read_images(s.spark, f"{files.write_model(s)}/images.txt")
    return seen


@query("model_cameras", """
    SELECT s_suppkey AS camera_id, CASE WHEN s_suppkey % 2 = 0 THEN 'PINHOLE' ELSE 'OPENCV' END AS model, (1000 + s_suppkey)::INTEGER AS width, (700 + s_nationkey)::INTEGER AS height,
           s_suppkey % 90 + 1000.5::DOUBLE AS p0, (s_suppkey % 70)::DOUBLE AS p1, -(s_suppkey % 50 + 1)::DOUBLE AS p2, 3 AS n_params FROM supplier""")
def model_cameras(s: Survey):
    cameras = text_model.read_cameras(s.spark, f"{files.write_model(s)}/cameras.txt")
    return cameras.select("camera_id", "model", "width", "height", *[F.col("params")[i].alias(f"p{i}") for i in range(3)], F.size("params").alias("n_params"))


@query("image_lines_rewritten", _SIGHTINGS + """,
    l AS (SELECT string_agg(q || '.5 ' || n || ' ' || CASE WHEN point_id % 3 = 0 THEN point_id ELSE -1 END, ' ' ORDER BY obs_idx) AS line FROM b GROUP BY image_id
          UNION ALL SELECT image_id || ' 1 0 0 0 ' || image_id % 17 || '.5 ' || p_size % 13 || '.25 ' || (40 + p_size) || ' ' || p_size % 4 || ' ' || name FROM images
          UNION ALL SELECT unnest([image_id || ' 0 1 0 0 9 9 9 9 stale.jpg', '1 1 -1']) FROM images WHERE image_id % 9 = 0
          UNION ALL SELECT '# between' FROM images WHERE image_id % 14 = 5 UNION ALL SELECT 'a stray line' FROM images WHERE image_id % 15 = 4
          UNION ALL SELECT '# Image list')
    SELECT line, count(*) AS n FROM l GROUP BY 1""")
def image_lines_rewritten(s: Survey):
    """The images file with references to all but every third point taken out."""
    kept = s.table("orders").select(F.col("o_orderkey").alias("point_id")).filter("point_id % 3 = 0")
    lines = text_model.rewrite_image_lines(s.spark, f"{files.write_model(s)}/images.txt", kept)
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("tier_export", _POINT_LINES + """
    SELECT row_number() OVER (ORDER BY id) + 2 AS place, line FROM p WHERE id % 4 IN (1, 2) UNION ALL SELECT 1, '# 3D point list' UNION ALL SELECT 2, '#   one line each'""")
def tier_export(s: Survey):
    """Point lines of the second dataset as exported: header first, then verbatim lines by id."""
    out = scratch_path(s.spark, "export")
    tiered = s.table("orders").select(F.col("o_orderkey").alias("point_id"), (F.col("o_orderkey") % 4).cast("int").alias("tier"))
    sink.export_tier_text(s.spark, files.write_model(s), tiered, 2, out)
    return number_rows(read_lines(s.spark, f"{out}/points3D.txt"), POSITION, "place").select("place", "line")


@query("analysis_written", """
    WITH p AS (SELECT o_orderkey AS id, o_orderkey % 40 + 0.125::DOUBLE AS error, coalesce(n, 0) AS track FROM orders
               LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) ON k = o_orderkey),
    m AS (SELECT median(error) AS m FROM p)
    SELECT 'tier ' || CASE WHEN track >= 5 AND error < m THEN 1 WHEN track >= 3 AND error < 2 * m THEN 2 WHEN error < 3 * m THEN 3 ELSE 0 END AS what, count(*) AS n FROM p, m GROUP BY 1
    UNION ALL SELECT 'images', count(*) FROM part""")
def analysis_written(s: Survey):
    """A model analysed from its files; the written tables read back."""
    result, out = analyze_model(s.spark, files.write_model(s)), scratch_path(s.spark, "analysis")
    sink.write_analysis(result.points, result.tiered, result.image_quality, out)
    tiers = s.spark.read.parquet(f"{out}/point_tiers").groupBy(F.concat(F.lit("tier "), F.col("tier").cast("string")).alias("what")).agg(F.count(F.lit(1)).alias("n"))
    rated = s.spark.read.parquet(f"{out}/image_quality").agg(F.count(F.lit(1)).alias("n")).select(F.lit("images").alias("what"), "n")
    return tiers.unionByName(rated)


@query("tier_read_back", "SELECT o_orderkey AS point_id, (o_orderkey % 4)::INTEGER AS tier FROM orders WHERE o_orderkey % 4 IN (1, 2)")
def tier_read_back(s: Survey):
    """The second tier dataset, written by tier and read with only its folders."""
    out = scratch_path(s.spark, "tiers")
    sink.write_tier(s.table("orders").select(F.col("o_orderkey").alias("point_id"), (F.col("o_orderkey") % 4).cast("int").alias("tier")), out)
    return sink.read_tier(s.spark, out, 2)


@query("nav_files", """
    SELECT 'img' || c_custkey || '.jpg' AS name, floor(c_acctbal)::DOUBLE AS x, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::DOUBLE ELSE c_custkey % 90 + 0.25 END AS y,
           CASE WHEN c_custkey % 2 = 0 THEN -(c_custkey % 40 + 0.5)::DOUBLE ELSE 0::DOUBLE END AS alt, CASE WHEN c_custkey % 2 = 1 THEN (c_custkey % 360)::DOUBLE END AS yaw,
           CASE WHEN c_custkey % 2 = 1 THEN -1::DOUBLE END AS roll, 1 AS coord_system FROM customer WHERE c_custkey % 50 <> 0
    UNION ALL SELECT 'img' || c_custkey || '.jpg', 1, 1, 1, NULL, NULL, 1 FROM customer WHERE c_custkey % 50 = 0 AND c_custkey % 20 = 2""")
def nav_files(s: Survey):
    """Nav rows of a folder whose files differ in delimiter, columns and spelling."""
    path = files.write_nav(s)
    system = coord_system(nav.nav_columns(s.spark, path))
    return nav.read_nav(s.spark, path).select("name", "x", "y", "alt", "yaw", "roll").withColumn("coord_system", F.lit(system))


@query("nav_rejects", "SELECT 'img' || c_custkey || '.jpg' AS name FROM customer WHERE c_custkey % 50 = 0")
def nav_rejects(s: Survey):
    return nav.read_nav_rejects(s.spark, files.write_nav(s)).select("name")


@query("camera_rule_file", """
    SELECT (row_number() OVER (ORDER BY n_nationkey) - 1)::INTEGER AS rule_idx, n_name AS prefix, ['OPENCV', 'PINHOLE', 'OPENCV_FISHEYE'][n_nationkey % 3 + 1] AS model,
           n_nationkey + 10.5::DOUBLE AS focal_mm, 36::DOUBLE AS sensor_width_mm FROM nation WHERE n_nationkey % 6 <> 5""")
def camera_rule_file(s: Survey):
    return nav.read_camera_rules(s.spark, files.write_rules(s))


@query("metric_log", """
    SELECT event_id::DOUBLE AS iteration, CAST('0.' || lpad(CAST(event_id * 7 % 1000 AS VARCHAR), 3, '0') AS DOUBLE) AS loss,
           CASE WHEN event_id % 4 = 0 THEN CAST((20 + event_id % 15) || '.' || lpad(CAST(event_id % 997 AS VARCHAR), 3, '0') AS DOUBLE) END AS psnr,
           CASE WHEN event_id % 6 = 0 THEN CAST('0.' || lpad(CAST(event_id % 991 AS VARCHAR), 3, '0') AS DOUBLE) END AS ssim, event_id::DOUBLE * 10000 AS gaussians FROM events""")
def metric_log(s: Survey):
    return logs.read_metric_log(s.spark, files.write_metric_log(s)).select("iteration", "loss", "psnr", "ssim", "gaussians")


@query("gpu_log", """
    SELECT epoch(date_trunc('second', ts))::BIGINT AS timestamp, event_type AS label, (event_id % 9000)::INTEGER AS used_mib, (event_id % 70)::INTEGER AS free_mib, 32607 AS total_mib FROM events""")
def gpu_log(s: Survey):
    return logs.read_gpu_samples(s.spark, files.write_gpu_log(s)).drop("ts")


@query("log_lines_timings", """
    WITH l AS (SELECT user_id % 10 AS run, event_id AS n, event_type AS kind FROM events),
    f AS (SELECT run, bool_or(kind = 'view' AND n % 3 = 0) AS matching, bool_or(kind = 'click' AND n % 10 < 5) AS averaging,
                 arg_min(n % 500 + 0.25::DOUBLE, n) FILTER (n % 97 = 0 AND run <> 3) AS minutes FROM l GROUP BY 1)
    SELECT run, CASE WHEN matching THEN 'Feature Matching' WHEN averaging THEN 'Global Mapper' ELSE 'Unknown Stage' END AS stage, minutes FROM f WHERE minutes IS NOT NULL""")
def log_lines_timings(s: Survey):
    """Stage and first elapsed time of each log, folded from its lines wherever they were read."""
    timed = report.timings_of_lines(logs.read_log_lines(s.spark, files.write_stage_logs(s), named=False))
    return timed.select(F.regexp_extract("path", "run=([0-9]+)", 1).cast("bigint").alias("run"), "stage", "minutes")
