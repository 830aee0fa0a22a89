"""Queries on nav, cameras and image pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from reefgrid.functions.names import basename, camera_tag, model_code
from reefgrid.operators import catalog, nav, pairs
from reefgrid.operators.components import component_sizes
from reefgrid.operators.report import stratified
from reefgrid.plans.base import Registry, rnd
from reefgrid.plans.oracle_views import with_views
from reefgrid.plans.views import Survey
from reefgrid.session import pin

query = Registry()


def _matched(s: Survey):
    return nav.match_nav(s.nav(), s.images())


@query("nav_match", with_views("nav_hit") + "SELECT name, image_id, camera_id, matched_by FROM nav_hit WHERE image_id IS NOT NULL")
def nav_match(s: Survey):
    return _matched(s).select("name", "image_id", "camera_id", "matched_by")


@query("nav_unmatched", with_views("nav_hit") + """
    SELECT name, greatest((SELECT count(*) FROM nav_hit WHERE image_id IS NULL) - 5, 0) AS n_more
    FROM nav_hit WHERE image_id IS NULL ORDER BY line_no LIMIT 5""")
def nav_unmatched(s: Survey):
    return nav.first_names(nav.nav_without_image(s.nav(), s.images()), "line_no")


@query("image_unmatched", with_views("nav_hit") + """
    SELECT image_id, name FROM images WHERE image_id NOT IN (SELECT image_id FROM nav_hit WHERE image_id IS NOT NULL)""")
def image_unmatched(s: Survey):
    return nav.images_without_nav(_matched(s), s.images()).select("image_id", "name")


GRAVITY_SQL = """
    round(-sin(radians(roll)) * cos(radians(pitch)), 6) AS gx, round(cos(radians(roll)) * cos(radians(pitch)), 6) AS gy,
    round(sin(radians(pitch)), 6) AS gz"""


@query("gravity", with_views("nav_hit") + f"SELECT image_id, {GRAVITY_SQL} FROM nav_hit WHERE image_id IS NOT NULL")
def gravity(s: Survey):
    g = nav.geometry.gravity(F.col("pitch"), F.col("roll"))
    return _matched(s).select("image_id", *[F.round(g[i], 6).alias(f"g{c}") for i, c in enumerate("xyz")])


PRIORS_SQL = """
    SELECT row_number() OVER (ORDER BY line_no) AS pose_prior_id, image_id, camera_id, x, y, alt AS z,
           power(coalesce(x_acc, 10.0), 2) AS var_x, power(coalesce(y_acc, 10.0), 2) AS var_y, power(coalesce(alt_acc, 1.0), 2) AS var_z
    FROM nav_hit WHERE image_id IS NOT NULL"""


def _priors(s: Survey):
    return nav.build_priors(_matched(s), ["line_no"])


@query("pose_priors", with_views("nav_hit") + PRIORS_SQL)
def pose_priors(s: Survey):
    return _priors(s).select(
        "pose_prior_id", "image_id", "camera_id", *[F.col("position")[i].alias(c) for i, c in enumerate("xyz")],
        *[F.col("covariance")[i].alias(f"var_{c}") for i, c in ((0, "x"), (4, "y"), (8, "z"))],
    )


@query("nav_stats", with_views("nav_hit") + """
    SELECT (SELECT count(*) FROM nav) AS n_nav, count(*) AS n_matched, min(x) AS x_min, max(x) AS x_max, round(max(y) - min(y), 6) AS y_span,
           min(pitch) AS pitch_min, max(pitch) AS pitch_max, min(roll) AS roll_min, max(roll) AS roll_max,
           min(coalesce(x_acc, 10.0)) AS acc_min, max(coalesce(x_acc, 10.0)) AS acc_max FROM nav_hit WHERE image_id IS NOT NULL""")
def nav_stats(s: Survey):
    return nav.nav_stats(s.nav(), _matched(s)).select(
        "n_nav", "n_matched", "x_min", "x_max", rnd("y_span"), "pitch_min", "pitch_max", "roll_min", "roll_max", "acc_min", "acc_max"
    )


@query("survey_extent", with_views("nav_hit") + """
    SELECT min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, min(alt) AS z_min, max(alt) AS z_max,
           round((max(x) - min(x)) * (max(y) - min(y)), 4) AS area_m2, round((max(x) - min(x)) * (max(y) - min(y)) / 10000, 4) AS hectares
    FROM nav_hit WHERE image_id IS NOT NULL""")
def survey_extent(s: Survey):
    return nav.survey_extent(_priors(s)).withColumns({"area_m2": F.round("area_m2", 4), "hectares": F.round("hectares", 4)})


@query("positions_sample", with_views("nav_hit") + f""", p AS ({PRIORS_SQL})
    SELECT p.pose_prior_id, p.image_id, p.x, p.y, p.z,
           CASE WHEN contains(i.name, 'HERC') THEN 'HERC' WHEN contains(i.name, 'camlower') THEN 'camlower'
                WHEN contains(i.name, 'cammid') THEN 'cammid' ELSE 'camupper' END AS camera
    FROM p JOIN images i USING (image_id) WHERE p.pose_prior_id % greatest(1, (SELECT count(*) FROM p) // 5000) = 0""")
def positions_sample(s: Survey):
    priors = pin(_priors(s))
    return nav.prior_positions(nav.every_nth(priors, nav.step_for(priors)), s.images())


ASSIGNED_SQL = with_views("images", "rules") + """
    , asg AS (SELECT i.*, (SELECT min(rule_idx) FROM rules WHERE contains(i.name, prefix)) AS rule_idx FROM images i),
    cnt AS (SELECT r.*, (SELECT count(*) FROM asg WHERE asg.rule_idx = r.rule_idx) AS n_images FROM rules r),
    made AS (SELECT *, 3 + rule_idx + 1 AS camera_id, focal_mm * 3840 / sensor_width_mm AS focal FROM cnt WHERE n_images > 0)
"""


def _assigned(s: Survey):
    return catalog.assign_cameras(s.images(), s.camera_rules())


def _created(s: Survey, assigned=None):
    counts = catalog.rule_counts(_assigned(s) if assigned is None else assigned, s.camera_rules(), s.cameras())
    return catalog.new_cameras(s.camera_rules(), counts, s.cameras())


def _assigned_and_created(s: Survey):
    """The assignment, found once for all that read it, and the cameras that come of it."""
    assigned = pin(_assigned(s))
    return assigned, _created(s, assigned)


@query("camera_assign", ASSIGNED_SQL + "SELECT image_id, rule_idx FROM asg")
def camera_assign(s: Survey):
    return _assigned(s).select("image_id", "rule_idx")


@query("images_unassigned", ASSIGNED_SQL + "SELECT image_id FROM asg WHERE rule_idx IS NULL")
def images_unassigned(s: Survey):
    return catalog.unassigned(_assigned(s)).select("image_id")


@query("rule_counts", ASSIGNED_SQL + "SELECT rule_idx, prefix, round(focal_mm * 3840 / sensor_width_mm, 6) AS focal_px, n_images FROM cnt")
def rule_counts(s: Survey):
    return catalog.rule_counts(_assigned(s), s.camera_rules(), s.cameras()).select("rule_idx", "prefix", rnd("focal_px"), "n_images")


@query("new_cameras", ASSIGNED_SQL + """
    SELECT CAST(camera_id AS BIGINT) AS camera_id, model, CASE model WHEN 'OPENCV' THEN 4 WHEN 'OPENCV_FISHEYE' THEN 5 END AS model_code,
           CAST(8 AS INTEGER) AS n_params, round(focal, 6) AS focal, 1920.0::DOUBLE AS cx, 1080.0::DOUBLE AS cy FROM made""")
def new_cameras(s: Survey):
    return _created(s).select(
        "camera_id", "model", "model_code", F.size("params").alias("n_params"),
        F.round(F.col("params")[0], 6).alias("focal"), F.col("params")[2].alias("cx"), F.col("params")[3].alias("cy"),
    )


@query("images_reassigned", ASSIGNED_SQL + """
    SELECT a.image_id, CAST(coalesce(m.camera_id, a.camera_id) AS BIGINT) AS camera_id FROM asg a LEFT JOIN made m ON m.rule_idx = a.rule_idx""")
def images_reassigned(s: Survey):
    return catalog.reassign(*_assigned_and_created(s)).select("image_id", "camera_id")


@query("rigs_frames", ASSIGNED_SQL + """
    SELECT CAST(m.camera_id AS BIGINT) AS rig_id, count(*) AS n_frames, min(a.image_id) AS first_frame
    FROM asg a JOIN made m ON m.rule_idx = a.rule_idx GROUP BY 1""")
def rigs_frames(s: Survey):
    rigs, frames, frame_data = catalog.build_rigs(*_assigned_and_created(s))
    return rigs.join(frames, "rig_id").join(frame_data.select("frame_id", "data_id"), "frame_id").groupBy("rig_id").agg(
        F.count("data_id").alias("n_frames"), F.min("frame_id").alias("first_frame")
    )


@query("orphan_cameras", ASSIGNED_SQL + """
    , now AS (SELECT coalesce(m.camera_id, a.camera_id) AS camera_id FROM asg a LEFT JOIN made m ON m.rule_idx = a.rule_idx),
    cams AS (SELECT c::BIGINT AS camera_id FROM range(0, 4) t(c) UNION ALL SELECT camera_id FROM made)
    SELECT camera_id FROM cams WHERE camera_id NOT IN (SELECT camera_id FROM now)""")
def orphan_cameras(s: Survey):
    assigned, created = _assigned_and_created(s)
    cameras = s.cameras().select("camera_id").unionByName(created.select("camera_id"))
    return catalog.orphan_cameras(cameras, catalog.reassign(assigned, created))


@query("cameras_by_model", with_views("images", "cameras") + """
    SELECT model, count(*) AS n_cameras FROM (SELECT DISTINCT camera_id FROM images) JOIN cameras USING (camera_id) GROUP BY 1""")
def cameras_by_model(s: Survey):
    used = catalog.drop_orphans(s.cameras(), s.images())
    return catalog.cameras_by_model(used.withColumn("model_code", model_code(F.col("model")))).select("model", "n_cameras")


@query("extension_fix", with_views("images") + """
    SELECT image_id, CASE WHEN image_id % 4 = 0 THEN regexp_replace(name, '\\.jpg$', '.png') ELSE name END AS name
    FROM (SELECT image_id, regexp_replace(name, '^.*/', '') AS name FROM images)""")
def extension_fix(s: Survey):
    names = s.images().select("image_id", basename(F.col("name")).alias("name"))
    disk = names.select(
        F.when(F.col("image_id") % 4 == 0, F.regexp_replace("name", r"\.jpg$", ".png")).otherwise(F.col("name")).alias("name")
    )
    return catalog.fix_extensions(names, disk).select("image_id", "name")


@query("name_subset", with_views("images", "obs") + """
    , kept AS (SELECT * FROM images ORDER BY name LIMIT 30)
    SELECT k.name, count(o.image_id) AS n_obs FROM kept k JOIN obs o ON o.image_id = k.image_id GROUP BY 1""")
def name_subset(s: Survey):
    kept, obs = catalog.subset_images(s.images(), s.observations(), catalog.first_by_name(s.images(), 30))
    return obs.join(kept.select("image_id", "name"), "image_id").groupBy("name").agg(F.count(F.lit(1)).alias("n_obs"))


@query("stratified_subset", with_views("images") + """
    , t AS (SELECT name, list_extract(['camlower','cammid','camupper','HERC'], CAST(p_size % 4 + 1 AS INTEGER)) AS tag FROM images),
    k AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY name) AS rn FROM t)
    SELECT tag, name FROM k WHERE rn <= CASE tag WHEN 'camlower' THEN 60 WHEN 'cammid' THEN 20 WHEN 'camupper' THEN 20 ELSE 0 END""")
def stratified_subset(s: Survey):
    quotas = {"camlower": 60, "cammid": 20, "camupper": 20}
    return stratified(s.images(), camera_tag(F.col("name")), quotas).select("tag", "name")


@query("pairs_exhaustive_plan", """
    WITH n AS (SELECT count(*) AS n FROM part), o AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
    SELECT i // 100 AS block, count(*) AS n_images, count(*) * (count(*) - 1) // 2 AS pairs_within,
           count(*) * ((SELECT n FROM n) - max(i) - 1) AS pairs_ahead FROM o GROUP BY 1""")
def pairs_exhaustive_plan(s: Survey):
    return pairs.exhaustive_plan(s.images())


@query("pairs_exhaustive_estimate", """
    SELECT count(*) AS n_images, count(*) * (count(*) - 1) // 2 AS n_pairs, count(*) * count(*) // 2 AS pairs_estimate,
           CASE WHEN count(*) <= 3000 THEN 'exhaustive' ELSE 'sequential' END AS suggested_mode FROM part""")
def pairs_exhaustive_estimate(s: Survey):
    return pairs.exhaustive_estimate(s.images())


@query("pairs_sequential", with_views("images") + """
    , o AS (SELECT image_id, row_number() OVER (ORDER BY name, image_id) AS i FROM images),
    steps AS (SELECT DISTINCT st FROM (SELECT unnest(range(1, 21)) AS st UNION ALL SELECT CAST(power(2, e) AS BIGINT) FROM range(0, 20) t(e)))
    SELECT a.image_id AS image_id1, b.image_id AS image_id2, st AS step FROM o a, steps, o b WHERE b.i = a.i + st""")
def pairs_sequential(s: Survey):
    return pairs.pairs_sequential(s.images())


@query("pairs_spatial", """
    WITH p AS (SELECT c_custkey AS id, c_acctbal AS x, c_acctbal * 0.5 + c_custkey AS y FROM customer),
    d AS (SELECT a.id AS a, b.id AS b, sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) AS dist FROM p a JOIN p b
          ON a.id <> b.id AND abs(a.x - b.x) <= 50 AND abs(a.y - b.y) <= 50),
    k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY dist, b) AS rn FROM d WHERE dist <= 50)
    SELECT least(a, b) AS image_id1, greatest(a, b) AS image_id2, round(min(dist), 6) AS dist FROM k WHERE rn <= 100 GROUP BY 1, 2""")
def pairs_spatial(s: Survey):
    return pairs.pairs_spatial(s.pose_positions()).select("image_id1", "image_id2", rnd("dist"))


@query("pairs_spatial_near", """
    WITH p AS (SELECT c_custkey AS id, c_acctbal AS x, c_acctbal * 0.5 + c_custkey AS y FROM customer),
    d AS (SELECT a.id AS a, b.id AS b, sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) AS dist FROM p a JOIN p b
          ON a.id <> b.id AND abs(a.x - b.x) <= 200 AND abs(a.y - b.y) <= 200),
    k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY dist, b) AS rn FROM d WHERE dist <= 200)
    SELECT a AS image_id, b AS neighbor_id, CAST(rn AS BIGINT) AS rank, round(dist, 6) AS dist FROM k WHERE rn <= 3""")
def pairs_spatial_near(s: Survey):
    """Few neighbours, small boxes: the limit on neighbours and both search rounds are at work."""
    near = pairs.neighbors_within(s.pose_positions(), "image_id", ["x", "y"], 3, 200.0, box_rows=400)
    return near.select("image_id", "neighbor_id", F.col("rank").cast("bigint").alias("rank"), rnd("dist"))


@query("cross_camera", with_views("matches", "images") + """
    SELECT least(a.camera_id, b.camera_id) AS camera_a, greatest(a.camera_id, b.camera_id) AS camera_b, count(*) AS n_pairs
    FROM matches m JOIN images a ON a.image_id = m.image_id1 JOIN images b ON b.image_id = m.image_id2 WHERE verified > 0 GROUP BY 1, 2""")
def cross_camera(s: Survey):
    return pairs.cross_camera(s.two_view(), s.images())


@query("pairs_min_matches", with_views("matches") + "SELECT image_id1, image_id2, verified AS rows FROM matches WHERE verified >= 30")
def pairs_min_matches(s: Survey):
    return pairs.min_matches(s.two_view())


@query("isolated_images", with_views("sparse", "images") + """
    SELECT image_id FROM images WHERE image_id NOT IN (SELECT image_id1 FROM sparse UNION SELECT image_id2 FROM sparse)""")
def isolated_images(s: Survey):
    return pairs.isolated_images(s.images(), s.sparse_view()).select("image_id")


@query("image_components", with_views("matches", "images", recursive=True) + """
    , e AS MATERIALIZED (SELECT image_id1 AS u, image_id2 AS v FROM matches WHERE verified > 0
          UNION ALL SELECT image_id2, image_id1 FROM matches WHERE verified > 0),
    reach(u, v) AS (SELECT image_id, image_id FROM images UNION SELECT reach.u, e.v FROM reach JOIN e ON e.u = reach.v),
    lab AS (SELECT u, min(v) AS component FROM reach GROUP BY 1)
    SELECT component, count(*) AS n_nodes FROM lab GROUP BY 1""")
def image_components(s: Survey):
    return component_sizes(pairs.image_components(s.two_view(), s.images()))


@query("sampled_pairs")
def sampled_pairs(s: Survey):
    return pairs.sample_pairs(s.two_view())
