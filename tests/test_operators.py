"""Quality, tiers, catalog and report operators on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from reefgrid.functions import names, sizing
from reefgrid.operators import catalog, compare, nav, pairs, quality, report, tiers
from reefgrid.sinks.results import append_result, write_priors


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_tier_edges(spark):
    cases = [(5, 0.99, 1), (5, 1.0, 2), (3, 1.99, 2), (2, 2.99, 3), (9, 3.0, 0), (0, 0.0, 3)]
    df = spark.createDataFrame(cases, "track int, error double, want int")
    assert df.filter(tiers.tier_of(F.col("error"), F.col("track"), F.lit(1.0)) != F.col("want")).count() == 0


def test_zero_median_drops_everything(spark):
    df = spark.createDataFrame([(i, 0.0, 9) for i in range(4)], "point_id int, error double, track_length int")
    assert {r.tier for r in tiers.point_tiers(df).collect()} == {0}


def test_cumulative_datasets_nest(spark):
    df = spark.createDataFrame([(i, float(i), i % 8) for i in range(40)], "point_id int, error double, track_length int")
    tiered = tiers.point_tiers(df)
    sets = {n: {r.point_id for r in tiers.tier_members(tiered).filter(F.col("dataset") == n).collect()} for n in (1, 2, 3)}
    assert sets[1] <= sets[2] <= sets[3]
    assert sets[3] | {r.point_id for r in tiers.dropped_points(tiered).collect()} == set(range(40))
    lines = spark.createDataFrame([(i, f"line {i}") for i in range(20)], "point_id int, line string")
    assert tiers.kept_lines(lines, tiers.tier_members(tiered)).count() == sum(len([p for p in s if p < 20]) for s in sets.values())


def test_empty_cloud_stats(spark):
    empty = spark.createDataFrame([], "point_id bigint, error double, track_length int")
    row = quality.point_stats(empty).first()
    assert row["count"] == 0 and row.error_median is None and row.error_stdev is None
    one = spark.createDataFrame([(1, 2.0, 3)], "point_id bigint, error double, track_length int")
    assert quality.point_stats(one).first().error_stdev == 0.0


def test_matched_counts_ids_outside_the_cloud(spark):
    images = spark.createDataFrame([(1, "a"), (2, "b")], "image_id bigint, name string")
    obs = spark.createDataFrame([(1, 10), (1, 99), (1, None)], "image_id bigint, point_id bigint")
    points = spark.createDataFrame([(10, 0.5)], "point_id bigint, error double")
    got = rows(quality.image_quality(images, obs, points).select(
        "name", "total_observations", "matched_3d_points", "median_point_error"), "name")
    assert got == [("a", 3, 2, 0.5), ("b", 0, 0, 0.0)]


def test_errors_missing_looks_at_all(spark):
    df = spark.range(1500).select("id", F.when(F.col("id") < 1400, 0.0).otherwise(1.0).alias("error"))
    assert not quality.errors_missing(df).first().errors_missing
    assert quality.errors_missing(df.filter("id < 1400")).first().errors_missing
    assert quality.errors_missing(df.limit(0)).first().errors_missing


def test_last_report_entry_counts(spark):
    base = spark.createDataFrame([("a",), ("b",)], "name string")
    rep = spark.createDataFrame(
        [("a", 1, 5, 0.1, 0.2, 0.3), ("a", 2, 6, None, 0.2, 0.3)],
        "image string, entry int, num_points bigint, image_coverage double, reproj_median double, reproj_mean double",
    )
    merged = quality.merge_report(base, rep)
    assert rows(merged.select("name", "ext_num_points", "ext_image_coverage"), "name") == [("a", 6, 0.0), ("b", None, None)]
    assert tuple(quality.merge_summary(merged).first()) == (2, 1, False)


def rig(spark):
    images = spark.createDataFrame(
        [(1, "camlower_HERC_1.jpg", 1), (2, "x/HERC_2.jpg", 1), (3, "other.jpg", 2)], "image_id bigint, name string, camera_id bigint")
    rules = spark.createDataFrame(
        [(0, "camlower", "OPENCV", 16.0, 36.0), (1, "none", "PINHOLE", 1.0, 1.0), (2, "HERC", "FULL_OPENCV", 24.0, 36.0)],
        "rule_idx int, prefix string, model string, focal_mm double, sensor_width_mm double")
    cameras = spark.createDataFrame([(1, 3840, 2160), (2, 100, 100), (3, 5, 5)], "camera_id bigint, width int, height int")
    return images, rules, cameras


def test_first_rule_wins(spark):
    images, rules, _ = rig(spark)
    assert rows(catalog.assign_cameras(images, rules).select("image_id", "rule_idx"), "image_id") == [(1, 0), (2, 2), (3, None)]
    assert rows(catalog.assign_cameras(images, rules, anchored=True).select("image_id", "rule_idx"), "image_id") == [(1, 0), (2, None), (3, None)]


def test_camera_tables_are_rebuilt(spark):
    images, rules, cameras = rig(spark)
    assigned = catalog.assign_cameras(images, rules)
    counts = catalog.rule_counts(assigned, rules, cameras)
    assert rows(counts.select("rule_idx", "n_images"), "rule_idx") == [(0, 1), (1, 0), (2, 1)]
    made = catalog.new_cameras(rules, counts, cameras)
    assert [(r.camera_id, len(r.params), r.model_code) for r in made.orderBy("camera_id").collect()] == [(4, 8, 4), (6, 3, 6)]
    assert made.orderBy("camera_id").first().params[0] == pytest.approx(16 * 3840 / 36)
    moved = catalog.reassign(assigned, made)
    assert rows(moved.select("image_id", "camera_id"), "image_id") == [(1, 4), (2, 6), (3, 2)]
    assert rows(catalog.orphan_cameras(cameras, moved).select("camera_id"), "camera_id") == [(1,), (3,)]
    assert rows(catalog.drop_orphans(cameras, moved).select("camera_id"), "camera_id") == [(2,)]
    rigs, frames, data = catalog.build_rigs(assigned, made)
    assert rigs.count() == 2 and rows(frames, "frame_id") == [(1, 4), (2, 6)] and data.count() == 2


def test_extension_repair_is_per_file(spark):
    images = spark.createDataFrame([(1, "a.png"), (2, "b.jpg"), (3, "gone.png")], "image_id int, name string")
    disk = spark.createDataFrame([("a.jpeg",), ("b.jpg",), ("b.png",), ("gone.txt",)], "name string")
    assert rows(catalog.fix_extensions(images, disk).select("image_id", "name"), "image_id") == [(1, "a.jpeg"), (2, "b.jpg"), (3, "gone.png")]


def test_priors_use_default_accuracy(spark, tmp_path):
    matched = spark.createDataFrame(
        [("b", 2, 7, 1.0, 2.0, 3.0, 90.0, 0.0, None, None, None, 2), ("a", 1, 7, 1.0, 2.0, 3.0, None, None, 2.0, 3.0, 4.0, 1)],
        "name string, image_id bigint, camera_id bigint, x double, y double, alt double, pitch double, roll double, x_acc double, y_acc double, alt_acc double, line_no int")
    got = nav.build_priors(matched, ["line_no"]).orderBy("pose_prior_id").collect()
    assert [(r.pose_prior_id, r.image_id) for r in got] == [(1, 1), (2, 2)]
    assert got[0].gravity is None and got[1].gravity == pytest.approx([0, 0, 1], abs=1e-9)
    assert got[0].covariance[::4] == [4.0, 9.0, 16.0] and got[1].covariance[::4] == [100.0, 100.0, 1.0]
    out = str(tmp_path / "priors")
    for _ in range(2):
        write_priors(nav.build_priors(matched, ["line_no"], use_gravity=False), out)
    assert spark.read.parquet(out).count() == 2


def test_append_results(spark, tmp_path):
    """A job that runs twice leaves one set of rows; other runs stay."""
    df = lambda *rows: spark.createDataFrame(rows, "label string, n int, run string")
    out = str(tmp_path / "r")
    for _ in range(2):
        append_result(df(("a", 1, "r1"), ("b", 2, "r1")), out, "run")
        append_result(df(("c", 3, "r2")), out, "run")
    append_result(df(("d", 4, "r1")), out, "run")
    assert sorted((r.label, r.n, r.run) for r in spark.read.parquet(out).collect()) == [("c", 3, "r2"), ("d", 4, "r1")]


def test_health_names_what_is_missing(spark):
    rows = report.health(spark.createDataFrame([(1, 60.0, None)], "run bigint, images_per_min double, gpu_pct double"), ["run"]).collect()
    assert {r.metric: r.status for r in rows} == {
        "images_per_min": "watch", "gpu_pct": "missing", **{m: "missing" for m in ("memory_pct", "verification_pct", "points_seen_pct", "error_mean", "db_gb_per_1000")}}


def test_names(spark):
    cases = {"x/HERC_1.jpg": "HERC", "camlower_2": "camlower", "gopro_3.jpg": "gopro", "plain.jpg": "unknown"}
    df = spark.createDataFrame([(k,) for k in cases], "n string")
    assert {r.n: r.t for r in df.select("n", names.camera_tag(F.col("n")).alias("t")).collect()} == cases
    codes = spark.createDataFrame([(4,), (7,)], "c int").select(names.model_name(F.col("c"))).collect()
    assert [r[0] for r in codes] == ["OPENCV", "UNKNOWN(7)"]
    row = spark.range(1).select(
        names.stage_progress(F.lit("MATCHING")), names.stage_progress(F.lit("???")), names.basename(F.lit("a/b/c.jpg")),
        names.swap_ext(F.lit("a.png.png"), "png", "jpg"), names.stem(F.lit("d.x/a.b.png")),
        sizing.eta_text(F.lit(7200.0)), sizing.eta_text(F.lit(90.0)), sizing.eta_text(F.lit(5.0)),
    ).first()
    assert tuple(row) == (50, 0, "c.jpg", "a.png.jpg", "d.x/a.b", "2.0h", "2m" if row[6] == "2m" else "1m", "5s")


def test_sizing_matches_the_calibration(spark):
    df = spark.createDataFrame([(2_000_000, 2, 30000), (3_000_000, 1, 30000)], "cap bigint, resize int, iters int")
    w, h = F.lit(4032), F.lit(3024)
    got = [r[0] for r in df.select(sizing.est_minutes(F.col("iters"), F.col("cap"), w, h, F.col("resize"))).collect()]
    assert 35 / 1.5 < got[0] < 35 * 1.5 and 90 / 1.5 < got[1] < 90 * 1.5
    assert spark.range(1).select(sizing.max_cap(w, h, F.lit(1), F.lit(3.0))).first()[0] == 0
    plan = compare.plan_sizing(spark.createDataFrame([(4032, 3024, 10, 0)], "width int, height int, images bigint, points bigint"))
    assert {r.preset: r.max_cap for r in plan.collect()} == dict.fromkeys(sizing.PRESETS, 100_000)


def test_reports(spark):
    stats = report.feature_stats(spark.createDataFrame([(1, 0)], "image_id int, rows int")).first()
    assert tuple(stats) == (0, 0, 0, 0, 0)
    metrics = spark.createDataFrame(
        [(1, 1000, 10.0, 970, 0.5, 10, 100, 5.0), (2, 10, None, None, None, 0, 0, None)],
        "run int, images int, feature_minutes double, registered int, error_mean double, verified_pairs int, matches int, db_gb double")
    notes = rows(report.recommendations(report.survey_metrics(metrics), ["run"]).select("run", "topic", "note"), "run", "topic")
    assert [n for n in notes if n[0] == 1][:4] == [(1, "error", "excellent"), (1, "extraction", "healthy"), (1, "features", "learned features suit low contrast"), (1, "mapper", "gravity priors constrain rotations")]
    assert len([n for n in notes if n[0] == 2]) == 2
    status = {r.metric: r.status for r in report.health(report.survey_metrics(metrics), ["run"]).filter("run = 1").collect()}
    assert {k: v for k, v in status.items() if v != "missing"} == {"images_per_min": "watch", "verification_pct": "alarm", "error_mean": "ok"}
    assert len(status) == 7


def test_sampling_reports(spark):
    priors = spark.range(1, 101).select(F.col("id").alias("pose_prior_id"))
    assert [r[0] for r in nav.every_nth(priors, nav.step_for(priors, 30)).orderBy("pose_prior_id").collect()] == list(range(3, 101, 3))
    assert nav.every_nth(priors, nav.step_for(priors)).count() == 100
    two = spark.range(500).select(F.col("id").alias("image_id1"), (F.col("id") + 1).alias("image_id2"), F.lit(1).alias("rows"))
    assert rows(pairs.sample_pairs(two), "image_id1") == rows(pairs.sample_pairs(two.repartition(9)), "image_id1")


def test_points_per_image(spark):
    t = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 1)], "point_id bigint, image_id bigint")
    assert rows(quality.points_per_image(t), "image_id") == [(1, 2, 2, 3), (2, 1, 2, 3), (3, 1, 2, 3)]
