"""Nav logs, camera rules, reports, logs, splat files, database import."""

import json
import math
import os
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from reefgrid.functions.names import canonical_columns, coord_system
from reefgrid.operators import nav as nav_ops
from reefgrid.operators.report import last_metrics, log_timings, stage_timings, timings_of_lines
from reefgrid.sources import logs, nav, ply, reports, survey_db


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_nav_semicolon_utm(spark, write):
    path = write("nav.txt", (
        "filename;X (East);Y (North);Alt;X Accuracy;Y Accuracy;Alt Accuracy;Yaw;Pitch;Roll\n"
        " a.jpg ;1.5;2.5;-650;2;3;1;10;89;1\nb.jpg;3;4;;;;;0;80;0\na.jpg;9;9;9;;;;1;2;3\nc.jpg;oops;1;1;;;;1;1;1\n"
    ))
    got = rows(nav.read_nav(spark, path).select("name", "x", "y", "alt", "pitch", "x_acc"), "name")
    assert got == [("a.jpg", 9.0, 9.0, 9.0, 2.0, None), ("b.jpg", 3.0, 4.0, 0.0, 80.0, None)]
    assert [r.name for r in nav.read_nav_rejects(spark, path).collect()] == ["c.jpg"]
    assert coord_system(nav.nav_columns(spark, path)) == 1


def test_nav_comma_latlon_without_orientation(spark, write):
    path = write("gps.csv", "image_name,lat,lon,depth,yaw\na.jpg,10.5,20.5,5,90\n")
    assert rows(nav.read_nav(spark, path).select("name", "x", "y", "alt", "yaw"), "name") == [("a.jpg", 20.5, 10.5, 5.0, None)]
    assert coord_system(nav.nav_columns(spark, path)) == 0
    assert coord_system({}, explicit=-1) == -1


def test_nav_header_rules(spark, write):
    assert canonical_columns([" File ", "NAME", "Easting", "zzz"]) == {"name": "NAME", "x": "Easting"}
    assert nav.detect_delimiter("a,b;c") == ";" and nav.detect_delimiter("a\tb") == "\t"
    with pytest.raises(ValueError, match="position"):
        nav.read_nav(spark, write("bad.csv", "name,foo\na,1\n"))
    with pytest.raises(ValueError, match="name"):
        nav.read_nav(spark, write("bad2.csv", "lat,lon\n1,2\n"))


def test_name_matching_prefers_full_names(spark):
    images = spark.createDataFrame(
        [(1, "x/a.jpg", 1), (2, "y/a.jpg", 2), (3, "b.jpg", 3), (4, "z/b.jpg", 4), (5, "c.jpg", 5)],
        "image_id bigint, name string, camera_id bigint",
    )
    points = spark.createDataFrame([("a.jpg", 1), ("b.jpg", 2), ("x/a.jpg", 3), ("none.jpg", 4)], "name string, line_no int")
    matched = nav_ops.match_nav(points, images)
    assert rows(matched.select("name", "image_id", "matched_by"), "name") == [
        ("a.jpg", 2, "basename"), ("b.jpg", 3, "full"), ("x/a.jpg", 1, "full")
    ]
    assert [r.name for r in nav_ops.nav_without_image(points, images).collect()] == ["none.jpg"]
    assert rows(nav_ops.images_without_nav(matched, images).select("image_id"), "image_id") == [(4,), (5,)]


@pytest.mark.parametrize("pitch,roll,want", [(0, 0, (0, 1, 0)), (90, 0, (0, 0, 1)), (0, 90, (-1, 0, 0))])
def test_gravity(spark, pitch, roll, want):
    g = spark.range(1).select(nav_ops.geometry.gravity(F.lit(float(pitch)), F.lit(float(roll))).alias("g")).first().g
    assert g == pytest.approx(want, abs=1e-12)


def test_camera_rules(spark, write):
    path = write("rig.conf", "# rig\ncamlower;opencv;16;36\n\nbroken;x\nHERC ; PINHOLE ; 24 ; 36\n")
    assert rows(nav.read_camera_rules(spark, path), "rule_idx") == [
        (0, "camlower", "OPENCV", 16.0, 36.0), (1, "HERC", "PINHOLE", 24.0, 36.0)
    ]
    assert [r.line for r in nav.skipped_rules(spark, path).collect()] == ["broken;x"]
    with pytest.raises(ValueError, match="FISH"):
        nav.read_camera_rules(spark, write("bad.conf", "a;FISH;1;2\n"))


GOOD = {"component": {"medianError": 0.4}, "cameras": [{"image": "a.jpg", "numPoints": 5, "reprojError": {"median": 0.5}}]}


def test_report_repair(spark, write, tmp_path):
    write("r/good.json", json.dumps(GOOD))
    write("r/broken.json", '<!-- a, ] -->\n{"component": {"medianError": 1.5,},\n"cameras": [{"image": "b.jpg"COMMA_PLACEHOLDER "numPoints": 7, },\n]}\n')
    write("r/hopeless.json", "{nothing")
    parsed = reports.read_quality_reports(spark, str(tmp_path / "r"))
    state = {r.path.rsplit("/", 1)[1]: (r.report is not None, r.was_repaired) for r in parsed.collect()}
    assert state == {"good.json": (True, False), "broken.json": (True, True), "hopeless.json": (False, False)}
    cams = rows(reports.report_cameras(parsed).select("image", "num_points", "reproj_median"), "image")
    assert cams == [("a.jpg", 5, 0.5), ("b.jpg", 7, None)]
    assert sorted(r.medianError for r in reports.component_stats(parsed).filter("medianError is not null").collect()) == [0.4, 1.5]
    reports.write_quality_reports(parsed, str(tmp_path / "fixed"))
    assert spark.read.json(str(tmp_path / "fixed")).count() == 2


def test_logs(spark, write, tmp_path):
    for i, (name, text) in enumerate({
        "one.log": "=== FEATURE extraction ===\nElapsed time: 12.5 [minutes]",
        "x.log.INFO.2": "Registering image\npatch_match\nElapsed time: 3.0 [minutes]",
        "c.log": "Elapsed time: 1.0 [minutes]", "d.log": "no time", "e.txt": "Elapsed time: 9.0 [minutes]",
    }.items()):
        os.utime(write(f"logs/{name}", text), (1000 + i, 1000 + i))
    timings = log_timings(logs.read_logs(spark, str(tmp_path / "logs")))
    assert [(r.stage, r.minutes) for r in timings.orderBy("mtime").collect()] == [
        ("Feature Extraction", 12.5), ("Incremental Mapper", 3.0), ("Unknown Stage", 1.0)
    ]
    assert {r.stage: r.minutes for r in stage_timings(timings).collect()}["TOTAL"] == 16.5


def test_metric_log(spark, write):
    path = write("training.log", (
        "start max_iter=30000\niter 10 loss=0.5 PSNR: 20.25\niteration[ 20 loss: 0.25 SSIM=0.9 num_points=1,234,567 12.5\n"
        "it/s=40.5\ncheckpoint saved\n"
    ))
    lines = logs.read_metric_log(spark, path)
    last = last_metrics(
        lines.withColumn("pos", F.struct("block", "seq")), ["file"], "pos",
        ["iteration", "total_iterations", "loss", "psnr", "ssim", "gaussians", "it_per_sec"],
    ).drop("file").first()
    assert tuple(last) == (20.0, 30000.0, 0.25, 20.25, 0.9, 1234567.0, 40.5)


def test_result_files(spark, write):
    head = "timestamp,label,used_mib,free_mib,total_mib\n"
    gpu = logs.read_gpu_samples(spark, write("gpu.csv", head + "1700000000,a,10,20,30\n" + head + "1700000002,b,15,15,30\n"))
    assert rows(gpu.select("label", "used_mib"), "label") == [("a", 10), ("b", 15)]
    clean = logs.read_cleaning(spark, write(
        "clean.csv", "source,clean_config,input_splats,output_splats,removed_pct,time_sec,output_file\nr1,default,100,90,10.0,3,o.ply\n"))
    assert rows(clean.select("source", "output_splats"), "source") == [("r1", 90)]
    runs = logs.read_runs(spark, write("runs.json", json.dumps({
        "timestamp": "t", "dataset": "d", "gpu": "g", "baseline_vram_mib": 5, "resize_factor": 2,
        "runs": [{"label": "a", "time_sec": 4, "psnr": "N/A"}, {"label": "b", "time_sec": 6, "psnr": "20.1"}]}, indent=1)))
    assert rows(runs.select("label", "time_sec", "psnr"), "label") == [("a", 4, "N/A"), ("b", 6, "20.1")]


def test_nav_folder_of_different_files(spark, write, tmp_path):
    """Every file is read by its own delimiter, column order and spellings."""
    write("nav/a.csv", 'filename,X (East),Y (North),Alt\n"a, one.jpg",1,2,-3\n')
    write("nav/b.txt", "Alt;name;lat;lon;Yaw;Pitch;Roll\n-9;b.jpg;50;-3;1;2;3\n\n-9;c.jpg;50;-3;;2;3\n")
    folder = str(tmp_path / "nav")
    got = rows(nav.read_nav(spark, folder).select("name", "x", "y", "alt", "yaw", "roll"), "name")
    assert got == [("a, one.jpg", 1.0, 2.0, -3.0, None, None), ("b.jpg", -3.0, 50.0, -9.0, 1.0, 3.0)]
    assert [r.name for r in nav.read_nav_rejects(spark, folder).collect()] == ["c.jpg"]
    assert nav.nav_columns(spark, folder).keys() >= {"x", "y", "lat", "lon", "name", "yaw"}
    write("nav/c.csv", "filename,depth\nx,1\n")
    with pytest.raises(ValueError, match="c.csv: no position"):
        nav.read_nav(spark, folder)


def test_logs_folded_from_lines_equal_whole_texts(spark, write, tmp_path):
    write("logs/a.log", "x\nRegistering image #1\n=== FEATURE matching (x)\nElapsed time: 1.5 [minutes]\nElapsed time: 9 [minutes]\n")
    write("logs/sub/b.log.INFO.1", "Elapsed time: 1.2.3 [minutes]\nElapsed time: 4 [minutes]\n")
    write("logs/c.log", "Loading descriptors\nBuilding index\nElapsed time: 7 [minutes]\n" + "y\n" * 5000)
    write("logs/d.log", "=== Feature extraction ===\n")
    write("logs/e.txt", "Elapsed time: 1 [minutes]\n")
    folder = str(tmp_path / "logs")
    whole = log_timings(logs.read_logs(spark, folder)).select("path", "stage", "minutes", "mtime")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        folded = timings_of_lines(logs.read_log_lines(spark, folder)).select("path", "stage", "minutes", "mtime")
        assert rows(folded, "path") == rows(whole, "path") and folded.count() == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def splat_frame(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    data = [(i, *map(float, rng.normal(size=3).astype("f4")), 2.0) for i in range(n)]
    return spark.createDataFrame(data, "splat_id bigint, x double, y double, z double, opacity double")


def test_ply_round_trip(spark, tmp_path):
    df = ply.rounded_to_float(splat_frame(spark, 500)).repartition(3)
    out = str(tmp_path / "cloud")
    ply.write_splats(df, out, fmt="ply")
    back = ply.read_splats(spark, out, range_rows=70)
    assert back.columns == ["splat_id", "x", "y", "z", "opacity"]
    assert rows(back, "splat_id") == rows(df, "splat_id")
    assert back.rdd.getNumPartitions() >= 8
    files = ply.list_ply(out)
    assert sum(r.n_splats for r in ply.splat_counts(spark, files).collect()) == 500
    # A second write replaces the first.
    ply.write_splats(df.filter("splat_id < 10"), out, fmt="ply")
    assert ply.read_splats(spark, out).count() == 10


def test_ply_write_that_fails_leaves_the_old_cloud(spark, tmp_path):
    out = str(tmp_path / "cloud")
    df = ply.rounded_to_float(splat_frame(spark, 60))
    ply.write_splats(df, out, fmt="ply")
    before = ply.list_ply(out)
    broken = df.withColumn("x", F.when(F.col("splat_id") == 37, F.raise_error("gone").cast("float")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="gone"):
        ply.write_splats(broken, out, fmt="ply")
    assert ply.list_ply(out) == before and rows(ply.read_splats(spark, out), "splat_id") == rows(df, "splat_id")
    assert not [f for f in (tmp_path / "cloud").iterdir() if f.suffix != ".ply"]
    # A cloud may be cleaned in place: its files go only when all new ones are there.
    ply.write_splats(ply.read_splats(spark, out).filter("splat_id % 2 = 0"), out, fmt="ply")
    assert [r[0] for r in rows(ply.read_splats(spark, out).select("x"), "x")] == sorted(r.x for r in df.filter("splat_id % 2 = 0").collect())
    assert not set(ply.list_ply(out)) & set(before)


def test_ply_files_with_other_properties_and_long_headers(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    head = "ply\nformat binary_little_endian 1.0\n{}element vertex 1\n{}end_header\n"
    notes = "".join(f"comment {'n' * 90} {i}\n" for i in range(1500))
    (folder / "a.ply").write_bytes(head.format(notes, "property float x\nproperty int n\n").encode() + struct.pack("<fi", 1.5, 7))
    (folder / "b.ply").write_bytes(head.format("", "property double x\nproperty uchar red\n").replace("\n", "\r\n").encode() + struct.pack("<dB", 0.1, 9))
    got = ply.read_splats(spark, str(folder))
    assert got.dtypes == [("splat_id", "bigint"), ("x", "double"), ("n", "int"), ("red", "smallint")]
    assert rows(got, "splat_id") == [(0, 1.5, 7, None), (1, 0.1, None, 9)]
    (tmp_path / "cut.ply").write_bytes(b"ply\nformat binary_little_endian 1.0\n")
    with pytest.raises(ValueError, match="no end"):
        ply.read_header(str(tmp_path / "cut.ply"))


def test_ply_header_with_other_elements(spark, tmp_path):
    path = tmp_path / "one.ply"
    head = "ply\nformat binary_little_endian 1.0\ncomment c\nelement vertex 2\nproperty float x\nproperty uchar red\nproperty double w\nelement face 0\nproperty list uchar int i\nend_header\n"
    path.write_bytes(head.encode() + struct.pack("<fBd", 1.5, 200, 2.5) + struct.pack("<fBd", -1.0, 3, 4.0))
    assert rows(ply.read_splats(spark, str(path)), "splat_id") == [(0, 1.5, 200, 2.5), (1, -1.0, 3, 4.0)]


def test_ply_empty_and_dry_run(spark, tmp_path):
    df = ply.rounded_to_float(splat_frame(spark, 50))
    ply.write_splats(df, str(tmp_path / "dry"), fmt="ply", dry_run=True)
    assert not (tmp_path / "dry").exists()
    ply.write_splats(df.limit(0), str(tmp_path / "none"), fmt="ply")
    assert ply.read_splats(spark, str(tmp_path / "none")).count() == 0


def test_database_import(spark, tmp_path):
    path = str(tmp_path / "survey.db")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE images (image_id INTEGER PRIMARY KEY, name TEXT, camera_id INTEGER)")
    con.executemany("INSERT INTO images VALUES (?, ?, ?)", [(i, f"im{i}.jpg", i % 2) for i in range(1, 251)])
    con.execute(
        "CREATE TABLE pose_priors (pose_prior_id INTEGER PRIMARY KEY, corr_data_id INTEGER, corr_sensor_id INTEGER, corr_sensor_type INTEGER,"
        " position BLOB, position_covariance BLOB, gravity BLOB, coordinate_system INTEGER)"
    )
    nan = math.nan
    con.executemany("INSERT INTO pose_priors VALUES (?, ?, 1, 0, ?, ?, ?, 1)", [
        (1, 1, struct.pack("<3d", 1, 2, 3), struct.pack("<9d", *range(9)), struct.pack("<3d", 0, 1, 0)),
        (2, 2, b"short", None, struct.pack("<3d", nan, nan, nan)),
    ])
    con.execute("CREATE TABLE rigs (rig_id INTEGER PRIMARY KEY, ref_sensor_id INTEGER, ref_sensor_type INTEGER)")
    con.commit()
    con.close()
    images = survey_db.import_survey_db(spark, path, "images", range_rows=100)
    assert images.rdd.getNumPartitions() == 3
    assert rows(images, "image_id") == [(i, f"im{i}.jpg", i % 2) for i in range(1, 251)]
    priors = rows(survey_db.import_survey_db(spark, path, "pose_priors").select("position", "position_covariance", "gravity", "pose_prior_id"), "pose_prior_id")
    assert priors == [([1.0, 2.0, 3.0], [float(i) for i in range(9)], [0.0, 1.0, 0.0], 1), (None, None, None, 2)]
    assert survey_db.import_survey_db(spark, path, "rigs").count() == 0
    with pytest.raises(ValueError):
        survey_db.import_survey_db(spark, path, "nope")
