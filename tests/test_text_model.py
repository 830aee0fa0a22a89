"""Model text files: the pose-line rule, paired lines, tracks, rewriting."""

import pytest
from pyspark.sql import functions as F

from reefgrid.functions.names import is_pose_line
from reefgrid.operators.analysis import analyze_model
from reefgrid.operators.tiers import point_tiers
from reefgrid.sinks.tiers import export_tier_text, read_tier, write_manifest, write_tier
from reefgrid.sources.inventory import count_by_extension, find_models, image_inventory
from reefgrid.sources.text_model import (
    camera_details, classified_image_lines, read_cameras, read_images, read_points, read_points_raw, rewrite_image_lines, tracks,
)

POSE = "1 0.8 0.1 0.2 0.3 4.0 5.5 6.25 1 "
POSE_CASES = {
    POSE + "dive.jpg": True, POSE + "still.png": True, POSE + "plate.tiff": True, POSE + "raw.bmp": True,
    POSE + "3e5.jpg": True, "8 1 0 0 0 9 9 9 4 000017.jpeg": True, POSE + "DSC.JPG": True,
    "12.25 88.5 901 13.5 90.75 902 14.0 91.0 -1": False, "7 1.0 0 0": False,
    "x7 1 0 0 0 1 2 3 4 dive.jpg": False, "7 1 0 0 0 1 2 3 four dive.jpg": False,
    POSE + "nodot": False, POSE + "notes.txt": False, POSE + "rig.yaml": False,
    "12.25 88.5 901": False, POSE + "tail.jpg extra": True,
}


def test_pose_line_rule(spark):
    df = spark.createDataFrame([(k,) for k in POSE_CASES], "line string")
    got = {r[0]: r[1] for r in df.select("line", is_pose_line(F.split("line", r"\s+"))).collect()}
    assert got == POSE_CASES


IMAGES = """\
# poses, each with its sightings below
1 0.8 0.1 0.2 0.3 4.0 5.5 6.25 1 left.jpg
12.5 80.0 42 99.0 61.0 -1
2 0.7 0.1 0.2 0.3 4.0 5.5 6.25 1 right.jpg
31.0 44.0 99 7 8
"""


def by_image(obs):
    out = {}
    for r in obs.orderBy("image_id", "obs_idx").collect():
        out.setdefault(r.image_id, []).append((r.px, r.py, r.point_id))
    return out


def test_paired_lines(spark, write):
    images, obs = read_images(spark, write("images.txt", IMAGES))
    assert {r.image_id: r.name for r in images.collect()} == {1: "left.jpg", 2: "right.jpg"}
    assert by_image(obs) == {1: [(12.5, 80.0, 42), (99.0, 61.0, None)], 2: [(31.0, 44.0, 99)]}


def test_missing_observation_line(spark, write):
    text = POSE + "a.jpg\n2 1 0 0 0 4.0 5.0 6.0 1 b.jpg\n\n# note\n11.0 22.0 42\n7 7 7\n"
    images, obs = read_images(spark, write("images.txt", text))
    assert images.count() == 2
    assert by_image(obs) == {2: [(11.0, 22.0, 42)]}


def test_comment_only_file(spark, write):
    images, obs = read_images(spark, write("images.txt", "# nothing yet\n"))
    assert images.count() == 0 and obs.count() == 0


def test_last_pose_of_an_id_wins(spark, write):
    text = POSE + "a.jpg\n1 1 5\n" + POSE + "b.jpg\n2 2 6\n"
    images, obs = read_images(spark, write("images.txt", text))
    assert [r.name for r in images.collect()] == ["b.jpg"]
    assert by_image(obs) == {1: [(2.0, 2.0, 6)]}


def test_pairs_survive_file_splits(spark, write):
    n = 400
    text = "".join(f"{i} 1 0 0 0 0 0 0 1 im{i}.jpg\n" + ("" if i % 3 == 0 else f"{i}.5 1.0 {i * 10}\n") for i in range(n))
    path = write("images.txt", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        images, obs = read_images(spark, path)
        assert images.count() == n
        assert by_image(obs) == {i: [(i + 0.5, 1.0, i * 10)] for i in range(n) if i % 3}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


POINTS = """\
# cloud of two
# and a broken row
1 1.5 2.5 -3.5 10 20 30 0.5 1 10 2 20
2 4.0 5.0 6.0 90 80 70 1.25 3 30 9
3 1 2 3
"""


def test_points(spark, write):
    rows = {r.point_id: r for r in read_points(spark, write("points3D.txt", POINTS)).collect()}
    assert set(rows) == {1, 2}
    assert rows[1].error == 0.5 and rows[1].track_length == 2 and [tuple(t) for t in rows[1].track] == [(1, 10), (2, 20)]
    assert rows[2].track_length == 1 and rows[2].r == 90
    assert tracks(read_points(spark, write("p2.txt", POINTS))).count() == 3


def test_duplicate_points_keep_the_last(spark, write):
    text = "1 0 0 0 1 1 1 0.1\n2 0 0 0 1 1 1 0.2\n1 9 0 0 1 1 1 0.9\n"
    rows = {r.point_id: r.error for r in read_points(spark, write("points3D.txt", text)).collect()}
    assert rows == {1: 0.9, 2: 0.2}


def test_raw_points(spark, write):
    header, lines = read_points_raw(spark, write("points3D.txt", POINTS))
    assert header.count() == 2 and lines.count() == 2
    assert "1.5 2.5 -3.5" in lines.filter("point_id = 1").first().line
    header, lines = read_points_raw(spark, write("empty.txt", "# nothing\n"))
    assert header.count() == 1 and lines.count() == 0


def test_cameras(spark, write):
    path = write("cameras.txt", "# c\n1 PINHOLE 3840 2160 2000 2010 1920 1080\n2 OPENCV 10 20\n")
    cams = {r.camera_id: r for r in read_cameras(spark, path).collect()}
    assert cams[1].params == [2000.0, 2010.0, 1920.0, 1080.0] and cams[2].params == []
    assert [tuple(r) for r in camera_details(read_cameras(spark, path)).collect()] == [(1, "PINHOLE", "3840x2160", 2000.0)]


def test_rewrite_image_lines(spark, write):
    text = (
        "# head\n" + POSE + "a.jpg\n1.50 2 7 3 4 8 5 6 -1 9\n\n" + POSE.replace("1 ", "2 ", 1) + "b.jpg\n# between\n"
        + POSE.replace("1 ", "3 ", 1) + "c.jpg\nx y 007\nstray line\n" + POSE.replace("1 ", "4 ", 1) + "d.jpg\n"
    )
    kept = spark.createDataFrame([(7,)], "point_id bigint")
    got = rewrite_image_lines(spark, write("images.txt", text), kept).orderBy("file", "block", "seq", "part")
    assert [r.line for r in got.collect()] == [
        "# head", POSE + "a.jpg", "1.50 2 7 3 4 -1 5 6 -1", "", POSE.replace("1 ", "2 ", 1) + "b.jpg", "# between", "",
        POSE.replace("1 ", "3 ", 1) + "c.jpg", "x y 7", "stray line", POSE.replace("1 ", "4 ", 1) + "d.jpg",
    ]


def model(write):
    write("m/sparse/0/cameras.txt", "1 SIMPLE_PINHOLE 200 200 100 100 100\n")
    write("m/sparse/0/images.txt", "1 1 0 0 0 0 0 0 1 a.jpg\n110 100 1 100 100 2 1 1 3\n2 1 0 0 0 0 0 0 9 b.jpg\n5 5 1\n")
    return write(
        "m/sparse/0/points3D.txt",
        "# head\n1 0 0 2 1 1 1 0 1 0 2 0\n2 1 0 2 1 1 1 0 1 1\n3 0 0 -1 1 1 1 0\n",
    ).rsplit("/", 1)[0]


def test_analysis_computes_missing_errors(spark, write):
    # Point 1 projects to (100, 100), seen at (110, 100): 10 px. Point 2 to
    # (150, 100), seen at (100, 100): 50 px. Point 3 is behind the camera, and
    # image 2 has no camera.
    result = analyze_model(spark, model(write))
    assert result.errors_computed
    assert {r.point_id: r.error for r in result.points.collect()} == {1: 10.0, 2: 50.0, 3: 0.0}
    quality = {r.name: r for r in result.image_quality.collect()}
    assert quality["a.jpg"].total_observations == 3 and quality["a.jpg"].median_point_error == 10.0
    assert quality["b.jpg"].match_ratio == 1.0


def test_tier_export(spark, write, tmp_path):
    folder = model(write)
    tiered = spark.createDataFrame([(1, 1), (2, 3), (3, 0)], "point_id bigint, tier int")
    out = str(tmp_path / "tier2")
    export_tier_text(spark, folder, tiered, 2, out)
    assert [r.value for r in spark.read.text(f"{out}/points3D.txt").collect()] == ["# head", "1 0 0 2 1 1 1 0 1 0 2 0"]
    _, obs = read_images(spark, f"{out}/images.txt")
    assert by_image(obs) == {1: [(110.0, 100.0, 1), (100.0, 100.0, None), (1.0, 1.0, None)], 2: [(5.0, 5.0, 1)]}
    assert read_cameras(spark, f"{out}/cameras.txt").first().params == [100.0, 100.0, 100.0]


def test_tier_parquet_is_pruned_and_manifest(spark, tmp_path):
    points = spark.createDataFrame([(i, i / 10.0, i % 7) for i in range(1, 30)], "point_id bigint, error double, track_length int")
    tiered = point_tiers(points)
    write_tier(tiered, str(tmp_path / "t"))
    back = read_tier(spark, str(tmp_path / "t"), 2)
    assert back.count() == tiered.filter("tier between 1 and 2").count()
    assert "PartitionFilters: [isnotnull(tier" in back._jdf.queryExecution().toString()
    write_manifest(tiered, str(tmp_path / "m"))
    row = spark.read.json(str(tmp_path / "m")).first()
    assert row.median_error == 1.5 and row.tier_counts.total == 29 and row.thresholds.t3_max_error == pytest.approx(4.5)


def test_find_models_and_inventory(spark, write, tmp_path):
    model(write)
    for name in ("Cameras.txt", "Images.txt", "Points3D.txt"):
        write(f"m/a/b/{name}", "# x\n")
    write("m/a/cameras.txt", "#")
    for name in ("one.JPG", "two.jpeg", "three.png", "no.doc"):
        write(f"m/images/{name}", "data")
    found = find_models(spark, str(tmp_path / "m")).orderBy("rank").collect()
    assert [r.model_dir.split("/m/")[1] for r in found] == ["sparse/0", "a/b"]
    assert found[1].files["cameras.txt"].endswith("a/b/Cameras.txt")
    counts = {r.ext: r.n_files for r in count_by_extension(image_inventory(spark, str(tmp_path / "m"))).collect()}
    assert counts == {"jpg": 1, "jpeg": 1, "png": 1}


def test_looking_back_holds_no_lines(spark, write):
    path = write("images.txt", "1 1 0 0 0 0 0 0 1 a.jpg\n1 2 3\n")
    plan = classified_image_lines(spark, path)._jdf.queryExecution().optimizedPlan()
    windows, todo = [], [plan]
    while todo:
        node = todo.pop()
        windows += [node] if node.nodeName() == "Window" else []
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert windows and not any("parts#" in w.output().toString() or "line#" in w.output().toString() for w in windows)


def test_written_models_get_more_files_with_more_rows(spark, monkeypatch, tmp_path):
    from reefgrid.plans import text_files
    from reefgrid.plans.views import Survey

    tables = {
        "orders": ([(i, i % 5) for i in range(30)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(i % 30, i % 11, i % 4, 2.0, "N") for i in range(90)], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string"),
        "part": ([(i, i) for i in range(12)], "p_partkey long, p_size long"), "supplier": ([(1, 2)], "s_suppkey long, s_nationkey long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    survey = Survey(spark, str(tmp_path))
    read = lambda: read_points(spark, text_files.write_model(survey) + "/points3D.txt")
    few = read()
    monkeypatch.setattr(text_files, "FILE_ROWS", 10)
    many = read()
    assert few.select("file").distinct().count() <= 3 < many.select("file").distinct().count()
    assert few.count() == 30 and few.drop("file", "block", "seq").exceptAll(many.drop("file", "block", "seq")).isEmpty()
