"""Appearance filters and the cleaning pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reefgrid.functions import splat
from reefgrid.operators import clean
from reefgrid.operators.clean import CLEAN_CONFIGS, CleanConfig

SCHEMA = "splat_id bigint, x double, y double, z double, f_dc_0 double, f_dc_1 double, f_dc_2 double, opacity double, scale_0 double, scale_1 double, scale_2 double"
OFF = CleanConfig(passes=0)


def cloud(spark, logits, positions=None, seed=0):
    n = len(logits)
    p = np.random.default_rng(seed).normal(size=(n, 3)).astype("f4") if positions is None else np.asarray(positions, dtype=float)
    rows = [(i, *map(float, p[i]), 1.0, 1.0, 1.0, float(logits[i]), -5.0, -5.0, -5.0) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_no_filters_keep_all(spark):
    assert clean.clean(cloud(spark, [2.0] * 100), OFF).count() == 100


def test_empty_cloud(spark):
    assert clean.clean(cloud(spark, []), OFF).count() == 0
    assert clean.clean(cloud(spark, []), CLEAN_CONFIGS["connected"]).count() == 0


@pytest.mark.parametrize("floor,left", [(0.1, 80), (0.0, 100)])
def test_opacity_floor(spark, floor, left):
    df = cloud(spark, [2.0] * 80 + [-3.0] * 20)
    assert clean.clean(df, CleanConfig(passes=0, opacity_min=floor)).count() == left


def test_bounding_box(spark):
    df = cloud(spark, [2.0] * 4, [[0, 0, 0], [5, 5, 5], [15, 15, 15], [11, 0, 0]])
    assert clean.bbox(df, (0, 0, 0, 10, 10, 10)).count() == 2
    with pytest.raises(ValueError):
        clean.bbox(df, (0, 1))


def test_missing_columns_switch_a_filter_off(spark):
    df = cloud(spark, [-3.0] * 5).drop("opacity", "scale_2", "f_dc_0")
    cfg = CleanConfig(passes=0, opacity_min=0.5, scale_max=1e-9, remove_hue=(0, 360))
    with pytest.warns(UserWarning):
        assert clean.clean(df, cfg).count() == 5


COLOURS = {
    (1.0, 0.0, 0.0): 0.0, (0.0, 1.0, 0.0): 120.0, (0.0, 0.0, 1.0): 240.0, (0.5, 0.5, 0.5): 0.0,
    (1.0, 0.0, 1.0): 300.0, (1.0, 1.0, 0.0): 60.0, (0.0, 1.0, 1.0): 180.0, (1.0, 0.0, 0.5): 330.0, (0.0, 0.0, 0.0): 0.0,
}


def test_hue(spark):
    df = spark.createDataFrame(list(COLOURS), "r double, g double, b double")
    for r in df.select("*", splat.hsv(F.col("r"), F.col("g"), F.col("b")).alias("c")).collect():
        assert r.c.h == pytest.approx(COLOURS[(r.r, r.g, r.b)])
        assert 0 <= r.c.h < 360 and 0 <= r.c.s <= 1 and r.c.v == max(r.r, r.g, r.b)


def test_hue_ranges_wrap_and_spare_greys(spark):
    dc = lambda v: (v - 0.5) / splat.SH_C0
    rows = [(i, 0.0, 0.0, 0.0, *map(dc, rgb), 2.0, -5.0, -5.0, -5.0) for i, rgb in enumerate(
        [(1.0, 0.0, 0.1), (1.0, 0.2, 0.0), (0.0, 1.0, 0.0), (0.5, 0.49, 0.49)])]
    df = spark.createDataFrame(rows, SCHEMA)
    left = lambda **kw: sorted(r.splat_id for r in clean.prefilter(df, CleanConfig(**kw)).collect())
    assert left(remove_hue=(350.0, 30.0), sat_min=0.2) == [2, 3]
    assert left(remove_hue=(350.0, 30.0)) == [2]
    assert left(keep_hue=(100.0, 140.0), sat_min=0.2) == [2, 3]
    assert left(keep_hue=(100.0, 140.0), val_min=0.6) == [2, 3]


def test_each_removed_splat_is_charged_once(spark):
    rows = [
        (0, 99.0, 0.0, 0.0, 1.0, 1.0, 1.0, -9.0, 9.0, 9.0, 9.0), (1, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, -9.0, 9.0, 9.0, 9.0),
        (2, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 2.0, -5.0, 1.0, -5.0), (3, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 2.0, -5.0, -5.0, -5.0),
    ]
    cfg = CleanConfig(bbox=(-1, -1, -1, 1, 1, 1), opacity_min=0.1, scale_max=0.5)
    got = {r.reason: r.n_splats for r in clean.prefilter_report(spark.createDataFrame(rows, SCHEMA), cfg).collect()}
    assert got == {"bbox": 1, "opacity": 1, "scale": 1, "kept": 1}


def test_hue_histogram_fills_empty_bins(spark):
    df = cloud(spark, [2.0] * 3)
    got = clean.hue_histogram(df).collect()
    assert len(got) == 24 and all(r.n_splats == 0 and r.pct is None for r in got)
    assert got[0].label == "Red" and got[23].label == "Red3+"


def test_keeping_the_largest_clusters(spark):
    at = [[0, 0, 0], [0.5, 0, 0], [1, 0, 0], [10, 0, 0], [10.5, 0, 0], [50, 0, 0]]
    df = cloud(spark, [2.0] * 6, at)
    kept = lambda n: sorted(r.splat_id for r in clean.clean(df, CleanConfig(
        passes=0, connected=True, connect_radius=0.6, keep_components=n)).collect())
    assert kept(1) == [0, 1, 2] and kept(2) == [0, 1, 2, 3, 4]


def test_named_settings_and_summary(spark):
    assert CLEAN_CONFIGS["maritime"].remove_hue == (180.0, 240.0)
    df = cloud(spark, [2.0] * 8 + [-9.0] * 2)
    row = clean.clean_summary(df, clean.prefilter(df, CLEAN_CONFIGS["default"])).first()
    assert (row.original, row.removed, row.remaining, row.removed_pct) == (10, 2, 8, 20.0)


def test_sweep_equals_each_setting_by_itself(spark):
    """Groups of one sweep, some too small for a pass, give what clean() gives for each run and setting; jobs do not grow with them."""
    rng = np.random.default_rng(3)

    def cloud(n, seed):
        xyz = np.concatenate([rng.normal(size=(n, 3)), rng.normal(size=(n // 3, 3)) * 0.3 + 40, rng.uniform(-300, 300, size=(n // 10, 3))])
        rows = [(i, *map(float, p), float(rng.normal() * 3)) for i, p in enumerate(xyz)]
        return spark.createDataFrame(rows, "splat_id bigint, x double, y double, z double, opacity double")

    runs = {"a": cloud(150, 1), "b": cloud(60, 2), "tiny": cloud(9, 3), "none": cloud(9, 3).limit(0)}
    settings = {
        "plain": clean.CleanConfig(neighbors=8, passes=2, opacity_min=0.2), "more": clean.CleanConfig(neighbors=8, passes=1, std_factor=1.0),
        "joined": clean.CleanConfig(neighbors=8, passes=2, connected=True), "wide": clean.CleanConfig(neighbors=5, passes=0, connected=True, connect_radius=30.0, keep_components=2),
    }
    got = {(r.source, r.clean_config): r for r in clean.clean_sweep(runs, settings).collect()}
    assert len(got) == 16
    for (run, name), row in got.items():
        assert row.input_splats == runs[run].count()
        assert row.output_splats == clean.clean(runs[run], settings[name]).count(), (run, name)

    def jobs(of, label):
        spark.sparkContext.setJobGroup(label, label)
        clean.clean_sweep(of, {"plain": settings["plain"], "more": settings["more"]}).collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(label))

    assert jobs({k: runs["b"] for k in "uvwxyz"}, "many") <= jobs({"u": runs["b"]}, "one") + 8  # a count of each run comes on top
