"""Neighbours, outliers, components and spatial pairs against brute force."""

import re

import numpy as np
import pandas as pd
import pytest

from reefgrid.operators import components, knn, pairs, vocab
from reefgrid.operators.clean import sor, sor_pass

XYZ = ["x", "y", "z"]


def frame(spark, p, parts=5):
    p = np.asarray(p, dtype=float)
    data = pd.DataFrame({"splat_id": np.arange(len(p)), **{c: p[:, i] for i, c in enumerate(XYZ[: p.shape[1]])}})
    return spark.createDataFrame(data).repartition(parts)


def distances(p):
    p = np.asarray(p, dtype=float)
    return np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))


def skewed(seed=1):
    """Spread points, a dense knot, far outliers, and a third of all rows on one spot."""
    rng = np.random.default_rng(seed)
    return np.concatenate([
        rng.normal(size=(250, 3)), rng.normal(size=(150, 3)) * 0.005 + 3, rng.normal(size=(15, 3)) * 25,
        np.repeat(rng.normal(size=(1, 3)), 200, axis=0),
    ])


@pytest.mark.parametrize("box_rows", [50_000, 40])
def test_knn_mean(spark, box_rows):
    p = skewed()
    want = np.sort(distances(p), axis=1)[:, 1:21].mean(axis=1)
    got = knn.knn_mean(frame(spark, p), "splat_id", XYZ, 20, box_rows=box_rows).toPandas().sort_values("splat_id")
    assert np.abs(got["mean_dist"].to_numpy() - want).max() < 1e-12


def test_knn_with_too_few_points(spark):
    p = np.random.default_rng(0).normal(size=(6, 3))
    got = knn.knn_mean(frame(spark, p), "splat_id", XYZ, 6)
    assert got.filter("mean_dist is null").count() == 6
    assert sor_pass(frame(spark, p), k=6).count() == 6


def test_auto_radius(spark):
    p = skewed()[:400]
    want = 3 * np.median(np.sort(distances(p), axis=1)[:, 1])
    got = knn.auto_radius(frame(spark, p), "splat_id", XYZ, box_rows=60)
    assert got == pytest.approx(want, rel=1e-12)


def test_outlier_passes_match_and_shrink(spark):
    p = np.random.default_rng(123).normal(size=(300, 3)).astype("f4").astype(float)
    alive = np.arange(len(p))
    for _ in range(2):
        m = np.sort(distances(p[alive]), axis=1)[:, 1:21].mean(axis=1)
        alive = alive[m <= m.mean() + 1.5 * m.std()]
    runs = [sorted(r.splat_id for r in sor(frame(spark, p), s=1.5, passes=2).collect()) for _ in range(2)]
    assert runs[0] == runs[1] == alive.tolist()


def labels(adjacent):
    n = len(adjacent)
    lab = np.arange(n)
    while True:
        new = np.where(adjacent, lab[None, :], n).min(axis=1)
        if (new == lab).all():
            return lab
        lab = new


@pytest.mark.parametrize("radius,few", [(0.004, 64), (0.3, 64), (0.3, 0), (1.2, 0)])
def test_radius_components(spark, radius, few, monkeypatch):
    monkeypatch.setattr(components, "FEW_PAIRS", few)
    p = skewed(2)
    got = components.radius_components(frame(spark, p), "splat_id", XYZ, radius).toPandas().sort_values("splat_id")
    assert got["component"].tolist() == labels(distances(p) <= radius).tolist()


def test_radius_is_inclusive(spark):
    over = 2.0**-20  # exact in binary
    chain = [[0, 0, 0], [1, 0, 0], [2, 0, 0], [3 + over, 0, 0], [4 + over, 0, 0]]
    got = components.radius_components(frame(spark, chain), "splat_id", XYZ, 1.0).toPandas().sort_values("splat_id")
    assert got["component"].tolist() == [0, 0, 0, 3, 3]


def test_connected_components_of_a_hub_and_a_long_chain(spark):
    edges = [(0, i) for i in range(1, 150)] + [(i, i + 1) for i in range(200, 260)] + [(300, 301), (5, 5)]
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)
    nodes = spark.range(303)
    got = {r.node: r.component for r in components.connected_components(df, "a", "b", nodes).collect()}
    want = {**{i: 0 for i in range(150)}, **{i: i for i in range(150, 303)}, **{i: 200 for i in range(200, 261)}, 301: 300}
    assert got == want


def test_component_choice_and_report(spark):
    sizes = spark.createDataFrame([(c, 3 if c < 4 else 1) for c in range(14)], "component bigint, n_nodes bigint")
    assert [r.component for r in components.largest(sizes, 2).collect()] == [0, 1]
    report = {r.label: (r.n_components, r.n_nodes) for r in components.size_report(sizes).collect()}
    assert report["rest"] == (4, 4) and report["0"] == (1, 3) and len(report) == 11


@pytest.mark.parametrize("box_rows", [50_000, 30])
def test_spatial_pairs(spark, box_rows):
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.uniform(0, 300, size=(160, 2)), np.repeat([[150.0, 150.0]], 80, axis=0)])
    d, k = distances(p), 7
    want = {}
    for i in range(len(p)):
        order = sorted((d[i, j], j) for j in range(len(p)) if j != i and d[i, j] <= 50)[:k]
        for dist, j in order:
            want[(min(i, j), max(i, j))] = dist
    got = pairs.pairs_spatial(frame(spark, p), "splat_id", ["x", "y"], 50.0, k, box_rows=box_rows).collect()
    assert {(r.image_id1, r.image_id2) for r in got} == set(want)
    assert all(abs(r.dist - want[(r.image_id1, r.image_id2)]) < 1e-9 for r in got)


def test_sequential_pairs(spark):
    images = spark.createDataFrame([(i, f"n{i:03d}") for i in range(60)], "image_id bigint, name string").repartition(4)
    got = {(r.image_id1, r.image_id2) for r in pairs.pairs_sequential(images, overlap=3).collect()}
    assert got == {(i, i + s) for i in range(60) for s in (1, 2, 3, 4) if i + s < 60}
    plain = {(r.image_id1, r.image_id2) for r in pairs.pairs_sequential(images, 3, quadratic=False).collect()}
    assert plain == {(i, i + s) for i in range(60) for s in (1, 2, 3) if i + s < 60}


def test_exhaustive_plan_adds_up(spark):
    images = spark.range(253).withColumnRenamed("id", "image_id")
    plan = pairs.exhaustive_plan(images).collect()
    assert sum(r.pairs_within + r.pairs_ahead for r in plan) == 253 * 252 // 2 == pairs.exhaustive_estimate(images).first().n_pairs


def test_boxes_split_tied_axes():
    rng = np.random.default_rng(4)
    p = np.column_stack([np.where(rng.random(4000) < 0.7, 0.0, 1000.0), rng.random(4000), rng.random(4000)])
    tree = knn.Boxes(p, 32)
    assert np.bincount(tree.locate(p), minlength=32).max() < 700
    d, ids = knn._nearest(p[:600], np.arange(600), p[:50], np.full(50, np.inf), 9)
    full = np.sort(distances(p[:600])[:50], axis=1)[:, :9]
    assert np.abs(d - full).max() < 1e-12


def test_ties_go_to_the_smaller_id():
    p = np.array([[x, y] for x in range(12) for y in range(12)], dtype=float)
    d, ids = knn._nearest(p, np.arange(144), p, np.full(144, np.inf), 5)
    full = distances(p)
    want = [sorted(range(144), key=lambda j: (full[i, j], j))[:5] for i in range(144)]
    assert ids.tolist() == want


@pytest.mark.parametrize("block", [4096, 4])
def test_loop_pairs_are_the_most_similar_of_all(spark, monkeypatch, block):
    monkeypatch.setattr(vocab, "LOOP_BLOCK", block)
    x = np.random.default_rng(3).normal(size=(2500, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[1000:1020] = x[100]  # equal images tie
    table = spark.createDataFrame([(i, *v) for i, v in enumerate(x.tolist())], "image_id bigint, " + ", ".join(f"v{i} double" for i in range(24)))
    got = vocab.loop_pairs(table.repartition(5), period=250, n=10).orderBy("image_id1", "rank").collect()
    want = []
    for q in range(0, 2500, 250):
        near = sorted((-sum(a * b for a, b in zip(x[i], x[q])), i) for i in range(2500) if i != q)[:10]
        want += [(q, i, r) for r, (_, i) in enumerate(near, 1)]
    assert [(r.image_id1, r.image_id2, r.rank) for r in got] == want


def test_small_boxes_do_not_make_as_many_tasks(spark):
    rows = [(i, float(i * 37 % 1009), float(i * 91 % 997)) for i in range(3000)]
    near = knn.nearest(spark.createDataFrame(rows, "id long, x double, y double"), "id", ["x", "y"], 3, 20.0, box_rows=6)
    parts = [int(n) for n in re.findall(r"hashpartitioning\(box#\d+, (\d+)\)", near._jdf.queryExecution().executedPlan().toString())]
    assert parts and max(parts) <= 2 * spark.sparkContext.defaultParallelism
    assert near.count() == len(set(r[1:] for r in rows))
