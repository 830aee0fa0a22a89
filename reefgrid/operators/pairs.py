"""Candidate image pairs and verified-pair graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.operators.components import connected_components
from reefgrid.operators.knn import nearest
from reefgrid.operators.ranks import number_rows

BLOCK_SIZE = 100


def exhaustive_plan(images: DataFrame, block: int = BLOCK_SIZE) -> DataFrame:
    """The exhaustive policy as work per block, in one linear pass.

    Images are numbered by id; block ``b`` is matched against itself and every
    later image. The pairs themselves number n(n-1)/2 and are never listed.
    """
    n = images.agg(F.count(F.lit(1))).scalar()
    numbered = number_rows(images.select("image_id"), ["image_id"], "ordinal", start=0)
    blocks = numbered.groupBy(F.floor(F.col("ordinal") / block).alias("block")).agg(
        F.count(F.lit(1)).alias("n_images"), F.max("ordinal").alias("_last")
    )
    size = F.col("n_images")
    within = F.floor(size * (size - 1) / 2).cast("bigint")
    return blocks.select(
        "block", "n_images", within.alias("pairs_within"),
        (size * (n - F.col("_last") - 1)).alias("pairs_ahead"),
    )


def exhaustive_estimate(images: DataFrame) -> DataFrame:
    """One row: exact pair count and the rough n squared over two."""
    n = F.col("n_images")
    return images.agg(F.count(F.lit(1)).alias("n_images")).select(
        "n_images", F.floor(n * (n - 1) / 2).cast("bigint").alias("n_pairs"),
        F.floor(n * n / 2).cast("bigint").alias("pairs_estimate"),
        F.when(n <= 3000, "exhaustive").otherwise("sequential").alias("suggested_mode"),
    )


def pairs_sequential(images: DataFrame, overlap: int = 20, quadratic: bool = True) -> DataFrame:
    """Each image with the next ``overlap`` ones by name, and those 2^i ahead."""
    offsets = set(range(1, overlap + 1))
    if quadratic:
        offsets |= {2**i for i in range(overlap)}
    numbered = number_rows(images.select("image_id", "name"), ["name", "image_id"], "ordinal")
    n = images.agg(F.count(F.lit(1))).scalar()
    ahead = numbered.select(
        F.col("image_id").alias("image_id1"), "ordinal",
        F.explode(F.array(*[F.lit(o).cast("bigint") for o in sorted(offsets)])).alias("step"),
    ).filter(F.col("ordinal") + F.col("step") <= n)
    other = numbered.select(F.col("image_id").alias("image_id2"), F.col("ordinal").alias("target"))
    return ahead.withColumn("target", F.col("ordinal") + F.col("step")).join(other, "target").select(
        "image_id1", "image_id2", "step"
    )


def neighbors_within(
    positions: DataFrame, id_col: str, coords: list[str], k: int, max_dist: float, **options
) -> DataFrame:
    """Up to ``k`` nearest others of each image within ``max_dist``, ties by id."""
    near = nearest(positions, id_col, coords, k + 1, max_dist=max_dist, **options)
    at = positions.select(F.col(id_col).alias("image_id"), *[F.col(c).cast("double").alias(c) for c in coords])
    # The list of a location serves all its images; each leaves itself out.
    others = F.filter("near", lambda e: e["id"] != F.col("image_id"))
    return at.join(near, coords).select("image_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "e")).select(
        "image_id", F.col("e.id").alias("neighbor_id"), (F.col("rank") + 1).alias("rank"), F.col("e.d").alias("dist")
    )


def pairs_spatial(
    positions: DataFrame, id_col: str = "image_id", coords: list[str] | None = None,
    max_dist: float = 50.0, k: int = 100, **options,
) -> DataFrame:
    """Pairs a < b where either image ranks the other among its ``k`` nearest within range."""
    ranked = neighbors_within(positions, id_col, coords or ["x", "y"], k, max_dist, **options)
    return ranked.groupBy(
        F.least("image_id", "neighbor_id").alias("image_id1"), F.greatest("image_id", "neighbor_id").alias("image_id2")
    ).agg(F.min("dist").alias("dist"))


def min_matches(two_view: DataFrame, n: int = 30) -> DataFrame:
    """Verified pairs with enough matches for the mapper."""
    return two_view.filter(F.col("rows") >= n)


def cross_camera(two_view: DataFrame, images: DataFrame) -> DataFrame:
    """Verified pairs per pair of cameras."""
    cam = images.select("image_id", "camera_id")
    pairs = two_view.filter(F.col("rows") > 0)
    for side in ("1", "2"):
        named = cam.select(F.col("image_id").alias(f"image_id{side}"), F.col("camera_id").alias(f"cam{side}"))
        pairs = pairs.join(named, f"image_id{side}")
    return pairs.groupBy(
        F.least("cam1", "cam2").alias("camera_a"), F.greatest("cam1", "cam2").alias("camera_b")
    ).agg(F.count(F.lit(1)).alias("n_pairs"))


def isolated_images(images: DataFrame, two_view: DataFrame) -> DataFrame:
    """Images in no verified pair."""
    pairs = two_view.filter(F.col("rows") > 0)
    seen = pairs.select(F.explode(F.array("image_id1", "image_id2")).alias("image_id")).distinct()
    return images.join(seen, "image_id", "left_anti")


def image_components(two_view: DataFrame, images: DataFrame) -> DataFrame:
    """Sub-models: components of the verified-pair graph, isolated images included."""
    pairs = two_view.filter(F.col("rows") > 0)
    labels = connected_components(pairs, "image_id1", "image_id2", images.select("image_id"))
    return labels.withColumnRenamed("node", "image_id")


def sample_pairs(two_view: DataFrame, n: int = 50, seed: int = 42) -> DataFrame:
    """``n`` verified pairs in a seeded random order that does not depend on layout."""
    mixed = F.xxhash64("image_id1", "image_id2", F.lit(seed))
    return two_view.filter(F.col("rows") > 0).orderBy(mixed, "image_id1", "image_id2").limit(n)

