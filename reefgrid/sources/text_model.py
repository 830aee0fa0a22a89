"""Sparse-model text files: cameras, images with observations, points with tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reefgrid.functions.names import is_pose_line
from reefgrid.operators.ranks import last_by_key
from reefgrid.sources.lines import POSITION, fields, is_data, read_lines, with_previous

MODEL_FILES = ["cameras.txt", "images.txt", "points3d.txt"]


def _part(i: int) -> Column:
    return F.get("parts", F.lit(i))


def _num(c: Column, kind: str = "double") -> Column:
    return c.try_cast(kind)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points with their track; rows with fewer than 8 fields are skipped, the last duplicate wins."""
    rows = fields(read_lines(spark, path)).filter(is_data() & (F.size("parts") >= 8))
    pairs = F.floor((F.size("parts") - 8) / 2).cast("int")
    track = F.when(
        pairs > 0,
        F.transform(
            F.sequence(F.lit(0), pairs - 1),
            lambda i: F.struct(
                _num(F.get("parts", i * 2 + 8), "bigint").alias("image_id"),
                _num(F.get("parts", i * 2 + 9), "int").alias("point2d_idx"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<image_id: bigint, point2d_idx: int>>"))
    parsed = rows.select(
        *POSITION, _num(_part(0), "bigint").alias("point_id"),
        *[_num(_part(i)).alias(c) for i, c in ((1, "x"), (2, "y"), (3, "z"))],
        *[_num(_part(i), "int").alias(c) for i, c in ((4, "r"), (5, "g"), (6, "b"))],
        _num(_part(7)).alias("error"), pairs.alias("track_length"), track.alias("track"),
    ).filter(F.col("point_id").isNotNull())
    return last_by_key(parsed, ["point_id"], POSITION)


def tracks(points: DataFrame) -> DataFrame:
    """The point-image edges of the tracks."""
    return points.select("point_id", F.inline("track"))


def read_points_raw(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Leading comment lines, and the verbatim line of each point."""
    rows = fields(read_lines(spark, path))
    start = rows.filter(is_data()).agg(F.min(F.struct(*POSITION))).scalar()
    header = rows.withColumn("_start", start).filter(
        F.col("_start").isNull() | (F.struct(*POSITION) < F.col("_start"))
    ).select(*POSITION, "line")
    points = rows.filter(is_data() & (F.size("parts") >= 8)).select(
        *POSITION, _num(_part(0), "bigint").alias("point_id"), "line"
    ).filter(F.col("point_id").isNotNull())
    return header, last_by_key(points, ["point_id"], POSITION)


def classified_image_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an images file as ``pose``, ``obs``, ``stray`` or ``skip`` (blank or comment).

    An observation line is the first data line after a pose that is not a pose
    itself. ``prev`` describes the data line before; ``pose_file/block/seq``
    place the pose an observation line belongs to.
    """
    rows = fields(read_lines(spark, path))
    data = rows.filter(is_data()).withColumn("is_pose", is_pose_line(F.col("parts")))
    linked = with_previous(
        data,
        {"is_pose": F.col("is_pose"), "image_id": _num(_part(0), "bigint"), "block": F.col("block"), "seq": F.col("seq")},
    )
    after_pose = F.coalesce(F.col("prev.is_pose"), F.lit(False))
    kind = F.when(F.col("is_pose"), "pose").when(after_pose, "obs").otherwise("stray")
    return linked.withColumn("kind", kind).withColumn("after_pose", after_pose)


def _triplets() -> Column:
    """``(x, y, id)`` strings of an observation line; a trailing remainder is dropped."""
    n = F.floor(F.size("parts") / 3).cast("int")
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                i.alias("obs_idx"), F.get("parts", i * 3).alias("x"), F.get("parts", i * 3 + 1).alias("y"),
                F.get("parts", i * 3 + 2).alias("id"),
            ),
        ),
    )


def read_images(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Image poses and their observations; of a repeated image id the last pose counts."""
    lines = classified_image_lines(spark, path)
    poses = lines.filter(F.col("kind") == "pose").select(
        *POSITION, _num(_part(0), "bigint").alias("image_id"), _part(9).alias("name"),
        _num(_part(8), "bigint").alias("camera_id"),
        F.array(*[_num(_part(i)) for i in range(1, 5)]).alias("qvec"),
        F.array(*[_num(_part(i)) for i in range(5, 8)]).alias("tvec"),
    )
    latest = last_by_key(poses, ["image_id"], POSITION)
    rows = lines.filter(F.col("kind") == "obs").select(
        "file", F.col("prev.image_id").alias("image_id"), F.col("prev.block").alias("block"),
        F.col("prev.seq").alias("seq"), F.explode(_triplets()).alias("o"),
    )
    current = latest.select("image_id", *POSITION)
    point = _num(F.col("o.id"), "bigint")
    observations = rows.join(current, ["image_id", *POSITION], "left_semi").select(
        "image_id", "o.obs_idx", _num(F.col("o.x")).alias("px"), _num(F.col("o.y")).alias("py"),
        F.when(point != -1, point).alias("point_id"),
    )
    return latest.drop(*POSITION), observations


def read_cameras(spark: SparkSession, path: str) -> DataFrame:
    rows = fields(read_lines(spark, path)).filter(is_data())
    parsed = rows.select(
        *POSITION, _num(_part(0), "bigint").alias("camera_id"), _part(1).alias("model"),
        _num(_part(2), "int").alias("width"), _num(_part(3), "int").alias("height"),
        F.transform(F.slice("parts", 5, F.greatest(F.size("parts") - 4, F.lit(0))), lambda p: _num(p)).alias("params"),
    ).filter(F.col("camera_id").isNotNull())
    return last_by_key(parsed, ["camera_id"], POSITION)


def camera_details(cameras: DataFrame) -> DataFrame:
    """Resolution text and focal length of cameras that state a parameter."""
    return cameras.filter(F.size("params") >= 1).select(
        "camera_id", "model", F.concat_ws("x", F.col("width").cast("string"), F.col("height").cast("string")).alias("resolution"),
        F.col("params")[0].alias("focal_px"),
    )


def rewrite_image_lines(spark: SparkSession, path: str, kept: DataFrame) -> DataFrame:
    """The images file with references to dropped points set to -1, as ordered lines.

    Comments, poses and stray lines pass through. A pose that directly follows
    a pose gets an empty observation line put before it.
    """
    rows = fields(read_lines(spark, path))
    skipped = rows.filter(~is_data()).select(*POSITION, F.lit(0).alias("part"), "line")
    lines = classified_image_lines(spark, path)
    passed = lines.filter(F.col("kind") != "obs")
    passed = passed.select(
        *POSITION,
        F.posexplode(
            F.when((F.col("kind") == "pose") & F.col("after_pose"), F.array(F.lit(""), F.col("line")))
            .otherwise(F.array("line"))
        ).alias("part", "line"),
    )
    obs = lines.filter(F.col("kind") == "obs").select(*POSITION, _triplets().alias("obs"))
    each = obs.select(*POSITION, F.explode_outer("obs").alias("o")).select(
        *POSITION, "o.obs_idx", "o.x", "o.y", _num(F.col("o.id"), "bigint").alias("point_id")
    )
    marks = kept.select(F.col("point_id").alias("_kept")).distinct()
    joined = each.join(marks, each["point_id"] == marks["_kept"], "left")
    token = F.struct("obs_idx", F.concat_ws(" ", "x", "y", F.coalesce("_kept", F.lit(-1)).cast("string")).alias("t"))
    # A group is one line of the file, which was one row to begin with.
    rebuilt = joined.groupBy(*POSITION).agg(
        F.concat_ws(" ", F.transform(
            F.array_sort(F.collect_list(F.when(F.col("obs_idx").isNotNull(), token))), lambda e: e["t"]
        )).alias("line")
    ).select(*POSITION, F.lit(0).alias("part"), "line")
    return skipped.unionByName(passed).unionByName(rebuilt)
