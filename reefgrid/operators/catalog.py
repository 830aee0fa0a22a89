"""Camera assignment and rebuild of the camera, rig and frame tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefgrid.functions.names import extension, is_image_name, model_code, model_name, stem
from reefgrid.functions.sizing import camera_params, focal_px
from reefgrid.operators.ranks import last_by_key
from reefgrid.session import pin

#: Up to so many different prefixes of rules are sent to all tasks.
BROADCAST_RULES = 100_000


def assign_cameras(images: DataFrame, rules: DataFrame, anchored: bool = False) -> DataFrame:
    """Images with the index of the first rule whose prefix their name contains, or begins with if ``anchored``.

    ``rule_idx`` is NULL where no rule fits. A name's substrings of the lengths
    that prefixes have meet the prefixes in an equi-join, however many rules
    there are. Lengths are at most those of a file name, so their array is small.
    """
    first = pin(rules.filter(F.col("prefix").isNotNull()).groupBy("prefix").agg(F.min("rule_idx").alias("rule_idx")))
    n, lengths = first.agg(F.count(F.lit(1)), F.array_sort(F.collect_set(F.length("prefix")))).first()
    last = F.lit(1) if anchored else F.length("name") - F.col("_length") + 1
    parts = images.select("name", F.explode(F.lit(lengths).cast("array<int>")).alias("_length")).filter(F.length("name") >= F.col("_length")).select(
        "name", "_length", F.explode(F.sequence(F.lit(1), last)).alias("_at")).select("name", F.expr("substring(name, _at, _length)").alias("prefix"))
    # Few prefixes are known to every task; many meet the names' parts in a shuffle.
    found = parts.join(F.broadcast(first) if n <= BROADCAST_RULES else first, "prefix").groupBy("name").agg(F.min("rule_idx").alias("rule_idx"))
    return images.join(found, "name", "left").select(*images.columns, "rule_idx")


def unassigned(assigned: DataFrame) -> DataFrame:
    return assigned.filter(F.col("rule_idx").isNull()).drop("rule_idx")


def first_size(cameras: DataFrame) -> Column:
    """Width and height of the camera with the smallest id, as a scalar struct."""
    return cameras.agg(F.min_by(F.struct("width", "height"), "camera_id")).scalar()


def rule_counts(assigned: DataFrame, rules: DataFrame, cameras: DataFrame) -> DataFrame:
    """Images and focal length in pixels per rule, rules without images included."""
    counts = assigned.filter(F.col("rule_idx").isNotNull()).groupBy("rule_idx").agg(
        F.count(F.lit(1)).alias("n_images")
    )
    sized = rules.withColumn("_size", first_size(cameras))
    return sized.join(counts, "rule_idx", "left").select(
        "rule_idx", "prefix", "model",
        focal_px(F.col("focal_mm"), F.col("_size.width"), F.col("sensor_width_mm")).alias("focal_px"),
        F.coalesce("n_images", F.lit(0)).alias("n_images"),
    )


def new_cameras(rules: DataFrame, counts: DataFrame, cameras: DataFrame) -> DataFrame:
    """One camera per rule that has images; ids continue after the largest one."""
    used = counts.filter(F.col("n_images") > 0).select("rule_idx")
    base = F.coalesce(cameras.agg(F.max("camera_id")).scalar(), F.lit(0))
    sized = rules.join(used, "rule_idx", "left_semi").withColumn("_size", first_size(cameras))
    width, height = F.col("_size.width"), F.col("_size.height")
    focal = focal_px(F.col("focal_mm"), width, F.col("sensor_width_mm"))
    return sized.select(
        "rule_idx", (base + F.col("rule_idx") + 1).cast("bigint").alias("camera_id"), "model",
        model_code(F.col("model")).alias("model_code"), width.alias("width"), height.alias("height"),
        camera_params(F.col("model"), focal, width, height).alias("params"),
        F.lit(1).alias("prior_focal_length"),
    )


def reassign(assigned: DataFrame, created: DataFrame) -> DataFrame:
    """Images with the camera of their rule; images without a rule keep theirs."""
    ids = created.select("rule_idx", F.col("camera_id").alias("_new"))
    return assigned.join(ids, "rule_idx", "left").withColumn(
        "camera_id", F.coalesce("_new", "camera_id")
    ).drop("_new", "rule_idx")


def build_rigs(assigned: DataFrame, created: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One rig per new camera; frames and frame data for assigned images only."""
    rigs = created.select(
        F.col("camera_id").alias("rig_id"), F.col("camera_id").alias("ref_sensor_id"), F.lit(0).alias("ref_sensor_type")
    )
    placed = assigned.join(created.select("rule_idx", F.col("camera_id").alias("sensor_id")), "rule_idx")
    frames = placed.select(F.col("image_id").alias("frame_id"), F.col("sensor_id").alias("rig_id"))
    frame_data = placed.select(
        F.col("image_id").alias("frame_id"), F.col("image_id").alias("data_id"), "sensor_id", F.lit(0).alias("sensor_type")
    )
    return rigs, frames, frame_data


def orphan_cameras(cameras: DataFrame, images: DataFrame) -> DataFrame:
    return cameras.join(images.select("camera_id").distinct(), "camera_id", "left_anti")


def drop_orphans(cameras: DataFrame, images: DataFrame) -> DataFrame:
    return cameras.join(images.select("camera_id").distinct(), "camera_id", "left_semi")


def cameras_by_model(cameras: DataFrame) -> DataFrame:
    """Camera count per model code, with the model's name."""
    counts = cameras.groupBy("model_code").agg(F.count(F.lit(1)).alias("n_cameras"))
    return counts.withColumn("model", model_name(F.col("model_code")))


def first_by_name(images: DataFrame, n: int = 30) -> DataFrame:
    """The first ``n`` images in name order."""
    return images.orderBy("name").limit(n)


def subset_images(images: DataFrame, observations: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Images of the named set and their observations."""
    kept = images.join(names.select("name"), "name", "left_semi")
    return kept, observations.join(kept.select("image_id"), "image_id", "left_semi")


def fix_extensions(images: DataFrame, inventory: DataFrame) -> DataFrame:
    """Names whose file is missing take the extension of the file with the same stem."""
    on_disk = inventory.filter(is_image_name(F.col("name"))).select(
        F.col("name").alias("_file"), stem(F.col("name")).alias("_stem"), extension(F.col("name")).alias("_ext")
    )
    exact = on_disk.select(F.col("_file").alias("name"), F.lit(True).alias("_found")).distinct()
    other = last_by_key(on_disk.select("_stem", "_ext"), ["_stem"], ["_ext"])
    keyed = images.withColumn("_stem", stem(F.col("name")))
    return keyed.join(exact, "name", "left").join(other, "_stem", "left").withColumn(
        "name",
        F.when(F.col("_found").isNull() & F.col("_ext").isNotNull(), F.concat_ws(".", "_stem", "_ext"))
        .otherwise(F.col("name")),
    ).drop("_stem", "_ext", "_found")
