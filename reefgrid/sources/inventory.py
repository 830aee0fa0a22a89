"""Listings of model folders, image files and logs; file contents are not read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reefgrid.functions.names import basename, is_image_name
from reefgrid.sources.text_model import MODEL_FILES


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, name, size and time of every file below ``root``."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
        .select("path", basename(F.col("path")).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    )


def find_models(spark: SparkSession, root: str, max_depth: int | None = None) -> DataFrame:
    """Folders that hold all three model files, best candidate first by ``rank``.

    ``sparse/0``, then ``sparse``, then the root, then any folder below, or
    up to ``max_depth`` below. File names match in any case; ``files`` maps the
    canonical name to the actual path, the first one in name order if a folder
    has several.
    """
    base = root.rstrip("/").split("://")[-1]
    base = base.removeprefix("file:")
    files = list_files(spark, root, "*.[tT][xX][tT]").withColumn("canonical", F.lower("name")).filter(
        F.col("canonical").isin(*MODEL_FILES)
    )
    folder = F.regexp_replace(F.regexp_replace("path", r"/[^/]*$", ""), r"^[a-z0-9]+:/*", "/")
    below = F.ltrim(F.expr(f"substring(model_dir, {len(base) + 1})"), F.lit("/"))
    one = files.withColumn("model_dir", folder).groupBy("model_dir", "canonical").agg(F.min("path").alias("path"))
    grouped = one.groupBy("model_dir").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("canonical", "path")))).alias("files"),
        F.count(F.lit(1)).alias("n"),
    ).filter(F.col("n") == len(MODEL_FILES))
    depth = F.when(F.col("below") == "", 0).otherwise(F.size(F.split("below", "/")))
    rank = F.when(F.col("below") == "sparse/0", 0).when(F.col("below") == "sparse", 1).when(F.col("below") == "", 2)
    found = grouped.withColumn("below", below).withColumn("depth", depth).withColumn(
        "rank", F.coalesce(rank, F.col("depth") + 2)
    )
    return (found if max_depth is None else found.filter(F.col("depth") <= max_depth)).select("model_dir", "rank", "files")


def image_inventory(spark: SparkSession, root: str) -> DataFrame:
    files = list_files(spark, root)
    return files.filter(is_image_name(F.col("name"))).withColumn(
        "ext", F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1))
    )


def count_by_extension(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("ext").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"))
