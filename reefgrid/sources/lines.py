"""Text files as rows that know their place in the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITION = ["file", "block", "seq"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with ``(file, block, seq)``.

    Files stay splittable: ``block`` is the offset of the split a line was read
    in and ``seq`` grows inside it, so the three order a file's lines.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"),
    )


def fields(df: DataFrame) -> DataFrame:
    """Adds the stripped line and its whitespace-separated ``parts``."""
    text = F.regexp_replace("line", r"^\s+|\s+$", "")
    return df.withColumn("text", text).withColumn("parts", F.split("text", r"\s+"))


def is_data():
    return (F.col("text") != "") & ~F.col("text").startswith("#")


def with_previous(df: DataFrame, state: dict, out: str = "prev") -> DataFrame:
    """The given fields of the preceding row of the same file, as struct ``out``.

    Rows look back inside their own block, by their place and state alone: the
    lines themselves are dealt by place, so that no task holds a block of them.
    Only the first row of a block needs the last row of an earlier block, found
    in a table of one row per block.
    """
    narrow = df.select("file", "block", "seq", F.struct(*[c.alias(name) for name, c in state.items()]).alias("_state"))
    inside = Window.partitionBy("file", "block").orderBy("seq")
    linked = narrow.withColumn("_before", F.lag("_state").over(inside))
    ends = narrow.groupBy("file", "block").agg(F.max_by("_state", "seq").alias("_end"))
    across = Window.partitionBy("file").orderBy("block")
    edges = ends.select("file", "block", F.lag("_end").over(across).alias("_edge"))
    before = linked.join(F.broadcast(edges), ["file", "block"], "left").select(
        *POSITION, F.coalesce("_before", "_edge").alias(out))
    return df.join(before, POSITION)
