"""External per-image quality reports: reading, repair, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reefgrid.schemas import QUALITY_REPORT


def repaired(content: Column) -> Column:
    """Report text without comments, placeholder tokens and trailing commas."""
    text = F.regexp_replace(content, r"<!--[\s\S]*?-->", "")
    text = F.regexp_replace(text, "COMMA_PLACEHOLDER", ",")
    return F.regexp_replace(F.regexp_replace(text, r",\s*([}\]])", "$1"), r"^\s+|\s+$", "")


def _parsed(text: Column) -> Column:
    return F.from_json(text, f"{QUALITY_REPORT}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"})


def parse_reports(reports: DataFrame, content: str = "content") -> DataFrame:
    """Adds ``report`` (NULL when unreadable) and ``was_repaired``; the raw text is tried first."""
    tried = reports.withColumn("_raw", _parsed(F.col(content)))
    fixed = tried.withColumn(
        "_fixed", F.when(F.col("_raw._bad").isNotNull(), _parsed(repaired(F.col(content))))
    )
    good_raw, good_fixed = F.col("_raw._bad").isNull(), F.col("_fixed._bad").isNull()
    return fixed.withColumns({
        "report": F.when(good_raw, F.col("_raw")).when(good_fixed, F.col("_fixed")),
        "was_repaired": ~good_raw & good_fixed,
    }).drop("_raw", "_fixed", content)


def report_cameras(parsed: DataFrame) -> DataFrame:
    """One row per image entry; within a report the last entry of a name wins downstream."""
    other = [c for c in parsed.columns if c not in ("report", "was_repaired")]
    return parsed.select(*other, F.posexplode("report.cameras").alias("entry", "cam")).select(
        *other, "entry", F.col("cam.image").alias("image"), F.col("cam.numPoints").alias("num_points"),
        F.col("cam.imageCoverage").alias("image_coverage"),
        F.col("cam.reprojError.median").alias("reproj_median"), F.col("cam.reprojError.mean").alias("reproj_mean"),
    )


def component_stats(parsed: DataFrame) -> DataFrame:
    return parsed.select("report.component.*")


def read_quality_reports(spark: SparkSession, path: str) -> DataFrame:
    """Whole report files, one row each, parsed."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )
    return parse_reports(files)


def write_quality_reports(parsed: DataFrame, path: str) -> None:
    """Repaired reports as JSON lines."""
    parsed.filter(F.col("report").isNotNull()).select(F.col("report").dropFields("_bad").alias("r")).select("r.*").write.mode(
        "overwrite"
    ).json(path)
