"""Nav logs and camera-rule files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reefgrid.functions.names import CAMERA_MODELS, canonical_columns
from reefgrid.operators.ranks import last_by_key, number_rows
from reefgrid.session import pin
from reefgrid.sources.lines import POSITION, read_lines

DELIMITERS = {"comma": ",", "semicolon": ";", "tab": "\t"}
NUMBERS = ["x", "y", "alt", "yaw", "pitch", "roll", "x_acc", "y_acc", "alt_acc"]


def detect_delimiter(first_line: str) -> str:
    return next((d for d in (";", ",", "\t") if d in first_line), ",")


_LAYOUT = "file string, header struct<block: bigint, seq: bigint>, sep string, places map<string, int>, spelled map<string, string>, problem string"


def _layout(delimiter: str):
    """Each file's delimiter and the places of its columns, from its first line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                sep = detect_delimiter(row["line"]) if delimiter == "auto" else DELIMITERS.get(delimiter, delimiter)
                names = [n.strip().strip('"') for n in row["line"].lstrip("\ufeff").split(sep)]
                found, problem = canonical_columns(names), None
                if not ({"x", "y"} <= set(found) or {"lat", "lon"} <= set(found)):
                    problem = f"{row['file']}: no position columns in {names}"
                elif "name" not in found:
                    problem = f"{row['file']}: no image name column in {names}"
                places = [(c, names.index(spelled)) for c, spelled in found.items()]
                out.append({"file": row["file"], "header": row["header"], "sep": sep, "places": places, "spelled": list(found.items()), "problem": problem})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("file", pa.string()), ("header", pa.struct([("block", pa.int64()), ("seq", pa.int64())])), ("sep", pa.string()),
                ("places", pa.map_(pa.string(), pa.int32())), ("spelled", pa.map_(pa.string(), pa.string())), ("problem", pa.string())]))
    return run


def _layouts(lines: DataFrame, delimiter: str) -> DataFrame:
    place = F.struct("block", "seq")
    heads = lines.groupBy("file").agg(F.min_by("line", place).alias("line"), F.min(place).alias("header"))
    found = pin(heads.mapInArrow(_layout(delimiter), _LAYOUT))
    wrong = found.filter("problem IS NOT NULL").select("problem").first()
    if wrong:
        raise ValueError(wrong["problem"])
    if found.isEmpty():
        raise ValueError("no header")
    return found.drop("problem")


def _nav_rows(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """Rows of every file, each read by its own header; delimiters inside quotes do not count."""
    lines = read_lines(spark, path).filter(F.trim("line") != "")
    rows = lines.join(_layouts(lines, delimiter), "file").filter(F.struct("block", "seq") > F.col("header"))
    outside = F.concat(F.lit("\\Q"), "sep", F.lit(r'\E(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    rows = rows.withColumn("parts", F.split("line", outside))

    def has(*names: str) -> Column:
        return F.size(F.array_intersect(F.map_keys("places"), F.array(*map(F.lit, names)))) == len(names)

    def text(name: str) -> Column:
        return F.trim(F.regexp_replace(F.get("parts", F.try_element_at("places", F.lit(name))), r'^\s*"(.*)"\s*$', "$1"))

    projected, oriented = has("x", "y"), has("yaw", "pitch", "roll")
    source = {c: text(c) for c in NUMBERS}
    source["x"], source["y"] = F.when(projected, text("x")).otherwise(text("lon")), F.when(projected, text("y")).otherwise(text("lat"))
    source |= {c: F.when(oriented, text(c)) for c in ("yaw", "pitch", "roll")}
    rows = rows.select(*POSITION, F.nullif(text("name"), F.lit("")).alias("name"), oriented.alias("oriented"), *[F.nullif(c, F.lit("")).alias(f"_{name}") for name, c in source.items()])
    values = {c: F.col(f"_{c}").try_cast("double") for c in NUMBERS}
    bad = F.col("name").isNull()
    for c in NUMBERS:
        unread = F.col(f"_{c}").isNotNull() & values[c].isNull()
        needed = F.lit(True) if c in ("x", "y") else F.col("oriented") if c in ("yaw", "pitch", "roll") else F.lit(False)
        bad = bad | F.when(needed, values[c].isNull()).otherwise(unread)
    return rows.withColumn("bad", bad).select(*POSITION, "name", *[v.alias(c) for c, v in values.items()], "bad")


def read_nav(spark: SparkSession, path: str, delimiter: str = "auto") -> DataFrame:
    """Nav rows by image name; of a repeated name the last row counts.

    Altitude defaults to 0. Rows with an unreadable number are left out, see
    ``read_nav_rejects``.
    """
    rows = _nav_rows(spark, path, delimiter)
    good = rows.filter(~F.col("bad")).drop("bad").withColumn("alt", F.coalesce("alt", F.lit(0.0)))
    kept = good.withColumns({f"pos_{c}": F.col(c) for c in POSITION})
    return last_by_key(kept, ["name"], POSITION).drop(*POSITION)


NAV_POSITION = [f"pos_{c}" for c in POSITION]


def read_nav_rejects(spark: SparkSession, path: str, delimiter: str = "auto") -> DataFrame:
    rows = _nav_rows(spark, path, delimiter)
    return rows.filter("bad").drop("bad")


def nav_columns(spark: SparkSession, path: str, delimiter: str = "auto") -> dict[str, str]:
    """Canonical names found in the headers, for the coordinate-system choice."""
    spelled = _layouts(read_lines(spark, path).filter(F.trim("line") != ""), delimiter).select("file", F.explode("spelled").alias("name", "spelled"))
    found = spelled.groupBy("name").agg(F.min_by("spelled", "file").alias("spelled"))  # one row per canonical name
    return {r["name"]: r["spelled"] for r in found.collect()}


def read_camera_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules in file order; lines with fewer than four fields are skipped."""
    lines = read_lines(spark, path).withColumn("line", F.trim("line")).filter(
        (F.col("line") != "") & ~F.col("line").startswith("#")
    )
    parts = F.transform(F.split("line", ";"), lambda p: F.trim(p))
    parsed = lines.withColumn("p", parts).filter(F.size("p") >= 4).select(
        *POSITION, F.col("p")[0].alias("prefix"), F.upper(F.col("p")[1]).alias("model"),
        F.col("p")[2].cast("double").alias("focal_mm"), F.col("p")[3].cast("double").alias("sensor_width_mm"),
    )
    unknown = parsed.filter(~F.col("model").isin(*CAMERA_MODELS)).select("model").first()
    if unknown:
        raise ValueError(f"unknown camera model {unknown['model']}")
    return number_rows(parsed, POSITION, "rule_idx", start=0).select(
        F.col("rule_idx").cast("int").alias("rule_idx"), "prefix", "model", "focal_mm", "sensor_width_mm"
    )


def skipped_rules(spark: SparkSession, path: str) -> DataFrame:
    lines = read_lines(spark, path).withColumn("line", F.trim("line")).filter(
        (F.col("line") != "") & ~F.col("line").startswith("#")
    )
    return lines.filter(F.size(F.split("line", ";")) < 4).select("line")
