"""Survey report: feature, match, timing and model statistics with advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.functions.names import ELAPSED_PATTERN, STAGE_MARKERS, elapsed_minutes, log_stage, metric
from reefgrid.functions.sizing import percent
from reefgrid.operators.ranks import middle


def feature_stats(keypoints: DataFrame) -> DataFrame:
    """Images with features and their sum, whole average, least and most; zeros when none."""
    rows = F.col("rows")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return keypoints.filter(rows > 0).agg(
        F.count(F.lit(1)).alias("images_with_features"), zero(F.sum(rows)).alias("total_features"),
        zero(F.floor(F.avg(rows))).alias("avg_features"), zero(F.min(rows)).alias("min_features"),
        zero(F.max(rows)).alias("max_features"),
    )


def db_counts(
    images: DataFrame, matches: DataFrame, two_view: DataFrame, priors: DataFrame, rigs: DataFrame
) -> DataFrame:
    """One row of table counts."""
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return images.agg(F.count(F.lit(1)).alias("images")).withColumns({
        "matches": n(matches), "verified_pairs": n(two_view.filter(F.col("rows") > 0)),
        "pose_priors": n(priors), "rigs": n(rigs),
    })


def model_stats(images: DataFrame, points: DataFrame) -> DataFrame:
    """Registered images, points and their error; the median is the upper one."""
    found = middle(points, "error")
    sums = points.agg(
        F.count(F.lit(1)).alias("total_points"), F.avg("error").alias("error_mean"), F.max("error").alias("error_max")
    )
    return sums.withColumns({
        "registered_images": images.agg(F.count(F.lit(1))).scalar(),
        "error_median": F.lit(found.upper if found else None).cast("double"),
    })


def log_timings(logs: DataFrame) -> DataFrame:
    """Stage and minutes of each log that states its elapsed time."""
    return logs.withColumns({
        "stage": log_stage(F.col("content")), "minutes": elapsed_minutes(F.col("content"))
    }).filter(F.col("minutes").isNotNull()).drop("content")


def timings_of_lines(lines: DataFrame) -> DataFrame:
    """``log_timings`` of ``(path, mtime, block, seq, line)``: every log is folded from its lines, a part of it in each task.

    A log's stage is the first in the order of the markers that any line has; its
    minutes are those of the first line that states them.
    """
    markers = F.coalesce(*[F.when(F.col("line").rlike(f"(?i){pattern}"), F.lit(i)) for i, (pattern, _) in enumerate(STAGE_MARKERS)])
    stated = F.when(F.col("line").rlike(ELAPSED_PATTERN), F.struct("block", "seq"))
    folded = lines.groupBy("path").agg(
        F.max("mtime").alias("mtime"), F.min(markers).alias("marker"), F.min_by(elapsed_minutes(F.col("line")), stated).alias("minutes"))
    stages = F.array(*[F.lit(name) for _, name in STAGE_MARKERS])
    return folded.filter(F.col("minutes").isNotNull()).select(
        "path", "mtime", F.coalesce(F.get(stages, F.col("marker")), F.lit("Unknown Stage")).alias("stage"), "minutes")


def stage_timings(timings: DataFrame) -> DataFrame:
    """Minutes per stage and a TOTAL row."""
    return timings.rollup("stage").agg(
        F.sum("minutes").alias("minutes"), F.count(F.lit(1)).alias("n_logs"), F.grouping("stage").alias("_all")
    ).select(
        F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("stage")).alias("stage"),
        "minutes", (F.col("minutes") / 60.0).alias("hours"), "n_logs",
    )


def first_stage(timings: DataFrame, stage: str, keys: list[str]) -> DataFrame:
    """Minutes of the earliest log of one stage."""
    return timings.filter(F.col("stage") == stage).groupBy(*keys).agg(
        F.min_by("minutes", "mtime").alias("minutes"), F.min("mtime").alias("mtime")
    )


def latest(logs: DataFrame, keys: list[str]) -> DataFrame:
    """The most recently written log per key."""
    return logs.groupBy(*keys).agg(F.max("mtime").alias("mtime"), F.max_by("path", F.struct("mtime", "path")).alias("path"))


def tail(lines: DataFrame, position: str, n: int = 100) -> DataFrame:
    """Last ``n`` lines."""
    return lines.orderBy(F.desc(position)).limit(n)


def last_metrics(lines: DataFrame, keys: list[str], position: str, names: list[str]) -> DataFrame:
    """Latest value of each metric per run; other lines do not overwrite it."""
    parsed = lines.select(*keys, position, *[metric(F.col("line"), n).alias(n) for n in names])
    return parsed.groupBy(*keys).agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(position))).alias(n) for n in names]
    )


def line_counts(lines: DataFrame, key: str) -> DataFrame:
    """Data lines (not blank, not comment) per file."""
    text = F.trim("line")
    return lines.groupBy(key).agg(F.count_if((text != "") & ~text.startswith("#")).alias("n_lines"))


def _notes(*rules: tuple[Column, str, str]) -> Column:
    """Array of the advice whose condition holds."""
    found = F.array(*[
        F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(topic).alias("topic"), F.lit(note).alias("note")))
        for cond, topic, note in rules
    ])
    return F.filter(found, lambda e: e.isNotNull())


def survey_metrics(df: DataFrame) -> DataFrame:
    """Derived rates of metric rows ``images, feature_minutes, registered, error_mean, verified_pairs, matches, db_gb``."""
    return df.withColumns({
        "images_per_min": F.try_divide(F.col("images").cast("double"), F.col("feature_minutes")),
        "registration_pct": percent(F.col("registered"), F.col("images")),
        "verification_pct": percent(F.col("verified_pairs"), F.col("matches")),
    })


def recommendations(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Advice per metrics row; a rule with a missing input says nothing."""
    speed, rate = F.col("images_per_min"), F.col("registration_pct")
    err, verified = F.col("error_mean"), F.col("verification_pct")
    notes = _notes(
        (speed < 50, "extraction", "slow"), (speed >= 50, "extraction", "healthy"),
        (rate < 80, "registration", "low"), ((rate >= 80) & (rate < 95), "registration", "good"),
        (rate >= 95, "registration", "excellent"),
        (err > 2.0, "error", "high"), ((err > 1.0) & (err <= 2.0), "error", "acceptable"),
        (err <= 1.0, "error", "excellent"),
        ((F.col("verified_pairs") > 0) & (verified < 30), "verification", "low"),
        (F.col("db_gb") > 100, "database", "large"),
        (F.lit(True), "mapper", "gravity priors constrain rotations"),
        (F.lit(True), "features", "learned features suit low contrast"),
    )
    return metrics.select(*keys, F.inline(notes))


# Documented healthy range and alarm limit per run metric:
# (column, low, high, alarm below, alarm above).
HEALTH_RANGES = [
    ("images_per_min", 5.0, 50.0, 5.0, None),
    ("memory_pct", None, 80.0, None, 90.0),
    ("gpu_pct", 50.0, None, 10.0, None),
    ("verification_pct", 50.0, None, 30.0, None),
    ("points_seen_pct", 50.0, None, 30.0, None),
    ("error_mean", None, 2.0, None, 4.0),
    ("db_gb_per_1000", None, 2.0, None, None),
]


def health(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Each metric as ok, watch (outside its range), alarm, or missing where it has no value or no column."""
    checks = []
    for name, low, high, under, over in HEALTH_RANGES:
        v = (F.col(name) if name in metrics.columns else F.lit(None)).cast("double")
        outside, alarm = F.lit(False), F.lit(False)
        outside = outside | (v < low) if low is not None else outside
        outside = outside | (v > high) if high is not None else outside
        alarm = alarm | (v < under) if under is not None else alarm
        alarm = alarm | (v > over) if over is not None else alarm
        status = F.when(v.isNull(), "missing").when(alarm, "alarm").when(outside, "watch").otherwise("ok")
        checks.append(F.struct(F.lit(name).alias("metric"), v.alias("value"), status.alias("status")))
    return metrics.select(*keys, F.inline(F.array(*checks)))


def stratified(images: DataFrame, tag: Column, quotas: dict[str, int], default: int = 0) -> DataFrame:
    """The first names of each camera tag, up to the tag's quota."""
    quota = F.when(F.lit(False), F.lit(0))
    for name, n in quotas.items():
        quota = quota.when(F.col("tag") == name, n)
    most = max([default, *quotas.values()])
    w = Window.partitionBy("tag").orderBy("name")
    ranked = images.withColumn("tag", tag).withColumn("rn", F.row_number().over(w))
    # The outer bound lets Spark cut each tag down before the shuffle.
    return ranked.filter(F.col("rn") <= most).filter(F.col("rn") <= quota.otherwise(default)).drop("rn")
