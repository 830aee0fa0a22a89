"""Confidence tiers of points and the datasets derived from them."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.operators.ranks import median_literal, middle


@dataclass(frozen=True)
class TierThresholds:
    """Track minimums, and error ceilings in percent of the median error."""

    t1_min_track: int = 5
    t1_max_error_pct: float = 100.0
    t2_min_track: int = 3
    t2_max_error_pct: float = 200.0
    t3_max_error_pct: float = 300.0


def _ceiling(median: Column, pct: float) -> Column:
    return median * (pct / 100.0)


def tier_of(error: Column, track: Column, median: Column, th: TierThresholds = TierThresholds()) -> Column:
    """1 seed, 2 expand, 3 full, 0 dropped; ceilings are strict."""
    return (
        F.when((track >= th.t1_min_track) & (error < _ceiling(median, th.t1_max_error_pct)), 1)
        .when((track >= th.t2_min_track) & (error < _ceiling(median, th.t2_max_error_pct)), 2)
        .when(error < _ceiling(median, th.t3_max_error_pct), 3)
        .otherwise(0)
    )


def point_tiers(
    points: DataFrame, th: TierThresholds = TierThresholds(), errors: DataFrame | None = None
) -> DataFrame:
    """Points with their exclusive tier.

    ``errors`` may name a cheaper table with the same ``error`` values, for the median.
    """
    median = median_literal(middle(points if errors is None else errors, "error"))
    return points.withColumn("tier", tier_of(F.col("error"), F.col("track_length"), median, th))


def tier_counts(tiered: DataFrame) -> DataFrame:
    """Exclusive counts and percentages of tiers 0..3, empty ones included."""
    # One pass of conditional counts; the four rows come from unpivoting it.
    sums = tiered.agg(
        *[F.count_if(F.col("tier") == t).alias(f"n{t}") for t in range(4)],
        F.count(F.lit(1)).alias("total"),
    )
    rows = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(f"n{t}").alias("n_points")) for t in range(4)])
    return sums.select("total", F.inline(rows)).select(
        "tier", "n_points", "total",
        F.when(F.col("total") > 0, F.col("n_points") * 100.0 / F.col("total")).alias("pct"),
    )


def tier_counts_cum(counts: DataFrame) -> DataFrame:
    """Cumulative counts of tiers 1..3 and the dropped rest, from exclusive counts."""
    w = Window.orderBy("tier").rowsBetween(Window.unboundedPreceding, 0)  # three rows
    kept = counts.filter(F.col("tier") > 0).select(
        F.concat(F.lit("tier"), F.col("tier")).alias("label"), F.sum("n_points").over(w).alias("n_points")
    )
    dropped = counts.filter(F.col("tier") == 0).select(F.lit("dropped").alias("label"), "n_points")
    return kept.unionByName(dropped)


def tier_members(tiered: DataFrame) -> DataFrame:
    """One row per point and dataset: tier 1 is part of tier 2, which is part of tier 3."""
    datasets = F.sequence(F.col("tier"), F.lit(3))
    return tiered.filter(F.col("tier") > 0).withColumn("dataset", F.explode(datasets))


def dropped_points(tiered: DataFrame) -> DataFrame:
    """Points in no dataset."""
    return tiered.filter(F.col("tier") == 0).drop("tier")


def tier_summary(tiered: DataFrame) -> DataFrame:
    """Size, mean error and mean track length of each cumulative dataset."""
    measures = []
    for n in (1, 2, 3):
        member = F.col("tier").between(1, n)
        measures += [
            F.count_if(member).alias(f"n{n}"),
            F.avg(F.when(member, F.col("error"))).alias(f"e{n}"),
            F.avg(F.when(member, F.col("track_length"))).alias(f"t{n}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("dataset"), F.col(f"n{n}").alias("n_points"),
            F.coalesce(F.col(f"e{n}"), F.lit(0.0)).alias("avg_error"),
            F.coalesce(F.col(f"t{n}"), F.lit(0.0)).alias("avg_track"),
        )
        for n in (1, 2, 3)
    ])
    return tiered.agg(*measures).select(F.inline(rows))


def tier_manifest(tiered: DataFrame, th: TierThresholds = TierThresholds()) -> DataFrame:
    """One row of thresholds and cumulative counts."""
    median = median_literal(middle(tiered, "error"))
    upto = lambda n: F.count_if(F.col("tier").between(1, n))
    counts = tiered.agg(
        upto(1).alias("tier1"), upto(2).alias("tier2"), upto(3).alias("tier3"),
        F.count_if(F.col("tier") == 0).alias("dropped"), F.count(F.lit(1)).alias("total"),
    ).withColumn("median_error", median)
    p = asdict(th)
    return counts.select(
        "median_error",
        F.struct(
            F.lit(p["t1_min_track"]).alias("t1_min_track"),
            _ceiling(F.col("median_error"), p["t1_max_error_pct"]).alias("t1_max_error"),
            F.lit(p["t2_min_track"]).alias("t2_min_track"),
            _ceiling(F.col("median_error"), p["t2_max_error_pct"]).alias("t2_max_error"),
            _ceiling(F.col("median_error"), p["t3_max_error_pct"]).alias("t3_max_error"),
        ).alias("thresholds"),
        F.struct("tier1", "tier2", "tier3", "dropped", "total").alias("tier_counts"),
    )


def invalidate_obs(obs: DataFrame, kept: DataFrame) -> DataFrame:
    """Observations whose point is not kept lose the reference, not the row."""
    marks = kept.select(F.col("point_id").alias("_kept")).distinct()
    joined = obs.join(marks, obs["point_id"] == marks["_kept"], "left")
    return joined.withColumn("point_id", F.col("_kept")).drop("_kept")


def kept_lines(lines: DataFrame, members: DataFrame) -> DataFrame:
    """Verbatim point lines of each dataset; ids without a line are skipped."""
    return lines.join(members.select("point_id", "dataset"), "point_id")


def filter_max_error(points: DataFrame, max_error: float = 4.0) -> DataFrame:
    """Points within the reprojection limit (4.0 for the sparse model, 2.0 for the dense)."""
    return points.filter(F.col("error") <= max_error)
