"""Splat-cloud cleaning: appearance filters, outlier removal, cluster selection."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.functions import splat
from reefgrid.functions.sizing import percent
from reefgrid.operators import components as cc
from reefgrid.operators.knn import auto_radius, knn_mean, nearest
from reefgrid.operators.ranks import grouped_median
from reefgrid.session import pin

XYZ = ["x", "y", "z"]


@dataclass(frozen=True)
class CleanConfig:
    """Cleaning options; zero or None switches a filter off."""

    neighbors: int = 20
    std_factor: float = 2.0
    passes: int = 3
    bbox: tuple[float, ...] | None = None
    opacity_min: float = 0.0
    scale_max: float = 0.0
    remove_hue: tuple[float, float] | None = None
    keep_hue: tuple[float, float] | None = None
    sat_min: float = 0.0
    val_min: float = 0.0
    connected: bool = False
    connect_radius: float = 0.0
    keep_components: int = 1
    seed: int = 42


# The named cleaning settings.
CLEAN_CONFIGS = {
    "default": CleanConfig(opacity_min=0.05, std_factor=2.0, passes=3),
    "gentle": CleanConfig(opacity_min=0.03, std_factor=2.5, passes=2),
    "aggressive": CleanConfig(opacity_min=0.1, std_factor=1.5, passes=3, scale_max=0.5),
    "connected": CleanConfig(opacity_min=0.05, std_factor=2.0, passes=3, connected=True),
    "stage1": CleanConfig(opacity_min=0.05, neighbors=20, std_factor=3.5, passes=1),
    "stage2": CleanConfig(opacity_min=0.05, neighbors=20, std_factor=3.0, passes=2),
    "stage3": CleanConfig(
        opacity_min=0.05, neighbors=20, std_factor=3.0, passes=2, connected=True, keep_components=5
    ),
    "maritime": CleanConfig(
        opacity_min=0.1, remove_hue=(180.0, 240.0), sat_min=0.3, std_factor=1.5, passes=3,
        connected=True, keep_components=5,
    ),
}


def _has(df: DataFrame, columns: list[str], what: str) -> bool:
    present = set(columns) <= set(df.columns)
    if not present:
        warnings.warn(f"no {what} columns in this cloud; filter skipped", stacklevel=3)
    return present


def scale_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c.startswith("scale_"))[:3]


def with_rgb(df: DataFrame) -> DataFrame:
    return df.withColumns({c: splat.sh_rgb(F.col(f"f_dc_{i}")) for i, c in enumerate(("red", "green", "blue"))})


def hsv_column() -> Column:
    return splat.hsv(*[splat.sh_rgb(F.col(f"f_dc_{i}")) for i in range(3)])


def with_hsv(df: DataFrame) -> DataFrame:
    """Adds ``red, green, blue`` and the struct ``hsv``, each computed once."""
    return with_rgb(df).withColumn("hsv", splat.hsv(F.col("red"), F.col("green"), F.col("blue")))


def bbox(df: DataFrame, box: tuple[float, ...]) -> DataFrame:
    return df.filter(_inside(box))


def _inside(box: tuple[float, ...]) -> Column:
    if len(box) != 6:
        raise ValueError("bbox needs xmin, ymin, zmin, xmax, ymax, zmax")
    x, y, z = (F.col(c).between(box[i], box[i + 3]) for i, c in enumerate(XYZ))
    return x & y & z


def failing_filter(df: DataFrame, cfg: CleanConfig) -> Column:
    """Name of the first filter that rejects a splat; NULL when it survives all."""
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    if cfg.bbox:
        reason = reason.when(~_inside(cfg.bbox), "bbox")
    if cfg.opacity_min > 0 and _has(df, ["opacity"], "opacity"):
        reason = reason.when(splat.opacity(F.col("opacity")) < cfg.opacity_min, "opacity")
    if (cfg.remove_hue or cfg.keep_hue) and _has(df, ["f_dc_0", "f_dc_1", "f_dc_2"], "colour"):
        hsv = hsv_column()
        eligible = F.lit(True)
        if cfg.sat_min > 0:
            eligible = eligible & (hsv["s"] >= cfg.sat_min)
        if cfg.val_min > 0:
            eligible = eligible & (hsv["v"] >= cfg.val_min)
        if cfg.remove_hue:
            reason = reason.when(eligible & splat.hue_between(hsv["h"], *cfg.remove_hue), "remove_hue")
        if cfg.keep_hue:
            reason = reason.when(eligible & ~splat.hue_between(hsv["h"], *cfg.keep_hue), "keep_hue")
    scales = scale_columns(df)
    if cfg.scale_max > 0 and _has(df, scales if len(scales) == 3 else ["scale_0", "scale_1", "scale_2"], "scale"):
        reason = reason.when(splat.max_scale([F.col(c) for c in scales]) > cfg.scale_max, "scale")
    return reason.otherwise(F.lit(None).cast("string"))


def prefilter(df: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Splats that pass every appearance filter."""
    return df.filter(failing_filter(df, cfg).isNull())


def prefilter_report(df: DataFrame, cfg: CleanConfig) -> DataFrame:
    """How many splats each filter removed, charged to the first that rejects them."""
    return df.groupBy(F.coalesce(failing_filter(df, cfg), F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_splats")
    )


def mean_rgb(df: DataFrame) -> DataFrame:
    return with_rgb(df).agg(*[F.avg(c).alias(f"mean_{c}") for c in ("red", "green", "blue")])


def hue_histogram(df: DataFrame) -> DataFrame:
    """24 bins of 15 degrees over splats with saturation above 0.1."""
    bin_of = F.least(F.floor(F.col("hsv.h") / 15), F.lit(23)).cast("int")
    counts = with_hsv(df).groupBy(F.when(F.col("hsv.s") > 0.1, bin_of).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    ).filter(F.col("bin").isNotNull())
    # At most 24 rows from here on.
    filled = counts.agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"), F.sum("n").alias("total"))
    names = F.array(*[F.lit(label) for label in splat.HUE_LABELS])
    return filled.select(
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("bin"), "by_bin", F.coalesce("total", F.lit(0)).alias("total")
    ).select(
        "bin", (F.col("bin") * 15).alias("hue_from"), F.get(names, F.col("bin")).alias("label"),
        F.coalesce(F.try_element_at("by_bin", F.col("bin")), F.lit(0)).alias("n_splats"),
        "total",
    ).withColumn("pct", percent(F.col("n_splats"), F.col("total")))


def sor_pass(df: DataFrame, id_col: str = "splat_id", k: int = 20, s: float = 2.0, **knn) -> DataFrame:
    """Drop splats whose mean neighbour distance exceeds mean + s population deviations.

    A cloud of ``k`` splats or fewer has no k neighbours; it is kept as it is.
    """
    means = pin(knn_mean(df, id_col, XYZ, k, **knn))
    limits = means.agg(
        (F.avg("mean_dist") + F.lit(s) * F.stddev_pop("mean_dist")).alias("t")
    )
    kept = means.filter(F.col("mean_dist").isNull() | (F.col("mean_dist") <= limits.scalar()))
    return df.join(kept.select(id_col), id_col, "left_semi")


def _positions(df: DataFrame, id_col: str) -> DataFrame:
    """Id and position only: rounds of the spatial steps carry nothing else."""
    return pin(df.select(id_col, *XYZ))


def _sor_rounds(slim: DataFrame, id_col: str, k: int, s: float, passes: int, knn: dict) -> DataFrame:
    for _ in range(passes):
        slim = pin(sor_pass(slim, id_col, k, s, **knn))
        if slim.isEmpty():
            break
    return slim


def sor(df: DataFrame, id_col: str = "splat_id", k: int = 20, s: float = 2.0, passes: int = 3, **knn) -> DataFrame:
    """Repeated outlier removal, each pass on the survivors of the one before."""
    kept = _sor_rounds(_positions(df, id_col), id_col, k, s, passes, knn)
    return df.join(kept.select(id_col), id_col, "left_semi")


def largest_members(df: DataFrame, id_col: str, radius: float, keep: int) -> DataFrame:
    """Ids in the ``keep`` largest clusters; ties go to the smaller label."""
    labelled = pin(cc.radius_components(df, id_col, XYZ, radius))
    top = cc.largest(cc.component_sizes(labelled), keep)
    return labelled.join(top.select("component"), "component", "left_semi").select(id_col)


def keep_largest(df: DataFrame, id_col: str, radius: float, keep: int) -> DataFrame:
    return df.join(largest_members(df, id_col, radius, keep), id_col, "left_semi")


def clean(df: DataFrame, cfg: CleanConfig, id_col: str = "splat_id", **knn) -> DataFrame:
    """All filters in their fixed order."""
    kept = prefilter(df, cfg)
    if cfg.passes <= 0 and not cfg.connected:
        return kept
    slim = _sor_rounds(_positions(kept, id_col), id_col, cfg.neighbors, cfg.std_factor, cfg.passes, knn)
    if cfg.connected and not slim.isEmpty():
        radius = cfg.connect_radius
        if radius <= 0:
            radius = auto_radius(slim, id_col, XYZ, seed=cfg.seed, **knn)
        if radius:
            slim = largest_members(slim, id_col, radius, cfg.keep_components)
    return df.join(slim.select(id_col), id_col, "left_semi")


def clean_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Original, removed and remaining counts with percentages."""
    n = before.agg(F.count(F.lit(1)).alias("original")).withColumn(
        "remaining", after.agg(F.count(F.lit(1))).scalar()
    )
    return n.withColumn("removed", F.col("original") - F.col("remaining")).select(
        "original", "removed", "remaining",
        percent(F.col("removed"), F.col("original")).alias("removed_pct"),
        percent(F.col("remaining"), F.col("original")).alias("remaining_pct"),
    )


#: The settings of a sweep.
SWEEP = ("default", "gentle", "aggressive", "connected")


def _stacked(runs: dict[str, DataFrame], configs: dict[str, CleanConfig], id_col: str) -> DataFrame:
    """``(pid, g, id, x, y, z)``: every splat once for each setting whose filters it passes, from one scan of each run.

    Group ``g`` is the run's place times the number of settings, plus the setting's.
    """
    stacked = None
    for at, cloud in enumerate(runs.values()):
        passes = [F.when(failing_filter(cloud, cfg).isNull(), F.lit(at * len(configs) + i)) for i, cfg in enumerate(configs.values())]
        rows = cloud.select(
            F.col(id_col).cast("bigint").alias("id"), *[F.col(c).cast("double").alias(c) for c in XYZ], F.explode(F.array(*passes)).alias("g"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return pin(stacked.filter("g IS NOT NULL").withColumn("pid", F.monotonically_increasing_id()))


def _apart(points: DataFrame) -> Column:
    """A fourth coordinate that keeps every group farther from all others than its own points are from each other."""
    bounds = points.agg(*[(F.max(c) - F.min(c)).alias(c) for c in XYZ]).first()
    span = 2.0 ** math.ceil(math.log2(1 + sum(b or 0.0 for b in bounds)) + 1)
    return F.col("g") * F.lit(span)


def _of_setting(configs: dict[str, CleanConfig], field: str) -> Column:
    """A setting's value in the rows of its groups."""
    values = F.array(*[F.lit(getattr(cfg, field)) for cfg in configs.values()])
    return F.get(values, (F.col("g") % len(configs)).cast("int"))


def clean_sweep(
    runs: dict[str, DataFrame], configs: dict[str, CleanConfig] | None = None, id_col: str = "splat_id", **knn
) -> DataFrame:
    """Every run output under every cleaning setting, one summary row each: what ``clean`` leaves of each.

    All runs and settings are groups of one cloud. An outlier pass measures all
    groups in one search, in which a fourth coordinate keeps them apart, and has
    a limit per group; clusters are found in one graph, by group, at each group's
    own radius. The number of jobs depends on the passes, not on the groups.
    """
    configs = configs or {k: CLEAN_CONFIGS[k] for k in SWEEP}
    spark = next(iter(runs.values())).sparkSession
    left = _stacked(runs, configs, id_col)
    space = [*XYZ, "apart"]
    left = left.withColumn("apart", _apart(left))
    for turn in range(max(cfg.passes for cfg in configs.values())):
        sizes = left.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        # A group of no more points than neighbours is kept as it is.
        todo = pin(left.join(sizes, "g").filter((_of_setting(configs, "passes") > turn) & (F.col("n") > _of_setting(configs, "neighbors"))).drop("n"))
        dropped = None
        for k in sorted({cfg.neighbors for cfg in configs.values()}):
            mine = todo.filter(_of_setting(configs, "neighbors") == k)
            means = pin(knn_mean(mine, "pid", space, k, **knn).join(mine.select("pid", "g"), "pid"))
            limits = means.groupBy("g").agg((F.avg("mean_dist") + _of_setting(configs, "std_factor") * F.stddev_pop("mean_dist")).alias("limit"))
            far = means.join(limits, "g").filter(F.col("mean_dist") > F.col("limit")).select("pid")
            dropped = far if dropped is None else dropped.unionByName(far)
        left = pin(left.join(dropped, "pid", "left_anti"))
    joined = left.filter(_of_setting(configs, "connected"))
    if any(cfg.connected for cfg in configs.values()):
        kept = left.filter(~_of_setting(configs, "connected")).select("pid", "g").unionByName(_largest_by_group(pin(joined), space, configs, knn))
    else:
        kept = left.select("pid", "g")
    before = None
    for at, cloud in enumerate(runs.values()):
        n = cloud.agg(F.count(F.lit(1)).alias("input_splats")).withColumn("at", F.lit(at))
        before = n if before is None else before.unionByName(n)
    names = [(at, at * len(configs) + i, run, name) for at, run in enumerate(runs) for i, name in enumerate(configs)]
    groups = spark.createDataFrame(names, "at int, g int, source string, clean_config string")
    after = kept.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    return groups.join(before, "at").join(after, "g", "left").select(
        "source", "clean_config", "input_splats", F.coalesce("n", F.lit(0)).alias("output_splats")
    ).withColumn("removed_pct", percent(F.col("input_splats") - F.col("output_splats"), F.col("input_splats")))


def _largest_by_group(points: DataFrame, space: list[str], configs: dict[str, CleanConfig], knn: dict) -> DataFrame:
    """``(pid, g)`` of the largest clusters of every group; ties go to the smaller id. A group without a radius is kept."""
    sizes = points.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    several = points.join(sizes.filter("n > 1").select("g"), "g")
    near = nearest(several, "pid", space, 2, **knn).select(*space, F.try_element_at("near", F.lit(2))["d"].alias("nn_dist"))
    middles = grouped_median(pin(several.join(near, space).select("g", "nn_dist")), ["g"], "nn_dist")
    given = _of_setting(configs, "connect_radius")
    radii = sizes.join(middles, "g", "left").select("g", F.when(given > 0, given).otherwise(3.0 * F.col("median")).alias("radius"))
    sized = pin(points.join(radii, "g"))
    scaled = sized.filter("radius > 0").select("pid", "g", "id", *[(F.col(c) / F.col("radius")).alias(c) for c in XYZ])
    found = cc.radius_components(scaled.select("pid", "g", *XYZ), "pid", XYZ, 1.0, by=["g"]).join(scaled.select("pid", "g", "id"), "pid")
    found = pin(found)
    order = Window.partitionBy("g").orderBy(F.desc("n_nodes"), "label")
    top = found.groupBy("g", "component").agg(F.count(F.lit(1)).alias("n_nodes"), F.min("id").alias("label")).withColumn(
        "place", F.row_number().over(order)).filter(F.col("place") <= _of_setting(configs, "keep_components")).select("component")
    kept = found.join(top, "component", "left_semi").select("pid", "g")
    return kept.unionByName(sized.filter("radius IS NULL OR NOT radius > 0").select("pid", "g"))
