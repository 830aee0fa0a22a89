"""Queries on splat clouds: appearance filters, outliers, clusters."""

from __future__ import annotations


from pyspark.sql import functions as F

from reefgrid.functions import splat
from reefgrid.operators import clean, components
from reefgrid.operators.knn import auto_radius, knn_mean
from reefgrid.plans.base import Registry, rnd
from reefgrid.plans.oracle_views import with_views
from reefgrid.plans.views import Survey

query = Registry()


@query("splat_opacity", with_views("look") + "SELECT splat_id, round(opacity, 6) AS opacity FROM look")
def splat_opacity(s: Survey):
    return s.splats().select("splat_id", F.round(splat.opacity(F.col("opacity")), 6).alias("opacity"))


@query("splat_scale", with_views("look") + "SELECT splat_id, round(scale, 6) AS max_scale FROM look")
def splat_scale(s: Survey):
    df = s.splats()
    scales = [F.col(c) for c in clean.scale_columns(df)]
    return df.select("splat_id", F.round(splat.max_scale(scales), 6).alias("max_scale"))


@query("splat_rgb_mean", with_views("look") + """
    SELECT round(avg(r), 6) AS mean_red, round(avg(g), 6) AS mean_green, round(avg(b), 6) AS mean_blue FROM look""")
def splat_rgb_mean(s: Survey):
    return clean.mean_rgb(s.splats()).select(*[rnd(f"mean_{c}") for c in ("red", "green", "blue")])


@query("splat_hsv", with_views("hsv") + "SELECT splat_id, round(h, 6) AS h, round(s, 6) AS s, round(v, 6) AS v FROM hsv")
def splat_hsv(s: Survey):
    hsv = clean.with_hsv(s.splats())
    return hsv.select("splat_id", *[F.round(f"hsv.{c}", 6).alias(c) for c in "hsv"])


@query("hue_histogram", with_views("hsv") + """
    , c AS (SELECT least(floor(h / 15), 23)::INTEGER AS bin, count(*) AS n FROM hsv WHERE s > 0.1 GROUP BY 1)
    SELECT b::INTEGER AS bin, coalesce(n, 0) AS n_splats, round(coalesce(n, 0) * 100.0::DOUBLE / (SELECT sum(n) FROM c), 6) AS pct
    FROM range(0, 24) t(b) LEFT JOIN c ON c.bin = b""")
def hue_histogram(s: Survey):
    return clean.hue_histogram(s.splats()).select("bin", "n_splats", rnd("pct"))


BOX = (-0.2, -0.2, -0.2, 0.2, 0.15, 0.2)
BOX_SQL = "x BETWEEN -0.2 AND 0.2 AND y BETWEEN -0.2 AND 0.15 AND z BETWEEN -0.2 AND 0.2"


@query("filter_bbox", with_views("splats") + f"SELECT splat_id FROM splats WHERE {BOX_SQL}")
def filter_bbox(s: Survey):
    return clean.bbox(s.splats(), BOX).select("splat_id")


@query("filter_opacity", with_views("look") + "SELECT splat_id FROM look WHERE opacity >= 0.05")
def filter_opacity(s: Survey):
    return clean.prefilter(s.splats(), clean.CleanConfig(opacity_min=0.05)).select("splat_id")


@query("filter_hue_remove", with_views("hsv") + """
    SELECT splat_id FROM hsv WHERE NOT (s >= 0.3 AND v >= 0.2 AND (h >= 300 OR h <= 40))""")
def filter_hue_remove(s: Survey):
    cfg = clean.CleanConfig(remove_hue=(300.0, 40.0), sat_min=0.3, val_min=0.2)
    return clean.prefilter(s.splats(), cfg).select("splat_id")


@query("filter_hue_keep", with_views("hsv") + """
    SELECT splat_id FROM hsv WHERE NOT (s >= 0.2 AND NOT (h BETWEEN 30 AND 160))""")
def filter_hue_keep(s: Survey):
    cfg = clean.CleanConfig(keep_hue=(30.0, 160.0), sat_min=0.2)
    return clean.prefilter(s.splats(), cfg).select("splat_id")


@query("filter_scale", with_views("look") + "SELECT splat_id FROM look WHERE scale <= 0.5")
def filter_scale(s: Survey):
    return clean.prefilter(s.splats(), clean.CleanConfig(scale_max=0.5)).select("splat_id")


ALL_FILTERS = clean.CleanConfig(
    bbox=BOX, opacity_min=0.05, remove_hue=(180.0, 240.0), keep_hue=(0.0, 320.0), sat_min=0.3, scale_max=0.5
)


@query("prefilter_attribution", with_views("hsv") + f"""
    SELECT CASE WHEN NOT ({BOX_SQL}) THEN 'bbox' WHEN opacity < 0.05 THEN 'opacity'
        WHEN s >= 0.3 AND h BETWEEN 180 AND 240 THEN 'remove_hue' WHEN s >= 0.3 AND NOT (h BETWEEN 0 AND 320) THEN 'keep_hue'
        WHEN scale > 0.5 THEN 'scale' ELSE 'kept' END AS reason, count(*) AS n_splats FROM hsv GROUP BY 1""")
def prefilter_attribution(s: Survey):
    return clean.prefilter_report(s.splats(), ALL_FILTERS)


def _knn_sql(source: str, out: str, k: int = 20) -> str:
    """Brute-force mean neighbour distance over a splat relation."""
    return (
        f"{out}_d AS (SELECT a.splat_id, sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)+power(a.z-b.z,2)) AS d, "
        f"row_number() OVER (PARTITION BY a.splat_id ORDER BY power(a.x-b.x,2)+power(a.y-b.y,2)+power(a.z-b.z,2), b.splat_id) AS rn "
        f"FROM {source} a JOIN {source} b ON a.splat_id <> b.splat_id), "
        f"{out} AS (SELECT splat_id, avg(d) AS m FROM {out}_d WHERE rn <= {k} GROUP BY 1)"
    )


def _sor_sql(source: str, out: str, s: float = 2.0) -> str:
    return (
        f"{_knn_sql(source, out + '_m')}, {out} AS (SELECT * FROM {source} WHERE splat_id IN (SELECT splat_id FROM {out}_m "
        f"WHERE m <= (SELECT avg(m) + {s} * stddev_pop(m) FROM {out}_m)))"
    )


@query("knn_mean", with_views("splats") + ", " + _knn_sql("splats", "k") + "SELECT splat_id, round(m, 6) AS mean_dist FROM k")
def knn_mean_query(s: Survey):
    return knn_mean(s.splats(), "splat_id", clean.XYZ).select("splat_id", rnd("mean_dist"))


@query("knn_mean_two_rounds", with_views("splats") + ", " + _knn_sql("splats", "k", 8) + "SELECT splat_id, round(m, 6) AS mean_dist FROM k")
def knn_mean_two_rounds(s: Survey):
    """Small boxes, so that answers cross box borders at every scale."""
    return knn_mean(s.splats(), "splat_id", clean.XYZ, 8, box_rows=100).select("splat_id", rnd("mean_dist"))


@query("knn_mean_points")
def knn_mean_points(s: Survey):
    """The same over the sparse cloud; brute force in SQL is too slow there."""
    return knn_mean(s.points(), "point_id", clean.XYZ, 20, box_rows=8_000).select("point_id", rnd("mean_dist"))


@query("sor_one_pass", with_views("splats") + ", " + _sor_sql("splats", "p1") + "SELECT splat_id FROM p1")
def sor_one_pass(s: Survey):
    return clean.sor_pass(s.splats()).select("splat_id")


@query("sor_three_pass", with_views("splats") + ", " + ", ".join(
    [_sor_sql("splats", "p1"), _sor_sql("p1", "p2"), _sor_sql("p2", "p3")]) + "SELECT splat_id FROM p3")
def sor_three_pass(s: Survey):
    return clean.sor(s.splats()).select("splat_id")


def _radius_sql(source: str) -> str:
    return (
        f"nn AS (SELECT a.splat_id, min(sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)+power(a.z-b.z,2))) AS d "
        f"FROM {source} a JOIN {source} b ON a.splat_id <> b.splat_id GROUP BY 1), rad AS (SELECT median(d) AS nn, 3 * median(d) AS r FROM nn)"
    )


def _component_sql(source: str) -> str:
    """Components by recursive reach over the radius graph; for clouds of at most 50 000 splats."""
    return (
        f"{_radius_sql(source)}, edges AS (SELECT a.splat_id AS u, b.splat_id AS v FROM {source} a JOIN {source} b "
        f"ON a.splat_id <> b.splat_id AND sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)+power(a.z-b.z,2)) <= (SELECT r FROM rad)), "
        f"reach(u, v) AS (SELECT splat_id, splat_id FROM {source} UNION SELECT reach.u, edges.v FROM reach JOIN edges ON edges.u = reach.v), "
        f"lab AS (SELECT u AS splat_id, min(v) AS component FROM reach GROUP BY 1)"
    )


@query("auto_radius", with_views("splats") + ", " + _radius_sql("splats") + "SELECT (SELECT count(*) FROM splats) AS n_splats, round(r, 6) AS radius FROM rad")
def auto_radius_query(s: Survey):
    radius = auto_radius(s.splats(), "splat_id", clean.XYZ)
    return s.splats().agg(F.count(F.lit(1)).alias("n_splats"), F.round(F.lit(radius), 6).alias("radius"))


def _labelled(s: Survey):
    radius = auto_radius(s.splats(), "splat_id", clean.XYZ)
    return components.radius_components(s.splats(), "splat_id", clean.XYZ, radius)


@query("component_labels", with_views("splats", recursive=True) + ", " + _component_sql("splats") + "SELECT splat_id, component FROM lab")
def component_labels(s: Survey):
    return _labelled(s)


@query("component_sizes", with_views("splats", recursive=True) + ", " + _component_sql("splats") + """
    , sizes AS (SELECT component, count(*) AS n FROM lab GROUP BY 1),
    ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, component) AS rn FROM sizes)
    SELECT CAST(component AS VARCHAR) AS label, CAST(1 AS BIGINT) AS n_components, n AS n_nodes FROM ranked WHERE rn <= 10
    UNION ALL SELECT 'rest', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM ranked WHERE rn > 10""")
def component_sizes(s: Survey):
    return components.size_report(components.component_sizes(_labelled(s)))


@query("component_keep", with_views("splats", recursive=True) + ", " + _component_sql("splats") + """
    SELECT splat_id FROM lab WHERE component IN (SELECT component FROM lab GROUP BY 1 ORDER BY count(*) DESC, component LIMIT 2)""")
def component_keep(s: Survey):
    df = s.splats()
    radius = auto_radius(df, "splat_id", clean.XYZ)
    return clean.keep_largest(df, "splat_id", radius, 2).select("splat_id")


@query("clean_connected", with_views("look", recursive=True) + ", pre AS (SELECT * FROM look WHERE opacity >= 0.05), " + ", ".join(
    [_sor_sql("pre", "p1"), _sor_sql("p1", "p2"), _sor_sql("p2", "p3"), _component_sql("p3")]) + """
    SELECT splat_id FROM lab WHERE component IN (SELECT component FROM lab GROUP BY 1 ORDER BY count(*) DESC, component LIMIT 1)""")
def clean_connected(s: Survey):
    return clean.clean(s.splats(), clean.CLEAN_CONFIGS["connected"]).select("splat_id")


@query("clean_summary", with_views("look") + ", pre AS (SELECT * FROM look WHERE opacity >= 0.1 AND scale <= 0.5), " + ", ".join(
    [_sor_sql("pre", "p1", 1.5), _sor_sql("p1", "p2", 1.5), _sor_sql("p2", "p3", 1.5)]) + """
    SELECT (SELECT count(*) FROM look) AS original, (SELECT count(*) FROM look) - (SELECT count(*) FROM p3) AS removed,
           (SELECT count(*) FROM p3) AS remaining, round((SELECT count(*) FROM p3) * 100.0::DOUBLE / (SELECT count(*) FROM look), 6) AS remaining_pct""")
def clean_summary(s: Survey):
    df = s.splats()
    return clean.clean_summary(df, clean.clean(df, clean.CLEAN_CONFIGS["aggressive"])).select("original", "removed", "remaining", rnd("remaining_pct"))


@query("clean_sweep", with_views("look", recursive=True) + """, d AS (SELECT * FROM look WHERE opacity >= 0.05), g AS (SELECT * FROM look WHERE opacity >= 0.03),
    a AS (SELECT * FROM look WHERE opacity >= 0.1 AND scale <= 0.5), """ + ", ".join(
    [_sor_sql("d", "d1"), _sor_sql("d1", "d2"), _sor_sql("d2", "d3"), _sor_sql("g", "g1", 2.5), _sor_sql("g1", "g2", 2.5),
     _sor_sql("a", "a1", 1.5), _sor_sql("a1", "a2", 1.5), _sor_sql("a2", "a3", 1.5), _component_sql("d3")]) + """
    , n AS (SELECT count(*) AS n FROM look)
    SELECT 'embeddings' AS source, 'default' AS clean_config, (SELECT n FROM n) AS input_splats, (SELECT count(*) FROM d3) AS output_splats
    UNION ALL SELECT 'embeddings', 'gentle', (SELECT n FROM n), (SELECT count(*) FROM g2)
    UNION ALL SELECT 'embeddings', 'aggressive', (SELECT n FROM n), (SELECT count(*) FROM a3)
    UNION ALL SELECT 'embeddings', 'connected', (SELECT n FROM n),
        (SELECT count(*) FROM lab WHERE component IN (SELECT component FROM lab GROUP BY 1 ORDER BY count(*) DESC, component LIMIT 1))""")
def clean_sweep(s: Survey):
    return clean.clean_sweep({"embeddings": s.splats()}).drop("removed_pct")


def _staged(name: str, factor: float, passes: int, keep: int | None = None, view: str = "look", where: str = "opacity >= 0.05"):
    """A query of one named cleaning setting, all of it."""
    rounds = [_sor_sql("pre" if i == 0 else f"p{i}", f"p{i + 1}", factor) for i in range(passes)]
    last = f"SELECT splat_id FROM p{passes}"
    if keep:
        rounds.append(_component_sql(f"p{passes}"))
        last = f"SELECT splat_id FROM lab WHERE component IN (SELECT component FROM lab GROUP BY 1 ORDER BY count(*) DESC, component LIMIT {keep})"

    @query(f"clean_{name}", with_views(view, recursive=bool(keep)) + f", pre AS (SELECT * FROM {view} WHERE {where}), " + ", ".join(rounds) + " " + last)
    def run(s: Survey):
        return clean.clean(s.splats(), clean.CLEAN_CONFIGS[name]).select("splat_id")


_staged("stage1", 3.5, 1)
_staged("stage2", 3.0, 2)
_staged("stage3", 3.0, 2, keep=5)
_staged("maritime", 1.5, 3, keep=5, view="hsv", where="opacity >= 0.1 AND NOT (s >= 0.3 AND h BETWEEN 180 AND 240)")
