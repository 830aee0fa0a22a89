"""Connected components of graphs and of radius graphs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefgrid.session import pin

FEW_PAIRS = 64
SPLIT = 2  # a finer cut would pair many more boxes per round


def connected_components(edges: DataFrame, a: str, b: str, nodes: DataFrame | None = None) -> DataFrame:
    """``(node, component)`` with the smallest node of each component as its label.

    Alternating large-star and small-star steps (Kiveris et al., SoCC 2014).
    Each step is a minimum per node, which combines map-side, and a join that
    may split a hub's edges. ``nodes`` adds isolated nodes.
    """
    start = edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v"))
    links = pin(start.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct())
    while not _all_stars(links):
        links = pin(_small_star(_large_star(links)))
    labels = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    found = labels.unionByName(roots)
    if nodes is None:
        return found
    ids = nodes.select(F.col(nodes.columns[0]).cast("bigint").alias("node")).distinct()
    return ids.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _all_stars(links: DataFrame) -> bool:
    """True once every node hangs on one root and no root hangs on anything."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("out")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("out"))
    )
    used = ends.groupBy("node").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
    return used.filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("least") == 0))).isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return both.filter(F.col("v") > F.col("u")).join(low, "u").select(
        F.col("v").alias("u"), F.col("low").alias("v")
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = links.groupBy("u").agg(F.min("v").alias("low"))
    moved = links.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = low.select("u", F.col("low").alias("v"))
    return moved.unionByName(own).filter(F.col("u") != F.col("v")).distinct()


def component_sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))


def largest(sizes: DataFrame, n: int) -> DataFrame:
    return sizes.orderBy(F.desc("n_nodes"), "component").limit(n)


def size_report(sizes: DataFrame, top: int = 10) -> DataFrame:
    """The largest components, then one row for all the rest."""
    head = pin(largest(sizes, top))
    rest = sizes.join(head.select("component"), "component", "left_anti").agg(
        F.lit("rest").alias("label"), F.count(F.lit(1)).alias("n_components"),
        F.coalesce(F.sum("n_nodes"), F.lit(0)).alias("n_nodes"),
    )
    return head.select(
        F.col("component").cast("string").alias("label"), F.lit(1).cast("bigint").alias("n_components"), "n_nodes"
    ).unionByName(rest)


def _box(coords: list[str]) -> list[Column]:
    return [F.min(c).alias(f"lo_{c}") for c in coords] + [F.max(c).alias(f"hi_{c}") for c in coords]


def _span(coords: list[str], nearest: bool) -> Column:
    """Least or greatest possible distance between the boxes of sides a and b."""
    gap = "greatest(0D, b_lo_{c} - a_hi_{c}, a_lo_{c} - b_hi_{c})"
    span = "greatest(b_hi_{c} - a_lo_{c}, a_hi_{c} - b_lo_{c})"
    sides = [(gap if nearest else span).format(c=c) for c in coords]
    return F.expr("sqrt(" + " + ".join(f"{d} * {d}" for d in sides) + ")")


def _may_reach(coords: list[str], side: float, radius: float) -> Column:
    """Whether the tight box of cell a can touch cell b's square at all, with slack for rounding."""
    gaps = [f"greatest(0D, b_cell_{c} * {side!r}D - a_hi_{c}, a_lo_{c} - (b_cell_{c} + 1) * {side!r}D)" for c in coords]
    return F.expr("sqrt(" + " + ".join(f"{g} * {g}" for g in gaps) + f") <= {radius * (1 + 1e-6)!r}D")


def _side(df: DataFrame, side: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(f"{side}_{c}") for c in df.columns])


def radius_edges(df: DataFrame, id_col: str, coords: list[str], radius: float, by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Cells of mutually close points and the links between them, each group of ``by`` by itself.

    Points of one grid cell with diagonal below the radius are all connected,
    so cells are the graph's nodes. Whether two cells hold a pair within the
    radius is decided on the tight boxes of their points: surely linked, surely
    apart, or undecided. Undecided pairs of near-empty cells compare their few
    points. All others are cut in ``SPLIT`` along each axis, and only the parts
    that can still hold the closest pair go on: however full a cell is, its
    points are never paired with those of another.
    """
    d, by = len(coords), by or []
    side = radius / math.sqrt(d) * (1 - 1e-6)
    cell = [f"cell_{c}" for c in coords]
    sub = [f"sub_{c}" for c in coords]
    points = df.select(
        F.col(id_col).cast("bigint").alias("pid"), *by, *[F.col(c).cast("double").alias(c) for c in coords]
    ).withColumns({f"cell_{c}": F.floor(F.col(c) / side) for c in coords})
    points = pin(points)
    cells = pin(points.groupBy(*by, *cell).agg(
        F.min("pid").alias("node"), F.count(F.lit(1)).alias("n"), *_box(coords)
    ))

    reach = math.ceil(math.sqrt(d))
    steps = [[]]
    for _ in coords:
        steps = [s + [o] for s in steps for o in range(-reach, reach + 1)]
    ahead = [s for s in steps if s > [0] * d]
    offsets = F.array(*[F.struct(*[F.lit(o).cast("bigint").alias(f"o_{c}") for c, o in zip(coords, s)]) for s in ahead])
    shifted = (
        _side(cells, "a", by)
        .withColumn("_o", F.explode(offsets))
        .withColumns({f"b_cell_{c}": F.col(f"a_cell_{c}") + F.col(f"_o.o_{c}") for c in coords}).drop("_o")
        .filter(_may_reach(coords, side, radius))
    )
    pairs = shifted.join(_side(cells, "b", by), [*by, *[f"b_cell_{c}" for c in coords]])
    bounded = pairs.withColumns({"near": _span(coords, True), "far": _span(coords, False)}).filter(
        F.col("near") <= radius
    )
    boxes = {s: [f"{s}_{end}_{c}" for end in ("lo", "hi") for c in coords] for s in "ab"}
    few = F.col("a_n") * F.col("b_n") <= FEW_PAIRS
    bounded = pin(bounded.select("a_node", "b_node", "near", "far", few.alias("few"), *boxes["a"], *boxes["b"]))
    links = bounded.filter(F.col("far") <= radius).select("a_node", "b_node")
    unsure = bounded.filter(F.col("far") > radius)
    tagged = points.join(cells.select(*by, *cell, "node"), [*by, *cell]).select("node", *coords)
    each = unsure.filter("few").select("a_node", "b_node")
    for s in "ab":
        each = each.join(tagged.select(F.col("node").alias(f"{s}_node"), *[F.col(c).alias(f"{s}_{c}") for c in coords]), f"{s}_node")
    gap = F.expr("sqrt(" + " + ".join(f"(a_{c} - b_{c}) * (a_{c} - b_{c})" for c in coords) + ")")
    links = links.unionByName(each.filter(gap <= radius).select("a_node", "b_node").distinct())
    open_ = unsure.filter(~F.col("few")).select(
        "a_node", "b_node", *[F.lit(0).cast("bigint").alias(f"{s}_{c}") for s in "ab" for c in sub], *boxes["a"], *boxes["b"]
    )

    level = 0
    while not open_.isEmpty():
        level += 1
        involved = open_.select(F.col("a_node").alias("node")).union(open_.select("b_node")).distinct()
        scale = float(SPLIT**level)
        parts = (
            tagged.join(involved, "node", "left_semi")
            .withColumns({
                f"sub_{c}": F.floor((F.col(c) / side - F.floor(F.col(c) / side)) * scale) for c in coords
            })
            .groupBy("node", *sub).agg(*_box(coords))
            .withColumns({f"up_{c}": F.floor(F.col(c) / SPLIT) for c in sub})
        )
        grown = open_
        for s in "ab":
            # Parts of side a that are too far from the whole of b never meet its parts.
            half, grown = _side(parts, s, []), grown.drop(*boxes[s])
            on = [grown[f"{s}_node"] == half[f"{s}_node"]] + [grown[f"{s}_{c}"] == half[f"{s}_up_{c}"] for c in sub]
            grown = grown.join(half, on).drop(grown[f"{s}_node"], *[grown[f"{s}_{c}"] for c in sub]).drop(
                *[f"{s}_up_{c}" for c in sub]
            ).withColumn("near", _span(coords, True)).filter(F.col("near") <= radius)
        judged = pin(grown.withColumn("far", _span(coords, False)))
        best = judged.groupBy("a_node", "b_node").agg(F.min("far").alias("best"))
        sure = best.filter(F.col("best") <= radius).select("a_node", "b_node")
        links = links.unionByName(sure)
        open_ = judged.join(best.filter(F.col("best") > radius), ["a_node", "b_node"]).filter(
            F.col("near") <= F.col("best")
        ).select(*open_.columns)
    return points.join(cells.select(*by, *cell, "node"), [*by, *cell]).select(F.col("pid").alias(id_col), "node"), links


def radius_components(df: DataFrame, id_col: str, coords: list[str], radius: float, by: list[str] | None = None) -> DataFrame:
    """``(id, component)`` of the graph that links points within ``radius`` (inclusive), and of one group of ``by``."""
    members, links = radius_edges(df, id_col, coords, radius, by)
    labels = connected_components(links, "a_node", "b_node", members.select("node"))
    return members.join(labels, "node").select(id_col, "component")
