"""Exact nearest neighbours by spatial partitions.

Points are split into boxes of about equal size (cut positions from a bounded
sample, as a range partitioner does). Round one answers every location inside
its own box. A location whose found radius reaches other boxes is sent to
those, and only those, in round two; the candidates are then merged. Equal
coordinates are one query, and only the first ``m`` ids of a location are
candidates, so a spot shared by a third of all points costs no more than ``m``
of them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.operators.ranks import middle
from reefgrid.session import pin

BOX_ROWS = 20_000
MAX_BOXES = 65_536
SAMPLE_PER_BOX = 16
BUCKET_ROWS = 32
BLOCK_QUERIES = 128


class Boxes:
    """A complete binary tree of axis cuts over points, and the extents of its leaves."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.depth = max(0, math.ceil(math.log2(max(leaves, 1))))
        inner = 2**self.depth - 1
        self.axis, self.cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        groups = {0: sample}
        for node in range(inner):
            part = groups.pop(node)
            if len(part):
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                values = part[:, axis]
                cut = np.median(values)
                if cut == values.min() and cut < values.max():
                    cut = values[values > cut].min()  # a tied minimum must not leave one side empty
                self.axis[node], self.cut[node] = axis, cut
            right = part[:, self.axis[node]] >= self.cut[node]
            groups[2 * node + 1], groups[2 * node + 2] = part[~right], part[right]

    @property
    def leaves(self) -> int:
        return 2**self.depth

    def locate(self, xyz: np.ndarray) -> np.ndarray:
        node = np.zeros(len(xyz), dtype=np.int64)
        for _ in range(self.depth):
            right = xyz[np.arange(len(xyz)), self.axis[node]] >= self.cut[node]
            node = 2 * node + 1 + right
        return node - (self.leaves - 1)

    def fit(self, leaf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """Set extents of all nodes from those of the occupied leaves."""
        n, d = self.leaves, lo.shape[1]
        self.lo, self.hi = np.full((2 * n - 1, d), np.inf), np.full((2 * n - 1, d), -np.inf)
        self.lo[n - 1 + leaf], self.hi[n - 1 + leaf] = lo, hi
        for node in range(n - 2, -1, -1):
            self.lo[node] = np.minimum(self.lo[2 * node + 1], self.lo[2 * node + 2])
            self.hi[node] = np.maximum(self.hi[2 * node + 1], self.hi[2 * node + 2])

    def touched(self, xyz: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, leaf) of balls that reach a leaf's extent."""
        row, node = np.arange(len(xyz)), np.zeros(len(xyz), dtype=np.int64)
        for level in range(self.depth + 1):
            gap = np.maximum(np.maximum(self.lo[node] - xyz[row], xyz[row] - self.hi[node]), 0.0)
            near = np.sqrt((gap * gap).sum(axis=1)) <= radius[row]
            row, node = row[near], node[near]
            if level < self.depth:
                row, node = np.repeat(row, 2), np.stack([2 * node + 1, 2 * node + 2], axis=1).ravel()
        return row, node - (self.leaves - 1)


def _nearest(data: np.ndarray, ids: np.ndarray, queries: np.ndarray, bound: np.ndarray, m: int):
    """The ``m`` nearest data rows per query within its bound, by (distance, id).

    Data go into small buckets. The queries of a bucket first look at home,
    which bounds their search radius, then at the buckets within that radius.
    """
    dist, near = np.full((len(queries), m), np.inf), np.full((len(queries), m), -1, dtype=np.int64)
    if not len(data) or not len(queries):
        return dist, near
    tree = Boxes(data, 2 ** int(math.log2(max(1, len(data) // max(BUCKET_ROWS, m + m // 2)))))
    bucket = tree.locate(data)
    order = np.argsort(bucket, kind="stable")
    data, ids, bucket = data[order], ids[order], bucket[order]
    used, first = np.unique(bucket, return_index=True)
    tree.fit(used, np.minimum.reduceat(data, first), np.maximum.reduceat(data, first))
    start = np.searchsorted(bucket, np.arange(tree.leaves + 1))
    base, half = tree.leaves - 1, tree.depth // 2
    width = 2 ** (tree.depth - half)  # buckets under one node of the middle level
    middle = np.arange(2**half) + 2**half - 1

    def near_nodes(lo, hi, nodes, radius):
        gap = np.maximum(np.maximum(tree.lo[nodes] - hi, lo - tree.hi[nodes]), 0.0)
        return np.sqrt((gap * gap).sum(axis=1)) <= radius

    def spans(block, rows):
        total = np.zeros((len(block), len(rows)))
        for axis in range(data.shape[1]):
            step = queries[block, axis][:, None] - data[rows, axis][None, :]
            total += step * step
        return np.sqrt(total)

    def closest(d, rows):
        """First m columns per row by (distance, id)."""
        if d.shape[1] > m:
            pick = np.argpartition(d, m - 1, axis=1)[:, :m]
            edge = np.take_along_axis(d, pick, axis=1).max(axis=1)
            tied = np.flatnonzero((d <= edge[:, None]).sum(axis=1) > m)
            for r in tied:  # more rows at the edge distance than places: smallest ids first
                inside = np.flatnonzero(d[r] <= edge[r])
                pick[r] = inside[np.lexsort((ids[rows[inside]], d[r, inside]))[:m]]
        else:
            pick = np.broadcast_to(np.arange(d.shape[1]), d.shape)
        found, names = np.take_along_axis(d, pick, axis=1), ids[rows[pick]]
        turn = np.lexsort((names, found), axis=1)
        return np.take_along_axis(found, turn, axis=1), np.take_along_axis(names, turn, axis=1)

    home = tree.locate(queries)
    by_home = np.argsort(home, kind="stable")
    edges = np.append(np.unique(home[by_home], return_index=True)[1], len(home))
    for a, b in zip(edges[:-1], edges[1:]):
        for c in range(a, b, BLOCK_QUERIES):
            block = by_home[c : min(c + BLOCK_QUERIES, b)]
            cap, q = bound[block], queries[block]
            lo, hi = q.min(axis=0), q.max(axis=0)
            up, leaf = 0, home[block[0]]
            while up < tree.depth and start[(leaf >> up) + 1 << up] - start[leaf >> up << up] < m:
                up += 1
            own = np.arange(start[leaf >> up << up], start[(leaf >> up) + 1 << up])
            radius = cap.max()
            if len(own) >= m:
                radius = min(radius, np.partition(spans(block, own), m - 1, axis=1)[:, m - 1].max())
            over = np.flatnonzero(near_nodes(lo, hi, middle, radius))
            leaves = (over[:, None] * width + np.arange(width)[None, :]).ravel()
            leaves = leaves[near_nodes(lo, hi, base + leaves, radius)]
            if not len(leaves):
                continue
            rows = np.concatenate([np.arange(start[i], start[i + 1]) for i in leaves])
            if len(rows):
                d, names = closest(spans(block, rows), rows)
                d = np.where(d <= cap[:, None], d, np.inf)
                dist[block, : d.shape[1]], near[block, : d.shape[1]] = d, names
    near[np.isinf(dist)] = -1
    return dist, near


def _boxes_for(points: DataFrame, coords: list[str], box_rows: int) -> tuple[Boxes, int]:
    """Boxes of about ``box_rows`` points, and the number of points."""
    n = points.count()
    boxes = min(MAX_BOXES, max(1, math.ceil(n / box_rows)))
    if boxes == 1:
        return Boxes(np.empty((0, len(coords))), 1), n
    # A bounded sample places the cuts; any cuts give the same answer.
    want = boxes * SAMPLE_PER_BOX
    share = min(1.0, 1.5 * want / n)
    mixed = F.pmod(F.xxhash64(*coords), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = points.filter(mixed).select(*coords).limit(want * 2).toPandas().to_numpy(dtype=float)
    return Boxes(sample, boxes), n


def nearest(
    df: DataFrame,
    id_col: str,
    coords: list[str],
    m: int,
    max_dist: float | None = None,
    queries: DataFrame | None = None,
    box_rows: int = BOX_ROWS,
) -> DataFrame:
    """Per location, its ``m`` nearest points (itself included) as ``near``.

    ``near`` is an array of ``(d, id)`` in order of distance, then id. Locations
    are those of ``df``, or those of ``queries`` when given.
    """
    at = [F.col(c).cast("double").alias(c) for c in coords]
    first = Window.partitionBy(*coords).orderBy("pid")
    slots = (
        df.select(*at, F.col(id_col).cast("bigint").alias("pid"))
        .withColumn("slot", F.row_number().over(first)).filter(F.col("slot") <= m)
    )
    slots = pin(slots)
    boxes, n = _boxes_for(slots, coords, box_rows)
    # Tasks follow the points, not the boxes: small boxes go many to a task, for each task reports to the driver.
    tasks = min(boxes.leaves, max(math.ceil(n / BOX_ROWS), 2 * df.sparkSession.sparkContext.defaultParallelism))

    @F.pandas_udf("int")
    def box_of(*columns: pd.Series) -> pd.Series:
        return pd.Series(boxes.locate(np.column_stack(columns)).astype(np.int32))

    where = box_of(*coords) if boxes.depth else F.lit(0)
    data = slots.withColumn("box", where)
    if boxes.depth:
        data = pin(data)
    # One row per box, at most MAX_BOXES of them.
    extents = data.groupBy("box").agg(
        *[F.min(c).alias(f"lo_{c}") for c in coords], *[F.max(c).alias(f"hi_{c}") for c in coords]
    ).toPandas()
    boxes.fit(
        extents["box"].to_numpy(dtype=np.int64),
        extents[[f"lo_{c}" for c in coords]].to_numpy(dtype=float),
        extents[[f"hi_{c}" for c in coords]].to_numpy(dtype=float),
    )
    limit = float("inf") if max_dist is None else float(max_dist)
    if queries is None:
        asked = data.filter(F.col("slot") == 1).select(*coords, "box")
    else:
        asked = queries.select(*at).distinct().withColumn("box", where)
    asked = asked.select(*[F.col(c).alias(c) for c in (*coords, "box")], F.lit(limit).alias("bound"))

    fields = ", ".join(f"{c} double" for c in coords)
    out_schema = f"{fields}, dists array<double>, ids array<bigint>, others array<int>"

    def answer(key, points: pd.DataFrame, wanted: pd.DataFrame, spread: bool) -> pd.DataFrame:
        if not len(wanted):
            return pd.DataFrame(columns=[*coords, "dists", "ids", "others"])
        if not len(points):
            points = pd.DataFrame(columns=[*coords, "pid"])
        q = wanted[coords].to_numpy(dtype=float)
        dist, near = _nearest(
            points[coords].to_numpy(dtype=float), points["pid"].to_numpy(dtype=np.int64),
            q, wanted["bound"].to_numpy(dtype=float), m,
        )
        out = wanted[coords].reset_index(drop=True)
        found = np.isfinite(dist).sum(axis=1)
        out["dists"] = [d[:n] for d, n in zip(dist, found)]
        out["ids"] = [i[:n] for i, n in zip(near, found)]
        others = [[] for _ in range(len(q))]
        if spread and boxes.depth and len(q):
            reach = np.where(found == m, dist[:, m - 1], limit)
            row, leaf = boxes.touched(q, reach)
            for r, b in zip(row[leaf != key[0]], leaf[leaf != key[0]]):
                others[r].append(b)
        out["others"] = others
        return out

    def home_round(key, points, wanted):
        return answer(key, points, wanted, True)

    def away_round(key, points, wanted):
        return answer(key, points, wanted, False)

    def by_box(df: DataFrame):
        # The work is in the boxes, not in their bytes, so they must not be packed together by size.
        return (df.repartition(tasks, "box") if boxes.depth else df).groupBy("box")

    pts = data.select(*coords, "pid", "box")
    home = by_box(pts).cogroup(by_box(asked)).applyInPandas(home_round, out_schema)
    candidates = F.arrays_zip(F.col("dists").alias("d"), F.col("ids").alias("id")).alias("near")
    if not boxes.depth:
        return home.select(*coords, candidates)
    home = pin(home)
    last = F.when(F.size("dists") == m, F.element_at("dists", -1)).otherwise(F.lit(limit))
    sent = home.select(*coords, F.explode("others").alias("box"), last.alias("bound"))
    away = by_box(pts).cogroup(by_box(sent)).applyInPandas(away_round, out_schema)
    done = home.filter(F.size("others") == 0).select(*coords, candidates)
    open_ = home.filter(F.size("others") > 0).select(*coords, candidates)
    merged = open_.unionByName(away.select(*coords, candidates)).groupBy(*coords).agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, m).alias("near")
    )
    return done.unionByName(merged)


def knn_mean(df: DataFrame, id_col: str, coords: list[str], k: int = 20, **options) -> DataFrame:
    """Mean distance of each point to its ``k`` nearest others; NULL with fewer than k others."""
    near = nearest(df, id_col, coords, k + 1, **options)
    # The first entry is the point itself (or a twin at the same distance zero).
    dists = F.slice(F.transform("near", lambda e: e["d"]), 2, k)
    total = F.aggregate(dists, F.lit(0.0), lambda acc, d: acc + d)
    means = near.select(*coords, F.when(F.size("near") == k + 1, total / k).alias("mean_dist"))
    points = df.select(F.col(id_col), *[F.col(c).cast("double").alias(c) for c in coords])
    return points.join(means, coords).select(id_col, "mean_dist")


def auto_radius(
    df: DataFrame, id_col: str, coords: list[str], seed: int = 42, sample: int | None = None, **options
) -> float | None:
    """Three times the median nearest-neighbour distance of all points, or of a seeded sample of ``sample`` points.

    None when there are fewer than two points.
    """
    asked = df.select(id_col, *coords)
    if sample is not None:
        asked = pin(asked.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(sample))
    near = nearest(df, id_col, coords, 2, queries=asked, **options)
    spots = near.select(*coords, F.try_element_at("near", F.lit(2))["d"].alias("nn_dist"))
    at = asked.select(*[F.col(c).cast("double").alias(c) for c in coords])
    found = middle(pin(at.join(spots, coords).select("nn_dist")), "nn_dist")
    return None if found is None else found.median * 3.0
