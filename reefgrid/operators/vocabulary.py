"""A vocabulary tree over descriptors: training, descent, and retrieval through an inverted file.

The tree is grown level by level. Every node divides its descriptors among up to
``branching`` children by Lloyd steps; the centres are rows of a table keyed by
node. Descriptors travel in blocks of one node, so that a node's centres meet
thousands of them in one row, and a step is one aggregation over (node, nearest
child). Nodes of few descriptors are finished, with everything below them, in one
task each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.operators.vocab import capped
from reefgrid.session import pin

# Default vocabulary and retrieval settings.
NUM_WORDS, ITERATIONS, ROUNDS = 262_144, 100, 3
LOOP_PERIOD, LOOP_IMAGES, LOOP_NEIGHBOURS = 10, 100, 5
#: 64 children on each of 3 levels make NUM_WORDS words.
BRANCHING, LEVELS = 64, 3
#: A node of so many descriptors at most is finished in one task (a matter of time only).
LOCAL_ROWS = 100_000
BLOCK_ROWS = 4096
#: Steps end when the cost no longer falls by this part of itself.
SETTLED = 1e-9
#: The words that give a first bound on an image's n-th candidate name at most so many times n images.
PROBE_TIMES = 50
#: Terms of asked images and postings of images that meet in one group (a matter of memory only).
SLICE_TERMS, BLOCK_POSTINGS = 50_000, 1 << 18

_ROWS = "id long, word long, cost double, level int, node long, child int, n long, centre array<double>"


def _nearest(v: np.ndarray, c: np.ndarray, k: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest centres of every vector and their squared distances; the first of equals."""
    which = np.empty((len(v), min(k, len(c))), np.int64)
    far = np.empty(which.shape)
    for at in range(0, len(v), 512):
        apart = np.zeros((len(v[at : at + 512]), len(c)))
        for d in range(v.shape[1]):  # dimension by dimension: equal vectors tie exactly
            apart += (v[at : at + 512, d, None] - c[None, :, d]) ** 2
        order = np.argsort(apart, axis=1, kind="stable")[:, : which.shape[1]] if k > 1 else apart.argmin(axis=1)[:, None]
        which[at : at + 512], far[at : at + 512] = order, np.take_along_axis(apart, order, 1)
    return which, far


def _means(v: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Children that have members, their sizes and the sums of their members."""
    order = np.argsort(near, kind="stable")
    children, first, sizes = np.unique(near[order], return_index=True, return_counts=True)
    return children, sizes, np.add.reduceat(v[order], first)


def _lloyd(v: np.ndarray, c: np.ndarray, iterations: int) -> tuple[np.ndarray, np.ndarray]:
    """Children that are left and their centres, from the seeds ``c``."""
    names, cost, before = np.arange(len(c)), 1e307, 1e308
    for _ in range(iterations):
        if not cost < before * (1 - SETTLED):
            break
        near, far = _nearest(v, c)
        before, cost = cost, float(far.sum())
        kept, sizes, sums = _means(v, near[:, 0])
        names, c = names[kept], sums / sizes[:, None]
    return names, c


def _seeds(ids: np.ndarray, v: np.ndarray, node: int, level: int, seed: int, branching: int) -> np.ndarray:
    """Different vectors of a node, those first whose smallest id hashes lowest."""
    order = np.argsort(ids, kind="stable")
    _, first = np.unique(v[order], axis=0, return_index=True)
    own = ids[order][first]
    ranked = sorted(range(len(own)), key=lambda i: hashlib.md5(f"{own[i]}:{node}:{level}:{seed}".encode()).hexdigest())
    return v[order][first][ranked[:branching]]


def _subtree(level: int, levels: int, branching: int, iterations: int, seed: int):
    """A node's words and centres, on all levels from its own on."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_numpy()
        v = rows.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        words, costs, centres = np.zeros(len(ids), np.int64), np.zeros(len(ids)), []
        todo = [(level, key[0].as_py(), np.arange(len(ids)))]
        while todo:
            depth, node, mine = todo.pop()
            names, c = _lloyd(v[mine], _seeds(ids[mine], v[mine], node, depth, seed, branching), iterations)
            near, far = _nearest(v[mine], c)
            for i, (name, centre) in enumerate(zip(names.tolist(), c)):
                below = mine[near[:, 0] == i]
                centres.append((depth, node, name, len(below), centre))
                if depth + 1 < levels:
                    if len(below):
                        todo.append((depth + 1, node * branching + name, below))
                else:
                    words[below] = node * branching + name
            if depth + 1 == levels:
                costs[mine] = far[:, 0]
        m = len(centres)
        none = lambda kind, k: pa.nulls(k, kind)
        members = [pa.array(ids), pa.array(words), pa.array(costs), none(pa.int32(), len(ids)), none(pa.int64(), len(ids)),
                   none(pa.int32(), len(ids)), none(pa.int64(), len(ids)), none(pa.list_(pa.float64()), len(ids))]
        nodes = [none(pa.int64(), m), none(pa.int64(), m), none(pa.float64(), m),
                 *[pa.array([x[i] for x in centres], k) for i, k in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.float64())))]]
        names = [c.split()[0] for c in _ROWS.split(", ")]
        return pa.concat_tables([pa.Table.from_arrays(members, names), pa.Table.from_arrays(nodes, names)])
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Descriptors sorted by node, up to BLOCK_ROWS of one node in a row."""
    for batch in batches:
        node, ids = batch.column(0).to_numpy(), batch.column(1)
        flat = batch.column(2).flatten().to_numpy()
        dims = len(flat) // max(1, len(node))
        starts = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1]) if len(node) else []
        cuts = sorted({*starts, *range(0, len(node), BLOCK_ROWS)})
        out = [(int(node[a]), ids[a:b].to_pylist(), flat[a * dims : b * dims].tobytes()) for a, b in zip(cuts, [*cuts[1:], len(node)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.list_(pa.int64())), pa.array([r[2] for r in out], pa.binary())],
            ["node", "ids", "vectors"])


def _in_blocks(members: DataFrame) -> DataFrame:
    """``(node, ids, vectors)`` from ``(id, node, v)``, without a shuffle."""
    return members.select("node", "id", "v").sortWithinPartitions("node").mapInArrow(_blocks, "node long, ids array<long>, vectors binary")


def _met(blocks: DataFrame, centres: DataFrame, few: bool = False) -> DataFrame:
    """Blocks with the children of their node, as one row of at most ``branching`` centres; ``few`` centres go to the blocks."""
    per_node = centres.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("child", "centre"))).alias("children"))
    return blocks.join(F.broadcast(per_node) if few else per_node, "node").select("node", "ids", "vectors", "children")


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = np.frombuffer(row["vectors"]).reshape(len(row["ids"]), -1)
    return v, np.array([c["child"] for c in row["children"]]), np.array([c["centre"] for c in row["children"]])


def _step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, child, n, cost, sums)`` of a task's descriptors by nearest child; blocks of one node follow each other."""
    def of(node: int, names: np.ndarray, sizes: np.ndarray, costs: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        kept = np.flatnonzero(sizes)
        return pa.RecordBatch.from_pydict(
            {"node": [node] * len(kept), "child": names[kept].astype(np.int32), "n": sizes[kept], "cost": costs[kept], "sums": list(sums[kept])})

    now = None
    for batch in batches:
        for row in batch.to_pylist():
            v, names, c = _read(row)
            if now is None or now[0] != row["node"]:
                if now is not None:
                    yield of(*now)
                now = row["node"], names, np.zeros(len(c), np.int64), np.zeros(len(c)), np.zeros(c.shape)
            near, far = _nearest(v, c)
            kept, sizes, sums = _means(v, near[:, 0])
            now[2][kept] += sizes
            now[3][:] += np.bincount(near[:, 0], far[:, 0], len(c))
            now[4][kept] += sums
    if now is not None:
        yield of(*now)


def _mean(key: tuple, parts: pa.Table) -> pa.Table:
    """A child's size, cost and new centre from all tasks' parts, added in one order."""
    n, cost = parts.column("n").to_numpy(), parts.column("cost").to_numpy()
    sums = parts.column("sums").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
    order = np.lexsort((sums[:, 0], cost, n))
    return pa.table({"node": key[:1], "child": key[1:], "cost": [cost[order].sum()], "centre": [sums[order].sum(axis=0) / n.sum()]}, _MEANS)


def _descend(branching: int, k: int):
    """``(id, node, place, apart, v)`` of the ``k`` nearest children of every descriptor of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v, names, c = _read(row)
                near, far = _nearest(v, c, k)
                m = near.shape[1]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(v) * m + 1) * v.shape[1], pa.int32()), pa.array(np.repeat(v, m, axis=0).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(row["ids"], np.int64), m)), pa.array(row["node"] * branching + names[near].ravel()),
                     pa.array(np.tile(np.arange(m, dtype=np.int32), len(v))), pa.array(far.ravel()), flat],
                    ["id", "node", "place", "apart", "v"])
    return run


_MEANS = pa.schema([("node", pa.int64()), ("child", pa.int32()), ("cost", pa.float64()), ("centre", pa.list_(pa.float64()))])
_BELOW = "id long, node long, place int, apart double, v array<double>"


def _split(members: DataFrame, level: int, branching: int, iterations: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Centres of the children of all nodes of ``members``, and the members below them: one job per step, whatever the number of nodes.

    Blocks stay where they are. A step takes the centres to them, ``branching`` for
    each node of more than LOCAL_ROWS descriptors, and moves one sum per task and child.
    """
    vectors = members.groupBy("node", "v").agg(F.min("id").alias("id"))
    hashed = vectors.withColumn("h", F.md5(F.concat_ws(":", "id", "node", F.lit(level), F.lit(seed))))
    order = F.row_number().over(Window.partitionBy("node").orderBy("h"))
    centres = pin(hashed.withColumn("nth", order).filter(F.col("nth") <= branching).select("node", (F.col("nth") - 1).alias("child"), F.col("v").alias("centre")))
    blocks = pin(_in_blocks(members))
    cost, before = 1e307, 1e308
    for _ in range(iterations):
        if not cost < before * (1 - SETTLED):
            break
        parts = _met(blocks, centres, few=True).mapInArrow(_step, "node long, child int, n long, cost double, sums array<double>")
        centres = pin(parts.groupBy("node", "child").applyInArrow(_mean, "node long, child int, cost double, centre array<double>"))
        before, cost = cost, centres.agg(F.sum("cost")).first()[0]
    return centres.select("node", "child", "centre"), pin(_met(blocks, centres, few=True).mapInArrow(_descend(branching, 1), _BELOW))


def _grow(points: DataFrame, branching: int, levels: int, iterations: int, seed: int, local_rows: int) -> tuple[DataFrame, DataFrame]:
    """``(id, word, cost)`` and ``(level, node, child, n, centre)`` of one round."""
    members, words, centres = points.withColumn("node", F.lit(0).cast("long")), [], []
    for level in range(levels):
        sizes = pin(members.groupBy("node").agg(F.count(F.lit(1)).alias("n")))
        # A level has branching**level nodes at most.
        few = members.join(F.broadcast(sizes.filter(F.col("n") <= local_rows).select("node")), "node")
        found = pin(few.select("id", "node", "v").groupBy("node").applyInArrow(_subtree(level, levels, branching, iterations, seed), _ROWS))
        words.append(found.filter("id IS NOT NULL").select("id", "word", "cost"))
        centres.append(found.filter("id IS NULL").select("level", "node", "child", "n", "centre"))
        many = sizes.filter(F.col("n") > local_rows)
        if many.isEmpty():
            break
        split, below = _split(pin(members.join(F.broadcast(many.select("node")), "node").select("id", "node", "v")), level, branching, iterations, seed)
        counts = below.groupBy("node").agg(F.count(F.lit(1)).alias("n")).select(
            F.floor(F.col("node") / branching).alias("node"), (F.col("node") % branching).cast("int").alias("child"), "n")
        centres.append(split.join(counts, ["node", "child"], "left").select(
            F.lit(level).alias("level"), "node", "child", F.coalesce("n", F.lit(0)).alias("n"), "centre"))
        members = below.select("id", "node", "v")
        if level + 1 == levels:
            words.append(below.select("id", F.col("node").alias("word"), F.col("apart").alias("cost")))
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return union(words), union(centres)


def train_vocabulary(
    desc: DataFrame, branching: int = BRANCHING, levels: int = LEVELS, iterations: int = ITERATIONS, rounds: int = ROUNDS,
    seed: int = 42, local_rows: int = LOCAL_ROWS, cap: int = -1,
) -> tuple[DataFrame, DataFrame]:
    """Words of ``(id, descriptor)`` rows, ``(id, word, cost)``, and the tree, ``(level, node, child, n, centre)``.

    A node's ``child`` is node ``node * branching + child`` of the next level; the
    last level's are the words. Seeds are different vectors of the node, taken by
    hash; a child without members is dropped. Of ``rounds`` trees the one of least
    total cost stays, compared to nine digits, the first of equals. Rows without
    an id or with null components are left out; ids are unique. ``cap`` bounds the
    descriptors, taken in hash order (all of them for -1).
    """
    points = pin(capped(desc, cap, seed).filter("id IS NOT NULL AND descriptor IS NOT NULL AND NOT exists(descriptor, x -> x IS NULL)").select(
        F.col("id").cast("long").alias("id"), F.col("descriptor").cast("array<double>").alias("v")))
    best = None
    for r in range(rounds):
        words, centres = _grow(points, branching, levels, iterations, seed + r, local_rows)
        cost = round(words.agg(F.sum("cost")).first()[0] or 0.0, 9)
        if best is None or cost < best[0]:
            best = (cost, words, centres)
    return best[1], best[2]


def assign_words(desc: DataFrame, centres: DataFrame, branching: int = BRANCHING, levels: int = LEVELS, neighbours: int = 1) -> DataFrame:
    """``(id, word, place)``: each descriptor's way down the tree, and the ``neighbours`` nearest words where it ends."""
    members = desc.filter("id IS NOT NULL AND descriptor IS NOT NULL AND NOT exists(descriptor, x -> x IS NULL)").select(
        F.col("id").cast("long").alias("id"), F.col("descriptor").cast("array<double>").alias("v"), F.lit(0).cast("long").alias("node"))
    for level in range(levels):
        here = centres.filter(F.col("level") == level).select("node", "child", "centre")
        k = neighbours if level + 1 == levels else 1
        members = _met(_in_blocks(members), here).mapInArrow(_descend(branching, k), _BELOW)
    return members.select("id", F.col("node").alias("word"), "place")


def word_weights(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(word, df, idf)`` of ``(image_id, word)`` rows, and unit vectors ``(image_id, word, weight)``; words of all images are left out."""
    counts = pin(words.groupBy("image_id", "word").agg(F.count(F.lit(1)).alias("n")))
    images = counts.agg(F.count_distinct("image_id")).first()[0]
    spread = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df")).withColumn("idf", F.log(F.lit(images) / F.col("df"))).filter("idf > 0")
    return spread, unit_vectors(counts, spread)


def unit_vectors(counts: DataFrame, spread: DataFrame) -> DataFrame:
    """TF-IDF vectors of unit length, ``(image_id, word, weight)``, from ``(image_id, word, n)``."""
    sizes = counts.groupBy("image_id").agg(F.sum("n").alias("total"))
    weighted = counts.join(spread, "word").join(sizes, "image_id").select("image_id", "word", (F.col("n") / F.col("total") * F.col("idf")).alias("w"))
    norms = weighted.groupBy("image_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, "image_id").select("image_id", "word", (F.col("w") / F.col("norm")).alias("weight"))


def probe_terms(asked: DataFrame, postings: DataFrame, n: int) -> DataFrame:
    """``(asked, word, weight, df, bound, first, rest)`` of the asked images' words.

    ``bound`` is the most the word can add to a similarity, ``first`` tells the
    image's rarest words, naming at most PROBE_TIMES * n images, and ``rest`` is
    what this word and all more frequent ones of the image can add together.
    """
    lists = postings.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.max("weight").alias("most"))
    terms = asked.select(F.col("image_id").alias("asked"), "word", "weight").join(lists, "word").withColumn("bound", F.col("weight") * F.col("most"))
    rare = Window.partitionBy("asked").orderBy("df", "word")
    frequent = Window.partitionBy("asked").orderBy(F.desc("df"), F.desc("word"))
    return terms.select(
        "asked", "word", "weight", "df", "bound", (F.sum("df").over(rare) <= PROBE_TIMES * n).alias("first"), F.sum("bound").over(frequent).alias("rest"))


def essential_terms(terms: DataFrame, postings: DataFrame, n: int) -> DataFrame:
    """``terms`` with the asked image's ``least``, a bound below its n-th similarity, and ``essential``: whether an image could
    reach ``least`` without this word or any rarer one of the asked image's."""
    partial = _looked_up(terms.filter("first").select("asked", "word", "weight"), postings, _first_similar(n), "asked long, s double")
    nth = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("s")))
    least = partial.withColumn("nth", nth).filter(F.col("nth") == n).select("asked", F.col("s").alias("least"))
    # Sums in another order differ in their last digits.
    return terms.join(least, "asked", "left").withColumn("least", F.coalesce("least", F.lit(0.0)) * (1 - 1e-6) - 1e-8).withColumn(
        "essential", F.col("rest") >= F.col("least"))


def _looked_up(terms: DataFrame, postings: DataFrame, look, schema: str) -> DataFrame:
    """Rows that ``look`` finds for slices of the asked images' ``terms`` in blocks of the images' ``postings``.

    An asked image is in one slice, an image in one block, and every slice meets
    every block. Postings come as one row per word and block.
    """
    slices = max(1, -(-terms.count() // SLICE_TERMS))
    blocks = max(1, -(-postings.count() // BLOCK_POSTINGS))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    dealt = terms.withColumn("slice", F.pmod(F.xxhash64("asked"), F.lit(slices)).cast("int")).withColumn("block", every(blocks))
    lists = postings.withColumn("block", F.pmod(F.xxhash64("image_id"), F.lit(blocks)).cast("int")).groupBy("word", "block").agg(
        F.sort_array(F.collect_list(F.struct("image_id", "weight"))).alias("list")).select(
        F.col("word").alias("of"), "block", F.col("list")["image_id"].alias("images"), F.col("list")["weight"].alias("weights"), every(slices).alias("slice"))
    return dealt.groupBy("slice", "block").cogroup(lists.groupBy("slice", "block")).applyInArrow(look, schema)


def _images_and_lists(lists: pa.Table) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """A block's images, and every word's places among them with their weights."""
    sizes = pa.compute.list_value_length(lists.column("images")).to_numpy()
    flat, weights = (lists.column(c).combine_chunks().flatten().to_numpy() for c in ("images", "weights"))
    images, places = np.unique(flat, return_inverse=True)
    ends = np.cumsum(sizes)
    return images, {w: (places[b - k : b], weights[b - k : b]) for w, b, k in zip(lists.column("of").to_pylist(), ends.tolist(), sizes.tolist())}


def _each_asked(terms: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    terms = terms.sort_by([("asked", "ascending"), ("word", "ascending")])
    asked = terms.column("asked").to_numpy()
    starts = np.flatnonzero(np.append(True, asked[1:] != asked[:-1])) if len(asked) else []
    for a, b in zip(starts, np.append(starts[1:], len(asked))):
        yield int(asked[a]), terms.slice(a, b - a)


def _added(images: np.ndarray, lists: dict, asked: int, words: list[int], weights: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the images that have any of the words, but the asked one, and what the words add for them."""
    found = [(*lists[w], x) for w, x in zip(words, weights) if w in lists]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    at, where = np.unique(np.concatenate([p for p, _, _ in found]), return_inverse=True)
    s = np.bincount(where, np.concatenate([y * x for _, y, x in found]), len(at))
    other = images[at] != asked
    return at[other], s[other]


def _first_similar(n: int):
    """The ``n`` largest sums of an asked image in one block of images."""
    def look(terms: pa.Table, lists: pa.Table) -> pa.Table:
        images, lists = _images_and_lists(lists)
        out = [(asked, -np.sort(-_added(images, lists, asked, mine.column("word").to_pylist(), mine.column("weight").to_pylist())[1])[:n])
               for asked, mine in _each_asked(terms)]
        return pa.table([pa.array(np.repeat([a for a, _ in out], [len(s) for _, s in out]).astype(np.int64)),
                         pa.array(np.concatenate([np.zeros(0), *[s for _, s in out]]))], ["asked", "s"])
    return look


def _most_similar(n: int):
    """The ``n`` most similar images of an asked one in one block, of those that can reach its bound."""
    def look(terms: pa.Table, lists: pa.Table) -> pa.Table:
        images, lists = _images_and_lists(lists)
        out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
        for asked, mine in _each_asked(terms):
            rows = mine.to_pylist()
            looked, aside = [r for r in rows if r["essential"]], [r for r in rows if not r["essential"]]
            at, s = _added(images, lists, asked, [r["word"] for r in looked], [r["weight"] for r in looked])
            able = s + max((r["rest"] for r in aside), default=0.0) >= rows[0]["least"]
            at, s = at[able], s[able]
            for r in aside:
                places, weights = lists.get(r["word"], (np.zeros(0, np.int64),) * 2)
                if len(places) and len(at):
                    nth = np.minimum(np.searchsorted(places, at), len(places) - 1)
                    s += np.where(places[nth] == at, weights[nth] * r["weight"], 0.0)
            s = np.round(s, 9)
            best = np.lexsort((at, -s))[:n]
            out.append((np.full(len(best), asked), images[at[best]], s[best]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], ["asked", "image_id", "similarity"])
    return look


def loop_candidates(words: DataFrame, asked_words: DataFrame, n: int = LOOP_IMAGES) -> DataFrame:
    """For every image of ``asked_words``, its ``n`` most similar others of ``words``: ``(image_id1, image_id2, rank, similarity)``.

    Both are ``(image_id, word)`` rows; similarity is the cosine of TF-IDF vectors,
    to nine digits, and images without a common word are no candidates. Ties go to
    the smaller id. Exact: an asked image's rarest words give a bound below its
    n-th similarity; words that cannot reach it together, the most frequent
    first, are not looked up, and only candidates that still can reach it meet them.
    """
    spread, vectors = word_weights(words)
    postings = pin(vectors)
    asked = unit_vectors(asked_words.groupBy("image_id", "word").agg(F.count(F.lit(1)).alias("n")), spread)
    terms = pin(essential_terms(pin(probe_terms(asked, postings, n)), postings, n))
    total = _looked_up(terms.select("asked", "word", "weight", "rest", "least", "essential"), postings, _most_similar(n),
                       "asked long, image_id long, similarity double")
    order = Window.partitionBy("asked").orderBy(F.desc("similarity"), "image_id")
    return total.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= n).select(
        F.col("asked").alias("image_id1"), F.col("image_id").alias("image_id2"), "rank", "similarity")
