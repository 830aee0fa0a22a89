"""Near-duplicate documents by min-max hashing.

Every permutation of a document's shingle hashes gives two signature values, its
minimum and its maximum, so half as many permutations are evaluated as values
are banded. Documents that share a band are candidates; a link counts only after
the full shingle sets have been compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import WordHashes, mixed, rolling, slices, stored, texts_of
from reefgrid.operators.components import connected_components

SHINGLE_WORDS = 5
#: 138 permutations give 276 values: 46 bands of 6. A pair of similarity 0.8 shares no band
#: with a probability of 9e-7, one of 0.85 of 4e-10.
PERMUTATIONS = 138
BAND_VALUES = 6
#: Documents of a hub, and the shingles they have apart from it, in one block; shingles of a block pair counted at once.
BLOCK_DOCS, BLOCK_SHINGLES, COLUMNS = 512, 1_000_000, 2048
BANDS = 2 * PERMUTATIONS // BAND_VALUES

_SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>"


def shingle_sets(texts: list[bytes], hashes: WordHashes, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A-Z is lower-cased; words end at space and at the control characters 9 to 13.
    """
    out = []
    for text in texts:
        words = hashes.of(text.lower().split())
        if len(words) == 0:
            out.append(np.zeros(0, np.uint64))
        elif len(words) < width:
            out.append(rolling(words, len(words)) ^ np.uint64(len(words)))
        else:
            out.append(np.unique(rolling(words, width)))
    return out


def _constants() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:PERMUTATIONS] | np.uint64(1), seeds[PERMUTATIONS:]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit key per band for each of the (non-empty) sets."""
    multiply, add = _constants()
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    flat = np.concatenate(sets)
    values = np.empty((2 * PERMUTATIONS, len(sets)), np.uint64)
    for i in range(PERMUTATIONS):
        permuted = flat * multiply[i] + add[i]
        values[2 * i] = np.minimum.reduceat(permuted, starts)
        values[2 * i + 1] = np.maximum.reduceat(permuted, starts)
    keys = np.empty((BANDS, len(sets)), np.uint64)
    for band in range(BANDS):
        total = np.full(len(sets), band + 1, np.uint64)
        for row in values[band * BAND_VALUES : (band + 1) * BAND_VALUES]:
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + row)
        keys[band] = total
    return keys.T


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in slices(batches, "text", 1 << 20):
        sets = shingle_sets(texts_of(batch, "text"), hashes)
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        if full:
            for i, keys in zip(full, band_keys([sets[i] for i in full]).view(np.int64)):
                bands[i] = keys
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "digest", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in slices(batches, "text"):
        sets = shingle_sets(texts_of(batch, "text"), hashes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
            ["digest", "shingles"])


def _crowded(keyed: DataFrame) -> DataFrame:
    """The rows of buckets with more than one document."""
    crowded = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    return keyed.join(crowded, "bucket")


def _weights(sets: DataFrame, percent: int) -> DataFrame:
    """``(rep, n, common)`` of the documents that can have a link: their shingles, and those that another one has too.

    A pair shares no more shingles than either has in common with anyone, so
    a document with too many of its own is linked with nothing.
    """
    each = sets.select("rep", F.explode("shingles").alias("shingle"))
    shared = each.groupBy("shingle").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high").select("shingle")
    common = each.join(shared, "shingle").groupBy("rep").agg(F.count(F.lit(1)).alias("common"))
    return sets.select("rep", F.size("shingles").cast("long").alias("n")).join(common, "rep").filter(100 * F.col("common") >= percent * F.col("n"))


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    """The sets of a column of signed hashes, in unsigned order."""
    flat, offsets = column.flatten().to_numpy().view(np.uint64), column.offsets.to_numpy() - column.offsets[0].as_py()
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _compare(percent: int):
    """``(hub, rep, linked, apart)`` of pairs with both sets: ``apart`` counts the shingles that one of them alone has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, apart = [], []
            for x, y in zip(_arrays(batch.column(2)), _arrays(batch.column(3))):
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                shared = int((x[at] == y).sum())
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
                apart.append(len(x) + len(y) - 2 * shared)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_()), pa.array(apart, pa.int64())], ["hub", "rep", "linked", "apart"])
    return run


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(hub, rep, label, blocks, n, apart)`` with the shingles that one of the two alone has."""
    for batch in batches:
        apart, sizes = [], []
        for x, y in zip(_arrays(batch.column(4)), _arrays(batch.column(5))):
            apart.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
            sizes.append(len(y))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(sizes, pa.int64()), pa.array(apart, pa.list_(pa.int64()))], ["hub", "rep", "label", "blocks", "n", "apart"])


def _in_common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements every set of ``left`` shares with every set of ``right``."""
    total = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets in (left, right):
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
    both = np.intersect1d(sides[0][0], sides[1][0])
    places = []
    for values, rows in sides:
        at = np.minimum(np.searchsorted(both, values), max(0, len(both) - 1))
        there = both[at] == values if len(both) else np.zeros(len(values), bool)
        places.append((at[there], rows[there]))
    for low in range(0, len(both), COLUMNS):
        held = []
        for (at, rows), sets in zip(places, (left, right)):
            mine = (at >= low) & (at < low + COLUMNS)
            matrix = np.zeros((len(sets), min(COLUMNS, len(both) - low)), np.float32)
            matrix[rows[mine], at[mine] - low] = 1
            held.append(matrix)
        total += held[0] @ held[1].T
    return total


def _joining(rows: list[tuple], percent: int, alone: bool) -> list[tuple[int, int]]:
    """Links between documents of one hub that join different labels, no more than it takes.

    The shingles that two documents have apart from each other are those that
    one of them alone has apart from the hub, so the sizes of three sets tell
    their similarity.
    """
    left = [r for r in rows if r[4]]
    right = left if alone else [r for r in rows if not r[4]]
    if not left or not right:
        return []
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    labels, sizes, aparts = (
        [np.array([r[1] for r in side]) for side in (left, right)], [np.array([r[2] for r in side]) for side in (left, right)],
        [np.array([len(r[3]) for r in side]) for side in (left, right)])
    common = _in_common([r[3] for r in left], [r[3] for r in right]).astype(np.int64)
    apart = aparts[0][:, None] + aparts[1][None, :] - 2 * common
    del common
    # 100 * (total - apart) >= percent * (total + apart), in one matrix
    total = (100 - percent) * (sizes[0][:, None] + sizes[1][None, :])
    apart *= 100 + percent
    links = total >= apart
    del total, apart
    links &= labels[0][:, None] != labels[1][None, :]
    out = []
    for i in np.flatnonzero(links.any(axis=1)):
        for j in np.flatnonzero(links[i]):
            x, y = root(int(labels[0][i])), root(int(labels[1][j]))
            if x != y:
                parent[x] = y
                out.append((left[i][0], right[j][0]))
    return out


def _resolve(percent: int):
    """Links within the hubs' groups, from ``(hub, low, high, rep, label, n, apart, own)`` sorted by the first three."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            found = _joining(held, percent, now[1] == now[2]) if len({r[1] for r in held}) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["hub", "rep"])

        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for key, rep, label, n, apart, own in zip(keys, *(batch.column(i).to_pylist() for i in (3, 4, 5)), _arrays(batch.column(6)), batch.column(7).to_pylist()):
                if key != now:
                    if held:
                        yield from done()
                    now, held = key, []
                held.append((rep, label, n, apart, own == key[1]))
        if held:
            yield from done()
    return run


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document.

    Documents whose shingle sets have ``100 * intersection >= percent * union``
    are linked; a component's id is its smallest ``doc_id``.

    Equal sets are one node from the start. The documents of a band's bucket are
    all compared with its smallest one, its hub. Documents of one hub that may
    still be linked with each other, but not through known links, are compared by
    what each has apart from the hub, block against block; only links that join
    components come out. No link is lost, buckets have no cap, and a bucket of
    copies costs one comparison per copy.

    Null and empty texts have no shingles and form components of their own. A
    null ``doc_id`` is linked with nothing: its component is null and it is
    kept. Rows that repeat an id each give a row, of whatever texts; the id gets
    the smallest of their components. Texts are taken whole. Other columns are
    ignored. An empty table gives no rows.
    """
    source = documents.select("doc_id", "text")
    signed = stored(source.mapInArrow(_sign, _SIGNED), "minmax-signed")
    nodes = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # A set is a node, whatever ids its documents have. Copies agree in their bands.
    classes = stored(nodes.groupBy("digest").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands")).withColumn(
        "rep", F.monotonically_increasing_id()), "minmax-classes")
    keyed = classes.select("rep", F.explode("bands").alias("bucket"))
    buckets = stored(_crowded(keyed), "minmax-buckets")
    met = buckets.select("rep").distinct().join(classes.select("rep", "digest", "least"), "rep")
    wanted = met.select(F.col("least").alias("doc_id")).distinct()
    texts = source.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "digest binary, shingles array<long>").dropDuplicates(["digest"])
    sets = stored(texts.join(met.select("rep", "digest"), "digest").select("rep", "shingles"), "minmax-sets")
    weights = stored(_weights(sets, percent), "minmax-weights")
    links = _links(_crowded(buckets.join(weights, "rep").select("bucket", "rep")), sets, percent)
    joined = connected_components(links, "hub", "rep")
    labelled = classes.select("digest", "least", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    least = labelled.groupBy("component").agg(F.min("least").alias("label"))
    members = nodes.select("doc_id", "digest").distinct().join(labelled.select("digest", "component"), "digest").join(least, "component")
    found = members.groupBy("doc_id").agg(F.min("label").alias("label"))
    out = signed.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("label", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def _links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links ``(hub, rep)``, enough of them to connect all linked documents that share a bucket of ``(bucket, rep)``."""
    hubs = buckets.groupBy("bucket").agg(F.min("rep").alias("hub"))
    pairs = stored(buckets.join(hubs, "bucket").filter("rep <> hub").select("hub", "rep").distinct(), "minmax-pairs")
    a = sets.select(F.col("rep").alias("hub"), F.col("shingles").alias("a"))
    both = pairs.join(a, "hub").join(sets, "rep").select("hub", "rep", "a", "shingles")
    compared = stored(both.mapInArrow(_compare(percent), "hub long, rep long, linked boolean, apart long"), "minmax-compared")
    links = compared.filter("linked").select("hub", "rep")
    labels = connected_components(links, "hub", "rep").select(F.col("node").alias("rep"), F.col("component").alias("label"))
    state = stored(compared.join(labels, "rep", "left").select("hub", "rep", "apart", F.coalesce("label", "rep").alias("label")), "minmax-state")
    # A hub whose other documents are of one component has nothing left to tell.
    open_ = state.groupBy("hub").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("apart").alias("held")
    ).filter("low < high").select("hub", F.ceil(F.greatest(F.col("n") / BLOCK_DOCS, F.col("held") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = state.join(open_, "hub").join(a, "hub").join(sets, "rep").select("hub", "rep", "label", "blocks", "a", "shingles")
    apart = members.mapInArrow(
        _differences, "hub long, rep long, label long, blocks int, n long, apart array<long>")
    own = apart.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    against = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = against.select(
        "hub", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "rep", "label", "n", "apart", "own")
    fresh = dealt.repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high").mapInArrow(_resolve(percent), "hub long, rep long")
    return links.unionByName(stored(fresh, "minmax-fresh"))


def without_near_duplicates(documents: DataFrame, percent: int = 80) -> DataFrame:
    """``documents`` without the rows whose component has a smaller ``doc_id``; all columns and other rows stay as they are."""
    gone = near_duplicates(documents, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    packed = documents.select(F.struct(*documents.columns).alias("row"))
    left = packed.join(gone, F.col("row.doc_id").cast("long") == F.col("gone_id"), "left_anti")
    return left.select(*[F.col("row").getField(c).alias(c) for c in documents.columns])
