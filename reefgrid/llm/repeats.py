"""Search for every string of WIDTH units that also stands in an earlier document.

What substring and suffix-array deduplication share. Each WIDTH-unit window is
named by the smallest hash among its n-grams, its anchor, so equal windows have
equal anchors wherever they stand, and neighbouring windows mostly share one.
Only runs of windows whose anchor occurs in two documents are cut out and
gathered by anchor; there an operator's own method compares them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import WordHashes, mixed, rolling, slices, sliding_min, stored, texts_of

WIDTH = 50
#: A run has at most this many windows; a longer one is cut, with the same anchor.
RUN_WINDOWS = 64
#: Text of one slice of the anchor search, text per bin of anchors.
SLICE = 8 << 20
BIN_TEXT = 24 << 20
#: Distinct cut-outs of one anchor beyond which its windows are grouped one by one instead of in one task.
CROWDED = 4000

#: Of one slice, in a bin of its own below zero, all texts with their numbers of runs; of one slice and bin the anchors, the
#: runs that have them, and for each anchor twice its number of runs plus 1 if two of the slice's texts have it.
_BLOBS = "bin long, slice long, text_keys array<long>, runs binary, anchors binary, places binary, local binary"
_FOUND = "slice long, text_keys array<long>, runs binary, chosen binary"
_FLAGS = "text_key long, flagged binary"
_CUTS = "anchor long, f1 long, cut binary, doc_id long, text_key long, begin int, n int"
#: Of a cut-out, the smallest first document of its windows, and those of all windows if they differ.
_COVER = "anchor long, f1 long, first long, firsts binary"
_MARKS = "doc_id long, text_key long, spans binary"


class Bytes:
    """Texts as their UTF-8 bytes."""

    gram = 20
    #: Cut-out text per bin of the comparison.
    shard = 4 << 20

    def units(self, text: bytes) -> tuple[bytes, np.ndarray]:
        return text, np.frombuffer(text, np.uint8).astype(np.uint64)

    @staticmethod
    def cut(units: bytes, a: int, b: int) -> bytes:
        return units[a:b]

    @staticmethod
    def window(cut: str, at: str):
        return F.expr(f"substring({cut}, {at} + 1, {WIDTH})")


class Words:
    """Texts as words between space and the control characters 9 to 13."""

    gram = 10
    shard = 2 << 20

    def __init__(self):
        self.hashes = WordHashes()

    def units(self, text: bytes) -> tuple[list[bytes], np.ndarray]:
        words = text.split()
        return words, self.hashes.of(words)

    @staticmethod
    def cut(units: list[bytes], a: int, b: int) -> bytes:
        return b" ".join(units[a:b])

    @staticmethod
    def window(cut: str, at: str):
        return F.expr(f"array_join(slice(split(cast({cut} AS string), ' '), {at} + 1, {WIDTH}), ' ')")


def runs_of(arrays: list[np.ndarray], gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, number of windows, anchor) of every run, by text and place.

    A text's runs depend on that text alone.
    """
    sizes = np.fromiter(map(len, arrays), np.int64, len(arrays))
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    none = np.zeros(0, np.int64)
    if len(flat) < WIDTH:
        return none, none, none, none.view(np.uint64)
    least = sliding_min(rolling(flat, gram), WIDTH - gram + 1)
    ends = np.cumsum(sizes)
    begins, limits = ends - sizes, ends - WIDTH + 1
    # Runs start where the anchor changes and where a text's windows begin; these few places are all that is looked at.
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    owner = np.searchsorted(ends, change, "right")
    inside = (change > begins[owner]) & (change < limits[owner])
    opening = np.flatnonzero(sizes >= WIDTH)
    starts, text = np.concatenate([begins[opening], change[inside]]), np.concatenate([opening, owner[inside]])
    order = np.argsort(starts)
    starts, text = starts[order], text[order]
    n = np.minimum(np.append(starts[1:], len(flat)), limits[text]) - starts
    pieces = -(-n // RUN_WINDOWS)
    if len(n) and pieces.max() > 1:
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        text, starts, n = np.repeat(text, pieces), np.repeat(starts, pieces) + nth * RUN_WINDOWS, np.repeat(n, pieces) - nth * RUN_WINDOWS
        n = np.minimum(n, RUN_WINDOWS)
    return text, starts - begins[text], n, least[starts]


def _chunks(texts: list[bytes], limit: int = 1 << 16) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def _anchors(kind: type, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grain, slice_ = kind(), TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", SLICE):
            slice_ += 1
            counts, anchors, owner, done = [], [], [], 0
            for part in _chunks(texts_of(batch, "text")):
                text, _, _, anchor = runs_of([grain.units(t)[1] for t in part], grain.gram)
                counts.append(np.bincount(text, minlength=len(part)))
                anchors.append(anchor)
                owner.append(text + done)
                done += len(part)
            runs, anchor, owner = np.concatenate(counts).astype(np.int32), np.concatenate(anchors), np.concatenate(owner)
            if not len(anchor):
                continue
            # One entry of an anchor speaks for the slice; where the slice has it in two texts, that is settled here.
            back = np.argsort(anchor, kind="stable").astype(np.int32)
            ordered = anchor[back]
            back_starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            keys, first = ordered[back_starts], back[back_starts]
            back_starts = np.append(back_starts, len(back))
            settled = owner[back[back_starts[1:] - 1]] != owner[first]
            bin_ = ((keys >> np.uint64(40)) % np.uint64(bins)).astype(np.int64)
            order = np.argsort(bin_ << 32 | first)
            cuts = np.searchsorted(bin_[order], np.arange(bins + 1))
            text_keys = batch.column(2)
            yield _blob(-1 - slice_, slice_, pa.ListArray.from_arrays([0, len(text_keys)], text_keys), runs.tobytes(), None, None, None)
            for b in range(bins):
                mine = order[cuts[b] : cuts[b + 1]]
                if len(mine):
                    # All places of the slice's anchors, and how many each has.
                    n = back_starts[mine + 1] - back_starts[mine]
                    places = back[np.repeat(back_starts[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                    local = (n.astype(np.int32) * 2 + settled[mine]).astype(np.int32)
                    yield _blob(b, slice_, pa.nulls(1, pa.list_(pa.int64())), None, _packed(keys[mine]), places.tobytes(), local.tobytes())
    return run


def _blob(bin_: int, slice_: int, text_keys: pa.Array, *blobs: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bin_], pa.int64()), pa.array([slice_], pa.int64()), text_keys, *[pa.array([b], pa.binary()) for b in blobs]],
        ["bin", "slice", "text_keys", "runs", "anchors", "places", "local"])


def _packed(keys: np.ndarray) -> bytes:
    """The upper 48 bits of each anchor: the few that agree in those alone are told apart when cut out."""
    return keys.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _shared(key: tuple, table: pa.Table) -> pa.Table:
    """Of each slice, the runs whose anchor stands in two texts, from one bin of anchors; slices' own rows pass."""
    if key[0].as_py() < 0:
        return table.select(["slice", "text_keys", "runs"]).append_column("chosen", pa.nulls(table.num_rows, pa.binary()))
    rows = [[table.column(c)[i].as_py() for c in ("anchors", "places", "local")] for i in range(table.num_rows)]
    anchors = [_unpacked(r[0]) for r in rows]
    local = [np.frombuffer(r[2], np.int32) for r in rows]
    keys, which, n = np.unique(np.concatenate(anchors), return_inverse=True, return_counts=True)
    settled = np.concatenate(local) & 1
    common = (n > 1) | (np.bincount(which, settled, len(keys)) > 0)
    keep = common[which]
    slices_, chosen, at = [], [], 0
    for i, (_, places, _) in enumerate(rows):
        mine = keep[at : at + len(anchors[i])]
        at += len(anchors[i])
        if mine.any():
            slices_.append(table.column("slice")[i].as_py())
            chosen.append(np.frombuffer(places, np.int32)[np.repeat(mine, local[i] >> 1)].tobytes())
    none = len(slices_)
    return pa.table([pa.array(slices_, pa.int64()), pa.nulls(none, pa.list_(pa.int64())), pa.nulls(none, pa.binary()), pa.array(chosen, pa.binary())],
                    ["slice", "text_keys", "runs", "chosen"])


def _flagged(table: pa.Table) -> pa.Table:
    """``(text_key, flagged)`` of one slice: the numbers of each text's runs that all bins have chosen."""
    chosen = np.sort(np.frombuffer(b"".join(c for c in table.column("chosen").to_pylist() if c is not None), np.int32))
    own = table.filter(pa.compute.is_valid(table.column("runs")))
    counts, key = np.frombuffer(own.column("runs")[0].as_py(), np.int32), own.column("text_keys")[0].as_py()
    starts = np.cumsum(counts) - counts
    # A text without runs begins where the next one does: the last that begins there has them.
    owner = np.searchsorted(starts, chosen, "right") - 1
    nth = (chosen - starts[owner]).astype(np.int32)
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    text_keys = [key[owner[a]] for a in first]
    flagged = [nth[a:b].tobytes() for a, b in zip(first, np.append(first[1:], len(owner)))]
    return pa.table([pa.array(text_keys, pa.int64()), pa.array(flagged, pa.binary())], ["text_key", "flagged"])


def _cut(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grain = kind()
        for batch in slices(batches, "text", 1 << 20):
            units = [grain.units(t) for t in texts_of(batch, "text")]
            text, begin, n, anchor = runs_of([u[1] for u in units], grain.gram)
            per_text = np.bincount(text, minlength=len(units))
            starts = np.cumsum(per_text) - per_text
            # Texts whose keys happen to agree share their flags; what one lacks of the other's is passed over.
            flagged = [np.unique(np.frombuffer(b"".join(f), np.int32)) for f in batch.column(3).to_pylist()]
            at = np.concatenate([f[f < k] + s for f, k, s in zip(flagged, per_text, starts)])
            cuts = [grain.cut(units[t][0], b, b + k + WIDTH - 1) for t, b, k in zip(text[at].tolist(), begin[at].tolist(), n[at].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[at].view(np.int64)),
                 pa.array(np.fromiter(map(xxhash.xxh3_64_intdigest, cuts), np.uint64, len(cuts)).view(np.int64)),
                 pa.array(cuts, pa.binary()), batch.column(0).take(pa.array(text[at])), batch.column(2).take(pa.array(text[at])),
                 pa.array(begin[at].astype(np.int32)), pa.array(n[at].astype(np.int32))],
                ["anchor", "f1", "cut", "doc_id", "text_key", "begin", "n"])
    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units covered by windows that an earlier document has, of occurrences of cut-outs that have such windows."""
    for batch in batches:
        whole = pa.compute.is_null(batch.column(4))
        rows = batch.filter(whole)
        begin = rows.column(2).to_numpy().astype(np.int64)
        yield _spans_of(rows, np.arange(rows.num_rows), begin, begin + rows.column(3).to_numpy() + WIDTH - 1)
        rows = batch.filter(pa.compute.invert(whole))
        if not rows.num_rows:
            continue
        windows = [np.frombuffer(f, np.int64) for f in rows.column(4).to_pylist()]
        sizes = np.fromiter(map(len, windows), np.int64, len(windows))
        row = np.repeat(np.arange(len(windows)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes - rows.column(2).to_numpy(), sizes)
        hit = np.concatenate(windows) < rows.column(0).to_numpy()[row]
        row, place = row[hit], place[hit]
        # Windows no farther apart than WIDTH cover one span.
        new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (np.diff(place) > WIDTH))[: len(row)])
        yield _spans_of(rows, row[new], place[new], place[np.append(new[1:], len(row))[: len(new)] - 1] + WIDTH)


def _spans_of(rows: pa.RecordBatch, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    packed = pa.py_buffer(np.stack([begin, end], axis=1).astype(np.int64).tobytes())
    offsets = pa.py_buffer((np.arange(len(row) + 1) * 16).astype(np.int32).tobytes())
    at = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [rows.column(0).take(at), rows.column(1).take(at), pa.Array.from_buffers(pa.binary(), len(row), [None, offsets, packed])],
        ["doc_id", "text_key", "spans"])


def joined(spans: list[bytes]) -> np.ndarray:
    """Sorted, disjoint (begin, end) rows of packed spans; touching ones are joined."""
    flat = np.frombuffer(b"".join(spans), np.int64).reshape(-1, 2)
    if not len(flat):
        return flat
    flat = flat[np.argsort(flat[:, 0], kind="stable")]
    reach = np.maximum.accumulate(flat[:, 1])
    new = np.append(True, flat[1:, 0] > reach[:-1])
    at = np.flatnonzero(new)
    return np.stack([flat[at, 0], reach[np.append(at[1:] - 1, len(flat) - 1)]], axis=1)


def marks(documents: DataFrame, kind: type, compare: Callable[[list[tuple[int, list[bytes], np.ndarray]]], list[np.ndarray]]) -> DataFrame:
    """``(doc_id, text_key, earlier, spans)`` of the documents that have anything in common with an earlier one.

    ``spans`` are packed (begin, end) pairs of units. A copy of a whole earlier
    text has its ``doc_id`` in ``earlier`` instead.

    ``compare`` takes ``(anchor, cut-outs, first documents)`` groups of one shard
    and returns, for each group, the first document of every window of its
    cut-outs, one after the other.
    """
    source = documents.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    texts = stored(source.select("doc_id", "text_key", F.md5("text").alias("digest"), F.octet_length("text").alias("bytes")), "repeats-texts")
    first = texts.groupBy("digest").agg(F.min("doc_id").alias("earlier"))
    classes = stored(texts.join(first, "digest").select("doc_id", "text_key", "earlier").distinct(), "repeats-classes")
    total = texts.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    bins = max(16, math.ceil(total / BIN_TEXT))
    blobs = source.mapInArrow(_anchors(kind, bins), _BLOBS)
    flags = blobs.groupBy("bin").applyInArrow(_shared, _FOUND).groupBy("slice").applyInArrow(_flagged, _FLAGS)
    own = classes.filter("doc_id = earlier").select("doc_id", "text_key")
    flags = stored(flags.groupBy("text_key").agg(F.collect_list("flagged").alias("flagged")).join(own, "text_key"), "repeats-flags")
    # Equal rows that repeat an id are one document here.
    met = source.join(flags, ["doc_id", "text_key"]).select("doc_id", "text", "text_key", "flagged")
    cuts = stored(met.mapInArrow(_cut(kind), _CUTS), "repeats-cuts", "zstd")
    distinct = stored(cuts.groupBy("anchor", "f1", "cut").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "repeats-distinct", "zstd")
    sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    crowded = stored(sizes.filter(F.col("n") > CROWDED).select("anchor"), "repeats-crowded")
    usual = distinct.join(crowded, "anchor", "left_anti")
    shards = max(16, math.ceil((distinct.agg(F.sum(F.octet_length("cut")).alias("n")).first()["n"] or 0) / kind.shard))
    cover = usual.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInArrow(_sharded(compare, kind), _COVER)
    cover = stored(cover.unionByName(_crowded(distinct.join(crowded, "anchor"), kind)), "repeats-cover", "zstd")
    spans = cuts.select("anchor", "f1", "doc_id", "text_key", "begin", "n").join(cover, ["anchor", "f1"]).filter("first < doc_id").select(
        "doc_id", "text_key", "begin", "n", "firsts")
    found = stored(spans.mapInArrow(_spans, _MARKS).groupBy("doc_id", "text_key").agg(F.collect_list("spans").alias("spans")), "repeats-found", "zstd")
    copies = classes.filter("doc_id > earlier")
    return copies.withColumn("spans", F.lit(None).cast("array<binary>")).unionByName(found.withColumn("earlier", F.lit(None).cast("long")))


def _sharded(compare, kind: type):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor", "ascending"), ("first", "ascending")])
        anchors = table.column("anchor").to_numpy()
        starts = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        sizes = np.diff(np.append(starts, len(anchors)))
        # An anchor's only cut-out is the same text wherever it stands.
        alone, several = table.take(pa.array(starts[sizes == 1])), table.filter(pa.array(np.repeat(sizes > 1, sizes)))
        # What no occurrence has from an earlier document covers nothing.
        alone = alone.filter(pa.compute.less(alone.column("first"), alone.column("last")))
        parts = [alone.select(["anchor", "f1", "first"]).append_column("firsts", pa.nulls(alone.num_rows, pa.binary()))]
        if several.num_rows:
            cuts, own = several.column("cut").to_pylist(), several.column("first").to_numpy()
            ends = np.cumsum(sizes[sizes > 1]).tolist()
            spans = list(zip([0, *ends], ends))
            flat = np.concatenate(compare([(int(anchors[i]), cuts[a:b], own[a:b]) for i, (a, b) in zip(starts[sizes > 1], spans)])).astype(np.int64)
            n = np.fromiter((windows_in(c, kind) for c in cuts), np.int64, len(cuts))
            begins = np.cumsum(n) - n
            least, most = np.minimum.reduceat(flat, begins), np.maximum.reduceat(flat, begins)
            firsts = [flat[b : b + k].tobytes() if lo < hi else None for b, k, lo, hi in zip(begins.tolist(), n.tolist(), least, most)]
            covers = pa.table([several.column("anchor"), several.column("f1"), pa.array(least), pa.array(firsts, pa.binary())],
                              ["anchor", "f1", "first", "firsts"])
            parts.append(covers.filter(pa.array(least < several.column("last").to_numpy())))
        return pa.concat_tables(parts)
    return run


def windows_in(cut: bytes, kind: type) -> int:
    return (len(cut) if kind is Bytes else cut.count(b" ") + 1) - WIDTH + 1


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [np.array([w["first"] for w in sorted(ws, key=lambda w: w["at"])], np.int64) for ws in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([int(p.min()) for p in packed], pa.int64()), pa.array([p.tobytes() for p in packed], pa.binary())],
            ["anchor", "f1", "first", "firsts"])


def _crowded(distinct: DataFrame, kind: type) -> DataFrame:
    """Cover of anchors with very many cut-outs: their windows are grouped one by one, over all executors."""
    n = F.expr("octet_length(cut)" if kind is Bytes else "size(split(cast(cut AS string), ' '))") - WIDTH
    windows = distinct.withColumn("at", F.explode(F.sequence(F.lit(0), n))).withColumn("window", Bytes.window("cut", "at") if kind is Bytes else Words.window("cut", "at"))
    least = windows.groupBy("anchor", "window").agg(F.min("first").alias("least"))
    placed = windows.drop("first").join(least, ["anchor", "window"]).groupBy("anchor", "f1").agg(
        F.collect_list(F.struct("at", F.col("least").alias("first"))).alias("windows"))
    return placed.mapInArrow(_pack, _COVER)
