"""Benchmark decontamination with a positional inverted index.

The index keeps, for every segment of training documents, the positions of each
test term. A phrase is found by intersecting the position lists of its terms,
each moved back by the term's place in the phrase, starting with the rarest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import slices, stored, texts_of

WINDOW_WORDS = 10
#: Text bytes of one index segment, and windows that are matched in one pass over the documents.
SEGMENT_BYTES = 4 << 20
BLOCK_WINDOWS = 200_000

_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_INDEX = "doc_ids array<long>, text_keys array<long>, n_words binary, terms binary, counts binary, positions binary"
_FOUND = "doc_id long, text_key long, n_words long, spans array<struct<begin:int,end:int>>, items array<long>"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of digits, letters a-z and everything beyond ASCII."""
    return text.translate(_LOWER).split()


def _windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text")):
                words = words_of(text)
                found = {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array([w.decode() for w in found], pa.string())],
                    ["item_id", "phrase"],
                )
    return run


def item_windows(benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """``(item_id, phrase)``: every window of ``width`` consecutive words of the items; a shorter item is one window."""
    rows = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    return rows.mapInArrow(_windows(width), "item_id long, phrase string").distinct()


def _segments(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in slices(batches, "text", SEGMENT_BYTES):
            n_words, lists = [], []
            for text in texts_of(batch, "text"):
                words = words_of(text)
                n_words.append(len(words))
                lists.append(np.fromiter((get(w, -1) for w in words), np.int32, len(words)))
                lists.append(np.full(1, -1, np.int32))  # keeps phrases inside their document
            flat = np.concatenate(lists)
            places = np.flatnonzero(flat >= 0).astype(np.int32)
            terms = flat[places]
            order = np.argsort(terms, kind="stable")
            used, counts = np.unique(terms, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([batch.column(2).to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.array(n_words, np.int32).tobytes()]), pa.array([used.astype(np.int32).tobytes()]),
                    pa.array([counts.astype(np.int32).tobytes()]), pa.array([places[order].tobytes()]),
                ],
                ["doc_ids", "text_keys", "n_words", "terms", "counts", "positions"],
            )
    return run


def build_index(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """The written index: one row per segment with its documents and the position lists of the given terms.

    A segment's positions count words through all its documents, with one place
    left free after each document.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    return stored(rows.mapInArrow(_segments(vocabulary), _INDEX), "postings")


class Segment:
    """The position lists of one segment."""

    def __init__(self, n_words: bytes, terms: bytes, counts: bytes, positions: bytes, n_terms: int):
        self.n_words = np.frombuffer(n_words, np.int32).astype(np.int64)
        self.begins = np.cumsum(self.n_words + 1) - (self.n_words + 1)
        used, n = np.frombuffer(terms, np.int32), np.frombuffer(counts, np.int32)
        self.counts = np.zeros(n_terms, np.int64)
        self.counts[used] = n
        self.starts = np.zeros(n_terms, np.int64)
        self.starts[used] = np.cumsum(n) - n
        self.positions = np.frombuffer(positions, np.int32)

    def places(self, term: int) -> np.ndarray:
        return self.positions[self.starts[term] : self.starts[term] + self.counts[term]]

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, places, "right") - 1

    def exact(self, phrase: np.ndarray) -> np.ndarray:
        """Places where the phrase begins."""
        order = np.argsort(self.counts[phrase], kind="stable")
        begins = self.places(phrase[order[0]]) - order[0]
        for i in order[1:]:
            if not len(begins):
                break
            begins = _within(begins, self.places(phrase[i]) - i)
        return begins

    def near(self, phrase: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Shortest spans, one per place of the rarest term at most, of up to ``reach`` words that hold all terms."""
        terms = np.unique(phrase)
        terms = terms[np.argsort(self.counts[terms], kind="stable")]
        begins, ends = [], []
        for anchor in self.places(terms[0]):
            starts = np.concatenate([p[np.searchsorted(p, anchor - reach + 1) : np.searchsorted(p, anchor, "right")]
                                     for p in map(self.places, terms)])
            last = starts.copy()
            for p in map(self.places, terms):
                i = np.searchsorted(p, starts)
                last = np.where(i < len(p), np.maximum(last, p[np.minimum(i, len(p) - 1)]), starts + reach)
                starts, last = starts[last - starts < reach], last[last - starts < reach]
            fits = (last >= anchor) & (self.document(starts) == self.document(last))
            if fits.any():
                best = np.lexsort((starts[fits], (last - starts)[fits]))[0]
                begins.append(starts[fits][best])
                ends.append(last[fits][best] + 1)
        return np.array(begins, np.int64), np.array(ends, np.int64)


def _within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Values of sorted ``a`` that sorted ``b`` holds."""
    if not len(b):
        return a[:0]
    i = np.searchsorted(b, a)
    return a[b[np.minimum(i, len(b) - 1)] == a]


def _match(phrases: list[np.ndarray], owners: list[list[int]], n_terms: int, slop: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widest = max(map(len, phrases))
        padded = np.array([np.concatenate([p, np.full(widest - len(p), p[0])]) for p in phrases])
        for batch in batches:
            for doc_ids, keys, *lists in zip(*(c.to_pylist() for c in batch.columns)):
                segment = Segment(*lists, n_terms)
                found: dict[int, list] = {}
                for w in np.flatnonzero((segment.counts[padded] > 0).all(axis=1)):
                    if slop is None:
                        begins = segment.exact(phrases[w])
                        ends = begins + len(phrases[w])
                    else:
                        begins, ends = segment.near(phrases[w], len(phrases[w]) + slop)
                    for d, b, e in zip(segment.document(begins).tolist(), begins.tolist(), ends.tolist()):
                        found.setdefault(d, []).append((b, e, w))
                spans, items = [[]] * len(doc_ids), [[]] * len(doc_ids)
                for d, hits in found.items():
                    spans[d] = _joined([(b, e) for b, e, _ in hits], int(segment.begins[d]))
                    items[d] = sorted({i for w in {w for _, _, w in hits} for i in owners[w]})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(segment.n_words, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                        pa.array(items, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_key", "n_words", "spans", "items"],
                )
    return run


def _joined(spans: list[tuple[int, int]], base: int) -> list[dict]:
    """Overlapping and touching spans joined, counted from ``base``."""
    out: list[list[int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [{"begin": b - base, "end": e - base} for b, e in out]


def phrase_matches(documents: DataFrame, windows: DataFrame, slop: int | None = None) -> DataFrame:
    """``(doc_id, text_key, n_words, spans, items)`` of every document row: word spans hit and the items hitting them.

    ``text_key`` is the text's 64-bit hash (``xxhash64``).

    ``windows`` are ``(item_id, phrase)`` rows of space-separated lower-cased
    words. Without ``slop`` a phrase matches word by word. With it, a span
    matches that holds all the phrase's words in any order and is at most
    ``slop`` words longer than the phrase.

    The phrases go through in blocks of ``BLOCK_WINDOWS``, each with an index of
    the terms it asks for, so what is sent to the tasks has a bound that does
    not depend on the tables.
    """
    owned = stored(windows.groupBy("phrase").agg(F.sort_array(F.collect_set("item_id")).alias("items")), "windows")
    blocks = -(-owned.count() // BLOCK_WINDOWS)
    found, passes = None, 0
    for block in range(blocks):
        mine = owned.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == block).collect()
        vocabulary: dict[bytes, int] = {}
        phrases = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in r.phrase.encode().split()]) for r in mine]
        if not phrases:
            continue
        index = build_index(documents, vocabulary)
        rows = index.mapInArrow(_match(phrases, [r["items"] for r in mine], len(vocabulary), slop), _FOUND)
        found = rows if found is None else found.unionByName(rows)
        passes += 1
    if found is None:  # no phrase at all: the documents with their word counts
        index = build_index(documents, {})
        return index.mapInArrow(_match([np.zeros(1, np.int64)], [[]], 1, None), _FOUND)
    if passes > 1:
        found = found.groupBy("doc_id", "text_key").agg(
            F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count(F.lit(1)) / passes).cast("int").alias("copies"),
        ).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return found.select("doc_id", "text_key", "n_words", "spans", "items")


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """``(doc_id, text_key, n_words, spans, items, n_hit, n_items, items_sha256, contaminated)`` of every document row.

    A null text has no words. Items with a null id or text, or without words,
    match nothing. Repeated document rows give a row each; items that share an
    id are one item. Columns other than ``doc_id``, ``text`` and ``item_id`` are
    ignored; empty tables give no rows or no hits.
    """
    found = phrase_matches(documents, item_windows(benchmark, width))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("last")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["last"], s["begin"]))).alias("n"),
            F.greatest(a["last"], s["end"]).alias("last"),
        ),
    )
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select(
        "*", covered["n"].cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"),
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """``documents`` without the rows that hold a window of a benchmark item; all columns and other rows stay as they are."""
    hit = contamination(documents, benchmark, width).filter("contaminated").select(
        F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    packed = documents.select(F.struct(*documents.columns).alias("row"))
    here = F.col("row.doc_id").cast("long").eqNullSafe(F.col("hit_id")) & (F.xxhash64("row.text") == F.col("hit_key"))
    return packed.join(hit, here, "left_anti").select(*[F.col("row").getField(c).alias(c) for c in documents.columns])
