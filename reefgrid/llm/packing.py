"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Pieces are range-sorted by length. Equal lengths form runs, as do equal gaps of
open sequences, and a run is known by its size and its ranks alone. Each
bulk-synchronous round sweeps both sorted run lists once: every gap takes the
nearest size below it, ranks decide which pieces go to which gaps where several
want the same, gaps shrink, and the next round begins. A capacity of 2048
bounds the runs by a number that does not grow with the documents; the pieces
themselves are ranked, placed and written by the executors.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.llm.common import CACHE_WORDS, slices, stored, texts_of

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACES = "size long, first long, past long, sequence long, each long, used long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Words whose characters case, compose and part the same way in Python as in the tokenizer, and their parts: letters,
#: single digits and runs of anything else, as the tokenizer's word pattern has them.
_PLAIN = re.compile("[!-~\u00a1-\u024f]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_²³¹¼-¾]+|[\\d²³¹¼-¾]|(?:[^\\w\\s]|_)+")


class _Parts(dict):
    """Ids of word parts, straight from the tokenizer's merges; a bounded cache."""

    def __init__(self, model):
        self.model = model
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printed]
        self.letters = {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def __missing__(self, part: str) -> bytes:
        if len(self) >= 2 * CACHE_WORDS:
            self.clear()
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        value = self[part] = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        return value


class TokenBytes(dict):
    """Token ids of texts as little-endian 32-bit numbers.

    This tokenizer's normaliser and word pattern never join characters across
    white space, so a text's ids are those of its white-space separated words,
    and theirs are those of their parts, which are remembered within bounded caches.
    Words of plain letters are lower-cased and parted here; any other goes through
    the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = _Parts(self.tokenizer.model)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= 2 * CACHE_WORDS:
            self.clear()
        text, parts = word.decode(), self.parts
        if _PLAIN.fullmatch(text) and "<|" not in text:
            low = text.lower()
            if low.isalpha():
                value = parts[low]
            elif low[-1] in ".,;:!?" and low[:-1].isalpha():
                value = parts[low[:-1]] + parts[low[-1]]
            else:
                value = b"".join(map(parts.__getitem__, _PARTS.findall(low)))
        else:
            value = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[word] = value
        return value

    def of(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


@functools.cache
def _tokens(path: str) -> TokenBytes:
    """One tokenizer and its caches for all tasks of a worker."""
    return TokenBytes(path)


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), map(tokens.of, texts_of(batch, "text"))):
                ids += b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )
    return run


def token_pieces(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: every document's ids and a closing 0, cut at ``capacity``."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_cut(path, capacity), _PIECES)


def place_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """``(size, first, past, sequence, each, used)``: pieces ``first`` to ``past`` of a size fill sequences from
    ``sequence`` on, ``each`` to a sequence, beginning ``used`` ids into it.

    As many sequences are opened as the ids need at least, or as there are
    pieces of more than half a sequence, with the longest pieces. Then gaps are
    filled round by round; what fits no gap opens sequences in the same way.
    """
    left = {size: n for size, n in counts.items() if n}
    taken = dict.fromkeys(left, 0)
    places: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[tuple[int, int, int]] = []  # gap, first sequence, number of sequences
    opened = 0

    def take(size: int, n: int, sequence: int, each: int, used: int) -> None:
        places.append((size, taken[size], taken[size] + n, sequence, each, used))
        taken[size] += n
        left[size] -= n
        if not left[size]:
            del left[size]

    while left:
        need = max(-(-sum(s * n for s, n in left.items()) // capacity), sum(n for s, n in left.items() if 2 * s > capacity))
        for size in sorted(left, reverse=True):
            n = min(need, left[size])
            if n:
                take(size, n, opened, 1, 0)
                gaps.append((capacity - size, opened, n))
                opened, need = opened + n, need - n
        moved = True
        while moved and left:
            moved, after = False, []
            for gap, sequence, n in sorted(gaps):
                sizes = sorted(left)
                while n:
                    at = bisect_right(sizes, gap)
                    if not at:
                        after.append((gap, sequence, n))
                        break
                    size = sizes[at - 1]
                    each = gap // size if left[size] >= n * (gap // size) else 1
                    fed = min(n, left[size] // each)
                    take(size, fed * each, sequence, each, capacity - gap)
                    if gap > size * each:
                        after.append((gap - size * each, sequence, fed))
                    sequence, n, moved = sequence + fed, n - fed, True
                    if size not in left:
                        sizes.pop(at - 1)
            gaps = after
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, in as few sequences as best fit reaches.

    Every piece is placed, also repeated ones; ties in length are ranked by
    ``doc_id``, ``piece`` and ``start``, null ids first.
    """
    spark = pieces.sparkSession
    order = ["length", "doc_id", "piece", "start"]
    shuffles = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = stored(pieces.repartitionByRange(shuffles, *order).withColumn("slab", F.spark_partition_id()), "packing-sorted")
    # A slab holds one range of lengths, so these are at most `capacity` rows and one for each slab.
    slabs = sorted_.groupBy("length", "slab").agg(F.count(F.lit(1)).alias("n")).collect()
    ahead, counts = [], {}
    for row in sorted(slabs):
        ahead.append((row.length, row.slab, counts.get(row.length, 0)))
        counts[row.length] = counts.get(row.length, 0) + row.n
    offsets = spark.createDataFrame(ahead, "length long, slab int, ahead long")
    places = spark.createDataFrame(place_runs(counts, capacity), _PLACES)
    local = F.row_number().over(Window.partitionBy("slab", "length").orderBy(*order[1:]))
    ranked = sorted_.withColumn("local", local).join(F.broadcast(offsets), ["length", "slab"]).withColumn(
        "rank", F.col("local") - 1 + F.col("ahead")
    )
    placed = ranked.join(F.broadcast(places), (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")))
    nth = F.col("rank") - F.col("first")
    return placed.select(
        *pieces.columns, (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("used") + (nth % F.col("each")) * F.col("length")).alias("offset"),
    )


def pack_documents(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of every document row.

    Null and empty texts are the closing id alone. Only documents of more than
    ``capacity`` ids are cut. Columns other than ``doc_id`` and ``text`` are
    ignored; an empty table gives no rows.
    """
    # A range sort reads its input twice, so the pieces are written first.
    return pack(stored(token_pieces(documents, path or tokenizer_path(), capacity), "packing-pieces"), capacity)


def lower_bound(total: int, capacity: int = CAPACITY) -> int:
    return math.ceil(total / capacity)
