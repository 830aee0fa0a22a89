"""What the operators of this subpackage share: written tables, batches of bounded size, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reefgrid.session import prepare, scratch_path

#: Rows per Arrow batch; texts of a batch are worked off in slices of SLICE_BYTES.
ARROW_ROWS = 1000
SLICE_BYTES = 2 << 20
#: Entries of a worker's word cache before it starts anew (a matter of memory only).
CACHE_WORDS = 400_000


def ready(spark: SparkSession) -> SparkSession:
    """The session with the options these operators rely on."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again.

    Cuts lineage: rows computed once stay the same for every later reader, and
    an executor lost later takes nothing with it.
    """
    path = scratch_path(df.sparkSession, label)
    # Shuffle files of what has been written go when the driver's JVM collects its garbage; those of the write before
    # this one were still referred to at its end.
    df.sparkSession.sparkContext._jvm.System.gc()
    df.write.parquet(path, compression=compression)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of each take about ``limit`` bytes; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0))
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """UTF-8 of every text of a batch; null is empty."""
    return [b"" if t is None else t.encode() for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, remembered within a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(x: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` neighbours of ``x`` (uint64), mixed; empty if there are fewer."""
    n = len(x) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    base, power, done, total, part = 0x9E3779B97F4A7C15, 1, 0, np.zeros(n, np.uint64), x
    while power <= width:  # part: hashes of `power` neighbours
        if width & power:
            total = total * np.uint64(pow(base, power, 1 << 64)) + part[done : done + n]
            done += power
        if power * 2 <= width:
            part = part[:-power] * np.uint64(pow(base, power, 1 << 64)) + part[power:]
        power *= 2
    return mixed(total)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def crc32_text(column: Column | str) -> Column:
    """crc32 of a number's decimal text."""
    return F.crc32((F.col(column) if isinstance(column, str) else column).cast("string").cast("binary"))
