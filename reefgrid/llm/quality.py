"""Document quality by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
texts. A text is compressed block by block with each; the normalised difference
of the two sizes becomes a calibrated score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.llm.common import slices, stored, texts_of
from reefgrid.llm.labelled import Logistic, held_out, sample

#: Labelled documents of each class that are learned from at most; a quarter of them calibrates the score.
FIT_ROWS = 4096
#: Text of each class that its dictionary is built from at most, and the dictionary's own size.
FIT_BYTES = 6 << 20
DICTIONARY_BYTES = 96 << 10
#: Blocks are compressed one by one, so that a long text leans on the dictionaries as much as a short one.
BLOCK_BYTES = 1024
LEVEL = 3
THRESHOLD = 0.7

_SCORED = "doc_id long, held_out boolean, score double, predicted int"
FIGURES = 4


def dictionary(texts: list[bytes]) -> bytes:
    """A zstandard dictionary of the texts' common strings; the texts themselves where they are too few to train one."""
    blocks = [t[i : i + BLOCK_BYTES] for t in texts for i in range(0, len(t), BLOCK_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


class Compressors:
    """Compressed sizes of texts by the good and by the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.both = []
        for data in (good, bad):
            if data:
                known = zstandard.ZstdCompressionDict(data)
                known.precompute_compress(level=LEVEL)
                self.both.append(zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))
            else:
                self.both.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False))

    def figures(self, text: bytes) -> tuple[float, float, float, float]:
        """Normalised size difference, size by either dictionary per byte, and the log length; zeros for an empty text."""
        if not text:
            return 0.0, 0.0, 0.0, 0.0
        good, bad = (
            sum(len(c.compress(text[i : i + BLOCK_BYTES])) for i in range(0, len(text), BLOCK_BYTES)) for c in self.both
        )
        return (bad - good) / (bad + good), good / len(text), bad / len(text), float(np.log1p(len(text)))


def _figures(fitted, labelled: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad, curve = fitted.value
        sizes = Compressors(good, bad)
        for batch in slices(batches, "text"):
            found = np.array([sizes.figures(t) for t in texts_of(batch, "text")])
            if labelled:
                yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(list(found), pa.list_(pa.float64()))], ["label", "figures"])
                continue
            score = curve.score(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )
    return run


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, fold: int = 2) -> tuple[bytes, bytes, Logistic]:
    """The two dictionaries and the curve from figures to score.

    They come from a bounded sample: ``FIT_ROWS`` documents of each class, and
    of three quarters of those as many whole texts as ``FIT_BYTES`` hold (in the
    order of a hash; a text that is longer by itself is passed over). The last
    quarter calibrates. Without labelled rows of both classes every score is one half.
    """
    rows = stored(sample(documents, labels, label, folds, fold, FIT_ROWS).withColumns({
        "calibrates": F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0,
        "bytes": F.coalesce(F.octet_length("text"), F.lit(0)),
    }), "quality-sample")
    ahead = F.sum("bytes").over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
    learned = rows.filter(~F.col("calibrates") & (F.col("bytes") <= FIT_BYTES)).withColumn("ahead", ahead).filter(
        F.col("ahead") <= FIT_BYTES).orderBy("label", "ahead").select("label", "text")
    texts: tuple[list, list] = ([], [])
    for row in learned.toLocalIterator():
        if row.text:
            texts[row.label].append(row.text.encode())
    bad, good = (dictionary(t) for t in texts)
    context = documents.sparkSession.sparkContext
    tuned = rows.filter("calibrates").select("doc_id", "text", "label").mapInArrow(
        _figures(context.broadcast((good, bad, None)), True), "label int, figures array<double>").collect()
    y = np.array([r.label for r in tuned], float)
    x = np.array([r.figures for r in tuned]).reshape(len(tuned), FIGURES)
    if len(set(y.tolist())) < 2:
        x, y = np.zeros((2, FIGURES)), np.array([0.0, 1.0])
    return good, bad, Logistic(x, y)


def quality_scores(documents: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, fold: int = 2) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document row; ``predicted`` is 1 from ``THRESHOLD`` on.

    Scores come from the whole text alone. Null and empty texts get the curve's
    value at zero figures. A null id is not held out. Repeated rows are scored
    each; other columns are ignored.
    """
    fitted = fit(documents, labels, label, folds, fold)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out("doc_id", folds, fold).alias("held_out"))
    shared = documents.sparkSession.sparkContext.broadcast(fitted)
    return rows.mapInArrow(_figures(shared, False), _SCORED)
