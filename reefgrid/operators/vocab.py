"""Whole-image descriptors: the cap on descriptors, mean vectors, and loop candidates by their exact cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.operators.ranks import number_rows
from reefgrid.session import pin

# Default retrieval settings.
LOOP_PERIOD, LOOP_IMAGES = 10, 100
# Asked images compared in one pass over all images, and images compared at a time (matters of memory only).
LOOP_BLOCK, LOOP_SLICE = 4096, 512


def capped(desc: DataFrame, cap: int, seed: int = 42) -> DataFrame:
    """At most ``cap`` descriptors, picked in hash order; all of them for -1."""
    if cap < 0:
        return desc
    mixed = desc.withColumn("_h", F.xxhash64("descriptor", "image_id", F.lit(seed)))
    return number_rows(mixed, ["_h"], "_n").filter(F.col("_n") <= cap).drop("_h", "_n")


def mean_vectors(desc: DataFrame, dims: int) -> DataFrame:
    """Mean descriptor of each image at unit length, one column per dimension."""
    means = desc.groupBy("image_id").agg(
        vector_to_array(Summarizer.mean(array_to_vector("descriptor"))).alias("v")
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, e: acc + e * e))
    scaled = means.withColumn("_n", norm).filter(F.col("_n") > 0)
    return scaled.select("image_id", *[(F.col("v")[i] / F.col("_n")).alias(f"v{i}") for i in range(dims)])


def _most_similar(block, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, wanted = block.value
        best = np.full(len(asked), -np.inf)  # similarity below which an image is none of the n
        which, ids, similar = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for whole in batches:
            for at in range(0, whole.num_rows, LOOP_SLICE):
                batch = whole.slice(at, LOOP_SLICE)
                own = batch.column(0).to_numpy()
                vectors = batch.column(1).flatten().to_numpy().reshape(len(own), -1)
                # Added up dimension by dimension: equal vectors tie exactly, whatever slice they are in.
                cosine = np.zeros((len(asked), len(own)))
                for d in range(vectors.shape[1]):
                    cosine += wanted[:, d, None] * vectors[None, :, d]
                q, i = np.nonzero(~(cosine < best[:, None]) & (asked[:, None] != own))
                which, ids, similar = (np.concatenate(x) for x in ((which, q), (ids, own[i]), (similar, cosine[q, i])))
                # NaN is greater than any number.
                order = np.lexsort((ids, np.where(np.isnan(similar), -np.inf, -similar), which))
                starts = np.searchsorted(which[order], np.arange(len(asked)))
                nth = np.arange(len(order)) - starts[which[order]]
                last = order[nth == n - 1]
                best[which[last]] = np.where(np.isnan(similar[last]), np.inf, similar[last])
                kept = order[nth < n]
                which, ids, similar = which[kept], ids[kept], similar[kept]
        yield pa.RecordBatch.from_arrays([pa.array(asked[which]), pa.array(ids), pa.array(similar)], ["image_id1", "image_id2", "similarity"])
    return run


def loop_pairs(vectors: DataFrame, period: int = LOOP_PERIOD, n: int = LOOP_IMAGES) -> DataFrame:
    """For every ``period``-th image, its ``n`` most similar others, most similar first.

    Exact: the images asked for are compared with all images, ``LOOP_BLOCK`` of
    them in a pass; a task hands on no more than ``n`` candidates of each.
    Similarity is the cosine; ties go to the smaller id.
    """
    dims = [c for c in vectors.columns if c != "image_id"]
    packed = pin(vectors.filter(F.col("image_id").isNotNull()).select(F.col("image_id").cast("bigint").alias("image_id"), F.array(*dims).alias("v")))
    asked = packed.filter(F.col("image_id") % period == 0)
    blocks = max(1, -(-asked.count() // LOOP_BLOCK))
    found = None
    for b in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("image_id"), F.lit(blocks)) == b).toArrow()
        wanted = mine.column(1).combine_chunks().flatten().to_numpy().reshape(mine.num_rows, len(dims))
        block = vectors.sparkSession.sparkContext.broadcast((mine.column(0).to_numpy(), wanted))
        near = packed.mapInArrow(_most_similar(block, n), "image_id1 bigint, image_id2 bigint, similarity double")
        found = near if found is None else found.unionByName(near)
    order = Window.partitionBy("image_id1").orderBy(F.desc("similarity"), "image_id2")
    return found.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= n).select(
        "image_id1", "image_id2", "rank", "similarity")
