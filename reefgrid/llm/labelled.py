"""Labelled rows for fitting a classifier, and the logistic curve that makes its figures a score."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import crc32_text


def held_out(column: str, folds: int, fold: int) -> Column:
    """Whether a row's label is kept from learning: crc32 of the id's text modulo ``folds`` is ``fold``; a null id's is not."""
    return F.coalesce(crc32_text(column) % folds == fold, F.lit(False))


def _usable(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """``(doc_id, label)`` of the ids that are not held out, each with its largest label of 0 and 1."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out("doc_id", folds, fold))
    return usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def labelled(documents: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """``(doc_id, text, label)`` of all labelled documents that are not held out.

    An id labelled more than once takes its largest label; labels other than 0
    and 1 and null ids are passed over.
    """
    return documents.select("doc_id", "text").join(_usable(labels, label, folds, fold), "doc_id")


def sample(documents: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``rows`` labelled documents of each class, none of them held out.

    The rows are those whose ids have the smallest hashes. An id labelled more
    than once takes its largest label; labels other than 0 and 1 and null ids
    are passed over.
    """
    one = _usable(labels, label, folds, fold)
    # Each task keeps no more than the rows wanted of a class; a rank by class would bring all of a class to one task.
    classes = [one.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    chosen = classes[0].unionByName(classes[1])
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


class Logistic:
    """Logistic regression on few columns, fitted by Newton's method with a small ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self._fit(x.mean(axis=0), x.std(axis=0), lambda: self._sums(x, y))

    @classmethod
    def of_table(cls, rows: DataFrame, columns: int) -> Logistic | None:
        """The curve of all ``(label, figures)`` rows, None if a class has none; each step adds up sums of the tasks."""
        at = [F.col("figures")[i] for i in range(columns)]
        seen = rows.agg(F.count_distinct("label"), *[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
        if seen[0] < 2:
            return None
        curve = cls.__new__(cls)

        def sums() -> tuple[np.ndarray, np.ndarray]:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, columns)
                    slope, bend = curve._sums(x, batch.column(0).to_numpy().astype(float))
                    flat = np.concatenate([slope, bend.ravel()])
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["at", "x"])
            parts = rows.select("label", "figures").mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x")).orderBy("at").collect()
            flat, n = np.array([x for _, x in parts]), columns + 1
            return flat[:n], flat[n:].reshape(n, n)
        curve._fit(np.array(seen[1 : columns + 1]), np.array(seen[columns + 1 :]), sums)
        return curve

    def _fit(self, middle: np.ndarray, width: np.ndarray, sums: Callable) -> None:
        self.middle, self.width = middle, np.maximum(width, 1e-9)
        self.weights = np.zeros(len(middle) + 1)
        ridge = np.full(len(self.weights), 1e-2)
        for _ in range(30):
            slope, bend = sums()
            step = np.linalg.solve(bend + np.diag(ridge), slope - ridge * self.weights)
            self.weights += step
            if np.abs(step).max() < 1e-8:
                break

    def _sums(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slope and curvature of the likelihood at the present weights."""
        z = self._design(x)
        p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
        return z.T @ (y - p), (z * (p * (1 - p))[:, None]).T @ z

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.width, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(x) @ self.weights, -30, 30)))
