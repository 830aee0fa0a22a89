"""Toxicity by two class-conditional Kneser-Ney models.

The models predict the letters of a word, so that an expression spelled or
inflected anew is still known by its parts. Each class has its own long n-grams;
short ones are counted over both classes together, and what a class has hardly
seen is smoothed towards these shared counts and speaks for neither. A text's
figures are differences of the two log-likelihoods, normalised by its length and
by that of its most toxic windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import CACHE_WORDS, mixed, slices, stored
from reefgrid.llm.decontaminate import words_of
from reefgrid.llm.labelled import Logistic, held_out, labelled

#: One labelled document of so many calibrates the score; the others are counted.
CALIBRATES = 4
#: Letters of the longest n-grams; n-grams of up to SHARED letters are counted over both classes.
ORDER = 6
SHARED = 3
DISCOUNT = 0.75
#: Words of the windows, and the difference from which a word counts as telling.
WINDOWS = (4, 16, 64)
TELLING = 2.0
THRESHOLD = 0.7

_SCORED = "doc_id long, held_out boolean, score double, predicted int"
_GRAMS = "label int, size int, gram long, suffix long, context long, opens boolean, n long"
FIGURES = 4 + len(WINDOWS)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words with a mark before (2) and after (3) each, and every letter's place in its word."""
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begins = np.repeat(np.cumsum(sizes) - sizes, sizes)
    return flat.astype(np.uint64), np.arange(len(flat)) - begins


def _grams(letters: np.ndarray) -> Iterator[np.ndarray]:
    """Keys of the n-grams ending at every letter, by growing n; the first is of n = 0."""
    total = np.zeros(len(letters), np.uint64)
    base = 1
    yield mixed(total)
    for n in range(1, ORDER + 1):
        shifted = np.concatenate([np.zeros(n - 1, np.uint64), letters])[: len(letters)]
        total = total + shifted * np.uint64(base)
        base = base * 0x9E3779B97F4A7C15 % 2**64
        yield mixed(total + np.uint64(n))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found[label].update(words_of((text or "").lower().encode()))
        for label in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(found[label]), pa.int32()), pa.array([w.decode() for w in found[label]], pa.string()),
                 pa.array(list(found[label].values()), pa.int64())], ["label", "word", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(iter([whole]), "word", 1 << 18):
            for label in (0, 1):
                mine = batch.filter(pa.compute.equal(batch.column(0), label))
                if not mine.num_rows:
                    continue
                words, n = mine.column(1).to_pylist(), mine.column(2).to_numpy()
                letters, place = _letters(words)
                weight = np.repeat(n, [len(w) + 2 for w in words])
                before = None
                for size, gram in enumerate(_grams(letters)):
                    if size:
                        at = np.flatnonzero((place >= size - 1) & (place >= 1))
                        keys, first, which = np.unique(gram[at], return_index=True, return_inverse=True)
                        first = at[first]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(keys), label, np.int32)), pa.array(np.full(len(keys), size, np.int32)),
                             pa.array(keys.view(np.int64)), pa.array(before[first].view(np.int64)),
                             pa.array(before[first - 1].view(np.int64)), pa.array(place[first] == size - 1),
                             pa.array(np.bincount(which, weight[at]).astype(np.int64))],
                            ["label", "size", "gram", "suffix", "context", "opens", "n"])
                    before = gram


def _kneser_ney(grams: DataFrame) -> DataFrame:
    """``(label, size, gram, context, n)``: counts of the longest and of word-opening n-grams, continuation kinds of the others.

    n-grams of up to ``SHARED`` letters appear once, with label 0, counted over both classes.
    """
    key = ["label", "size", "gram"]
    whole = grams.groupBy(*key).agg(
        F.min("suffix").alias("suffix"), F.min("context").alias("context"), F.bool_or("opens").alias("opens"), F.sum("n").alias("n"))
    kinds = whole.filter("size > 1").groupBy("label", (F.col("size") - 1).alias("size"), F.col("suffix").alias("gram")).agg(
        F.count(F.lit(1)).alias("kinds"))
    exact = (F.col("size") == ORDER) | F.col("opens")
    counts = whole.join(kinds, key, "left").select(
        *key, "context", F.when(exact, F.col("n")).otherwise(F.coalesce("kinds", "n")).alias("n"))
    label = F.when(F.col("size") <= SHARED, F.lit(0)).otherwise(F.col("label"))
    return counts.groupBy(label.alias("label"), "size", "gram").agg(F.min("context").alias("context"), F.sum("n").alias("n"))


class KneserNey:
    """Both classes' models and the curve from figures to score."""

    def __init__(self, counts: DataFrame):
        rows = counts.select("label", "size", "gram", "context", "n").toArrow()
        label, size, gram, context, n = (rows.column(i).to_numpy() for i in range(5))
        grams, contexts = [], []
        for k in range(1, ORDER + 1):
            each = []
            for c in (0,) if k <= SHARED else (0, 1):
                at = (size == k) & (label == c)
                keys, which, kinds = np.unique(context[at].view(np.uint64), return_inverse=True, return_counts=True)
                total = np.bincount(which, n[at], len(keys))
                share = np.maximum(n[at] - DISCOUNT, 0) / np.maximum(total[which], 1)
                each.append((gram[at].view(np.uint64), share, keys, DISCOUNT * kinds / np.maximum(total, 1)))
            grams.append([(g, v) for g, v, _, _ in each])
            contexts.append([(g, v) for _, _, g, v in each])
        # A context of k letters is found along with the n-grams of k letters; a class that has not seen it leaves what
        # the shorter one says. The last entries stand for what is not known.
        self.start, *self.parts = [_part(own, following) for own, following in zip([[], *grams], [*contexts, []])]
        self.known = Known()
        self.curve: Logistic | None = None

    def _learn(self, words: list[bytes]) -> None:
        """Differences of words not met before: the sum over their letters of log p(toxic) - log p(ordinary)."""
        letters, place = _letters([w.decode() for w in words])
        p = np.full((2, len(letters)), 1e-4)
        backoffs = context = None
        for k, keys in enumerate(_grams(letters)):
            places, shares, following = self.parts[k - 1] if k else self.start
            at = places.of(keys)
            if k:
                # n-grams that would reach into the word before are none.
                inside = place >= k - 1
                mine, before = np.where(inside, at, places.none), np.where(inside, context, len(backoffs[0]) - 1)
                for c in (0, 1):
                    p[c] = shares[c % len(shares)][mine] + backoffs[c % len(backoffs)][before] * p[c]
            backoffs, context = following, np.concatenate([at[:1], at[:-1]])
        each = np.where(place > 0, np.log(p[1]) - np.log(p[0]), 0)
        starts = np.flatnonzero(place == 0)
        self.known.update(zip(words, np.add.reduceat(each, starts).tolist()))

    def differences(self, words: list[bytes]) -> np.ndarray:
        """log p(word | toxic) - log p(word | ordinary) of every word, within -8 and 8."""
        found = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        missed, self.known.missed = self.known.missed, []
        if missed:
            fresh = list(dict.fromkeys(missed))
            if len(self.known) + len(fresh) > 2 * CACHE_WORDS:
                self.known.clear()
            for i in range(0, len(fresh), 20_000):
                self._learn(fresh[i : i + 20_000])
            found[np.isnan(found)] = np.fromiter(map(self.known.__getitem__, missed), np.float64, len(missed))
        return np.clip(found, -8, 8)

    def figures(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text: mean difference per word, that of its most toxic windows, share and number of
        telling words, and log length; zeros for a text without words."""
        out = np.zeros((len(texts), FIGURES))
        words = [words_of((text or "").lower().encode()) for text in texts]
        # All texts at once: a few words at a time cost more in calls than in work.
        flat = self.differences(list(chain.from_iterable(words)))
        ends = np.cumsum([len(w) for w in words]).tolist()
        for i, (a, b) in enumerate(zip([0, *ends], ends)):
            own, n = flat[a:b], b - a
            if not n:
                continue
            sums = np.concatenate([[0.0], np.cumsum(own)])
            windows = [(sums[w:] - sums[:-w]).max() / w if n >= w else sums[-1] / w for w in WINDOWS]
            telling = int((own >= TELLING).sum())
            out[i] = [sums[-1] / n, *windows, telling / n, np.log1p(telling), np.log1p(n)]
        return out


class Known(dict):
    """Values of words; a word without one is noted in ``missed`` and is nan."""

    def __init__(self):
        self.missed: list[bytes] = []

    def __missing__(self, word: bytes) -> float:
        self.missed.append(word)
        return np.nan


class Places:
    """Places of sorted, evenly spread keys, found through their leading bits; ``none`` for what is not among them.

    The length is the number of n-grams among the keys, without those that are contexts alone.
    """

    def __init__(self, keys: np.ndarray, grams: int):
        self.none, self.grams = len(keys), grams
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(keys >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)
        self.keys = np.append(keys, np.uint64(2**64 - 1))

    def __len__(self) -> int:
        return self.grams

    def of(self, wanted: np.ndarray) -> np.ndarray:
        at = self.starts[wanted >> self.shift]
        here = self.keys[at]
        behind = np.flatnonzero(here < wanted)
        while len(behind):
            at[behind] += 1
            here[behind] = self.keys[at[behind]]
            behind = behind[here[behind] < wanted[behind]]
        return np.where(here == wanted, at, self.none)


def _part(own: list[tuple], following: list[tuple]) -> tuple[Places, np.ndarray, np.ndarray]:
    """Places of n-grams of one length, each class's shares of them, and its weights of what is shorter after them."""
    grams, contexts = ([np.zeros(0, np.uint64), *[k for k, _ in tables]] for tables in (own, following))
    keys = np.unique(np.concatenate(grams + contexts))
    return Places(keys, len(np.unique(np.concatenate(grams)))), _values(keys, own, 0.0), _values(keys, following, 1.0)


def _values(keys: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]], missing: float) -> np.ndarray:
    """For each table its values at the sorted keys, and ``missing`` where it has none and after the last."""
    values = np.full((max(1, len(tables)), len(keys) + 1), missing)
    for i, (k, v) in enumerate(tables):
        values[i, np.searchsorted(keys, k)] = v
    return values


def _scores(model: KneserNey, found: np.ndarray) -> np.ndarray:
    """Scores of figures; a text without words speaks for neither class."""
    return np.where(found.any(axis=1), model.curve.score(found), 0.5)


def _figures(model, labelled: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kn = model.value
        for batch in slices(batches, "text"):
            found = kn.figures(batch.column(1).to_pylist())
            if labelled:
                yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(list(found), pa.list_(pa.float64()))], ["label", "figures"])
                continue
            score = _scores(kn, found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )
    return run


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, fold: int = 1) -> KneserNey:
    """Models of all labelled documents that are not held out.

    Three quarters of them are counted, the last quarter calibrates the score.
    All n-grams of the counted rows are kept, and every worker holds them:
    memory grows with the distinct n-grams of the labelled texts' words, at most
    48 bytes for each. Without labelled rows of both
    classes every score is one half.
    """
    rows = labelled(documents, labels, label, folds, fold)
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(CALIBRATES)) == 0
    learned = rows.filter(~calibrates).select("text", "label").mapInArrow(_count_words, "label int, word string, n long")
    words = stored(learned.groupBy("label", "word").agg(F.sum("n").alias("n")), "toxicity-words")
    model = KneserNey(stored(_kneser_ney(words.mapInArrow(_count_grams, _GRAMS)), "toxicity-grams"))
    context = documents.sparkSession.sparkContext
    shared = context.broadcast(model)
    tuned = stored(rows.filter(calibrates).select("doc_id", "text", "label").mapInArrow(
        _figures(shared, True), "label int, figures array<double>"), "toxicity-figures")
    model.curve = Logistic.of_table(tuned, FIGURES) or Logistic(np.zeros((2, FIGURES)), np.array([0.0, 1.0]))
    shared.unpersist()
    return model


def toxicity_scores(documents: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, fold: int = 1) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document row; ``predicted`` is 1 from ``THRESHOLD`` on.

    Scores come from the whole text alone. Null and empty texts have no words
    and score one half. A null id is not held out. Repeated rows are scored each; other columns are ignored.
    """
    model = fit(documents, labels, label, folds, fold)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out("doc_id", folds, fold).alias("held_out"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_figures(shared, False), _SCORED)


def _passing(model, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kn = model.value
        for batch in slices(batches, "text"):
            score = _scores(kn, kn.figures(batch.column(text).to_pylist()))
            yield batch.filter(pa.array(score < THRESHOLD))
    return run


def without_toxic(documents: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, fold: int = 1) -> DataFrame:
    """``documents`` without the rows that score ``THRESHOLD`` or more; all columns and other rows stay as they are."""
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, label, folds, fold))
    return documents.mapInArrow(_passing(model, documents.columns.index("text")), documents.schema)
