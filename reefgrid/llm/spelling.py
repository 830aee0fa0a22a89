"""Spelling variants: words one edit apart, found through a variable-length gram index.

The gram dictionary holds the grams that too many words have. At every place of a
word stands its shortest gram that is not in the dictionary, so frequent beginnings
are told apart by longer grams and rare ones stay short. A gram is settled by its
own letters alone, hence an edit affects just the grams that hold the edited place.

Of two grams without a common place an edit affects one at most. Every word
therefore takes the two such grams whose lists are shortest, and each word one
edit away stands in one of these two lists; all other lists of the word need not
be read. What the lists give is verified letter by letter as they are joined.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import CACHE_WORDS, slices, stored

MIN_LENGTH, MIN_COUNT = 7, 2
#: A near word is a word's form if it occurs so many times as often.
FORM_TIMES = 10
#: Lengths of grams. Two halves of a word of MIN_LENGTH hold a gram of SHORTEST each.
SHORTEST, LONGEST = 2, 4
#: A gram of more words than this is in the dictionary; on large vocabularies the bound is higher, so that the
#: dictionary never has more than MOST_GRAMS grams.
FREQUENT, MOST_GRAMS = 300, 200_000
#: Lengths of lists are known by hash, in so many cells; they only decide which of a word's lists are read.
CELL_BITS = 20

_RUN = re.compile("[a-zÀ-ÿ]+")


def _drop(doc, run: str, head: int, every: int) -> str:
    """The run, or the run without one letter where its hash with the document's id is a multiple of ``every``."""
    h = zlib.crc32(run.encode(), head)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(every: int, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                head = zlib.crc32(("" if doc is None else f"{doc}").encode() + b":")
                low = text.encode().lower().decode()  # bytes: A-Z only
                for found, n in Counter([r for r in _RUN.findall(low) if len(r) >= min_length]).items():
                    word = _drop(doc, found, head, every)
                    if len(word) >= min_length:
                        counts[word] += n
            if len(counts) >= CACHE_WORDS:
                yield out()
                counts.clear()
        if counts:
            yield out()
    return run


def words_of(documents: DataFrame, every: int = 31, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: runs of Latin letters, A-Z lower-cased, with misprints made by dropping a letter of every ``every``-th run."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count(every, min_length), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(gram, n)`` of the grams that may go into the dictionary, in parts."""
    counts: Counter = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            for size in range(SHORTEST, LONGEST):
                counts.update([word[p : p + size] for p in range(len(word) - size + 1)])
        if len(counts) >= CACHE_WORDS:
            yield pa.RecordBatch.from_pydict({"gram": list(counts), "n": list(counts.values())})
            counts.clear()
    if counts:
        yield pa.RecordBatch.from_pydict({"gram": list(counts), "n": list(counts.values())})


def gram_dictionary(words: DataFrame) -> set[str]:
    """Grams, shorter than the longest, of more than FREQUENT words' places; MOST_GRAMS of them at most."""
    places = sum(F.greatest(F.length("word") - size + 1, F.lit(0)) for size in range(SHORTEST, LONGEST))
    total = words.agg(F.sum(places)).first()[0]
    # At most total / bound grams have more than bound places.
    bound = max(FREQUENT, -(-(total or 0) // MOST_GRAMS))
    grams = words.select("word").mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return set(grams.filter(F.col("n") > bound).select("gram").toArrow().column(0).to_pylist())


def grams_of(word: str, dictionary: set[str]) -> list[str]:
    """The gram at every place of a word: the shortest that is not in the dictionary, or all that is left of the word."""
    out, n = [], len(word)
    for p in range(n - SHORTEST + 1):
        end = p + SHORTEST
        while end < n and end - p < LONGEST and word[p:end] in dictionary:
            end += 1
        out.append(word[p:end])
    return out


def _list_name(gram: str, length: int, place: int) -> str:
    return f"{gram} {length} {place}"


def _letters(word: str) -> int:
    """Parity of the letters of a word, in 64 bits: an edit changes two at most."""
    value = 0
    for c in word:
        value ^= 1 << (ord(c) & 63)
    return value - (1 << 64) if value >> 63 else value


def _postings(dictionary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = dictionary.value
        for batch in batches:
            lists, words, letters = [], [], []
            for word in batch.column(0).to_pylist():
                names = [_list_name(g, len(word), p) for p, g in enumerate(grams_of(word, frequent))]
                lists += names
                words += [word] * len(names)
                letters += [_letters(word)] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists, pa.string()), pa.array(words, pa.string()), pa.array(letters, pa.int64())], ["list", "other", "other_letters"])
    return run


def _cells(names: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(x.encode()) for x in names), np.int64, len(names)) & ((1 << CELL_BITS) - 1)


def _probes(dictionary, sizes):
    """The lists that each word reads: those of its two grams, among words of its length and among those one longer.

    A row of the second gram names the first, for words that have both come from the first list alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, cells = dictionary.value, sizes.value
        for batch in batches:
            rows: list[tuple] = []
            for word in batch.column(0).to_pylist():
                n, grams = len(word), grams_of(word, frequent)
                names = [_list_name(g, n, p) for p, g in enumerate(grams)]
                cost = cells[_cells(names)].tolist()
                # The shortest list that begins at a place or later.
                later: list[int] = [0] * len(grams)
                for p in range(len(grams) - 1, -1, -1):
                    later[p] = p if p == len(grams) - 1 or cost[p] <= cost[later[p + 1]] else later[p + 1]
                pairs = [(cost[p] + cost[later[p + len(g)]], p) for p, g in enumerate(grams) if p + len(g) < len(grams)]
                p = min(pairs)[1]
                q, letters = later[p + len(grams[p])], _letters(word)
                first = (word, letters, None, 0)
                second = (word, letters, grams[p], p + 1)
                rows += [(names[p], *first), (names[q], *second),
                         (_list_name(grams[p], n + 1, p), *first), (_list_name(grams[q], n + 1, q + 1), *second)]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["list", "word", "letters", "first_gram", "first_at"])
    return run


def near_words(words: DataFrame) -> DataFrame:
    """``(word, other)``, once for each two of ``words`` that one inserted, deleted or replaced letter parts.

    ``words`` are distinct and have at least LONGEST + SHORTEST letters.
    """
    context = words.sparkSession.sparkContext
    dictionary = context.broadcast(gram_dictionary(words))
    postings = stored(words.select("word").mapInArrow(_postings(dictionary), "list string, other string, other_letters long"), "spelling-lists")
    cell = F.crc32(F.col("list").cast("binary")).bitwiseAND(F.lit((1 << CELL_BITS) - 1))
    known = postings.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    sizes = np.zeros(1 << CELL_BITS, np.int64)
    sizes[known.column("cell").to_numpy()] = known.column("n").to_numpy()
    probes = words.select("word").mapInArrow(
        _probes(dictionary, context.broadcast(sizes)), "list string, word string, letters long, first_gram string, first_at int")
    met = (
        (F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2)
        & ((F.col("word") < F.col("other")) | (F.length("word") < F.length("other")))
        & (F.levenshtein("word", "other", 1) == 1)
        & (F.col("first_gram").isNull() | (F.substring("other", F.col("first_at"), F.length("first_gram")) != F.col("first_gram")))
    )
    both = probes.withColumnRenamed("list", "read").join(postings, (F.col("read") == F.col("list")) & met)
    return both.select("word", "other")


def spelling_groups(documents: DataFrame, every: int = 31, times: int = FORM_TIMES) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the documents.

    A word's ``form`` is the most frequent word one edit away (ties: the first in
    code-point order) if that is at least ``times`` as frequent; ``root`` is where
    the forms lead in the end. ``n_near`` counts the words one edit away.

    Null and empty texts have no words; texts are read whole, however long, and
    repeated rows count as often as they occur. A null ``doc_id`` counts as an
    empty one where misprints are made. Columns other than ``doc_id`` and
    ``text`` are ignored; a table without words gives no rows.
    """
    words = stored(words_of(documents, every), "spelling-words")
    near = stored(near_words(words), "spelling-near")
    both = near.unionByName(near.select(F.col("other").alias("word"), F.col("word").alias("other")))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(counts, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    judged = words.join(best, "word", "left").withColumn("taken", -F.col("best.less") >= times * F.col("n"))
    formed = stored(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("taken"), F.col("best.other")).alias("form"),
        F.when(F.col("taken"), -F.col("best.less")).alias("form_n")), "spelling-forms")
    # Every step multiplies the count by `times`, so few doublings reach the end of every chain.
    leads = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = leads.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(leads.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        leads = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return formed.join(leads, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
