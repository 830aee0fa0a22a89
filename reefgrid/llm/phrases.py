"""Substring deduplication by repeated-phrase automata.

Passages of WIDTH words that recur are confirmed per shard and compiled into an
Aho-Corasick automaton, in which each word is one letter; the text of all
documents that may hold them runs through it, and every occurrence is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reefgrid.llm.common import slices, texts_of
from reefgrid.llm.repeats import WIDTH, Words, joined, marks
from reefgrid.llm.suffixes import with_marks

#: Phrases of one automaton; a shard with more compiles several, one after the other.
AUTOMATON_PHRASES = 20_000
#: Code points of words: all but the surrogates.
_SURROGATES = range(0xD800, 0xE000)

_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class Letters(dict):
    """A letter for each word of a shard."""

    def __missing__(self, word: bytes) -> str:
        n = len(self) + 1
        letter = self[word] = chr(n if n < _SURROGATES.start else n + len(_SURROGATES))
        return letter


def first_documents(groups: list[tuple[int, list[bytes], np.ndarray]]) -> list[np.ndarray]:
    """For every WIDTH-word window of the groups' strings the smallest document number of an equal window."""
    letters = Letters()
    texts, own = [], []
    phrases: dict[str, int] = {}
    recurring: dict[str, int] = {}
    for _, cuts, firsts in groups:
        for cut, first in zip(cuts, firsts.tolist()):
            text = "".join(map(letters.__getitem__, cut.split(b" ")))
            texts.append(text)
            own.append(first)
            for i in range(len(text) - WIDTH + 1):
                phrase = text[i : i + WIDTH]
                seen = phrases.get(phrase)
                if seen is None:
                    phrases[phrase] = first
                else:
                    recurring[phrase] = phrases[phrase] = min(seen, first)
    del phrases
    found = [np.full(len(t) - WIDTH + 1, f, np.int64) for t, f in zip(texts, own)]
    confirmed = list(recurring.items())
    for at in range(0, len(confirmed), AUTOMATON_PHRASES):
        automaton = ahocorasick.Automaton()
        for phrase, first in confirmed[at : at + AUTOMATON_PHRASES]:
            automaton.add_word(phrase, first)
        automaton.make_automaton()
        for text, out in zip(texts, found):
            for end, first in automaton.iter(text):
                out[end - WIDTH + 1] = first
    result, at = [], 0
    for _, cuts, _ in groups:
        result.append(np.concatenate(found[at : at + len(cuts)]))
        at += len(cuts)
    return result


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = []
        for text, copy, spans in zip(texts_of(batch, "text"), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = text.split()
            if copy is not None and len(words) >= WIDTH:
                gone = np.array([[0, len(words)]])
            else:
                gone = joined(spans or [])
            edges = [0, *gone.ravel().tolist(), len(words)]
            kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        n, removed, digests = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"])


def remove_repeated_words(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every document row.

    A word goes if WIDTH consecutive words that cover it also start in a document
    with a smaller ``doc_id``. Passages are judged on the input and never cross
    documents. Null texts have no words. A null id has no order: such a row keeps
    all and stands before none. Rows that repeat an id are one document to each
    other. Other columns are ignored; an empty table gives no rows.
    """
    return with_marks(documents, marks(documents, Words, first_documents)).mapInArrow(_keep, _KEPT)
