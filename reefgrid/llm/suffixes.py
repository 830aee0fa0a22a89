"""Suffix-array deduplication: bytes of strings that an earlier document has are removed.

Shards of text that may repeat get a suffix array by induced sorting: suffixes
are classified, the leftmost-smaller (LMS) substrings sorted and named, the
string of their names sorted in turn, and the array induced from them in two
linear sweeps. Permuted common prefixes, computed in text order, tell which
neighbours in the array share WIDTH bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import slices, texts_of
from reefgrid.llm.repeats import WIDTH, Bytes, joined, marks

_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def classify(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S-type); the last one is not."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1])
    step[-1] = -1
    known = np.flatnonzero(step)
    return step[known[np.searchsorted(known, np.arange(n))]] > 0


def _sorted_lms(s: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """LMS suffixes in the order of their first ``depth`` letters."""
    # Names of the LMS substrings, each with the letter it ends on, four letters at a time.
    ends = np.append(lms[1:], len(s) - 1)
    padded = np.concatenate([s.astype(np.int64) + 1, np.zeros(8, np.int64)])
    name = np.zeros(len(lms), np.int64)
    at = lms.copy()
    while True:
        key = name
        for j in range(4):
            key = key * 512 + np.where(at + j <= ends, padded[np.minimum(at + j, len(padded) - 1)], 0)
        name = _ranks(key)
        at = at + 4
        if (at > ends).all() or (at - lms).max() > depth:
            break
    # The string of names in turn: ranks of 1, 2, 4, ... names until all differ or depth is reached. A name but the
    # last has two letters at least.
    span = 1
    while 2 * span <= depth and name.max(initial=0) < len(lms) - 1:
        following = np.concatenate([name[span:] + 1, np.zeros(min(span, len(name)), np.int64)])[: len(name)]
        name = _ranks(name * (len(lms) + 1) + following)
        span *= 2
    return lms[np.argsort(name, kind="stable")]


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Rank of each key among the distinct ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
    return out


def _deal(items: np.ndarray, letters: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Append items to the buckets of their letters, in order."""
    if not len(items):
        return
    if len(items) == 1:
        buckets[letters[0]].append(items)
        return
    order = np.argsort(letters, kind="stable")
    items, letters = items[order], letters[order]
    cuts = np.flatnonzero(letters[1:] != letters[:-1]) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(items)]):
        buckets[letters[a]].append(items[a:b])


def suffix_array(s: np.ndarray, depth: int = 1 << 40) -> np.ndarray:
    """Suffixes of letters 0 to 510 in the order of their first ``depth`` letters at least (an end is smaller than any letter).

    With the default depth the order is that of the whole suffixes.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    s = s.astype(np.int16)
    small = classify(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    top = int(s.max()) + 1
    ls: list[list[np.ndarray]] = [[] for _ in range(top)]
    ss: list[list[np.ndarray]] = [[] for _ in range(top)]
    seeds: list[list[np.ndarray]] = [[] for _ in range(top)]
    if len(lms):
        first = _sorted_lms(s, lms, depth)
        _deal(first, s[first], seeds)
    ls[s[n - 1]].append(np.array([n - 1]))  # induced by the end
    # A suffix without one before it has neither type there.
    types = np.append(small, 2).astype(np.int8)
    for c in range(top):
        _induce(ls[c], s, types, False, ls)
        _induce(seeds[c], s, types, False, ls)
    for c in range(top - 1, -1, -1):
        _induce(ss[c], s, types, True, ss)
        _induce([part[::-1] for part in reversed(ls[c])], s, types, True, ss)
    out = []
    for c in range(top):
        out += ls[c]
        out += [part[::-1] for part in reversed(ss[c])]
    return np.concatenate(out)


def _induce(parts: list[np.ndarray], s: np.ndarray, types: np.ndarray, wanted: bool, buckets: list[list[np.ndarray]]) -> None:
    """Deal the suffixes just before those of ``parts`` that are of the wanted type, in order.

    What is dealt to the very bucket whose parts these are follows in the next
    round, so a bucket takes as many rounds as its letter repeats in a row.
    """
    done = 0
    while done < len(parts):
        items, done = np.concatenate(parts[done:]), len(parts)
        before = items - 1
        before = before[types[before] == wanted]
        _deal(before, s[before], buckets)


def permuted_lcp(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix, in text order, with its predecessor in the array.

    Where predecessors move along with the text and the letter left behind was
    common, the length drops by one, so only the other places are compared
    letter by letter.
    """
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int64)
    jump = np.ones(n, bool)
    jump[1:] = (phi[1:] != phi[:-1] + 1) | (phi[:-1] < 0) | (s[:-1] != s[phi[:-1]])
    at = np.flatnonzero(jump & (phi >= 0))
    i, j = at, phi[at]
    length = np.zeros(len(at), np.int64)
    # Seven letters at a time, then one by one; what follows the end is unlike any letter.
    letters = np.append(s, np.full(8, 511)).astype(np.int64)
    several = letters[: n + 1]
    for k in range(1, 7):
        several = several << 9 | letters[k : n + 1 + k]
    for step, units in ((7, several), (1, letters)):
        live = np.arange(len(at))
        while len(live):
            live = live[units[i[live] + length[live]] == units[j[live] + length[live]]]
            length[live] += step
    out[at] = length
    origin = np.maximum.accumulate(np.where(jump, np.arange(n), 0))
    return np.where(phi >= 0, out[origin] - (np.arange(n) - origin), 0)


def first_documents(groups: list[tuple[int, list[bytes], np.ndarray]]) -> list[np.ndarray]:
    """For every WIDTH-byte window of the groups' strings the smallest document number of an equal window."""
    strings = [c for _, cuts, _ in groups for c in cuts]
    docs = np.concatenate([f for _, _, f in groups])
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    text = np.frombuffer(b"\0".join(strings), np.uint8).astype(np.int16) + 1
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text[starts[1:] - 1] = 0  # apart from any byte
    sa = suffix_array(text, WIDTH)
    plcp = permuted_lcp(text, sa)
    new = plcp[sa] < WIDTH
    group = np.cumsum(new) - 1
    owner = np.repeat(np.arange(len(strings)), sizes + 1)[: len(text)]
    whole = np.arange(len(text)) + WIDTH <= (starts + sizes)[owner]
    least = np.minimum.reduceat(np.where(whole[sa], docs[owner[sa]], np.iinfo(np.int64).max), np.flatnonzero(new))
    first = np.empty(len(text), np.int64)
    first[sa] = least[group]
    out, at = [], 0
    for _, cuts, _ in groups:
        end = at + len(cuts)
        out.append(np.concatenate([first[starts[k] : starts[k] + sizes[k] - WIDTH + 1] for k in range(at, end)]))
        at = end
    return out


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = []
        for text, copy, spans in zip(texts_of(batch, "text"), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if copy is not None and len(text) >= WIDTH:
                gone = np.array([[0, len(text)]])
            else:
                gone = joined(spans or [])
            edges = [0, *gone.ravel().tolist(), len(text)]
            digest = hashlib.sha256()
            for a, b in zip(edges[::2], edges[1::2]):
                digest.update(text[a:b])
            rows.append((len(text), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), digest.hexdigest()))
        n, removed, count, digests = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def with_marks(documents: DataFrame, found: DataFrame) -> DataFrame:
    """``(doc_id, text, earlier, spans)`` of every document row."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    return rows.join(found, ["doc_id", "text_key"], "left").select("doc_id", "text", "earlier", "spans")


def remove_repeated_bytes(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every document row.

    A byte goes if a WIDTH-byte string that covers it also starts in a document
    with a smaller ``doc_id``. Strings are judged on the input and never cross
    documents. Null texts are empty. A null id has no order: such a row keeps all
    and stands before none. Rows that repeat an id are one document to each
    other. Other columns are ignored; an empty table gives no rows.
    """
    return with_marks(documents, marks(documents, Bytes, first_documents)).mapInArrow(_keep, _KEPT)
