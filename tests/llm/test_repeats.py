"""Suffix arrays and phrase automata against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reefgrid.llm import phrases, repeats, suffixes
from reefgrid.llm.phrases import remove_repeated_words
from reefgrid.llm.suffixes import classify, permuted_lcp, remove_repeated_bytes, suffix_array


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array_and_common_prefixes(seed):
    random.seed(seed)
    n = random.choice([2, 3, 5, 50, 400])
    s = np.array([random.randrange(random.choice([1, 2, 4, 200])) for _ in range(n)]) if seed % 3 else np.array([seed % 2, 0] * (n // 2) + [1])
    want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    sa = suffix_array(s)
    assert sa.tolist() == want
    small = [i + 1 < len(s) and s[i:].tolist() < s[i + 1 :].tolist() for i in range(len(s))]
    assert classify(s.astype(np.int16)).tolist() == small

    def common(a, b):
        k = 0
        while a + k < len(s) and b + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        return k
    plcp = permuted_lcp(s, sa)
    assert all(plcp[sa[k]] == common(sa[k], sa[k - 1]) for k in range(1, len(s)))


def brute(rows, width):
    first = {}
    for i, units in rows:
        if i is not None:
            for p in range(len(units) - width + 1):
                w = tuple(units[p : p + width])
                first[w] = min(first.get(w, i), i)
    out = []
    for i, units in rows:
        gone = np.zeros(len(units), bool)
        if i is not None:
            for p in range(len(units) - width + 1):
                if first[tuple(units[p : p + width])] < i:
                    gone[p : p + width] = True
        out.append((i, gone))
    return out


def repetitive(seed, units, count):
    """Texts sharing passages of around WIDTH units, edited copies, runs of one unit and exact copies."""
    random.seed(seed)
    pool = [[random.choice(units) for _ in range(random.choice([30, 49, 50, 51, 60, 180]))] for _ in range(8)]
    texts = []
    for _ in range(count):
        t = []
        for _ in range(random.randint(0, 5)):
            p = list(random.choice(pool))
            if random.random() < 0.4:
                p[random.randrange(len(p))] = random.choice(units)
            t += p[random.randint(0, 5) :] + [random.choice(units) for _ in range(random.randint(0, 20))]
        texts.append(t)
    texts += [[units[0]] * 300, [units[0]] * 120, [units[0]] * 49, [units[0], units[1]] * 60, texts[3], texts[3], [units[0]] * 20_000]
    return texts


@pytest.mark.parametrize("crowded", [4000, 1])
def test_repeated_bytes(docs, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)  # both ways of comparing give the same
    monkeypatch.setattr(repeats, "SLICE", 4000)
    texts = ["".join(t) for t in repetitive(1, list("abcdé \n"), 50)]
    rows = list(zip(random.sample(range(1000), len(texts)), texts))
    rows += [(2000, None), (2001, ""), (None, texts[5]), (2002, texts[7]), (2002, texts[7])]
    want = []
    for (i, t), (_, gone) in zip(rows, brute([(i, (t or "").encode()) for i, t in rows], 50)):
        kept = bytes(np.frombuffer((t or "").encode(), np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((-1 if i is None else i, len(gone), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    got = [(-1 if r[0] is None else r[0], *r[1:]) for r in remove_repeated_bytes(docs(rows, "spans,cut,earlier")).collect()]
    assert sorted(got) == sorted(want)
    assert sum(w[2] for w in want) > 1000


@pytest.mark.parametrize("crowded", [4000, 1])
def test_repeated_words(docs, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    monkeypatch.setattr(phrases, "AUTOMATON_PHRASES", 37)
    texts = [random.choice([" ", "\n", "  "]).join(t) for t in repetitive(2, ["A", "a", "bb", "é", "d."], 50)]
    rows = list(zip(random.sample(range(1000), len(texts)), texts))
    rows += [(2000, None), (2001, " \n "), (None, texts[5]), (2002, texts[7]), (2002, texts[7])]
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    want = []
    for (i, ws), (_, gone) in zip(cut, brute(cut, 50)):
        kept = b" ".join(w for w, g in zip(ws, gone) if not g)
        want.append((-1 if i is None else i, len(ws), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    got = [(-1 if r[0] is None else r[0], *r[1:]) for r in remove_repeated_words(docs(rows, "spans,cut,earlier")).collect()]
    assert sorted(got) == sorted(want)
    assert sum(w[2] for w in want) > 1000


def test_empty_tables(docs):
    assert remove_repeated_bytes(docs([])).count() == 0
    assert remove_repeated_words(docs([])).count() == 0
    row = remove_repeated_bytes(docs([(1, None)])).first()
    assert (row.n_bytes, row.n_removed, row.n_spans) == (0, 0, 0)


def test_both_compare_alike():
    """Neither method misses a window that the other finds."""
    random.seed(9)
    cuts = [("".join(random.choices("ab", k=20)) + "x" * 40 + "".join(random.choices("ab", k=20))).encode() for _ in range(30)]
    firsts = np.arange(30)
    by_bytes = suffixes.first_documents([(1, cuts, firsts)])[0]
    spaced = [" ".join(c.decode()).encode() for c in cuts]
    assert phrases.first_documents([(1, spaced, firsts)])[0].tolist() == by_bytes.tolist()


def test_anchor_rows_do_not_grow_with_the_bins(spark, docs):
    """A slice's texts are written once, whatever the number of bins."""
    from reefgrid.llm.repeats import _BLOBS, Bytes, Words, _anchors

    random.seed(4)
    rows = [(i, " ".join(f"w{random.randrange(10 ** 6)}" for _ in range(120))) for i in range(400)]
    table = docs(rows).select("doc_id", "text", F.xxhash64("text").alias("text_key")).coalesce(1)
    for kind in (Bytes, Words):
        sizes = []
        for bins in (16, 1250):
            blobs = table.mapInArrow(_anchors(kind, bins), _BLOBS)
            held = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("runs", "anchors", "places", "local")) + 8 * F.coalesce(F.size("text_keys"), F.lit(0))
            sizes.append(blobs.agg(F.sum(held)).first()[0])
        assert sizes[0] == sizes[1]


def test_calls_do_not_grow_with_the_cut_outs(monkeypatch):
    """Buckets are induced in rounds, and occurrences of cut-outs become spans a batch at a time."""
    import pyarrow as pa

    random.seed(6)
    calls = []
    for count in (60, 480):
        deals, deal = [], suffixes._deal
        monkeypatch.setattr(suffixes, "_deal", lambda *a: (deals.append(1), deal(*a)))
        groups = []
        for g in range(count):
            middle = random.randbytes(50)
            groups.append((g, [random.randbytes(9) + middle + random.randbytes(9) for _ in range(3)], np.array([3, 5, 9])))
        found = suffixes.first_documents(groups)
        monkeypatch.undo()
        assert all(f.reshape(3, 19)[:, 9].tolist() == [3, 3, 3] and f.reshape(3, 19)[:, 0].tolist() == [3, 5, 9] for f in found)
        calls.append(len(deals))
    assert calls[1] < 3 * calls[0]

    firsts = [None, np.array([9, 1, 1] + [9] * 60 + [2]), np.array([1, 9])]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5, 5, 6]), pa.array([50, 51, 60]), pa.array([7, 100, 0], pa.int32()), pa.array([3, 64, 2], pa.int32()),
         pa.array([None if f is None else f.astype(np.int64).tobytes() for f in firsts], pa.binary())], ["doc_id", "text_key", "begin", "n", "firsts"])
    rows = [r for b in repeats._spans(iter([batch])) for r in b.to_pylist()]
    spans = sorted((r["doc_id"], r["text_key"], *np.frombuffer(r["spans"], np.int64).tolist()) for r in rows)
    assert spans == [(5, 50, 7, 59), (5, 51, 101, 152), (5, 51, 163, 213), (6, 60, 0, 50)]
