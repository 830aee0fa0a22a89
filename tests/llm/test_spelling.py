"""Spelling groups against a comparison of all words with each other."""

import random
import re
import zlib
from collections import Counter

import pytest

from reefgrid.llm import spelling
from reefgrid.llm.spelling import gram_dictionary, grams_of, near_words, spelling_groups

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def walk(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def family(seed=4):
    """A chain of forms, variants of frequent words, and unrelated words, as (doc_id, text)."""
    rng = random.Random(seed)
    letters = "abcdeÉéÿ"
    words = []
    for _ in range(25):
        base = "".join(rng.choices(letters, k=rng.randint(7, 12)))
        words += [base] * 40
        for _ in range(8):
            at, kind = rng.randrange(len(base)), rng.choice("idr")
            words += [base[:at] + (rng.choice(letters) if kind != "d" else "") + base[at + (kind != "i") :]] * rng.choice([1, 2, 3, 4])
    words += ["verylongish"] * 500 + ["verylongis"] * 30 + ["verylongi"] * 2 + ["verylongishs"] * 2 + ["short"] * 50
    rng.shuffle(words)
    return [(i, rng.choice([" ", ", ", "\n", "-", "1"]).join(words[at : at + 37])) for i, at in enumerate(range(0, len(words), 37))]


@pytest.mark.parametrize("frequent", [0, 5, 300])
def test_against_all_pairs(spark, docs, monkeypatch, frequent):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    rows = family() + [(1, "VeryLongish ÀÉverylong"), (1, "VeryLongish ÀÉverylong"), (None, "verylongish"), (7, None), (8, ""), (9, "12 ??")]
    rows += [(100, "verylongish " * 20_000)]
    want = walk(rows)
    found = spelling_groups(docs(rows, "word,n,form")).select(COLUMNS).collect()
    assert sorted(map(tuple, found)) == want
    assert {len(r[0]) for r in want if r[4]} >= {8, 9, 10, 11}
    chain = {r[0]: r for r in want}
    assert chain["verylongi"][1:3] == ("verylongis", "verylongish")


def test_shapes_of_grams(spark, monkeypatch):
    assert grams_of("abcdefg", {"ab", "abc", "fg"}) == ["abcd", "bc", "cd", "de", "ef", "fg"]
    monkeypatch.setattr(spelling, "FREQUENT", 1)
    words = spark.createDataFrame([("abcdefg",), ("abcxyzw",)], "word string")
    assert gram_dictionary(words) == {"ab", "bc", "abc"}
    monkeypatch.setattr(spelling, "MOST_GRAMS", 5)  # 22 places: only grams of more than 5 of them
    assert gram_dictionary(words) == set()


def test_every_edit_of_short_words_and_a_hub(spark):
    rng = random.Random(2)
    words = {"".join(rng.choices("ab", k=rng.choice([7, 8]))) for _ in range(300)}
    hub = "hubwords"
    words |= {hub[:i] + c + hub[i + 1 :] for i in range(8) for c in "abcdefghijklmnopqrstuvwxyz"}
    want = {(min((a, b), key=lambda w: (len(w), w)), max((a, b), key=lambda w: (len(w), w))) for a in words for b in words if one_edit(a, b)}
    found = [tuple(r) for r in near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_empty(spark, docs):
    assert spelling_groups(docs([])).collect() == []
    assert spelling_groups(docs([(1, None), (2, "a b c"), (3, "onlyonce")])).collect() == []
