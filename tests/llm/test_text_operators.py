"""Decontamination, packing, line spread and near duplicates against brute force on small tables."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reefgrid.llm import decontaminate, minmax, packing
from reefgrid.llm.decontaminate import contamination, decontaminated, item_windows, phrase_matches
from reefgrid.llm.linespread import remove_boilerplate, without_boilerplate
from reefgrid.llm.minmax import near_duplicates, without_near_duplicates
from reefgrid.llm.packing import TokenBytes, pack_documents, place_runs, tokenizer_path

LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def as_dict(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_contamination_brute_force(spark, docs, monkeypatch):
    random.seed(5)
    words = ["a", "b", "c", "Dé", "7"]
    texts = [(i, " ".join(random.choices(words, k=random.randint(0, 80)))) for i in range(60)]
    items = [(i, " ".join(random.choices(words, k=k))) for i, k in enumerate([10, 11, 12, 10, 4, 3, 25])]
    items += [(3, "b, b!! b? c-c c."), (8, None), (9, "  "), (None, "a"), (10, "zz a b")]
    texts += [(100, None), (101, ""), (102, items[1][1] + " tail"), (102, items[1][1] + " tail"), (103, LONG + " " + items[2][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def want(t):
        ws, hit, found = cut(t), set(), set()
        for item, text in items:
            iw = cut(text)
            if item is None or not iw:
                continue
            k = min(10, len(iw))
            for window in {tuple(iw[j : j + k]) for j in range(len(iw) - k + 1)}:
                for p in range(len(ws) - k + 1):
                    if tuple(ws[p : p + k]) == window:
                        hit |= set(range(p, p + k))
                        found.add(str(item))
        ids = ",".join(sorted(found))
        return len(ws), len(hit), len(found), sha(ids), bool(hit)

    expected = sorted((i, *want(t)) for i, t in texts)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    table = docs(texts, "spans,items,n_words")
    assert sorted(map(tuple, contamination(table, bench).select(columns).collect())) == expected
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 5)  # many blocks give the same rows
    assert sorted(map(tuple, contamination(table, bench).select(columns).collect())) == expected
    kept = decontaminated(table, bench)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(e[0] for e in expected if not e[-1])


def test_contamination_of_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs([]), bench).count() == 0
    row = contamination(docs([(1, "a b")]), bench).first()
    assert (row.n_words, row.n_hit, row.contaminated, row.items_sha256) == (2, 0, False, sha(""))
    assert contamination(docs([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_proximity(spark, docs):
    windows = item_windows(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"))
    table = docs([(1, "green x red y blue"), (2, "green x x red y blue"), (3, "red green"), (4, "red green blue"), (5, "red"), (6, "green blue")])
    near = {r.doc_id: [tuple(s) for s in r.spans] for r in phrase_matches(table, windows, slop=2).collect()}
    assert near == {1: [(0, 5)], 2: [], 3: [], 4: [(0, 3)], 5: [], 6: []}


def test_packing_round_trip(docs):
    random.seed(2)
    pool = ["lorem", "Ipsum,", "x", "straße", "42", "<|endoftext|>", "éte", "ΣΑΣ"]
    rows = [(i, " ".join(random.choices(pool, k=random.choice([0, 1, 5, 200, 900, 3000])))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, "x"), (92, "x"), (None, "x"), (93, LONG)] + [(200 + i, "same words here") for i in range(150)]
    out = pack_documents(docs(rows, "length,piece,rank")).toPandas()
    plain = TokenBytes(tokenizer_path()).tokenizer
    want = []
    for i, t in rows:
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(-1 if i is None else i, a // 2048, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for a in range(0, len(ids), 2048)]
    got = out.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(map(tuple, got.astype("int64").values.tolist())) == sorted(want)
    by = out.sort_values(["sequence_id", "offset"])
    assert ((by.groupby("sequence_id").length.cumsum() - by.length) == by.offset).all()
    assert by.groupby("sequence_id").length.sum().max() <= 2048
    assert out.sequence_id.nunique() <= packing.lower_bound(int(out.length.sum())) + 1
    assert pack_documents(docs([])).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_place_runs_fills_without_overlap(seed):
    random.seed(seed)
    counts = {s: random.randint(1, 40) for s in random.sample(range(1, 101), random.randint(1, 60))}
    used, seen = {}, {s: set() for s in counts}
    for size, first, past, sequence, each, at in place_runs(counts, 100):
        for rank in range(first, past):
            assert rank not in seen[size]
            seen[size].add(rank)
            place = range(at + (rank - first) % each * size, at + (rank - first) % each * size + size)
            cells = used.setdefault(sequence + (rank - first) // each, set())
            assert not cells & set(place)
            cells |= set(place)
    assert all(len(seen[s]) == n for s, n in counts.items())
    assert all(c == set(range(len(c))) and len(c) <= 100 for c in used.values())


def test_line_spread_brute_force(docs):
    random.seed(3)
    lines = [f"line {k}" for k in range(30)] + ["", " ", "x"]
    rows = [(i, "\n".join(random.choice(["", " ", "\t"]) + random.choice(lines[: 8 + i % 25]) for _ in range(random.randint(0, 9))), f"s{i % 14}") for i in range(120)]
    rows += [(200, None, "s1"), (201, "line 1\nline 1", None), (None, "line 1\nline 2", "s3"), (203, "line 1", "s2"), (203, "line 1", "s2"), (204, "\n".join(f"l{i}" for i in range(5000)), "s0")]
    table = docs(rows, "n_lines,h1,runs,row")
    sites, first = {}, {}
    for i, t, s in rows:
        for ln in (t or "").split("\n"):
            ln = ln.strip(" \t\r")
            if ln:
                sites.setdefault(ln, set()).update([s] if s else [])
                if i is not None:
                    first[ln] = min(first.get(ln, i), i)
    bad = {ln for ln, s in sites.items() if len(s) >= 10}
    assert bad and len(bad) < 30
    want = []
    for i, t, _ in rows:
        ls = [] if t is None else t.split("\n")
        kept = [ln for ln in ls if i is None or ln.strip(" \t\r") not in bad or first[ln.strip(" \t\r")] == i]
        want.append((-1 if i is None else i, len(ls), len(ls) - len(kept), None if t is None else "\n".join(kept)))
    out = remove_boilerplate(table)
    got = [(-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert "n_lines" in out.columns and out.columns.count("n_lines") == 1
    assert without_boilerplate(table).columns == table.columns
    emptied = {w[0] for w in want if w[2] and not (w[3] or "").strip(" \t\r\n")}
    assert emptied and not emptied & {r.doc_id for r in without_boilerplate(table).collect()}
    assert remove_boilerplate(docs([])).count() == 0


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[j : j + 5]) for j in range(max(1, len(ws) - 4))} if ws else set()


def components(rows, percent):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("percent, block", [(80, 1024), (85, 1024), (85, 3)])
def test_near_duplicates_brute_force(docs, monkeypatch, percent, block):
    """Families of edited copies whose members are partly linked only through each other, also in many blocks."""
    monkeypatch.setattr(minmax, "BLOCK_DOCS", block)
    random.seed(percent)
    rows, n = [], 0
    for family in range(6):
        base = [f"f{family}w{k}" for k in range(random.choice([30, 60, 150]))]
        for _ in range(30):
            words = list(base)
            for _ in range(random.randint(0, 5)):
                words[random.choice(range(0, len(words), 3))] = random.choice(["edit", "other", f"n{n}"])
            if random.random() < 0.3:
                base = words  # the family drifts
            rows.append((n, " ".join(words)))
            n += 1
    random.shuffle(rows)
    rows += [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE two"), (1004, "one two three"), (1005, LONG), (1006, LONG), (1005, LONG)]
    got = near_duplicates(docs(rows, "rep,bands,label"), percent)
    want = components(rows, percent)
    assert got.count() == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())
    linked = [c for _, c in want.values()]
    assert any(linked.count(c) > 5 for c in linked)


def test_a_large_near_group_is_not_paired(docs, monkeypatch):
    """2000 edited copies of one text, most of them too far from each other: rows grow with the group, not with its square."""
    random.seed(9)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 2000):
        words = list(base)
        for at in random.sample(range(120), random.choice([1, 2, 3, 4])):
            words[at] = f"n{i}"
        rows.append((i, " ".join(words)))
    sizes, keep = {}, minmax.stored

    def counted(df, label):
        out = keep(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(minmax, "stored", counted)
    found = near_duplicates(docs(rows)).collect()
    assert sizes["minmax-pairs"] < 20 * len(rows) and sizes["minmax-fresh"] < len(rows)
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for _, t in rows]
    near_base = {i for i in range(2000) if 100 * len(sets[i] & sets[0]) >= 85 * len(sets[i] | sets[0])}
    assert {r.doc_id for r in found if r.component_id == 0} >= near_base
    assert sum(r.component_id == 0 for r in found) < 1900


def test_one_id_on_two_texts(docs):
    one, two = (" ".join(f"{c}{k}" for k in range(40)) for c in "xy")
    rows = [(7, one), (7, two), (3, one + " more"), (9, two + " more"), (8, two)]
    got = near_duplicates(docs(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (7, 3), (7, 3), (8, 7), (9, 7)]


def test_near_duplicates_edges(docs):
    assert near_duplicates(docs([])).count() == 0
    only = as_dict(near_duplicates(docs([(5, "a b"), (None, "a b"), (None, None)])))
    assert only[5].component_id == 5 and only[None].component_id is None and only[None].kept
    table = docs([(2, "a b c"), (1, "A b c"), (3, "")], "rep")
    left = without_near_duplicates(table)
    assert left.columns == table.columns and sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_line_spread_of_very_many_lines(docs):
    """100 000 lines in a document, every other of them boilerplate."""
    common = [f"common {i}" for i in range(50_000)]
    rows = [(0, "\n".join(common), "s0"), (1, "\n".join(common), "s1")]
    rows.append((2, "\n".join(x for i, c in enumerate(common) for x in (c, f"own {i}")), "s2"))
    start = time.perf_counter()
    got = as_dict(remove_boilerplate(docs(rows), min_sites=3))
    assert time.perf_counter() - start < 60
    assert got[2].n_removed == 50_000 and got[2].text == "\n".join(f"own {i}" for i in range(50_000))
    assert got[0].n_removed == 0 and got[1].text == ""


def test_line_spread_is_native(docs):
    """No Python on the executors."""
    plan = remove_boilerplate(docs([(1, "a", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_extra_columns_pass(docs):
    out = without_boilerplate(docs([(1, "a", "s")], "text_key,island")).withColumn("one", F.lit(1))
    assert out.first().text_key == "x"
