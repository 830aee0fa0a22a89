"""The vocabulary tree against plain Lloyd steps, and retrieval against all pairs."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reefgrid.operators import vocabulary
from reefgrid.operators.vocabulary import assign_words, essential_terms, loop_candidates, probe_terms, train_vocabulary, word_weights


def table(spark, vectors, parts=3):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id long, descriptor array<double>").repartition(parts)


def clouds(n, dims=6, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 9, size=(n, 1)) * 10 + rng.normal(size=(n, dims))).round(3)


@pytest.mark.parametrize("local_rows", [10**6, 40, 0])
def test_small_vocabulary_is_plain_lloyd(spark, local_rows):
    v = clouds(160)
    words, centres = train_vocabulary(table(spark, v), branching=4, levels=2, iterations=50, rounds=2, local_rows=local_rows)
    best = None
    for seed in (42, 43):
        def split(ids, node, level):
            c = vocabulary._seeds(ids, v[ids], node, level, seed, 4)
            names = list(range(len(c)))
            for _ in range(50):
                near = [min(range(len(c)), key=lambda j: (((x - c[j]) ** 2).sum(), j)) for x in v[ids]]
                kept = sorted(set(near))
                c, names = np.array([v[ids][[n == j for n in near]].mean(axis=0) for j in kept]), [names[j] for j in kept]
            near = [min(range(len(c)), key=lambda j: (((x - c[j]) ** 2).sum(), j)) for x in v[ids]]
            return [names[j] for j in near], [((x - c[j]) ** 2).sum() for x, j in zip(v[ids], near)]
        all_ids, found, cost = np.arange(len(v)), {}, 0.0
        top, _ = split(all_ids, 0, 0)
        for child in sorted(set(top)):
            ids = all_ids[np.array(top) == child]
            below, costs = split(ids, child, 1)
            found |= {int(i): child * 4 + b for i, b in zip(ids, below)}
            cost += sum(costs)
        if best is None or round(cost, 9) < best[0]:
            best = (round(cost, 9), found)
    rows = words.collect()
    assert {r.id: r.word for r in rows} == best[1]
    assert abs(sum(r.cost for r in rows) - best[0]) < 1e-6
    tree = centres.collect()
    assert sum(r.n for r in tree if r.level == 0) == sum(r.n for r in tree if r.level == 1) == 160
    down = assign_words(table(spark, v, 2), centres, branching=4, levels=2, neighbours=3).collect()
    assert {r.id: r.word for r in down if r.place == 0} == best[1]
    near = defaultdict(list)
    for r in sorted(down, key=lambda r: (r.id, r.place)):
        near[r.id].append(r.word)
    by_node = defaultdict(dict)
    for r in tree:
        if r.level == 1:
            by_node[r.node][r.node * 4 + r.child] = np.array(r.centre)
    for i, got in near.items():
        here = by_node[got[0] // 4]
        assert got == sorted(here, key=lambda w: (((v[i] - here[w]) ** 2).sum(), w))[:3]


@pytest.mark.parametrize("local_rows", [100, 0])
def test_copies_nulls_and_few_descriptors(spark, local_rows):
    v = [[1.0, 2.0]] * 7 + [[5.0, 5.0]] * 2 + [None, [1.0, None]]
    words, centres = train_vocabulary(table(spark, v), branching=4, levels=2, iterations=5, rounds=1, local_rows=local_rows)
    groups = defaultdict(set)
    for r in words.collect():
        groups[r.word].add(r.id)
    assert sorted(map(sorted, groups.values())) == [list(range(7)), [7, 8]]
    assert {r.id for r in assign_words(table(spark, v), centres, 4, 2).collect()} == set(range(9))
    words, centres = train_vocabulary(table(spark, v).limit(0), branching=4, levels=2, iterations=5, rounds=2, local_rows=local_rows)
    assert words.collect() == centres.collect() == []


def test_capped_descriptors(spark):
    from pyspark.sql import functions as F

    desc = table(spark, clouds(50)).withColumn("image_id", F.col("id"))
    assert train_vocabulary(desc, 4, 1, 3, 1, cap=20)[0].count() == 20


def pairs_by_hand(words, asked, n):
    db, q = defaultdict(Counter), defaultdict(Counter)
    for i, w in words:
        db[i][w] += 1
    for i, w in asked:
        q[i][w] += 1
    df = Counter(w for c in db.values() for w in c)
    def unit(c):
        total = sum(c.values())
        x = {w: k / total * math.log(len(db) / df[w]) for w, k in c.items() if w in df and df[w] < len(db)}
        norm = math.sqrt(sum(y * y for y in x.values()))
        return {w: y / norm for w, y in x.items()}
    units = {i: unit(c) for i, c in db.items()}
    out = []
    for a, c in q.items():
        x = unit(c)
        found = [(-round(sum(x[w] * u[w] for w in x if w in u), 9), i) for i, u in units.items() if i != a and any(w in u for w in x)]
        out += [(a, i, r, -s) for r, (s, i) in enumerate(sorted(found)[:n], 1)]
    return out


def test_loop_candidates_against_all_pairs(spark):
    rng = random.Random(6)
    words = [(i, rng.choice([0, 0, 0, 1, *range(2, 60)])) for i in range(400) for _ in range(8)]
    words += [(i, 1000 + i // 12) for i in range(400) for _ in range(3)]
    asked = [(i, w) for i, w in words if i % 10 == 0] + [(0, 77_777)]
    make = lambda rows: spark.createDataFrame(rows, "image_id long, word long")
    for n in (5, 300):
        got = sorted(map(tuple, loop_candidates(make(words), make(asked), n).collect()))
        want = sorted(pairs_by_hand(words, asked, n))
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert all(abs(g[3] - w[3]) < 2e-9 for g, w in zip(got, want))
    _, postings = word_weights(make(words))
    terms = essential_terms(probe_terms(postings.filter("image_id % 10 = 0"), postings, 5), postings, 5).collect()
    looked_up = sum(t.df for t in terms if t.essential)
    assert looked_up < 0.5 * sum(t.df for t in terms)  # frequent words bound the similarity and are not joined
    assert loop_candidates(make([]), make([])).collect() == []


def test_a_lloyd_step_moves_one_sum_per_task_and_child(spark):
    v, c = np.array([[0.0, 1.0], [0.2, 1.0], [9.0, 9.0]]), [{"child": 1, "centre": [0.0, 1.0]}, {"child": 4, "centre": [9.0, 9.0]}]
    block = lambda node: {"node": node, "ids": [0, 1, 2], "vectors": v.tobytes(), "children": c}
    batches = [pa.RecordBatch.from_pylist([block(7), block(7)]), pa.RecordBatch.from_pylist([block(7), block(8)])]
    rows = [r for b in vocabulary._step(iter(batches)) for r in b.to_pylist()]
    assert [(r["node"], r["child"], r["n"]) for r in rows] == [(7, 1, 6), (7, 4, 3), (8, 1, 2), (8, 4, 1)]
    assert np.allclose(rows[0]["sums"], [0.6, 6.0]) and np.allclose(rows[0]["cost"], 0.12)
    # The blocks are not dealt out anew to meet their centres.
    blocks = spark.createDataFrame([(7, [0], bytes(16))], "node long, ids array<long>, vectors binary")
    centres = spark.createDataFrame([(7, 1, [0.0, 1.0])], "node long, child int, centre array<double>")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = vocabulary._met(blocks, centres, few=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # of the centres


def test_loop_candidates_in_slices_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vocabulary, "SLICE_TERMS", 30, raising=False)
    monkeypatch.setattr(vocabulary, "BLOCK_POSTINGS", 150, raising=False)
    found = []
    looked_up = vocabulary._looked_up
    monkeypatch.setattr(vocabulary, "_looked_up", lambda *a: found.append(looked_up(*a)) or found[-1])
    rng = random.Random(7)
    words = [(i, rng.choice([0, 0, 1, *range(2, 30)])) for i in range(200) for _ in range(5)]
    words += [(i, 500) for i in range(60)] + [(None, 3), (5, None)]  # alike images, and rows without a key
    asked = [(i, w) for i, w in words if i is not None and i % 10 == 0] + [(900, 4)]
    make = lambda rows: spark.createDataFrame(rows, "image_id long, word long")
    whole = [(i, w) for i, w in words if i is not None and w is not None]
    for n in (3, 500):
        got = sorted(map(tuple, loop_candidates(make(whole), make(asked), n).collect()))
        want = sorted(pairs_by_hand(whole, asked, n))
        assert [g[:3] for g in got] == [w[:3] for w in want] and all(abs(g[3] - w[3]) < 2e-9 for g, w in zip(got, want))
    assert loop_candidates(make(words), make(asked), 3).count() > 0
    # No more than the nearest of each block come out, not all pairs.
    blocks = -(-word_weights(make(whole))[1].count() // 150)
    assert blocks > 1 and found[1].groupBy("asked").count().agg({"count": "max"}).first()[0] <= 3 * blocks
