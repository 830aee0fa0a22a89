"""Queries on descriptors: the embeddings table, four descriptors per image."""

from __future__ import annotations

from pyspark.sql import functions as F

from reefgrid.operators import vocab, vocabulary
from reefgrid.plans.base import Registry, rnd
from reefgrid.plans.views import Survey

query = Registry()

DIMS = 64
#: A vocabulary of a size that these tables fill: 8 children on each of 3 levels, best of 2 rounds.
SMALL = {"branching": 8, "levels": 3, "iterations": 20, "rounds": 2}
FULL = {"branching": vocabulary.BRANCHING, "levels": vocabulary.LEVELS, "iterations": vocabulary.ITERATIONS, "rounds": vocabulary.ROUNDS}


def _tree_sql(branching: int, levels: int, iterations: int, rounds: int, seed: int = 42) -> str:
    """Tables ``words(id, word, cost)`` and ``centres(level, node, child, n, centre)`` of the best round, by plain Lloyd steps."""
    parts = ["d AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)"]
    for r in range(rounds):
        parts.append(f"m{r}_0 AS MATERIALIZED (SELECT id, v, 0::BIGINT AS node, 0::DOUBLE AS cost FROM d)")
        for level in range(levels):
            m, k, c, a = f"m{r}_{level}", f"k{r}_{level}", f"c{r}_{level}", f"a{r}_{level}"
            parts.append(f"""s{r}_{level} AS MATERIALIZED (SELECT node, v, row_number() OVER (PARTITION BY node ORDER BY md5(
                  min(id) || ':' || node || ':{level}:{seed + r}')) AS nth FROM {m} GROUP BY node, v)""")
            parts.append(f"""{k} AS (
                SELECT 0 AS step, node, nth - 1 AS child, v AS c, 1e307::DOUBLE AS cost, 1e308::DOUBLE AS past
                FROM s{r}_{level} WHERE nth <= {branching}
                UNION ALL
                SELECT step + 1, node, child, list(x ORDER BY i), max(all_cost), max(past) FROM (
                  SELECT any_value(step) AS step, node, near.child AS child, i, avg(x) AS x, any_value(all_cost) AS all_cost, any_value(past) AS past
                  FROM (SELECT *, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM (
                    SELECT *, sum(near.dist) OVER () AS all_cost FROM (
                      SELECT {m}.id, any_value({m}.v) AS v, any_value({m}.node) AS node, any_value(step) AS step, any_value({k}.cost) AS past,
                             min(struct_pack(dist := pow(list_distance({m}.v, {k}.c), 2), child := {k}.child)) AS near
                      FROM {k} JOIN {m} ON {m}.node = {k}.node
                      WHERE step < {iterations} AND {k}.cost < {k}.past * (1 - 1e-9) GROUP BY {m}.id)))
                  GROUP BY node, near.child, i) GROUP BY step, node, child)""")
            parts.append(f"{c} AS MATERIALIZED (SELECT node, child, c FROM {k} WHERE step = (SELECT max(step) FROM {k}))")
            parts.append(f"""{a} AS MATERIALIZED (SELECT {m}.id, any_value({m}.v) AS v, any_value({m}.node) AS node,
                  min(struct_pack(dist := pow(list_distance({m}.v, {c}.c), 2), child := {c}.child)) AS near
                  FROM {m} JOIN {c} ON {m}.node = {c}.node GROUP BY {m}.id)""")
            parts.append(f"m{r}_{level + 1} AS MATERIALIZED (SELECT id, v, node * {branching} + near.child AS node, near.dist AS cost FROM {a})")
    costs = " UNION ALL ".join(f"SELECT {r} AS r, round(sum(cost), 9) AS cost FROM m{r}_{levels}" for r in range(rounds))
    parts.append(f"best AS MATERIALIZED (SELECT r FROM ({costs}) ORDER BY cost, r LIMIT 1)")
    parts.append("words AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT id, node AS word, cost FROM m{r}_{levels} WHERE {r} = (SELECT r FROM best)" for r in range(rounds)) + ")")
    parts.append("centres AS MATERIALIZED (" + " UNION ALL ".join(
        f"""SELECT {v} AS level, c.node, c.child, (SELECT count(*) FROM m{r}_{v + 1} x WHERE x.node = c.node * {branching} + c.child) AS n, c.c AS centre
            FROM c{r}_{v} c WHERE {r} = (SELECT r FROM best)""" for r in range(rounds) for v in range(levels)) + ")")
    return "WITH RECURSIVE " + ",\n".join(parts)


#: Unit TF-IDF vectors ``u`` of the images, from ``words``.
_VECTORS_SQL = """,
    w AS (SELECT id // 4 AS image_id, word FROM words),
    c AS (SELECT image_id, word, count(*) AS n FROM w GROUP BY 1, 2), s AS (SELECT image_id, count(*) AS total FROM w GROUP BY 1),
    i AS (SELECT word, ln((SELECT count(DISTINCT image_id) FROM w) / count(*)::DOUBLE) AS idf FROM c GROUP BY 1),
    t AS (SELECT c.image_id, c.word, n / total::DOUBLE * idf AS w FROM c JOIN s USING (image_id) JOIN i USING (word) WHERE idf > 0),
    u AS (SELECT image_id, word, w / sqrt(sum(w * w) OVER (PARTITION BY image_id)) AS weight FROM t)"""


def _descriptors(s: Survey):
    return s.table("embeddings").select(
        F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 4).alias("image_id"), F.col("embedding").alias("descriptor"), "label"
    )


@query("vocab_words", _tree_sql(**FULL) + """
    SELECT label, count(DISTINCT word) AS n_words, count(*) AS n, round(sum(cost), 6) AS cost
    FROM words JOIN embeddings ON id = vec_id GROUP BY 1""")
def vocab_words(s: Survey):
    """Words, descriptors and training cost per true label, in the vocabulary of the default settings."""
    words, _ = vocabulary.train_vocabulary(_descriptors(s), **FULL)
    return words.join(_descriptors(s).select("id", "label"), "id").groupBy("label").agg(
        F.count_distinct("word").alias("n_words"), F.count(F.lit(1)).alias("n"), F.round(F.sum("cost"), 6).alias("cost"))


@query("vocab_tree", _tree_sql(**SMALL) + """
    SELECT CAST(level AS INTEGER) AS level, node, CAST(child AS INTEGER) AS child, n, round(list_sum(centre), 6) AS centre_sum,
           round(centre[1], 6) AS first, round(centre[64], 6) AS last FROM centres""")
def vocab_tree(s: Survey):
    """Centres of a small vocabulary's nodes on all levels."""
    _, centres = vocabulary.train_vocabulary(_descriptors(s), **SMALL)
    return centres.select(
        "level", "node", "child", "n", F.round(F.aggregate("centre", F.lit(0.0), lambda a, x: a + x), 6).alias("centre_sum"),
        F.round(F.col("centre")[0], 6).alias("first"), F.round(F.col("centre")[DIMS - 1], 6).alias("last"))


@query("word_assign", _tree_sql(**SMALL) + "SELECT id AS vec_id, word FROM words")
def word_assign(s: Survey):
    """Every descriptor's word, by its way down the tree."""
    _, centres = vocabulary.train_vocabulary(_descriptors(s), **SMALL)
    return vocabulary.assign_words(_descriptors(s), centres, SMALL["branching"], SMALL["levels"]).select(F.col("id").alias("vec_id"), "word")


@query("image_tfidf", _tree_sql(**SMALL) + _VECTORS_SQL + "SELECT image_id, word, round(weight, 6) AS weight FROM u")
def image_tfidf(s: Survey):
    """TF-IDF vectors of the images over the vocabulary's words."""
    words, _ = vocabulary.train_vocabulary(_descriptors(s), **SMALL)
    return vocabulary.word_weights(words.select(F.floor(F.col("id") / 4).alias("image_id"), "word"))[1].select("image_id", "word", rnd("weight"))


@query("loop_candidates", _tree_sql(**SMALL) + _VECTORS_SQL + """,
    qw AS (SELECT m.id // 4 AS image_id, m.node * 8 + c.child AS word, row_number() OVER (PARTITION BY m.id ORDER BY list_distance(m.v, c.centre), c.child) AS place
           FROM (SELECT id, embedding::DOUBLE[] AS v, word // 8 AS node FROM words JOIN embeddings ON id = vec_id WHERE (id // 4) % 10 = 0) m
           JOIN centres c ON c.level = 2 AND c.node = m.node),
    qc AS (SELECT image_id, word, count(*) AS n FROM qw WHERE place <= 5 GROUP BY 1, 2),
    qs AS (SELECT image_id, sum(n) AS total FROM qc GROUP BY 1),
    qt AS (SELECT qc.image_id, word, n / total::DOUBLE * idf AS w FROM qc JOIN qs USING (image_id) JOIN i USING (word) WHERE idf > 0),
    q AS (SELECT image_id, word, w / sqrt(sum(w * w) OVER (PARTITION BY image_id)) AS weight FROM qt),
    p AS (SELECT q.image_id AS image_id1, u.image_id AS image_id2, round(sum(q.weight * u.weight), 9) AS similarity
          FROM q JOIN u USING (word) WHERE q.image_id <> u.image_id GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY image_id1 ORDER BY similarity DESC, image_id2) AS rank FROM p)
    SELECT image_id1, image_id2, rank, round(similarity, 6) AS similarity FROM r WHERE rank <= 100""")
def loop_candidates(s: Survey):
    """The images that every tenth image may close a loop with, by their words; its descriptors count for their 5 nearest words."""
    words, centres = vocabulary.train_vocabulary(_descriptors(s), **SMALL)
    own = words.select(F.floor(F.col("id") / 4).alias("image_id"), "word")
    asked = _descriptors(s).filter(F.col("image_id") % vocabulary.LOOP_PERIOD == 0)
    near = vocabulary.assign_words(asked, centres, SMALL["branching"], SMALL["levels"], vocabulary.LOOP_NEIGHBOURS)
    soft = near.select(F.floor(F.col("id") / 4).alias("image_id"), "word")
    return vocabulary.loop_candidates(own, soft).select("image_id1", "image_id2", "rank", rnd("similarity"))


@query("loop_pairs", """
    WITH e AS (SELECT vec_id // 4 AS image_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    m AS (SELECT image_id, i, avg(v) AS v FROM e GROUP BY 1, 2), n AS (SELECT image_id, sqrt(sum(v * v)) AS n FROM m GROUP BY 1),
    u AS (SELECT image_id, list(v / n ORDER BY i) AS v FROM m JOIN n USING (image_id) WHERE n > 0 GROUP BY 1),
    d AS (SELECT a.image_id AS image_id1, b.image_id AS image_id2, list_inner_product(a.v, b.v) AS s
          FROM u a JOIN u b ON a.image_id % 10 = 0 AND a.image_id <> b.image_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY image_id1 ORDER BY s DESC, image_id2) AS rank FROM d)
    SELECT image_id1, image_id2, rank, round(s, 6) AS similarity FROM r WHERE rank <= 100""")
def loop_pairs(s: Survey):
    return vocab.loop_pairs(vocab.mean_vectors(_descriptors(s), DIMS)).select("image_id1", "image_id2", "rank", rnd("similarity"))
