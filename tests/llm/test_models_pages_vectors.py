"""Classifiers by held-out accuracy, page extraction on fixtures, neighbours by recall."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from reefgrid.llm import pstable, toxicity
from reefgrid.llm.consensus import Page, extract_pages, host_paths
from reefgrid.llm.labelled import Logistic, held_out, sample
from reefgrid.llm.pstable import nearest, perturbations
from reefgrid.llm.quality import quality_scores
from reefgrid.llm.toxicity import toxicity_scores, without_toxic

DATA = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    return (rank[label == 1].mean() - (label == 1).sum() / 2 + 0.5) / (label == 0).sum()


@pytest.mark.parametrize("scores,label,least", [(quality_scores, "quality", 0.97), (toxicity_scores, "toxic", 0.85)])
def test_held_out_accuracy(spark, docs, scores, label, least):
    documents, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.join(documents, "doc_id", "left_semi").toPandas().set_index("doc_id")[label]
    out = scores(documents, labels).toPandas().set_index("doc_id")
    assert len(out) == documents.count() and out.score.between(0, 1).all()
    assert (out.predicted == (out.score >= 0.7)).all()
    held = out[out.held_out & out.index.isin(known.index)]
    assert len(held) > 500
    assert auc(held.score.values, known[held.index].values) > least


@pytest.mark.parametrize("scores,label", [(quality_scores, "quality"), (toxicity_scores, "toxic")])
def test_classifiers_on_odd_tables(spark, docs, scores, label):
    rows = [(i, ("good words stand here " if i % 2 else "### $$$ &&& ") * (1 + i % 5)) for i in range(60)] + [(100, None), (101, ""), (None, "x"), (102, "w " * 40_000), (3, "twice")]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)] + [(None, 1, 1), (7, None, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    out = scores(docs(rows, "score,label,figures"), labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    found = out.collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    none = scores(docs([(1, "a"), (2, None)]), labels.limit(0)).collect()
    assert [round(r.score, 6) for r in none] == [0.5, 0.5]
    assert scores(docs([]), labels).count() == 0


def test_without_toxic_keeps_columns(spark, docs):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    table = docs([(i, "calm plain words follow " * 5 + ("vile scum " if i % 2 else "nice folk ") * 5) for i in range(200)] + [(None, None)], "score")
    left = without_toxic(table, labels)
    assert left.columns == table.columns
    ids = {r.doc_id for r in left.collect()}
    assert None in ids and len([i for i in ids if i is not None and i % 2]) < 10 and len([i for i in ids if i is not None and not i % 2]) > 90


ARTICLE = (
    '<html><head><title>T</title><style>p{}</style></head><body><div class="top-nav"><a href="/">Home</a></div>'
    '<div id="cookie-notice">We use cookies and say so at length, so that this block is long.</div>'
    '<div class="wrap w{n}"><div class="post-{n} story"><h1>Head &amp; line</h1><p>First   para\n with <b>bold</b> &eacute;&nbsp;x.</p>'
    '<div class="ad-slot">Buy now, buy more, buy this very long advert text.</div><ul><li>one<li>two</ul><p>Last<br>line</p>'
    '<form><input>Sign up here</form><div class="comments"><p>A reader says a lot, far more than the article itself ever said.</p></div></div>'
    '<aside>More to read</aside></div><script>var a = "<p>no</p>";</script><!-- <p>no</p> --><footer>&copy; me</footer></body></html>'
)
WANTED = "Head & line\nFirst para with bold é x.\none\ntwo\nLast line"


def test_extraction(spark):
    pages = [(n, f"https://News.example.com/{n}?p=1", ARTICLE.replace("{n}", str(n))) for n in range(1, 6)]
    # Too short to win by itself: the host's path decides.
    pages.append((6, "http://news.example.com:80/6", '<div class="wrap w9"><div class="post-9 story"><p>Ok.</p></div></div><div class="x"><p>A long foreign block of text that is no article but stands on the page.</p></div>'))
    pages += [(7, None, None), (8, "nonsense", ""), (9, "http://other.org/", "just text &lt;b&gt;"), (9, "http://other.org/", "just text &lt;b&gt;"), (10, "http://h.org", "<div><p>open <b>tags <p>go on" + "<div>" * 3000 + "deep")]
    table = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, path string, host string")
    out = extract_pages(table).collect()
    assert len(out) == len(pages)
    texts = {r.page_id: r.text for r in out}
    assert [texts[n] for n in range(1, 6)] == [WANTED] * 5
    assert texts[6] == "Ok." and texts[7] == "" and texts[8] == "" and texts[9] == "just text <b>"
    assert texts[10].startswith("open tags\ngo on") and texts[10].endswith("deep")
    assert all(r.n_chars == len(r.text) for r in out)
    assert {r.host: r.path.rsplit("#", 1)[0] for r in host_paths(table).collect()}["news.example.com"] == "div.w#.wrap/div.post-#.story"
    assert extract_pages(table.limit(0)).count() == 0


def test_page_ends_elements():
    page = Page("<table><tr><td>a<td>b<tr><td>c</table><p>d<div>e</div><dl><dt>f<dd>g</dl>")
    assert [t for _, t, _ in page.blocks] == list("abcdefg")


def test_perturbations_in_order_of_success():
    inside = np.array([0.1, 0.6, 0.95])
    cost = np.concatenate([inside, 1 - inside]) ** 2
    found = perturbations(inside, 27)
    price = [sum(cost[j] if s < 0 else cost[3 + j] if s > 0 else 0 for j, s in enumerate(shift)) for shift in found]
    assert len(found) == 27 and len({tuple(f) for f in found}) == 27
    assert price == sorted(price)


def brute(vectors, queries, k):
    out = {}
    for q, x in queries:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(x)) ** 2).sum())), i) for i, v in vectors if i != q and len(v) == len(x))
        out[q] = near[:k]
    return out


def test_neighbours(spark, docs):
    random = np.random.default_rng(1)
    middles = random.normal(size=(20, 16))
    rows = [(i, (middles[i % 20] + 0.3 * random.normal(size=16)).tolist()) for i in range(3000)]
    rows += [(4000 + i, rows[7][1]) for i in range(300)] + [(5000, [1.0, 2.0]), (5100, [1.0, 2.5])]
    bad = [(6000, None), (6100, [0.0] * 16), (6200, [float("nan")] + [1.0] * 15), (6300, [None] + [1.0] * 15), (6400, [float("inf")] * 16), (None, [1.0] * 16), (6500, [])]
    table = spark.createDataFrame([(i, v, 0.0, "z") for i, v in rows + bad + [rows[100]]], "vec_id long, embedding array<double>, score double, rank string")
    found = nearest(table, table.filter(F.col("vec_id") % 100 == 0)).toPandas()
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert set(found.query_id) == set(want)
    hits = 0
    for q, rows_ in found.sort_values("rank").groupby("query_id"):
        true = want[q]
        assert len(rows_) == len(true) and rows_["rank"].tolist() == list(range(1, len(true) + 1))
        assert (np.diff(rows_.score) >= -1e-12).all() and q not in set(rows_.vec_id)
        hits += len({i for _, i in true} & set(rows_.vec_id)) / len(true)
    assert hits / len(want) >= 0.9
    twin = found[found.query_id == 4000].sort_values("rank")
    assert twin.score.abs().max() == 0 and twin.vec_id.tolist() == [7, *range(4001, 4010)]
    assert nearest(table.limit(0), table.limit(0)).count() == 0


def test_exhaustive_is_exact(spark, monkeypatch):
    monkeypatch.setattr(pstable, "QUERY_BLOCK", 3)
    monkeypatch.setattr(pstable, "PROBES", 1)
    monkeypatch.setattr(pstable, "WIDTH", 1e-6)  # no bucket has anything but the vector itself
    random = np.random.default_rng(2)
    rows = [(i, random.normal(size=4).tolist()) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest(table, table.filter("vec_id % 10 = 0")).toPandas()
    for q, near in brute(rows, [r for r in rows if r[0] % 10 == 0], 10).items():
        mine = found[found.query_id == q].sort_values("rank")
        assert mine.vec_id.tolist() == [i for _, i in near]
        assert np.allclose(mine.score, [d for d, _ in near])


@pytest.mark.parametrize("outer", [
    '<div class="content-sidebar-wrap"><main><article>{}</article></main></div>', '<div class="site has-sidebar"><div>{}</div></div>',
    '<div class="layout no-sidebar"><article>{}</article></div>', '<div class="elementor-widget-container">{}</div>',
    '<div data-title="the hidden style">{}</div>', '<div data-class="sidebar" title="id=footer">{}</div>', "<div>{}</div>",
    '<div class="has-sidebar"><main><div class="elementor-widget-container"><article>{}</article></div></main></div>',
])
def test_noise_words_do_not_condemn_the_text(outer):
    body = '<h2 id="related-work">Work</h2><p>A text of some length on reefs.</p><section id="discussion"><h2>Talk</h2></section><p class="warning">Mind the tide.</p>'
    page = Page(outer.format(body) + '<div class="sidebar"><p>More</p></div><div id="comments"><article class="comment-body"><p>Nice</p></article></div><footer>me</footer>')
    assert page.text(None) == "Work\nA text of some length on reefs.\nTalk\nMind the tide."


def test_noise_beside_an_article_stays_noise():
    talk = "<p>" + "Readers say far more than the article. " * 20 + "</p>"
    page = Page(f'<main><article><p>The text.</p></article><div class="related"><article><p>Card</p></article></div><div id="comments"><p>{talk}</p></div></main>')
    assert page.text(None) == "The text."


LONG = "A long body of text on reefs. " * 40


@pytest.mark.parametrize("source", [
    '<article><h1>T</h1><p>lead</p><div class="a"><div class="b"><div class="c"><p>{}</p></div></div></div></article>',
    '<div class="post"><h1>T</h1><p>lead</p><div class="post-body">{}</div></div>',
    '<article><div class="breadcrumbs">Home</div><h1>T</h1><div><p>lead</p></div><div class="share">Tell</div><div class="a"><div class="c">{}</div></div></article>',
])
def test_text_around_the_winner_is_kept(source):
    page = Page('<body><div class="nav">Menu</div>' + source.format(LONG) + "<p>loose</p><footer>me</footer>")
    best = max(page.votes().items(), key=lambda v: v[::-1])[0]
    assert page.text(best) == page.text(None) == "T\nlead\n" + LONG.strip()


def test_a_second_template_keeps_its_text():
    page = Page(f'<div class="nav">Menu</div><div class="story"><p>A teaser.</p></div><div class="nav">Menu</div><div class="x"><p>{LONG}</p></div>')
    assert page.text("div.story") == LONG.strip()


def test_every_container_around_a_block_is_credited():
    page = Page("<div>" * 6 + "0123456789")
    assert [page.scores()[e] for e in range(6, 0, -1)] == [10 / 2**i for i in range(6)]


def test_rare_letters_are_counted_too(spark):
    total = toxicity.ORDER * 350_000  # more n-grams than were once kept
    rows = spark.range(total).select(
        (F.col("id") % 2).cast("int").alias("label"), F.lit(toxicity.ORDER).alias("size"), F.col("id").alias("gram"),
        (F.col("id") % 1000).alias("context"), F.lit(1).cast("long").alias("n"))
    model = toxicity.KneserNey(rows.unionByName(spark.range(2).select(
        F.col("id").cast("int").alias("label"), F.lit(toxicity.ORDER).alias("size"), (-1 - F.col("id")).alias("gram"), F.lit(0).cast("long").alias("context"), F.lit(9).cast("long").alias("n"))))
    assert len(model.parts[-1][0]) == total + 2


def test_sample_keeps_the_smallest_hashes_without_a_task_for_a_class(spark, docs):
    labels = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    table = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = sample(table, labels, "toxic", 3, 1, 1500)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    usable = labels.filter(~held_out("doc_id", 3, 1)).withColumn("h", F.xxhash64("doc_id")).collect()
    want = {r.doc_id for c in (0, 1) for r in sorted((r for r in usable if r.toxic == c), key=lambda r: r.h)[:1500]}
    got = found.collect()
    assert len(got) == 3000 and {r.doc_id for r in got} == want


@pytest.mark.parametrize("source", [
    "<div class=c>" * 100_000 + "<p>deep text of the page</p>",
    "<p>text</p>" + "</div>" * 100_000 + "</span></td>" * 1000,
    "<div>" + "</p><table><tr><td>x</table>" * 30_000,
    "<div>" * 30_000 + "<li>x" * 30_000,
    "<div class=a><p>" * 50_000 + "end" + "</div>" * 50_000,
])
def test_long_broken_pages_take_linear_time(source):
    start = time.perf_counter()
    page = Page(source)
    votes = page.votes()
    page.text(max(votes, key=votes.get, default=None))
    assert time.perf_counter() - start < 10


def test_paths_differ_at_any_depth():
    inner = "<div class=x>" * 20 + "<p>" + "words " * 60
    page = Page(f"<div class=a>{inner}" + "</div>" * 21 + f"<div class=b>{inner}")
    named = [p for p in page.paths() if p]
    assert len(named) == len(set(named)) == 42


def test_a_host_without_article_is_decided_by_its_votes(spark):
    """Two templates: most pages of the host hold their text in div.copy, and div.promo is large on one page only."""
    good = "<div class=copy><p>" + "the main text goes on. " * 12 + "</p></div>"
    page = "<html><body><div class=wrap><ul class=menu><li>Home<li>News</ul><div class=promo><p>{}</p></div>{}</div></body></html>"
    rows = [(i, "http://h.org/%d" % i, page.format("buy this now", good)) for i in range(8)]
    rows.append((8, "http://h.org/8", page.format("buy this now and that too. " * 14, good)))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    paths = host_paths(table).collect()
    assert [p.path.rsplit("#", 1)[0].split("/")[-1] for p in paths] == ["div.copy"]
    got = extract_pages(table).collect()
    assert all("the main text goes on." in r.text for r in got)


def test_toxicity_counts_all_labelled_rows(spark):
    # A letter of its own in each document; two thirds of the rows are not held out.
    table = spark.range(20_000).select(F.col("id").alias("doc_id")).withColumn(
        "text", F.decode(F.unhex(F.lpad(F.hex(F.col("doc_id") + 0x4E00), 4, "0")), "UTF-16BE"))
    labels = table.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    counted = labels.filter(~held_out("doc_id", 3, 1) & (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) != 0)).count()
    model = toxicity.fit(table, labels)
    assert counted > 2 * 4096 and len(model.parts[0][0]) == counted + 1  # and the mark after a word


def test_toxicity_learns_the_words_of_many_texts_at_once(spark, docs, monkeypatch):
    rows = [(i, f"{'vile' if i % 2 else 'kind'}{i} words number {i}") for i in range(60)]
    model = toxicity.fit(docs(rows), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int"))
    texts = [f"new{i} vileness {'kindly ' * (i % 5)}{chr(0x4E00 + i)}x" for i in range(300)] + [None, "", "?!"]
    calls, learn = [], toxicity.KneserNey._learn

    def counted(self, words):
        calls.append(len(words))
        learn(self, words)
    monkeypatch.setattr(toxicity.KneserNey, "_learn", counted)
    whole = model.figures(texts)
    assert calls == [602]
    model.known.clear()
    assert np.array_equal(whole, np.concatenate([model.figures([t]) for t in texts]))
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 20)
    model.known.clear()
    assert np.array_equal(whole, np.concatenate([model.figures(texts[i : i + 7]) for i in range(0, len(texts), 7)]))
    # Longer n-grams that are not known leave what the shorter ones say; no class knows these letters.
    assert model.differences(["\u0416".encode()])[0] == model.differences(["\u0417".encode()])[0]


def test_logistic_curve_of_a_table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3))
    y = (x @ [1.0, -2.0, 0.0] + rng.normal(size=500) > 0).astype(float)
    rows = spark.createDataFrame([(int(c), r.tolist()) for c, r in zip(y, x)], "label int, figures array<double>").repartition(3)
    assert np.allclose(Logistic.of_table(rows, 3).score(x), Logistic(x, y).score(x), atol=1e-6)
    assert Logistic.of_table(rows.filter("label = 1"), 3) is None


def test_candidates_are_no_rows(spark, docs, monkeypatch):
    """What a task hands on follows the queries, not the sizes of the buckets, and is the nearest of what they hold."""
    docs([])
    monkeypatch.setattr(pstable, "QUERY_BLOCK", 4)
    monkeypatch.setattr(pstable, "WIDTH", 1e6)  # one bucket holds all vectors
    handed = []
    ranked = pstable._ranked
    monkeypatch.setattr(pstable, "_ranked", lambda pairs, count: handed.append(pairs.count()) or ranked(pairs, count))
    random = np.random.default_rng(5)
    rows = [(i, np.round(random.normal(size=3), 1).tolist()) for i in range(600)] + [(700 + i, [float(i), 2.0]) for i in range(40)]  # ties, copies, two dimensions
    rows = [r for r in rows if any(r[1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = [r for r in rows if r[0] % 50 == 0]
    found = nearest(table, table.filter("vec_id % 50 = 0")).toPandas()
    assert handed[0] <= 11 * len(asked)
    for q, near in brute(rows, asked, 10).items():
        mine = found[found.query_id == q].sort_values("rank")
        assert np.allclose(mine.score, [d for d, _ in near]) and len(set(mine.vec_id)) == 10
        assert mine.vec_id.tolist() == [i for _, i in sorted(zip(mine.score, mine.vec_id))]
