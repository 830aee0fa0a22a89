"""The driver contract and the shape of the plans."""

import duckdb
import pytest

import __spark_entry__ as entry
from reefgrid.plans import registry

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plan(spark, name):
    return entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sorted(r.tier for r in rows) == [0, 1, 2, 3] and sum(r.n_points for r in rows) == rows[0].total


def test_every_oracle_belongs_to_a_query():
    assert set(registry.oracles()) <= set(registry.queries())
    assert set(registry.queries()) - set(registry.oracles()) == {"knn_mean_points", "sampled_pairs"}


LAZY = [
    "tier_assign", "reproj_point_error", "image_quality", "covisibility", "prefilter_attribution", "nav_match", "camera_assign",
    "images_reassigned", "cross_camera", "pairs_min_matches", "stage_timings_rollup", "last_metric", "recommendations",
    "plan_sizing", "json_repair", "image_tfidf", "extension_fix", "isolated_images",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_per_row(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "max_error_filter")
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    text = plan(spark, "covisibility")
    assert "l_quantity" not in text and "l_shipdate" not in text


def test_group_limits_reach_the_map_side(spark):
    assert "WindowGroupLimit" in plan(spark, "stratified_subset")


@pytest.mark.parametrize("name", ["tier_counts", "image_quality", "prefilter_attribution", "nav_match", "plan_sizing", "pairs_spatial"])
def test_small_queries_match_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    res = duck.execute(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in df.select(cols).collect()))) == sorted(map(repr, res))


def test_any_verified_pair_joins_images(spark):
    from reefgrid.plans.catalog_queries import image_components, isolated_images

    class Weak:
        def images(self):
            return spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "image_id bigint")

        def sparse_view(self):
            return spark.createDataFrame([(1, 2, 1), (2, 3, 79), (3, 4, 0)], "image_id1 bigint, image_id2 bigint, rows bigint")

        two_view = sparse_view

    assert [r.image_id for r in isolated_images(Weak()).collect()] == [4]
    assert sorted((r.component, r.n_nodes) for r in image_components(Weak()).collect()) == [(1, 3), (4, 1)]


def test_image_components_take_the_pairs_of_all_lines(spark, tmp_path):
    lines = [(1, 1, 1, "N", 40.0), (3, 1, 2, "A", 50.0), (5, 0, 7, "R", 3.0), (7, 0, 7, "A", 5.0)]
    spark.createDataFrame(lines, "l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(i, 1) for i in range(10)], "p_partkey long, p_size long").write.parquet(str(tmp_path / "part.parquet"))
    found = entry.queries()["image_components"](spark, str(tmp_path))
    assert sorted((r.component, r.n_nodes) for r in found.collect()) == [(0, 1), (1, 3), (2, 1), (4, 1), (6, 1), (7, 2), (9, 1)]
    with duckdb.connect() as con:
        for t in ("lineitem", "part"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        rows = con.execute(entry.oracle_sql()["image_components"]).fetchall()
    assert sorted(rows) == sorted((r.component, r.n_nodes) for r in found.collect())
