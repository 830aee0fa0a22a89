"""Exact medians, numbering and last-write-wins."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reefgrid.operators import ranks
from reefgrid.operators.ranks import grouped_median, last_by_key, middle, middle_integers, number_rows


def found(spark, values):
    return middle(spark.createDataFrame([(v,) for v in values], "v double"), "v")


@pytest.fixture(autouse=True, params=[0, 200_000])
def exact_rows(request, monkeypatch):
    monkeypatch.setattr(ranks, "EXACT_ROWS", request.param)


def want(values):
    kept = sorted(v for v in values if v is not None and v == v)
    n = len(kept)
    return (n, kept[(n - 1) // 2], kept[n // 2]) if n else None


@pytest.mark.parametrize("values", [
    [], [None], [3.0], [1.0, 2.0], [-5.0, 0.0, 1e-300], [7.0] * 9, [1.0, 1.0, 2.0, 2.0], [1.0, 1e9],
    [-1e300, -1e-300, 0.0, 1e300], [float("nan"), 1.0, 4.0], [float("inf"), 2.0, float("-inf"), float("inf")], [float(i) for i in range(101)],
    [1.0 + i * 1e-15 for i in range(50)], [0.1] * 5 + [1e6] * 5,
])
def test_middle_values(spark, values):
    assert found(spark, values) == want(values)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_middle_values_property(spark, values):
    assert found(spark, values) == want(values)


def test_integer_middle_needs_one_pass(spark):
    values = [3, 1, 1, 9, 4, 4, 4, 100]
    assert middle_integers(spark.createDataFrame([(v,) for v in values], "v int"), "v") == want(values)
    assert middle(spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "v double"), "v").median == 6.0


def test_grouped_median_with_a_group_of_a_third_of_all_rows(spark):
    rng = random.Random(3)
    data = [("hot", rng.lognormvariate(0, 3)) for _ in range(500)] + [("tied", 2.5) for _ in range(200)]
    data += [(f"k{i % 70}", rng.uniform(-5, 5)) for i in range(800)]
    df = spark.createDataFrame(data, "k string, v double")
    truth = {k: statistics.median([v for key, v in data if key == k]) for k, _ in data}
    got = {r.k: r.median for r in grouped_median(df, ["k"], "v").collect()}
    assert got == pytest.approx(truth, abs=0)


def test_grouped_median_puts_nan_last_and_keeps_empty_groups(spark):
    nan = float("nan")
    data = [("a", v) for v in (0.0, 1.0, 2.0, 3.0, 4.0, nan, nan, nan, nan)] + [("b", nan), ("b", nan), ("c", None), (None, 2.0), (None, 4.0), ("d", float("inf")), ("d", nan), ("d", 1.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.median for r in grouped_median(df, ["k"], "v").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert {k: str(v) for k, v in got.items()} == {k: str(v) for k, v in want.items()}
    assert got["a"] == 4.0 and got["c"] is None and got[None] == 3.0


def test_number_rows_is_global_and_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    got = number_rows(df, ["v"], "n").orderBy("n").collect()
    assert [r.v for r in got] == list(range(1000)) and [r.n for r in got] == list(range(1, 1001))


def test_last_by_key(spark):
    df = spark.createDataFrame([(1, "a", 5, 0), (1, "b", 5, 9), (2, "c", 1, 1), (1, "d", 4, 99)], "k int, v string, p int, q int")
    assert sorted(tuple(r) for r in last_by_key(df, ["k"], ["p", "q"]).collect()) == [(1, "b", 5, 9), (2, "c", 1, 1)]
