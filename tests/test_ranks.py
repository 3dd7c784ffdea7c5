"""Exact quantiles, running totals and hot-level joins on their large-table paths."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from sparkprep.operators import joins, quantiles, ranking
from sparkprep.operators import levels as lv

PROBS = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


def test_nearest_quantiles(table):
    df = table("x int", *[(i,) for i in range(1, 11)])
    assert quantiles.exact_quantiles(df, ["x"], [0.01, 0.25, 0.99], "nearest") == {"x": [1.0, 3.0, 10.0]}


@pytest.mark.parametrize("read_out", [20_000, 5])
def test_quantiles_equal_numpy(spark, monkeypatch, read_out):
    monkeypatch.setattr(quantiles, "READ_OUT_ROWS", read_out)
    rng = random.Random(7)
    hot = [3.25] * 2000  # a third of the rows share one value
    values = hot + [rng.gauss(0, 50) for _ in range(3000)] + [float(rng.randint(-5, 5)) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    got = quantiles.exact_quantiles(df, ["x"], PROBS)["x"]
    assert got == pytest.approx(np.percentile(values, [p * 100 for p in PROBS]).tolist(), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.one_of(hs.none(), hs.integers(-3, 3), hs.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_quantiles_of_any_list(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    found = quantiles.exact_quantiles(df, ["x"], [0.0, 0.3, 0.5, 1.0])["x"]
    present = [float(v) for v in values if v is not None]
    if not present:
        assert found is None
    else:
        assert found == pytest.approx(np.percentile(present, [0, 30, 50, 100]).tolist(), rel=1e-9, abs=1e-9)


def test_exclude_flag(table):
    df = table("x double", (-1.0,), (-1.0,), (4.0,), (None,), (6.0,))
    assert quantiles.exact_quantiles(df, ["x"], [0.5], exclude=-1.0) == {"x": [5.0]}


@pytest.mark.parametrize("rows_per_range", [200_000, 20])
def test_running_totals(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", rows_per_range)
    rng = random.Random(1)
    data = [(rng.randint(0, 200), f"k{rng.randint(0, 50):03d}") for _ in range(2000)]
    df = spark.createDataFrame(data, "a int, b string")
    levels = lv.level_counts(df, ["a", "b"])
    got = {(r.variable, r.v_int if r.variable == "a" else r.v_str): (r.position, r.before) for r in ranking.running_totals(levels.where(~lv.level_is_null())).collect()}
    for i, name in enumerate("ab"):
        column = [d[i] for d in data]
        for k, v in enumerate(sorted(set(column))):
            assert got[(name, v)] == (k, sum(x < v for x in column))


@pytest.mark.parametrize("limit", [500_000, 0])
def test_join_levels_paths_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(joins, "HOT_PARTS", 5)
    keys = ["hot"] * 300 + [f"k{i}" for i in range(40)] * 5 + [None] * 50
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string")
    lookup = df.where("k IS NOT NULL AND k <> 'k7'").groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("n") * 2)
    got = {r.id: r.v for r in joins.join_levels(df, lookup, "k").collect()}
    assert got == {i: (None if k in (None, "k7") else 600 if k == "hot" else 10) for i, k in enumerate(keys)}


def test_decode_large_dimension(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
    df = spark.createDataFrame([(i, i % 5 if i % 7 else None) for i in range(100)], "id int, code int")
    dim = spark.createDataFrame([(k, f"label {k}") for k in range(4)], "key int, name string")
    got = {r.id: r.code_name for r in joins.decode_dimension(df, "code", dim, "key", "name").collect()}
    assert got == {i: (f"label {i % 5}" if i % 7 and i % 5 < 4 else None) for i in range(100)}


def test_level_counts_types_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(lv, "CHUNK", 2)
    df = spark.createDataFrame([(1, 0.0, "a", True), (1, -0.0, None, None)], "i int, d double, s string, b boolean")
    got = {(r.variable, r.v_int, r.v_dbl, r.v_str): r.n for r in lv.level_counts(df, df.columns).collect()}
    assert got == {
        ("i", 1, None, None): 2,
        ("d", None, 0.0, None): 2,
        ("s", None, None, "a"): 1,
        ("s", None, None, None): 1,
        ("b", None, None, "true"): 1,
        ("b", None, None, None): 1,
    }


def test_bracket_covers_rank():
    for n in (1, 2, 10, 999, 1001, 50_000):
        grid = [float(round(i * (n - 1) / 1000)) for i in range(1001)]
        for r in {0, n // 3, n - 1}:
            low, high, _ = quantiles._bracket(grid, r, n)
            assert low <= r <= high or math.isinf(low) or math.isinf(high)
