"""Frequent levels by summaries: same rows as the whole level table, bounded work."""

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import frequent
from sparkprep.operators import levels as lv
from sparkprep.operators.frequent import frequent_levels, frequent_values


def rows(df):
    fix = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted([tuple(fix(r[c]) for c in ("variable", "rank", *lv.LEVEL_PARTS, "n")) for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    # five values hold a third of the rows, the rest is nearly unique
    hot = np.where(rng.random(n) < 0.33, rng.choice(5, n, p=[0.4, 0.3, 0.15, 0.1, 0.05]), rng.integers(10, 10**9, n))
    out = [
        (int(h), f"t{h}", None if h % 3 == 1 else Decimal(int(h)) / 4, float("nan") if h == 1 else -0.0 if i % 2 and h == 0 else float(h), i, int(h) % 3)
        for i, h in enumerate(hot)
    ]
    return spark.createDataFrame(out, "a long, b string, c decimal(20,2), d double, id int, few int").repartition(8).cache()


@pytest.mark.parametrize("nulls", [True, False])
def test_equal_to_the_level_table(skewed, nulls):
    cols = ["a", "b", "c", "d", "few", "id"]
    got = frequent_levels(skewed, cols, 4, nulls, entries=100)
    assert rows(got) == rows(lv.top_levels(lv.level_counts(skewed, cols), 4, nulls))


def test_hot_columns_need_no_level_table(skewed, monkeypatch):
    asked = []
    whole = lv.level_counts
    monkeypatch.setattr(lv, "level_counts", lambda df, cols, keep=None: asked.append(cols) or whole(df, cols, keep))
    frequent_levels(skewed, ["a", "b", "d", "few", "id"], 4, entries=100)
    # all values of an id occur once: nothing can be told apart before counting
    assert asked == [["id"]]


def test_levels_that_share_a_hash_are_told_apart(skewed, monkeypatch):
    hashed = frequent._hashed
    monkeypatch.setattr(frequent, "_hashed", lambda *a: [F.pmod(h, F.lit(37)) for h in hashed(*a)])
    for entries in (5, 30, 100):
        got = frequent_levels(skewed, ["a", "few"], 4, entries=entries)
        assert rows(got) == rows(lv.top_levels(lv.level_counts(skewed, ["a", "few"]), 4))


def test_a_summary_is_bounded_and_misses_no_more_than_it_says():
    rng = np.random.default_rng(5)
    batches = [np.where(rng.random(3000) < 0.4, rng.integers(0, 8, 3000), rng.integers(100, 10**6, 3000)) for _ in range(12)]
    # the empty batch and the null count for nothing
    fed = [pa.RecordBatch.from_pydict({"x": pa.array([*b.tolist(), None], pa.int64())}) for b in [*batches, np.empty(0, np.int64)]]
    (out,) = frequent._summaries(1, 50)(iter(fed))
    found = dict(zip(out.column("h").to_pylist(), zip(out.column("n").to_pylist(), out.column("e").to_pylist(), strict=True), strict=True))
    error = found.pop(None)[1]
    values, counts = np.unique(np.concatenate(batches), return_counts=True)
    assert len(found) <= 50 and 0 < error <= 36_000 / 51
    for v, n in zip(values.tolist(), counts.tolist(), strict=True):
        kept = found.get(v, (0, 0))[0]
        assert kept <= n <= kept + error


def test_few_rows_ties_and_nothing(spark, table):
    df = table("`a b` string, x int", ("q", 1), ("p", 1), (None, 2), (None, None), ("q", None), ("p", 3))
    got = [(r.variable, r["rank"], r.value, r.n) for r in frequent_values(df, ["a b", "x"], 2).orderBy("variable", "rank").collect()]
    # ties by level, null last
    assert got == [("a b", 1, "p", 2), ("a b", 2, "q", 2), ("x", 1, "1", 2), ("x", 2, None, 2)]
    assert frequent_values(df.where("false"), ["x"], 2).collect() == []
    assert frequent_values(df.where("x is null"), ["x"], 3, nulls=False).collect() == []
    with pytest.raises(ValueError, match="no columns"):
        frequent_levels(df, [])


def test_more_columns_than_a_pass_reads(spark):
    df = spark.range(300).select(*[(F.col("id") % (i + 2)).alias(f"c{i}") for i in range(lv.CHUNK + 3)])
    cols = df.columns
    assert rows(frequent_levels(df, cols, 2)) == rows(lv.top_levels(lv.level_counts(df, cols), 2))


def test_too_many_candidates_go_the_other_way(spark):
    df = spark.range(500).select((F.col("id") % 250).alias("a"))
    assert rows(frequent_levels(df, ["a"], 3, candidates=10)) == rows(lv.top_levels(lv.level_counts(df, ["a"]), 3))
