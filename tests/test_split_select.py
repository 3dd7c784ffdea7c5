"""Splits, samples, neighbour search and feature selection."""

import hashlib
import math
import random
from collections import Counter

import pytest

from sparkprep.functions import scalar
from sparkprep.operators import knn, select, shuffle, split


def _keys(ids, seed=42):
    return sorted(ids, key=lambda i: hashlib.md5(f"{i}#{seed}".encode()).hexdigest())


@pytest.mark.parametrize("digits", [13, 2])
def test_simple_split_follows_hash_order(spark, monkeypatch, digits):
    # with two digits many keys tie and the whole text decides
    monkeypatch.setattr(scalar, "KEY_DIGITS", digits)
    monkeypatch.setattr(split, "KEY_DIGITS", digits)
    ids = list(range(1003))
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(4)
    got = {r.id: r.split for r in split.split_simple(df, ["id"]).collect()}
    order = _keys(ids)
    assert [got[i] for i in order] == ["test"] * 200 + ["val"] * 200 + ["train"] * 603


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500)
    a = {r.id: r.split for r in split.split_simple(df.repartition(7), ["id"]).collect()}
    b = {r.id: r.split for r in split.split_simple(df.coalesce(1), ["id"]).collect()}
    assert a == b


def test_tiny_tables(spark):
    assert split.split_simple(spark.range(0), ["id"]).count() == 0
    assert {r.split for r in split.split_simple(spark.range(3), ["id"]).collect()} == {"train"}


def test_stratified_sizes(spark):
    # 10 rows of a low and 7 of a high target in two bins
    rows = [(i, 1.0) for i in range(10)] + [(i, 2.0) for i in range(10, 17)]
    df = spark.createDataFrame(rows, "id int, y double")
    out = split.split_stratified(df, "y", ["id"], bins=2).collect()
    sizes = Counter((r.bin, r.split) for r in out)
    bins = sorted({b for b, _ in sizes})
    low, high = [(sizes[(b, "test")], sizes[(b, "val")], sizes[(b, "train")]) for b in bins] if len(bins) == 2 else (None, None)
    assert (low, high) in (((2, 2, 6), (1, 1, 5)), (None, None))
    assert sum(sizes.values()) == 17


def test_sample_and_slice(spark):
    df = spark.range(200)
    order = _keys(range(200))
    assert {r.id for r in split.sample_rows(df, ["id"], n=17).collect()} == set(order[:17])
    assert {r.id for r in split.sample_rows(df, ["id"], fraction=0.25).collect()} == set(order[:50])
    assert split.sample_rows(df, ["id"], n=1000).count() == 200
    assert {r.id for r in split.slice_rows(df, ["id"], 190, 50).collect()} == set(order[190:])
    assert split.slice_rows(df, ["id"], 300, 5).count() == 0


def test_folds_and_undersampling(spark):
    rows = [(i, float(i), "a" if i % 3 else "b") for i in range(300)] + [(300, None, None)]
    df = spark.createDataFrame(rows, "id int, y double, c string")
    folds = Counter(r.fold for r in split.stratified_folds(df, "y", ["id"]).collect())
    assert folds == {0: 60, 1: 60, 2: 60, 3: 60, 4: 60, None: 1}
    assert Counter(r.c for r in split.undersample(df, "c", ["id"]).collect()) == {"a": 100, "b": 100}


def test_quantile_bins_keep_ties_together(table):
    df = table("id int, x int", *[(i, v) for i, v in enumerate([1, 1, 1, 1, 2, 3, 4, 5, None])])
    got = {(r.x, r.b) for r in split.quantile_bins(df, "x", ["lo", "mid", "hi", "top"], "b").collect()}
    assert len({b for x, b in got if x == 1}) == 1 and (None, None) in got


def _brute(donors, row, k):
    """Neighbour fill of one row: every donor row is compared."""
    out = list(row)
    for f, v in enumerate(row):
        if v is not None:
            continue
        found = []
        for d in donors:
            both = [(a, b) for a, b in zip(row, d) if a is not None and b is not None]
            if d[f] is not None and both:
                gap = len(row) / len(both) * sum((a - b) ** 2 for a, b in both)
                found.append((gap, [math.inf if x is None else x for x in d], d[f]))
        have = [d[f] for d in donors if d[f] is not None]
        near = sorted(found)[:k]
        out[f] = sum(n[2] for n in near) / len(near) if near else (sum(have) / len(have) if have else 0.0)
    return out


@pytest.mark.parametrize("blocks", [(20_000, 2_000), (7, 5)])
def test_knn_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(knn, "DONOR_BLOCK", blocks[0])
    monkeypatch.setattr(knn, "RECEIVER_BLOCK", blocks[1])
    rng = random.Random(5)
    cell = lambda hi: None if rng.random() < 0.25 else rng.randint(1, hi)
    rows = [(i, cell(4), cell(5), cell(3)) for i in range(150)]
    train, other = rows[:100], rows[100:] + [(900, None, None, None)]
    schema = "id int, a int, b int, c int"
    model = knn.KnnFill(inputCols=["a", "b", "c"], k=5).fit(spark.createDataFrame(train, schema))
    got = {r.id: [r.a, r.b, r.c] for r in model.transform(spark.createDataFrame(other, schema)).collect()}
    donors = [r[1:] for r in train]
    for r in other:
        assert got[r[0]] == pytest.approx(_brute(donors, r[1:], 5), abs=1e-9), r


def test_knn_example_and_storage(spark, table):
    from sparkprep.session import scratch_path

    donors = table("a double, b double", (1.0, 1.0), (2.0, 2.0), (10.0, 10.0))
    model = knn.KnnFill(inputCols=["a", "b"], k=2).fit(donors)
    path = scratch_path(spark, "knn")
    model.save(path)
    for m in (model, knn.KnnModel.load(path)):
        assert m.transform(table("a double, b double", (1.4, None))).first().b == 1.5


def test_knn_without_donors(table):
    donors = table("a double, b double", (1.0, None), (2.0, None))
    row = knn.KnnFill(inputCols=["a", "b"], k=2).fit(donors).transform(donors).first()
    assert row.b == 0.0


def test_mutual_information(table):
    rows = [(i, float(i % 2), float(i % 2), float(i // 2 % 2)) for i in range(40)]
    df = table("id int, y double, same double, free double", *rows)
    got = {r.variable: r.mi for r in select.mutual_information(df, ["same", "free"], "y").collect()}
    assert got["same"] == pytest.approx(math.log(2)) and got["free"] == pytest.approx(0.0, abs=1e-12)


def _names(spark, names):
    return spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "variable string, rank int")


@pytest.mark.parametrize(
    "mi, rfe, n, expected",
    [
        (["a", "b", "c"], ["a", "d", "e"], 4, ["a", "b", "d", "c"]),
        (["a", "b"], ["b", "a"], 1, ["a"]),
        (["a"], ["x", "y", "z"], 4, ["a", "x", "y", "z"]),
    ],
)
def test_merge(spark, mi, rfe, n, expected):
    sets = select.feature_sets(_names(spark, mi), _names(spark, rfe))
    got = [r.variable for r in select.merge_features(sets, n).orderBy("position").collect()]
    assert got == expected


def _planted(spark, n=600):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        a, b, *noise = [rng.random() for _ in range(5)]
        rows.append((i, 10 * a + 3 * b + 0.01 * rng.random(), a, b, *noise))
    return spark.createDataFrame(rows, "id int, y double, a double, b double, n1 double, n2 double, n3 double")


def test_planted_signal_is_selected(spark):
    df = _planted(spark)
    features = ["a", "b", "n1", "n2", "n3"]
    ranks = {r.variable: r.rank for r in select.eliminate(df, features, "y", ["id"], n_features=2, trees=10, depth=5).collect()}
    assert ranks["a"] == ranks["b"] == 1 and sorted(ranks.values()) == [1, 1, 2, 3, 4]
    mi = [r.variable for r in select.mutual_information(df, features, "y").collect()]
    assert mi[0] == "a"
    grid = select.forest_grid(df, features, "y", ["id"], trees=[3, 10], depths=[1, 5], folds=2).collect()
    best = [r for r in grid if r.best]
    assert len(grid) == 4 and len(best) == 1 and best[0].max_depth == 5


@pytest.mark.parametrize("block", [500_000, 100])
def test_permutation_keeps_values(spark, monkeypatch, block):
    monkeypatch.setattr(shuffle, "ROWS_PER_BLOCK", block)
    df = _planted(spark, 350).select("id", "a", "b")
    out = {r.id: r for r in shuffle.permuted_column(df, "a", ["id"], 1).collect()}
    before = {r.id: r for r in df.collect()}
    assert sorted(r.a for r in out.values()) == sorted(r.a for r in before.values())
    assert all(out[i].b == before[i].b for i in before)
    assert sum(out[i].a != before[i].a for i in before) > 300
