"""Association measures against hand-computed and numpy results."""

import itertools
import math

import numpy as np
import pytest

from sparkprep.operators import assoc


def test_spearman_with_ties(table):
    df = table("x int, y int", (1, 1), (2, 3), (2, 2), (3, 4), (None, 9))
    row = assoc.spearman(df, [("x", "y")]).first()
    assert row.n == 4 and row.r == pytest.approx(0.948683, abs=1e-6)


def test_spearman_constant_column_has_no_value(table):
    df = table("x int, y int", (1, 1), (1, 3), (1, 2))
    assert assoc.spearman(df, [("x", "y")]).first().r is None


def _cells(table, counts):
    rows = [(f"r{i}", f"c{j}") for i, row in enumerate(counts) for j, n in enumerate(row) for _ in range(n)]
    return table("a string, b string", *rows)


def test_cramers_v_yates(table):
    df = _cells(table, [[10, 20], [30, 40]])
    row = assoc.cramers_v(df, [("a", "b")]).first()
    assert (row.chi2, row.v) == (pytest.approx(0.446429, abs=1e-6), pytest.approx(0.066815, abs=1e-6))
    row = assoc.cramers_v(df, [("a", "b")], yates=False).first()
    assert (row.chi2, row.v) == (pytest.approx(0.793651, abs=1e-6), pytest.approx(0.089087, abs=1e-6))


def test_cramers_v_with_empty_cell_and_single_level(table):
    df = _cells(table, [[5, 0], [0, 5]])
    assert assoc.cramers_v(df, [("a", "b")], yates=False).first().v == pytest.approx(1.0)
    assert assoc.cramers_v(df, [("a", "b")]).first().chi2 == pytest.approx(6.4)
    assert assoc.cramers_v(_cells(table, [[3, 4]]), [("a", "b")]).first().v == 0.0


def test_functional_mapping(table):
    one = table("a string, b int", ("a", 1), ("a", 1), ("b", 2))
    assert assoc.functional_mapping(one, "a", "b").first().one_to_one
    two = one.union(table("a string, b int", ("b", 3)))
    row = assoc.functional_mapping(two, "a", "b").first()
    assert (row.n_a, row.n_b, row.n_pairs, row.perfect) == (2, 3, 3, False)
    shared = table("a string, b int", ("a", 1), ("b", 1))
    row = assoc.functional_mapping(shared, "a", "b").first()
    assert row.perfect and not row.one_to_one


def _data(seed=3, n=400):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 10, 1e3, 1] + [0, 5, 1e6, 0]
    x[:, 1] += 3 * x[:, 0]
    x[:, 3] = 7.0  # constant
    rows = [[None if rng.random() < 0.2 and j < 2 else float(v) for j, v in enumerate(r)] for r in x]
    return rows


@pytest.mark.parametrize("jvm_pairs", [300, 0])
def test_pearson_paths_equal_numpy(spark, monkeypatch, jvm_pairs):
    monkeypatch.setattr(assoc, "JVM_PAIRS", jvm_pairs)
    rows = _data()
    names = list("abcd")
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} double" for n in names)).repartition(4)
    got = {(r.var_a, r.var_b): (r.n, r.r) for r in assoc.pearson_matrix(df, names).collect()}
    assert len(got) == 6
    for i, j in itertools.combinations(range(4), 2):
        both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
        n, r = got[(names[i], names[j])]
        assert n == len(both)
        if 3 in (i, j):
            assert r is None or abs(r) < 1e-6
        else:
            assert r == pytest.approx(np.corrcoef(np.array(both).T)[0, 1], abs=1e-9)


def test_pearson_null_propagation(table):
    df = table("a double, b double, c double", (1.0, 2.0, 1.0), (2.0, 4.0, None), (3.0, 6.0, 3.0))
    got = {(r.var_a, r.var_b): r.r for r in assoc.pearson_matrix(df, ["a", "b", "c"], nulls="propagate").collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] is None


def test_p_value():
    # t distribution tables: t = 2.228 with 10 degrees of freedom has p = 0.05
    t, dof = 2.228138852, 10
    r = t / math.sqrt(dof + t * t)
    assert assoc.correlation_p_value(r, dof + 2) == pytest.approx(0.05, abs=1e-6)
    assert assoc.correlation_p_value(0.0, 12) == pytest.approx(1.0)
    # t = 12.706 with one degree of freedom
    t = 12.706204736
    assert assoc.correlation_p_value(t / math.sqrt(1 + t * t), 3) == pytest.approx(0.05, abs=1e-6)
    assert assoc.correlation_p_value(1.0, 10) == 0.0


def test_duplicate_candidates():
    names = ["ST006", "ST006_duplicated_0", "X_duplicated_0", "other"]
    assert assoc.duplicate_candidates(names) == [("ST006", "ST006_duplicated_0")]


@pytest.mark.parametrize("wide", [False, True])
def test_pearson_rules_do_not_depend_on_the_number_of_columns(spark, monkeypatch, wide):
    monkeypatch.setattr(assoc, "JVM_PAIRS", 0 if wide else 300)
    rows = [(float(i), float((i * 7) % 20), 0.1, float("nan") if i % 2 else i * 1.0, 1e9 + (i * i) % 7, None if i < 10 else 1e9 + i % 3) for i in range(20)]
    rows += [(1e9, None, 0.1, None, 1e9, 0.5), (None, None, None, None, None, None)]
    names = list("abcdef")
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r.var_a, r.var_b): (r.n, r.r) for r in assoc.pearson_matrix(df, names).collect()}
    assert len(got) == 15
    for i, j in itertools.combinations(range(6), 2):
        both = [(r[i], r[j]) for r in rows if None not in (r[i], r[j]) and not math.isnan(r[i]) and not math.isnan(r[j])]
        n, r = got[names[i], names[j]]
        assert n == len(both)
        x, y = (np.array(v, dtype=np.longdouble) for v in zip(*both))
        if (x == x[0]).all() or (y == y[0]).all():
            assert r is None
        else:
            dx, dy = x - x.mean(), y - y.mean()
            assert r == pytest.approx(float((dx @ dy) / np.sqrt((dx @ dx) * (dy @ dy))), abs=1e-7)
    empty = assoc.pearson_matrix(df.where("false"), names).collect()
    assert len(empty) == 15 and all((r.n, r.r) == (0, None) for r in empty)


def test_rank_correlation_leaves_nan_out(table):
    nan = float("nan")
    df = table("a double, b double", (1.0, nan), (2.0, 2.0), (3.0, 1.0), (4.0, 0.0))
    row = assoc.spearman(df, [("a", "b")]).first()
    assert (row.n, row.r) == (3, pytest.approx(-1.0))


def test_task_tables_equal_row_counts(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [tuple(None if rng.random() < 0.1 else float(rng.integers(0, m)) for m in (2, 5, 40, 3000)) + (-0.0 if i % 2 else 0.0,) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(6)
    pairs = list(itertools.combinations("abcde", 2))
    value = lambda c: assoc._rankable(c, df.schema[c].dataType)
    counts = lambda: {(r.pair, r.x, r.y): r.n for r in assoc._cells(df, pairs, value).collect()}
    by_row = counts()
    monkeypatch.setattr(assoc, "ROW_PAIRS", 0)
    assert counts() == by_row
    monkeypatch.setattr(assoc, "TASK_CELLS", 500)
    monkeypatch.setattr(assoc, "DENSE", 100)
    assert counts() == by_row
    text = df.select(*[df[c].cast("int").cast("string").alias(c) for c in "abcd"])
    v = {(r.var_a, r.var_b): (r.n, r.levels_a, r.levels_b, r.chi2) for r in assoc.cramers_v(text, list(itertools.combinations("abcd", 2))).collect()}
    monkeypatch.setattr(assoc, "ROW_PAIRS", 99)
    w = {(r.var_a, r.var_b): (r.n, r.levels_a, r.levels_b, r.chi2) for r in assoc.cramers_v(text, list(itertools.combinations("abcd", 2))).collect()}
    assert v.keys() == w.keys() and all(v[k][:3] == w[k][:3] and v[k][3] == pytest.approx(w[k][3]) for k in v)


def test_many_pairs_do_not_multiply_rows(spark):
    df = spark.range(10).selectExpr(*[f"CAST(id % {k + 2} AS DOUBLE) AS c{k}" for k in range(90)])
    pairs = list(itertools.combinations(df.columns, 2))
    assert len(pairs) > 4000
    plan = assoc._cells(df, pairs, lambda c: assoc._rankable(c, df.schema[c].dataType))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
