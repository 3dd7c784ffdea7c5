"""Group quantiles, columns missing together, dependencies and components with missing cells, against plain versions."""

import math
from collections import defaultdict
from itertools import combinations, permutations

import numpy as np
import pytest

from sparkprep.operators import component, dependencies, grouped
from sparkprep.operators import select as sel
from sparkprep.operators.component import fit_component
from sparkprep.operators.grouped import group_quantiles
from sparkprep.operators.together import missing_together


@pytest.mark.parametrize("size", [400, 200_000])
@pytest.mark.parametrize("how", ["linear", "nearest"])
def test_quantiles_of_many_groups(spark, monkeypatch, size, how):
    monkeypatch.setattr(grouped, "LEVELS_PER_RANGE", size)
    rng = np.random.default_rng(3)
    group = np.where(rng.random(9000) < 0.34, -1, rng.integers(0, 1500, 9000))
    x = np.where(rng.random(9000) < 0.5, rng.integers(0, 9, 9000).astype(float), rng.normal(size=9000))
    rows = [(None if g < 0 else int(g), "ab"[i % 2], None if i % 50 == 0 else math.nan if i % 50 == 1 else float(v)) for i, (g, v) in enumerate(zip(group, x, strict=True))]
    df = spark.createDataFrame(rows, "k0 int, c string, part double")
    got = {(r.k0, r.c): (r.n, r.low, r.mid, r.top) for r in group_quantiles(df, ["k0", "c"], "part", {"low": 0.0, "mid": 0.5, "top": 0.93}, how).collect()}
    want = defaultdict(list)
    for g, c, v in rows:
        if v is not None and v == v:
            want[(g, c)].append(v)
    assert set(got) == set(want) and len(got) > 1500
    for key, values in want.items():
        values = np.sort(values)
        at = [q * (len(values) - 1) for q in (0.0, 0.5, 0.93)]
        exact = [float(np.interp(p, range(len(values)), values)) if how == "linear" else values[min(len(values) - 1, math.floor(p + 0.5))] for p in at]
        assert got[key] == pytest.approx((len(values), *exact), abs=1e-12)


def test_group_quantile_edges(spark, table):
    empty = spark.createDataFrame([], "g string, x double")
    assert group_quantiles(empty, ["g"], "x", {"m": 0.5}).count() == 0
    df = table("g string, x double", ("a", None), (None, 2.0), (None, 2.0), ("b", -0.0), ("b", 0.0))
    assert {r.g: (r.n, r.m) for r in group_quantiles(df, ["g"], "x", {"m": 0.5}).collect()} == {None: (2, 2.0), "b": (2, 0.0)}
    assert group_quantiles(df, [], "x", {"m": 1.0}).first() == (4, 2.0)
    with pytest.raises(ValueError, match="distinct"):
        group_quantiles(df, ["g"], "x", {"G": 0.5})
    with pytest.raises(ValueError, match="probabilities"):
        group_quantiles(df, ["g"], "x", {"m": 1.5})


def test_missing_together_of_165_columns(spark):
    rng = np.random.default_rng(4)
    flags = rng.random((777, 165)) < rng.random(165) * 0.8
    flags[:, 7], flags[:, 8] = True, False
    flags[:, 9] = flags[:, 10]
    df = spark.createDataFrame([[None if f else 1 for f in row] for row in flags.tolist()], ", ".join(f"c{i} int" for i in range(165))).repartition(5)
    got = {(r.var_a, r.var_b): r for r in missing_together(df).collect()}
    assert len(got) == 165 * 164 // 2
    both = flags.astype(int).T @ flags.astype(int)
    for i, j in combinations(range(165), 2):
        r = got[(f"c{i}", f"c{j}")]
        assert (r.n_rows, r.n_a, r.n_b, r.n_both) == (777, both[i, i], both[j, j], both[i, j])
        if {i, j} & {7, 8}:
            assert r.r is None
        else:
            assert r.r == pytest.approx(np.corrcoef(flags[:, i], flags[:, j])[0, 1], abs=1e-12)
    assert got[("c9", "c10")].r == pytest.approx(1.0)
    none = missing_together(df.where("false"), ["c1", "c2"]).first()
    assert (none.n_rows, none.n_both, none.r) == (0, 0, None)


@pytest.mark.parametrize("step", [2, 16])
def test_dependencies_equal_every_pair(spark, monkeypatch, step):
    monkeypatch.setattr(dependencies, "STEP", step)
    rows = [
        (i, i % 12, (i % 12) // 3, str((i % 12) // 3) if (i % 12) // 3 else None, i % 5, "x", None if i % 12 == 4 else 1.5, float(i % 4) if i % 4 else math.nan)
        for i in range(120)
    ]
    names = ["id", "fine", "coarse", "a.b", "other", "constant", "half", "w"]
    schema = "id int, fine int, coarse int, `a.b` string, other int, constant string, half double, w double"
    df = spark.createDataFrame(rows, schema)
    plain = [["nan" if v != v else v for v in row] for row in rows]
    want = set()
    for a, b in permutations(range(len(names)), 2):
        seen = defaultdict(set)
        for r in plain:
            seen[r[a]].add(r[b])
        if all(len(v) == 1 for v in seen.values()) and len({r[a] for r in plain}) > 1 and len({r[b] for r in plain}) > 1:
            want.add((names[a], names[b]))
    got = dependencies.dependencies(df).collect()
    assert {(r.lhs, r.rhs) for r in got} == want and ("coarse", "a.b") in want and ("fine", "w") in want
    assert {r.lhs for r in got if r.lhs_is_key} == {"id"}
    assert dependencies.dependencies(df.where("false")).count() == 0


def _rowwise(z, steps):
    """The same model by the rows, one after the other."""
    p = z.shape[1]
    pairs = [[np.nanmean(z[:, i] * z[:, j]) for j in range(p)] for i in range(p)]
    value, vector = np.linalg.eigh(np.array(pairs))
    w, level, noise = vector[:, -1] * np.sqrt(value[-1]), np.zeros(p), 0.5
    for _ in range(steps):
        t, tt = np.zeros(len(z)), np.zeros(len(z))
        for i, row in enumerate(z):
            has = ~np.isnan(row)
            size = noise + w[has] @ w[has]
            t[i] = w[has] @ (row[has] - level[has]) / size
            tt[i] = noise / size + t[i] ** 2
        rest = count = 0.0
        new_w, new_level = w.copy(), level.copy()
        for j in range(p):
            k = ~np.isnan(z[:, j])
            a = np.array([[tt[k].sum(), t[k].sum()], [t[k].sum(), k.sum()]])
            new_w[j], new_level[j] = np.linalg.solve(a, [(t[k] * z[k, j]).sum(), z[k, j].sum()])
            e = z[k, j] - new_level[j]
            rest += (e**2 - 2 * e * new_w[j] * t[k] + new_w[j] ** 2 * tt[k]).sum()
            count += k.sum()
        w, level, noise = new_w, new_level, rest / count
    return w, level, noise


def test_component_with_missing_cells_equals_the_rowwise_model(spark):
    rng = np.random.default_rng(6)
    t = rng.normal(size=500)
    x = np.outer(t, [2.0, -1.0, 0.5, 3.0]) + rng.normal(size=(500, 4)) * [1, 0.5, 0.7, 2] + [10, 0, -5, 1e4]
    x[rng.random((500, 4)) < 0.3] = np.nan
    x = x[~np.isnan(x).all(axis=1)]
    rows = [(i, *[None if v != v and i % 2 else float(v) for v in row]) for i, row in enumerate(x)] + [(9999, None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double")
    model = fit_component(df, list("abcd"), steps=25, tolerance=0.0)
    z = (x - np.nanmean(x, axis=0)) / np.nanstd(x, axis=0)
    w, level, noise = _rowwise(z, 25)
    sign = np.sign(w[0])
    assert list(model.loading.values()) == pytest.approx(sign * w, abs=1e-8)
    assert list(model.level.values()) == pytest.approx(level, abs=1e-8) and model.noise == pytest.approx(noise, abs=1e-8)
    got = {r.id: r.s for r in model.score(df, "s").collect()}
    assert got.pop(9999) is None
    for i, row in enumerate(z):
        has = ~np.isnan(row)
        assert got[i] == pytest.approx(sign * (w[has] @ (row[has] - level[has])) / (noise + w[has] @ w[has]), abs=1e-7)
    # it follows the score behind the data better than filling with the mean
    settled = fit_component(df, list("abcd"))
    scores = {r.id: r.s for r in settled.score(df, "s").where("s is not null").collect()}
    keep = [i for i in scores if i < 500]
    assert abs(np.corrcoef([scores[i] for i in keep], np.nansum(z[keep] * np.sign(w), axis=1))[0, 1]) > 0.9


def test_component_of_whole_rows_is_the_first_eigenvector(spark, table):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 3)) @ np.array([[2, 1, 0], [0, 1, 0.5], [0, 0, 1]])
    df = spark.createDataFrame([[float(v) for v in row] for row in x], "a double, b double, c double")
    w = np.array(list(fit_component(df, list("abc")).loading.values()))
    first = np.linalg.eigh(np.corrcoef(x.T))[1][:, -1]
    assert w / np.linalg.norm(w) == pytest.approx(first * np.sign(first[0]), abs=1e-5)
    odd = table("a double, b double", (1.0, None), (1.0, None))
    assert [r.s for r in fit_component(odd, ["a", "b"]).score(odd, "s").collect()] == [None, None]
    with pytest.raises(ValueError, match="at most"):
        fit_component(odd, ["a"] * (component.MOST_COLUMNS + 1))


def test_errors_of_a_nested_forest_are_those_of_separate_ones(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 3))
    y = x[:, 0] * 3 + np.where(x[:, 1] > 0.3, 5, 0) + rng.normal(size=400)
    df = spark.createDataFrame([(i, *map(float, row), float(v)) for i, (row, v) in enumerate(zip(x, y, strict=True))], "id int, a double, b double, c double, y double")
    rows = sel.assembled(sel.training_table(df, ["a", "b", "c"], "y", ["id"], 4, 1), ["a", "b", "c"])
    train, test = rows.where("_fold <> 0"), rows.where("_fold = 0")
    big = sel.forest(6, 9, 1).fit(train)
    got = sel.nested_errors(big, test, [2, 6], [1, 4, 9])
    cells = [(r._features, r._label) for r in test.collect()]
    for depth in (1, 4, 9):
        own = sel.forest(6, depth, 1).fit(train)
        # equal draws, so a tree cut at a depth is the tree grown to it
        assert got[(6, depth)] == pytest.approx(np.mean([(own.predict(f) - v) ** 2 for f, v in cells]), rel=1e-9)
        assert got[(2, depth)] == pytest.approx(np.mean([(np.mean([t.predict(f) for t in own.trees[:2]]) - v) ** 2 for f, v in cells]), rel=1e-9)
    assert sel.nested_errors(big, test.where("false"), [2], [1]) == {}
