"""Mutual information by nearest neighbours against every pair of rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import information
from sparkprep.operators.information import neighbour_information


def digamma(m):
    return sum(1 / i for i in range(1, m)) - 0.5772156649015329


def plain(x, y, k):
    """The estimate from all pairs of rows, on the grid."""
    rows = [(a, b) for a, b in zip(x, y, strict=True) if a is not None and b is not None and not math.isnan(a) and not math.isnan(b)]
    n = len(rows)
    if n < 2:
        return n, 0.0
    z = np.array(rows, dtype=float)
    spread = z.std(axis=0)
    if (z == z[0]).all(axis=0).any():
        return n, 0.0
    z = np.floor(z * (2.0**information.GRID / spread) + 0.5).astype(np.int64)
    k = min(k, n - 1)
    total = 0.0
    for i in range(n):
        dx, dy = np.abs(z[:, 0] - z[i, 0]), np.abs(z[:, 1] - z[i, 1])
        r = max(np.sort(np.delete(np.maximum(dx, dy), i))[k - 1] - 1, 0)
        total += digamma(int((dx <= r).sum())) + digamma(int((dy <= r).sum()))
    return n, max(digamma(n) + digamma(k) - total / n, 0.0)


@pytest.mark.parametrize("block", [16, 4096])
def test_information_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(information, "BLOCK", block)
    monkeypatch.setattr(information, "VISITORS", 7)
    rng = np.random.default_rng(block)
    n = 300
    y = rng.standard_normal(n)
    columns = {
        "copy": y,
        "noisy": y + 0.5 * rng.standard_normal(n),
        "free": rng.standard_normal(n),
        # few values, one of them a third of the rows, beside a far one
        "few": np.where(np.arange(n) % 3 == 0, 0.0, np.round(y)),
        "far": np.where(np.arange(n) == 7, 1e9, y),
        "const": np.full(n, 0.1),
    }
    columns = {c: [float(v) for v in x] for c, x in columns.items()}
    columns["holes"] = [None if i % 4 else math.nan if i % 8 else v for i, v in enumerate(columns["copy"])]
    columns["one"] = [v if i == 5 else None for i, v in enumerate(columns["copy"])]
    columns["four"] = [v if i < 4 else None for i, v in enumerate(columns["noisy"])]
    y = [float(v) for v in y]
    df = spark.createDataFrame(list(zip(y, *columns.values(), strict=True)), ", ".join(f"{c} double" for c in ["y", *columns]))
    # repeated rows count each
    df = df.unionByName(df.where("y > 1"))
    rows = df.toPandas()
    got = {r.variable: (r.n, r.mi) for r in neighbour_information(df, list(columns), "y").collect()}
    for c in columns:
        known = [None if v is None or math.isnan(v) else float(v) for v in rows[c]]
        want = plain(known, [float(v) for v in rows["y"]], 5)
        assert got[c][0] == want[0] and got[c][1] == pytest.approx(want[1], abs=1e-9), c
    assert got["copy"][1] > got["noisy"][1] > got["free"][1]
    empty = neighbour_information(df.where("false"), ["copy", "far"], "y").collect()
    assert {(r.variable, r.n, r.mi) for r in empty} == {("copy", 0, 0.0), ("far", 0, 0.0)}


def test_digamma(spark):
    got = spark.range(1, 60).select(information.psi(F.col("id")).alias("p")).orderBy("id").collect()
    assert [r.p for r in got] == pytest.approx([digamma(m) for m in range(1, 60)], abs=1e-12)
