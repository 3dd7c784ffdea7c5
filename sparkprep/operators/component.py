"""First principal component of columns with missing cells, without filling them.

The model is a probabilistic component: each standardised column is its level plus its loading times the row's
score plus noise.  Missing cells drop out of the likelihood.  All that the iteration needs of the rows are counts,
sums and products by missing pattern, so the table is read twice and the iteration runs on at most ``2 ** MOST_COLUMNS``
small matrices.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.operators.stats import aggregate_long

#: Columns of one component; their missing patterns are read by the driver.
MOST_COLUMNS = 12
#: Least noise, so that columns that agree exactly don't divide by zero.
LEAST_NOISE = 1e-9


@dataclass
class Component:
    """Loadings and levels of standardised columns, their noise, and the mean and deviation that standardise them."""

    loading: dict[str, float]
    level: dict[str, float]
    noise: float
    scale: dict[str, tuple[float, float]]

    def score(self, df: DataFrame, name: str) -> DataFrame:
        """Append the expected score of each row given the cells it has; null for a row without any."""
        above, below, some = F.lit(0.0), F.lit(float(self.noise)), F.lit(False)
        for c, w in self.loading.items():
            z = _standard(c, *self.scale[c])
            above += F.coalesce((z - F.lit(self.level[c])) * F.lit(w), F.lit(0.0))
            below += F.when(z.isNotNull(), F.lit(w * w)).otherwise(0.0)
            some = some | z.isNotNull()
        return df.select("*", F.when(some, above / below).alias(name))


def _number(c: str):
    x = col(c).cast("double")
    return F.when(~F.isnan(x), x)  # NaN is missing


def _standard(c: str, mean: float, deviation: float):
    return (_number(c) - F.lit(mean)) / F.lit(deviation)


def _patterns(df: DataFrame, cols: list[str], scale: dict) -> list[tuple]:
    """``(present columns, rows, sums, products)`` by missing pattern of the standardised columns."""
    import numpy as np

    p = len(cols)
    z = df.select(*[_standard(c, *scale[c]).alias(f"z{i}") for i, c in enumerate(cols)])
    mask = F.concat(*[F.when(F.col(f"z{i}").isNull(), "0").otherwise("1") for i in range(p)])
    sums = [F.sum(f"z{i}").alias(f"s{i}") for i in range(p)]
    products = [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"p{i}_{j}") for i in range(p) for j in range(i, p)]
    out = []
    for r in z.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect():
        has = np.array([i for i, bit in enumerate(r.mask) if bit == "1"], dtype=int)
        if len(has):
            cross = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in has] for i in has])
            out.append((has, r.n, np.array([r[f"s{i}"] for i in has]), cross))
    return sorted(out, key=lambda t: t[0].tolist())


def iterate(patterns: list[tuple], p: int, steps: int, tolerance: float):
    """Expectation and maximisation until no parameter moves by more than the tolerance."""
    import numpy as np

    w, level, noise = np.full(p, 0.5), np.zeros(p), 0.5
    # start from the correlations of the pairs, so that loadings of both signs are found
    n, cross = np.zeros((p, p)), np.zeros((p, p))
    for has, rows, _, products in patterns:
        n[np.ix_(has, has)] += rows
        cross[np.ix_(has, has)] += products
    start = np.linalg.eigh(np.divide(cross, n, out=np.eye(p), where=n > 0))
    w = start[1][:, -1] * np.sqrt(max(start[0][-1], LEAST_NOISE))
    for _ in range(steps):
        tt, t, rows_of = np.zeros(p), np.zeros(p), np.zeros(p)
        tx, x, xx = np.zeros(p), np.zeros(p), np.zeros(p)
        for has, rows, sums, products in patterns:
            v, m = w[has], level[has]
            size = noise + v @ v
            centred = products - np.outer(sums, m) - np.outer(m, sums) + rows * np.outer(m, m)
            tt[has] += rows * noise / size + v @ centred @ v / size**2
            t[has] += v @ (sums - rows * m) / size
            tx[has] += v @ (products - np.outer(m, sums)) / size
            x[has] += sums
            xx[has] += np.diag(products)
            rows_of[has] += rows
        spread = tt * rows_of - t * t
        new_w = (tx * rows_of - t * x) / spread
        new_level = (x - new_w * t) / rows_of
        rest = xx - 2 * new_w * tx - 2 * new_level * x + new_w**2 * tt + 2 * new_w * new_level * t + rows_of * new_level**2
        new_noise = max(rest.sum() / rows_of.sum(), LEAST_NOISE)
        moved = max(np.abs(new_w - w).max(), np.abs(new_level - level).max(), abs(new_noise - noise))
        w, level, noise = new_w, new_level, new_noise
        if moved <= tolerance:
            break
    return w, level, noise


def fit_component(df: DataFrame, cols: list[str], steps: int = 2000, tolerance: float = 1e-10) -> Component:
    """Fit to all rows.  The first column with a loading has a positive one.

    Columns without two different values are left out; without any other the scores are null.  Rows without
    a value don't count.  Equal rows count each time.
    """
    if len(cols) > MOST_COLUMNS:
        raise ValueError(f"at most {MOST_COLUMNS} columns make a component, got {len(cols)}")
    numbers = df.select(*[_number(c).alias(c) for c in cols])
    measures = {
        "m": (F.avg, "double"),
        "s": (lambda c: F.when(F.min(c) != F.max(c), F.stddev_pop(c)), "double"),
    }
    found = {r.variable: (r.m, r.s) for r in aggregate_long(numbers, cols, measures).collect()}
    scale = {c: found[c] for c in cols if found[c][1]}
    if not scale:
        return Component({}, {}, 1.0, {})
    names = list(scale)
    w, level, noise = iterate(_patterns(df, names, scale), len(names), steps, tolerance)
    first = next((v for v in w if abs(v) > LEAST_NOISE), 1.0)
    w = -w if first < 0 else w
    of = lambda values: dict(zip(names, map(float, values), strict=True))
    return Component(of(w), of(level), float(noise), scale)
