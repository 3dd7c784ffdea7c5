"""Exact order statistics without sorting a column into one task.

``percentile`` in Spark keeps every distinct value of a column in one
aggregation buffer, so it does not hold for near-unique columns of a very large
table.  Here the wanted ranks are bracketed step by step:

1. one aggregate gives row count, minimum and maximum of each group;
2. one aggregate counts equal-width bins, which settles columns with few values
   and leaves a small part of the others;
3. a part that is still large is cut at the quantiles of a bounded sketch
   (``percentile_approx``), which shrinks it whatever the distribution;
4. the few values left are counted one by one.

The answer is exact, the driver only sees bins, brackets and one row per wanted
rank, and every pass is an aggregate with map-side combine.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col

#: Equal-width bins per group.
BINS = 512
#: Steps of the sketch grid and its accuracy; the rank error (1/accuracy) is a
#: tenth of a grid step, so one spare step on each side is a safe bracket.
GRID_STEPS = 1000
ACCURACY = 10 * GRID_STEPS
#: A bracket is read out once it is expected to hold at most this many rows.
READ_OUT_ROWS = 20_000

_GRID = [i / GRID_STEPS for i in range(GRID_STEPS + 1)]


def _sketch(x: Column) -> Column:
    return F.percentile_approx(x, _GRID, ACCURACY)


@dataclass
class Ranked:
    """The value at one 0-based rank, the rows below it and the rows equal to it."""

    value: float
    below: int
    equal: int


def long_values(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """One row ``(g, x)`` per cell with a number; ``exprs`` maps a group name to a double.

    Null and NaN are left out.
    """
    args = [a for name, e in exprs.items() for a in (F.lit(name), e.cast("double"))]
    return df.select(F.stack(F.lit(len(exprs)), *args).alias("g", "x")).where(
        F.col("x").isNotNull() & ~F.isnan("x")
    )


def _bracket(grid: list[float], rank: int, n: int) -> tuple[float, float, float]:
    """Bracket of a rank among ``n`` sketched rows and the rows expected inside."""
    at = rank / max(n - 1, 1) * GRID_STEPS
    lo = max(0, math.floor(at) - 1)
    hi = min(GRID_STEPS, math.ceil(at) + 1)
    low = -math.inf if lo == 0 else grid[lo]
    high = math.inf if hi == GRID_STEPS else grid[hi]
    return low, high, (hi - lo + 1) / GRID_STEPS * n


def _place(x: Column, lo: Column, hi: Column) -> Column:
    return F.least(F.floor((x - lo) / (hi - lo) * F.lit(BINS)), F.lit(BINS - 1))


def _binned(values: DataFrame, place: Column) -> dict[str, list]:
    """Ascending ``(min, max, rows)`` of the non-empty bins of each group."""
    found = (
        values.groupBy("g", place.alias("b"))
        .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("c"))
        .collect()
    )
    out: dict[str, list] = {}
    for row in sorted(found, key=lambda r: (r.g, r.b)):
        out.setdefault(row.g, []).append((row.low, row.high, row.c))
    return out


def select_ranks(
    values: DataFrame,
    ranks: Callable[[str, int], Iterable[int]],
    span: tuple[float, float] | None = None,
    heads: dict[str, tuple[int, float, float]] | None = None,
) -> dict[str, tuple[int, dict[int, Ranked]]]:
    """Values at chosen ranks of each group of ``values(g, x)``.

    ``ranks(group, n)`` names the 0-based ranks wanted once the group's row count
    is known.  The number of groups must be small (columns or bins), the number
    of rows and distinct values need not be.  The first pass is saved by ``span``,
    bounds of all values, or by ``heads``, the ``(rows, min, max)`` of each group.
    Returns ``{group: (n, {rank: Ranked})}``.
    """
    spark = values.sparkSession
    x, lo, hi = F.col("x"), F.col("lo"), F.col("hi")
    out: dict[str, tuple[int, dict[int, Ranked]]] = {}
    # ranks still open, by the bracket (group, low, high) they fall in
    wide: dict[tuple[str, float, float], set[int]] = {}
    narrow: dict[tuple[str, float, float], set[int]] = {}
    # rows below a bracket, where an earlier pass has counted them
    known: dict[tuple[str, float, float], int] = {}

    if span is not None:
        bins_of = _binned(values, _place(x, F.lit(span[0]), F.lit(span[1])))
        wanted = {}
        for g, bins in bins_of.items():
            n = sum(c for _, _, c in bins)
            out[g], wanted[g] = (n, {}), set(ranks(g, n))
    else:
        if heads is None:
            ends = values.groupBy("g").agg(F.count("x").alias("n"), F.min("x").alias("a"), F.max("x").alias("b"))
            heads = {r.g: (r.n, r.a, r.b) for r in ends.collect()}
        wanted, spans = {}, []
        for g, (n, low, high) in heads.items():
            if not n:
                continue
            out[g] = (n, {})
            open_ranks = set(ranks(g, n))
            if low == high:
                out[g][1].update({r: Ranked(low, 0, n) for r in open_ranks})
            elif open_ranks and math.isinf(high - low):
                wide[(g, -math.inf, math.inf)] = open_ranks
            elif open_ranks:
                wanted[g] = open_ranks
                spans.append((g, low, high))
        bins_of = {}
        if spans:
            table = spark.createDataFrame(spans, "g string, lo double, hi double")
            # one row per group: bounded by the number of columns or bins
            bins_of = _binned(values.join(F.broadcast(table), "g"), _place(x, lo, hi))

    for g, bins in bins_of.items():
        below = 0
        for low, high, c in bins:
            here = {r for r in wanted[g] if below <= r < below + c}
            if here and low == high:
                out[g][1].update({r: Ranked(low, below, c) for r in here})
            elif here:
                (narrow if c <= READ_OUT_ROWS else wide)[(g, low, high)] = here
                known[(g, low, high)] = below
            below += c

    def joined(brackets):
        rows = [(*b, b not in known) for b in brackets]
        table = spark.createDataFrame(rows, "g string, lo double, hi double, uncounted boolean")
        # a few brackets per group: bounded by the number of columns or bins
        return values.join(F.broadcast(table), "g")

    while wide:
        inside = (x > lo) & (x < hi)
        rows = (
            joined(wide)
            .groupBy("g", "lo", "hi")
            .agg(
                F.count_if(x < lo).alias("below"),
                F.count_if(x == lo).alias("at_lo"),
                F.count_if(inside).alias("inner"),
                F.count_if(x == hi).alias("at_hi"),
                _sketch(F.when(inside, x)).alias("q"),
            )
            .collect()
        )
        still: dict[tuple[str, float, float], set[int]] = {}
        for row in rows:
            upto_lo = row.below + row.at_lo
            for r in wide[(row.g, row.lo, row.hi)]:
                if r < upto_lo:
                    out[row.g][1][r] = Ranked(row.lo, row.below, row.at_lo)
                elif r >= upto_lo + row.inner:
                    out[row.g][1][r] = Ranked(row.hi, upto_lo + row.inner, row.at_hi)
                else:
                    a, b, size = _bracket(row.q, r - upto_lo, row.inner)
                    a, b = max(a, row.lo), min(b, row.hi)
                    target = narrow if size <= READ_OUT_ROWS or a == b else still
                    target.setdefault((row.g, a, b), set()).add(r)
        wide = still

    if narrow:
        for row in _read_out(joined(narrow), narrow, known).collect():  # one row per wanted rank
            out[row.g][1][row.r] = Ranked(row.v, row.below, row.c)
    return out


def _read_out(rows: DataFrame, brackets: dict, known: dict) -> DataFrame:
    """``(g, r, v, below, c)``: the value at each rank ``r`` that falls in a small bracket.

    Distinct values are counted and added up per bracket in the executors; a
    bracket is small, so is its window.  Rows under a bracket that no earlier
    pass has counted fold into one null level, which sorts first.
    """
    x, lo, hi = F.col("x"), F.col("lo"), F.col("hi")
    levels = (
        rows.where((x <= hi) & ((x >= lo) | F.col("uncounted")))
        .groupBy("g", "lo", "hi", F.when(x >= lo, x).alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    w = Window.partitionBy("g", "lo", "hi").orderBy(F.col("v").asc_nulls_first())
    counted = levels.withColumn("inside", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("c"))
    wanted = rows.sparkSession.createDataFrame(
        [(*b, known.get(b, 0), r) for b, ranks in brackets.items() for r in ranks],
        "g string, lo double, hi double, base bigint, r bigint",
    )
    below = F.col("base") + F.col("inside")
    # as many rows as ranks were asked for: columns (or bins) times probabilities
    return (
        counted.where(F.col("v").isNotNull())
        .join(F.broadcast(wanted), ["g", "lo", "hi"])
        .where((F.col("r") >= below) & (F.col("r") < below + F.col("c")))
        .select("g", "r", "v", below.alias("below"), "c")
    )


def _ranks_for(q: float, n: int, interpolation: str) -> tuple[int, int, float]:
    pos = q * (n - 1)
    if interpolation == "nearest":
        r = min(n - 1, math.floor(pos + 0.5))
        return r, r, 0.0
    r = math.floor(pos)
    return r, min(n - 1, r + 1), pos - r


def grouped_quantiles(
    values: DataFrame, probs: list[float], interpolation: str = "linear", heads: dict | None = None
) -> dict[str, list[float]]:
    """Exact quantiles of each group of ``values(g, x)``; groups without rows are absent."""
    if interpolation not in ("linear", "nearest"):
        raise ValueError(f"unknown interpolation {interpolation!r}")
    picked = select_ranks(
        values, lambda _, n: [r for q in probs for r in _ranks_for(q, n, interpolation)[:2]], heads=heads
    )
    out = {}
    for g, (n, by_rank) in picked.items():
        row = []
        for q in probs:
            a, b, frac = _ranks_for(q, n, interpolation)
            va = by_rank[a].value
            row.append(va if frac == 0 else va + (by_rank[b].value - va) * frac)
        out[g] = row
    return out


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    interpolation: str = "linear",
    exclude: float | None = None,
    heads: dict[str, tuple[int, float, float]] | None = None,
) -> dict[str, list[float] | None]:
    """Exact quantiles of numeric columns, nulls, NaN (and ``exclude``) ignored.

    ``linear`` interpolates between neighbours, ``nearest`` takes the element at
    ``round(q * (n - 1))``.  A column without values maps to ``None``.  ``heads``
    are the ``(rows, min, max)`` of the columns if known; not used where they
    count a NaN or an excluded value.
    """
    if not cols:
        return {}
    exprs = {}
    for c in cols:
        x = col(c).cast("double")
        exprs[c] = x if exclude is None else F.when(x != F.lit(exclude), x)
    if heads is not None and (exclude is not None or any(h != h for _, _, h in heads.values())):
        heads = None  # NaN sorts last, so it would be the maximum
    found = grouped_quantiles(long_values(df, exprs), probs, interpolation, heads)
    return {c: found.get(c) for c in cols}


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return {c: v[0] if v else None for c, v in exact_quantiles(df, cols, [0.5]).items()}
