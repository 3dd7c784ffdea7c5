"""Mutual information by nearest neighbours, exact and without an order of rows.

For each row the distance to its k-th nearest row in the plane of feature and target (the larger of both differences) is
found; the rows that are strictly nearer in the feature alone and in the target alone are counted.  The estimate is
``psi(n) + psi(k) - mean(psi(n_x) + psi(n_y))``, not below 0.

Both columns are divided by their deviation and put on a grid of ``2 ** -GRID`` deviations, so distances are whole numbers
and no comparison depends on rounding.  Equal points are one point with a count.  Points are cut into blocks by range; a
block finds the neighbours of its own points, and only points whose distance reaches into the boxes of other blocks visit
those.  Range counts are differences of running totals over the distinct values.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.operators.ranking import running_totals
from sparkprep.session import materialise

#: Steps of the grid inside a deviation, as a power of two.
GRID = 30
#: Points of a block, and visitors of a block that one task compares.
BLOCK, VISITORS = 4096, 20_000
#: Points whose distances to a block are held at once.
CHUNK = 256
#: Beyond every distance.
FAR = 2**61
_EULER = 0.5772156649015329


def psi(m: Column) -> Column:
    """The digamma function of a whole number from 1."""
    small = F.array(*[F.lit(sum(1.0 / i for i in range(1, k)) - _EULER) for k in range(1, 10)])
    x = m.cast("double")
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6) + 1 / (240 * x**8)
    return F.when(m < 10, F.element_at(small, F.least(m, F.lit(9)).cast("int"))).otherwise(series)


def _nearest(px, py, qx, qy, qn, own, k: int) -> np.ndarray:
    """The ``k`` least distances from each point ``p`` to the points ``q``, which count ``qn`` times; ``own`` leaves out ``p`` itself once."""
    out = np.full((len(px), k), FAR, dtype=np.int64)
    take = min(k, len(qx))
    for at in range(0, len(px), CHUNK):
        part = slice(at, at + CHUNK)
        d = np.maximum(np.abs(px[part, None] - qx), np.abs(py[part, None] - qy))
        n = np.broadcast_to(qn, d.shape)
        if own:
            row = np.arange(len(d))
            n = n.copy()
            n[row, row + at] -= 1
            d[row[n[row, row + at] == 0], row[n[row, row + at] == 0] + at] = FAR
        near = np.argpartition(d, take - 1, axis=1)[:, :take]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
        d, upto = np.take_along_axis(d, near, 1), np.cumsum(np.take_along_axis(n, near, 1), axis=1)
        for j in range(k):
            place = (upto <= j).sum(axis=1)
            has = place < take
            out[np.flatnonzero(has) + at, j] = d[has, place[has]]
    return out


def _own(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, n = (pdf[c].to_numpy(np.int64) for c in ("x", "y", "n"))
        near = _nearest(x, y, x, y, n, True, k)
        # all points with a feature value inside the block's range are its own
        inside = (x - near[:, -1] > x.min()) & (x + near[:, -1] < x.max())
        return pdf[["f", "block", "x", "y", "n"]].assign(near=list(near), inside=inside)

    return run


def _visited(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"f": pd.Series(dtype="int32"), "x": pd.Series(dtype="int64"), "y": pd.Series(dtype="int64"), "near": pd.Series(dtype=object)})
        x, y = left["x"].to_numpy(np.int64), left["y"].to_numpy(np.int64)
        q = [right[c].to_numpy(np.int64) for c in ("x", "y", "n")]
        return left[["f", "x", "y"]].assign(near=list(_nearest(x, y, *q, False, k)))

    return run


def _distances(cells: DataFrame, k: int) -> DataFrame:
    """``cells`` ``(f, x, y, n)`` with ``near``, the ``k`` least distances of each to other rows, in order."""
    parts = max(1, math.ceil(cells.count() / BLOCK))
    dealt = cells.repartitionByRange(parts, "f", "x", "y").select("f", F.spark_partition_id().alias("block"), "x", "y", "n")
    points = materialise(dealt, "points")
    own = points.groupBy("f", "block").applyInPandas(_own(k), "f int, block int, x long, y long, n long, near array<long>, inside boolean")
    own = materialise(own, "own_neighbours")
    box = [F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")]
    boxes = points.groupBy("f", F.col("block").alias("other")).agg(*box)
    reach = F.element_at("near", -1)
    open_points = own.where("NOT inside").withColumn("reach", reach)
    meets = (F.col("x0") <= F.col("x") + F.col("reach")) & (F.col("x1") >= F.col("x") - F.col("reach"))
    meets &= (F.col("y0") <= F.col("y") + F.col("reach")) & (F.col("y1") >= F.col("y") - F.col("reach"))
    visits = materialise(open_points.join(boxes, "f").where(meets & (F.col("other") != F.col("block"))).select("f", "other", "x", "y"), "visits")
    most = visits.groupBy("f", "other").count().agg(F.max("count")).first()[0] or 0
    chunks = max(1, math.ceil(most / VISITORS))
    left = visits.withColumn("chunk", F.pmod(F.xxhash64("x", "y"), F.lit(chunks)))
    asked = left.select("f", F.col("other").alias("block"), "chunk").distinct()
    right = points.join(asked, ["f", "block"]).withColumnsRenamed({"f": "g", "chunk": "of"})
    seen = left.groupBy("f", "other", "chunk").cogroup(right.groupBy("g", "block", "of")).applyInPandas(_visited(k), "f int, x long, y long, near array<long>")
    merged = (
        open_points.select("f", "x", "y", "near")
        .unionByName(seen)
        .groupBy("f", "x", "y")
        .agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
    )
    late = open_points.select("f", "x", "y", "n").join(merged, ["f", "x", "y"])
    return materialise(own.where("inside").select("f", "x", "y", "n", "near").unionByName(late), "distances")


def neighbour_information(df: DataFrame, features: list[str], target: str, k: int = 5) -> DataFrame:
    """``(variable, n, mi)``: mutual information (nats) of each numeric feature with the target, best first.

    Rows where either is null or NaN are left out, for each feature on its own.  With ``k`` rows or fewer all others are
    the neighbours; fewer than two rows or a constant column give 0.
    """

    def value(c: str) -> Column:
        x = col(c).cast("double")
        return F.when(~F.isnan(x), x)

    y = value(target)
    both = [value(c).isNotNull() & y.isNotNull() for c in features]

    def deviation(x: Column) -> Column:
        # that of a constant may come out as rounding noise
        return F.when(F.min(x) != F.max(x), F.stddev_pop(x))

    facts = []
    for i, c in enumerate(features):
        facts += [deviation(F.when(both[i], value(c))).alias(f"x{i}"), deviation(F.when(both[i], y)).alias(f"y{i}"), F.count_if(both[i]).alias(f"n{i}")]
    found = df.agg(*facts).first()

    def on_grid(x: Column, deviation: float | None) -> Column:
        return F.floor(x * F.lit(2.0**GRID / deviation) + 0.5).cast("long") if deviation else F.lit(0).cast("long")

    args = [a for i, c in enumerate(features) for a in (
        F.lit(i), F.when(both[i], on_grid(value(c), found[f"x{i}"])), F.when(both[i], on_grid(y, found[f"y{i}"])))]
    long = df.select(F.stack(F.lit(len(features)), *args).alias("f", "x", "y")).where("x IS NOT NULL AND y IS NOT NULL")
    cells = materialise(long.groupBy("f", "x", "y").agg(F.count("*").alias("n")), "cells")
    kinds = df.sparkSession.createDataFrame(
        [(i, c, found[f"n{i}"], max(1, min(k, found[f"n{i}"] - 1)), bool(found[f"x{i}"] and found[f"y{i}"])) for i, c in enumerate(features)],
        "f int, variable string, rows long, k int, varies boolean",
    )
    near = _distances(cells, k).join(F.broadcast(kinds), "f")
    # strictly nearer, or equal where the k-th neighbour is at the same place
    within = F.greatest(F.get("near", F.col("k") - 1) - 1, F.lit(0).cast("long"))
    sides = near.select("f", "n", within.alias("r"), F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("v")) for s in "xy"])).alias("p"))
    sides = sides.select(F.concat_ws(":", "f", "p.side").alias("variable"), "f", "n", (F.col("p.v") - F.col("r")).alias("low"), (F.col("p.v") + F.col("r")).alias("high"), F.col("p.v").alias("v"))
    sides = materialise(sides.where(F.col("high") < FAR // 2), "sides")
    none = F.lit(0).cast("long")
    events = sides.select("variable", "v", "n").unionByName(sides.select("variable", F.col("low").alias("v"), none.alias("n")))
    events = events.unionByName(sides.select("variable", F.col("high").alias("v"), none.alias("n"))).groupBy("variable", F.col("v").alias("v_int")).agg(F.sum("n").alias("n"))
    events = materialise(events.select("variable", "v_int", F.lit(None).cast("double").alias("v_dbl"), F.lit(None).cast("string").alias("v_str"), "n"), "values")
    totals = materialise(running_totals(events).select("variable", "v_int", "n", "before"), "totals")
    below = totals.select("variable", F.col("v_int").alias("low"), F.col("before").alias("below"))
    upto = totals.select("variable", F.col("v_int").alias("high"), (F.col("before") + F.col("n")).alias("upto"))
    counted = sides.join(below, ["variable", "low"]).join(upto, ["variable", "high"])
    sums = counted.groupBy("f").agg(F.sum(F.col("n") * psi(F.col("upto") - F.col("below"))).alias("s"))
    estimate = psi(F.col("rows")) + psi(F.col("k")) - F.col("s") / F.col("rows")
    mi = F.when(F.col("varies") & (F.col("rows") > 1), F.greatest(estimate, F.lit(0.0))).otherwise(0.0)
    return kinds.join(sums, "f", "left").select("variable", F.col("rows").alias("n"), mi.alias("mi")).orderBy(F.desc("mi"), "variable")
