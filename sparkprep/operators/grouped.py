"""Exact quantiles of any number of groups, found in the executors.

Equal values of a group are one level with a count, combined before the shuffle.
Levels are cut into ranges of (group, value), so neither a group with a third of
the rows nor a million small groups meet in one task; the driver sees one number,
the count of the levels.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.session import materialise

#: Levels that one window task sorts.
LEVELS_PER_RANGE = 200_000


def group_quantiles(
    df: DataFrame, by: list[str], column: str, probs: dict[str, float], interpolation: str = "linear"
) -> DataFrame:
    """``(by..., n, <probs...>)``: quantiles of ``column`` for each value of ``by``, ``probs`` maps a name to a probability.

    ``linear`` interpolates between neighbours, ``nearest`` takes the element at ``round(p * (n - 1))``.  Null is
    a group like any other; null and NaN values are left out, and groups without values are absent.
    """
    if interpolation not in ("linear", "nearest"):
        raise ValueError(f"unknown interpolation {interpolation!r}")
    names = [*by, "n", *probs]
    if len({c.lower() for c in names}) < len(names):
        raise ValueError(f"result columns are not distinct: {names}")
    if bad := [p for p in probs.values() if not 0 <= p <= 1]:
        raise ValueError(f"no probabilities: {bad}")

    keys = [f"k{i}" for i in range(len(by))]
    value = col(column).cast("double")
    cells = df.select(*[col(c).alias(k) for c, k in zip(by, keys, strict=True)], (value + F.lit(0.0)).alias("x"))
    levels = cells.where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("c"))
    levels = materialise(levels, "group_levels")
    ranges = max(1, math.ceil(levels.count() / LEVELS_PER_RANGE))
    if ranges > 1:
        spread = levels.repartitionByRange(ranges, *keys, "x").withColumn("part", F.spark_partition_id())
        # the range number must not change between the two reads below
        levels = materialise(spread, "group_ranges")
    else:
        levels = levels.withColumn("part", F.lit(0))

    within = Window.partitionBy(*keys, "part").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    counted = levels.withColumn("inside", F.coalesce(F.sum("c").over(within), F.lit(0)))
    # one row for each range of a group; only groups cut by a border of ranges have several
    parts = levels.groupBy(*keys, "part").agg(F.sum("c").alias("rows"))
    whole = Window.partitionBy(*keys)
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*keys, "part", F.coalesce(before, F.lit(0)).alias("base"), F.sum("rows").over(whole).alias("n"))
    # null is a group, so keys are compared null-safe
    same = F.col("l.part") == F.col("r.part")
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    placed = counted.alias("l").join(parts.alias("r"), same).select(
        *[F.col(f"l.{k}").alias(k) for k in keys], "x", "c", "n", (F.col("base") + F.col("inside")).alias("low")
    )

    def at(rank):
        return F.max(F.when((F.col("low") <= rank) & (rank < F.col("low") + F.col("c")), F.col("x")))

    found, out = [], []
    for i, (name, p) in enumerate(probs.items()):
        position = F.lit(float(p)) * (F.col("n") - 1)
        if interpolation == "nearest":
            found.append(at(F.least(F.col("n") - 1, F.floor(position + 0.5))).alias(f"a{i}"))
            out.append(F.col(f"a{i}").alias(name))
            continue
        lower = F.floor(position)
        found += [at(lower).alias(f"a{i}"), at(F.least(F.col("n") - 1, lower + 1)).alias(f"b{i}")]
        share = position - lower
        out.append(F.when(share == 0, F.col(f"a{i}")).otherwise(F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * share).alias(name))
    picked = placed.groupBy(*keys).agg(F.max("n").alias("n"), *found)
    return picked.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], "n", *out)
