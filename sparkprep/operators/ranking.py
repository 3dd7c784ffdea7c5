"""Running totals over distinct levels, spread over range partitions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.operators.levels import level_order
from sparkprep.session import materialise

#: Levels one window task may sort; larger tables are cut into ranges.
ROWS_PER_RANGE = 200_000


def running_totals(levels: DataFrame, rows: int | None = None) -> DataFrame:
    """Append ``position`` (levels before) and ``before`` (rows before) per variable.

    ``levels`` has one row per (variable, level) and must be cheap to read again.
    Because levels are distinct no range can be hot.  A large table is range
    partitioned on (variable, level); each range is ranked on its own and
    shifted by the totals of the ranges before it.
    """
    rows = levels.count() if rows is None else rows
    ranges = max(1, math.ceil(rows / ROWS_PER_RANGE))
    by = ["variable"]
    if ranges > 1:
        spread = levels.repartitionByRange(ranges, "variable", *level_order())
        # the range number must not change between the two reads below
        levels = materialise(spread.withColumn("_range", F.spark_partition_id()), "ranges")
        by = ["variable", "_range"]
    w = Window.partitionBy(*by).orderBy(*level_order()).rowsBetween(Window.unboundedPreceding, -1)
    out = levels.select(
        "*",
        F.count(F.lit(1)).over(w).alias("position"),
        F.coalesce(F.sum("n").over(w), F.lit(0)).cast("bigint").alias("before"),
    )
    if ranges == 1:
        return out
    # one row per range and variable: bounded by the number of ranges
    totals = levels.groupBy(*by).agg(F.count(F.lit(1)).alias("_levels"), F.sum("n").alias("_rows"))
    w = Window.partitionBy("variable").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(
        *by,
        F.coalesce(F.sum("_levels").over(w), F.lit(0)).alias("_p"),
        F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_b"),
    )
    return (
        out.join(F.broadcast(shift), by)
        .withColumns({"position": F.col("position") + F.col("_p"), "before": F.col("before") + F.col("_b")})
        .drop("_range", "_p", "_b")
    )
