"""Level-frequency tables: one pre-aggregated pass shared by many operators.

``level_counts`` turns a wide table into ``(variable, level, n)``.  Rows are
combined on the map side before the shuffle, so a level that holds a third of
the table arrives as one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions.scalar import col, is_integral

#: Columns per pass; more columns are read in further passes to bound the rows
#: that one input row turns into.
CHUNK = 64

#: Level columns: one is set for a level, none for the null level.  A decimal
#: sets its double (which orders it) and its exact text (which tells it apart).
LEVEL_PARTS = ("v_int", "v_dbl", "v_str")


def _parts(name: str, dtype: T.DataType) -> list[Column]:
    c = col(name)
    none = {p: F.lit(None).cast(t) for p, t in zip(LEVEL_PARTS, ("bigint", "double", "string"))}
    if is_integral(dtype):
        none["v_int"] = c.cast("bigint")
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        none["v_dbl"] = c.cast("double")
    elif isinstance(dtype, T.DecimalType):
        none["v_dbl"], none["v_str"] = c.cast("double"), c.cast("string")
    else:
        none["v_str"] = c.cast("string")
    return [none[p] for p in LEVEL_PARTS]


def level_counts(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """``(keep..., variable, v_int, v_dbl, v_str, n)`` with the null group included."""
    keep = keep or []
    types = {f.name: f.dataType for f in df.schema}
    out = None
    for start in range(0, len(cols), CHUNK):
        chunk = cols[start : start + CHUNK]
        args = [a for c in chunk for a in (F.lit(c), *_parts(c, types[c]))]
        long = df.select(*keep, F.stack(F.lit(len(chunk)), *args).alias("variable", *LEVEL_PARTS))
        out = long if out is None else out.unionAll(long)
    if out is None:
        raise ValueError("no columns given")
    return out.groupBy(*keep, "variable", *LEVEL_PARTS).agg(F.count(F.lit(1)).alias("n"))


def level_is_null() -> Column:
    return F.col("v_int").isNull() & F.col("v_dbl").isNull() & F.col("v_str").isNull()


def level_text() -> Column:
    """Readable form of a level; null for the null level."""
    return F.coalesce(F.col("v_str"), F.col("v_int").cast("string"), F.col("v_dbl").cast("string"))


def level_order() -> list[Column]:
    """Native order of levels (numbers by value, text by code point), nulls last."""
    return [F.col(p).asc_nulls_last() for p in LEVEL_PARTS]


def top_levels(levels: DataFrame, k: int, nulls: bool = True) -> DataFrame:
    """The ``k`` most frequent levels of each variable with their ``rank``.

    The ``row_number() <= k`` filter is pushed below the shuffle by Spark, so a
    variable with very many levels sends at most ``k`` rows per partition.
    """
    if not nulls:
        levels = levels.where(~level_is_null())
    w = Window.partitionBy("variable").orderBy(F.col("n").desc(), *level_order())
    return levels.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


def first_levels(levels: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest non-null levels of each variable with their ``rank``."""
    w = Window.partitionBy("variable").orderBy(*level_order())
    return (
        levels.where(~level_is_null())
        .select("*", F.row_number().over(w).alias("rank"))
        .where(F.col("rank") <= k)
    )


def modes(levels: DataFrame, null_candidate: bool = False) -> DataFrame:
    """Most frequent level per variable; ties go to the smallest level.

    ``null_candidate`` lets null compete (and win only with a strictly higher
    count), in which case the returned level is null.
    """
    best = F.min(
        F.when(
            F.lit(null_candidate) | ~level_is_null(),
            F.struct(
                (-F.col("n")).alias("neg"),
                level_is_null().alias("is_null"),
                *[F.col(p) for p in LEVEL_PARTS],
            ),
        )
    )
    return (
        levels.groupBy("variable")
        .agg(best.alias("b"))
        .select("variable", *[F.col(f"b.{p}").alias(p) for p in LEVEL_PARTS], (-F.col("b.neg")).alias("n"))
    )


def level_summary(levels: DataFrame) -> DataFrame:
    """Per variable: distinct counts, missing count, rows, largest and smallest group."""
    null = level_is_null()
    return levels.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_unique"),
        F.count_if(~null).alias("n_levels"),
        F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0).cast("bigint")).alias("missing_count"),
        F.sum("n").alias("n_rows"),
        F.max("n").alias("max_count"),
        F.min("n").alias("min_count"),
    )


def mode_values(levels: DataFrame, null_candidate: bool = False) -> dict[str, object]:
    """Modes as Python values, one per variable (as many rows as columns)."""
    out = {}
    for r in modes(levels, null_candidate).collect():
        out[r.variable] = next((r[p] for p in LEVEL_PARTS if r[p] is not None), None)
    return out
