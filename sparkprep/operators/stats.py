"""Column statistics: each function is one fused aggregate over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, is_numeric, tier
from sparkprep.operators import levels as lv
from sparkprep.operators.quantiles import exact_quantiles, long_values


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


#: Up to this many aggregates stay in one row; generated code for wider rows is
#: too long to be compiled, and one row per cell is faster.
WIDE_AGGREGATES = 60


def _as_row(df: DataFrame, cols: list[str], measures: dict[str, tuple]) -> DataFrame:
    aggs, args = [], []
    for i, c in enumerate(cols):
        args.append(F.lit(c))
        for j, (fn, dtype) in enumerate(measures.values()):
            aggs.append(fn(col(c)).cast(dtype).alias(f"m{i}_{j}"))
            args.append(F.col(f"m{i}_{j}"))
    return df.agg(*aggs).select(F.stack(F.lit(len(cols)), *args).alias("variable", *measures))


def _as_cells(df: DataFrame, cols: list[str], measures: dict[str, tuple]) -> DataFrame:
    cells = df.select(*[col(c).cast("double").alias(c) for c in cols]).unpivot([], [col(c) for c in cols], "variable", "x")
    out = cells.groupBy("variable").agg(*[fn(F.col("x")).cast(t).alias(m) for m, (fn, t) in measures.items()])
    # every column gets a row, also when the table is empty; both sides have one row per column
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    # what the measures give on no rows: counts are 0 there
    none = df.sparkSession.createDataFrame([], "x double").agg(*[fn(F.col("x")).cast(t).alias(m) for m, (fn, t) in measures.items()]).first()
    value = {m: F.col(m) if none[m] is None else F.coalesce(m, F.lit(none[m])).alias(m) for m in measures}
    return names.join(F.broadcast(out), "variable", "left").select("variable", *value.values())


def aggregate_long(df: DataFrame, cols: list[str], measures: dict[str, tuple]) -> DataFrame:
    """Aggregates of many columns in one pass, one row per column.

    ``measures`` maps an output name to ``(function of a column, type name)``.
    Many aggregates over numeric columns are computed on one row per cell, as
    doubles, combined before the shuffle.
    """
    if not cols:
        raise ValueError("no columns given")
    types = {f.name: f.dataType for f in df.schema}
    wide = len(cols) * len(measures) <= WIDE_AGGREGATES or not all(is_numeric(types[c]) for c in cols)
    return (_as_row if wide else _as_cells)(df, cols, measures)


def _nulls(c: Column) -> Column:
    return F.count(F.lit(1)) - F.count(c)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(variable, missing_count, n_rows)``."""
    # one cheap aggregate per column, whatever its type
    return _as_row(
        df,
        cols or df.columns,
        {"missing_count": (_nulls, "bigint"), "n_rows": (lambda c: F.count(F.lit(1)), "bigint")},
    )


def null_rates(df: DataFrame, cols: list[str] | None = None) -> dict[str, float]:
    """Null share per column as a driver-side dict (one row per column)."""
    rows = null_counts(df, cols).collect()
    return {r.variable: (r.missing_count / r.n_rows if r.n_rows else 0.0) for r in rows}


def missing_table(df: DataFrame, cols: list[str] | None = None, top: int | None = None) -> DataFrame:
    """Missing count and percentage per column, most missing first."""
    out = null_counts(df, cols).select(
        "variable",
        "missing_count",
        F.coalesce(F.try_divide(F.col("missing_count") * F.lit(100.0), F.col("n_rows")), F.lit(0.0)).alias(
            "missing_pct"
        ),
    )
    out = out.orderBy(F.col("missing_pct").desc(), "variable")
    return out.limit(top) if top else out


def missing_total(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null cells, all cells and their ratio in percent."""
    return (
        null_counts(df, cols)
        .agg(F.sum("missing_count").alias("missing_cells"), F.sum("n_rows").alias("total_cells"))
        .select(
            "missing_cells",
            "total_cells",
            F.coalesce(
                F.try_divide(F.col("missing_cells") * F.lit(100.0), F.col("total_cells")), F.lit(0.0)
            ).alias("missing_pct"),
        )
    )


def value_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count of every value of every column, nulls included, largest first."""
    return (
        lv.level_counts(df, cols or df.columns)
        .select("variable", lv.level_text().alias("value"), "n")
        .orderBy("variable", F.col("n").desc(), F.col("value").asc_nulls_last())
    )


def group_counts(df: DataFrame, column: str, ordered: bool = False) -> DataFrame:
    """Row count per value of one column; null is a group.  ``ordered`` sorts by value."""
    out = df.groupBy(col(column)).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(col(column).asc_nulls_last()) if ordered else out


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties by value, nulls last."""
    return group_counts(df, column).orderBy(F.col("n").desc(), col(column).asc_nulls_last()).limit(k)


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(col(a), col(b)).distinct()


def n_unique(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct values per column with null counted as one value."""
    return lv.level_summary(lv.level_counts(df, cols or df.columns)).select("variable", "n_unique")


def special_codes(df: DataFrame, cols: list[str], high=(97, 99)) -> DataFrame:
    """How many values are negative, and how many lie in the range of reserved codes."""
    types = {f.name: f.dataType for f in df.schema}
    cols = [c for c in cols if is_numeric(types[c])]
    return aggregate_long(
        df,
        cols,
        {
            "n_negative": (lambda c: F.count_if(c < 0), "bigint"),
            "n_high_codes": (lambda c: F.count_if(c.between(*high)), "bigint"),
        },
    )


def attach_values(long: DataFrame, values: dict[str, dict[str, float | None]]) -> DataFrame:
    """Join driver-side statistics (one per column) onto a table with ``variable``."""
    names = sorted({k for row in values.values() for k in row})
    schema = "variable string, " + ", ".join(f"{n} double" for n in names)
    rows = [(v, *[None if r.get(n) is None else float(r[n]) for n in names]) for v, r in values.items()]
    extra = long.sparkSession.createDataFrame(rows, schema)
    return long.join(F.broadcast(extra), "variable", "left")


def _with_quantiles(df: DataFrame, cols: list[str], measures: dict, probs: dict[str, float], interpolation: str) -> DataFrame:
    """Aggregates (with ``count``, ``min`` and ``max``) plus named exact quantiles per column."""
    base = aggregate_long(df, cols, measures)
    rows = base.collect()  # one row per column
    heads = {r.variable: (r["count"], r["min"], r["max"]) for r in rows}
    found = exact_quantiles(df, cols, list(probs.values()), interpolation, heads=heads)
    named = {c: dict(zip(probs, v or [None] * len(probs))) for c, v in found.items()}
    return attach_values(df.sparkSession.createDataFrame(rows, base.schema), named)


_SPREAD = {"count": (F.count, "bigint"), "min": (F.min, "double"), "max": (F.max, "double"), "mean": (F.avg, "double")}


def value_scope(df: DataFrame, cols: list[str] | None = None, suspicious_above: float = 7200) -> DataFrame:
    """Min, max, mean and exact median per numeric column, with a flag for huge maxima."""
    cols = [c for c in (cols or df.columns) if c in set(numeric_columns(df))]
    out = _with_quantiles(df, cols, _SPREAD, {"median": 0.5}, "linear")
    # the whole part is compared, as an integer
    big = F.col("max").cast("bigint") > F.lit(suspicious_above)
    return out.select("variable", "min", "max", "median", "mean", F.coalesce(big, F.lit(False)).alias("suspicious"))


def describe(df: DataFrame, cols: list[str] | None = None, interpolation: str = "nearest") -> DataFrame:
    """Count, nulls, mean, sample deviation, min, quartiles and max per numeric column."""
    cols = cols or numeric_columns(df)
    measures = {**_SPREAD, "null_count": (_nulls, "bigint"), "std": (F.stddev_samp, "double")}
    out = _with_quantiles(df, cols, measures, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, interpolation)
    return out.select("variable", "count", "null_count", "mean", "std", "min", "max", "p25", "p50", "p75")


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max; nulls dropped, max in the last bin.

    A constant column is spread half a unit to each side, as plotting tools do.
    """
    ends = aggregate_long(df, cols, {"low": (F.min, "double"), "high": (F.max, "double")}).collect()
    spans = []
    for r in ends:  # one row per column
        if r.low is not None:
            half = 0.5 if r.low == r.high else 0.0
            low, high = r.low - half, r.high + half
            spans.append((r.variable, low, (high - low) / bins))
    table = df.sparkSession.createDataFrame(spans, "variable string, low double, width double")
    cells = long_values(df, {c: col(c) for c in cols}).withColumnRenamed("g", "variable")
    # bin b holds values from low + b * width up to the next edge
    place = F.least(F.floor((F.col("x") - F.col("low")) / F.col("width")), F.lit(bins - 1)).cast("int")
    joined = cells.join(F.broadcast(table), "variable")  # one row per column on the right
    return joined.groupBy("variable", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def compare_histograms(before: DataFrame, after: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """Histograms of the same columns in two tables, each over its own range."""
    tag = lambda df, name: histogram(df, cols, bins).select(F.lit(name).alias("stage"), "*")
    return tag(before, "before").unionByName(tag(after, "after"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """How many columns have each type, and how many values (no nulls) they hold."""
    names = df.sparkSession.createDataFrame(df.dtypes, "variable string, dtype string")
    return (
        # both sides have one row per column
        null_counts(df).join(F.broadcast(names), "variable")
        .groupBy("dtype")
        .agg(F.count(F.lit(1)).alias("n_columns"), F.sum(F.col("n_rows") - F.col("missing_count")).alias("n_values"))
    )


def columns_with_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return null_counts(df, cols).where(F.col("missing_count") > 0).select("variable", "missing_count")


def missing_matrix(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """0/1 indicators, 1 where the cell is null."""
    return df.select(*(keep or []), *[col(c).isNull().cast("int").alias(c) for c in cols])


def imputation_tiers(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing percentage per column and the imputation effort it calls for."""
    table = missing_table(df, cols)
    return table.select("variable", "missing_pct", tier(F.col("missing_pct")).alias("strategy"))


def missing_above(df: DataFrame, roles, threshold_pct: float = 80.0) -> DataFrame:
    """Columns above a missing percentage, with their role (``roles`` has ``variable, role``)."""
    table = missing_table(df).where(F.col("missing_pct") > threshold_pct)
    # the right side holds one row per column of the table
    return table.join(F.broadcast(roles), "variable", "left").select("variable", "missing_pct", "role")
