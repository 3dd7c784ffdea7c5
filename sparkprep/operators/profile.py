"""Profiles of ordinal and categorical columns, one row per column.

All columns are profiled together from one level-frequency table; the only
collected lists are the top and first levels, whose length is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import cardinality_tier, is_numeric, scale_type
from sparkprep.operators import levels as lv
from sparkprep.operators.stats import n_unique
from sparkprep.session import cut_lineage


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def _joined(ranked: DataFrame, item: Column, name: str) -> DataFrame:
    """Ranked levels of a variable as one text, in rank order (at most k of them)."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", item.alias("item")))), lambda s: s["item"])
    return ranked.groupBy("variable").agg(F.array_join(listed, ", ").alias(name))


def _dtypes(df: DataFrame, cols: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.sparkSession.createDataFrame([(c, types[c]) for c in cols], "variable string, dtype string")


def _counted() -> Column:
    return F.concat_ws(": ", F.coalesce(lv.level_text(), F.lit("None")), F.col("n").cast("string"))


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def profile_ordinal(df: DataFrame, cols: list[str], first: int = 20, top: int = 10) -> DataFrame:
    """Cardinality, missingness, first levels, most frequent levels and special codes.

    Names that are no column of ``df`` are left out.
    """
    cols = _present(df, cols)
    types = {f.name: f.dataType for f in df.schema}
    numeric = [c for c in cols if is_numeric(types[c])]
    # the level table is small next to the data and is read four times
    levels = cut_lineage(lv.level_counts(df, cols))
    value = F.coalesce(F.col("v_int").cast("double"), F.col("v_dbl"))
    codes = levels.groupBy("variable").agg(
        F.coalesce(F.sum(F.when(value < 0, F.col("n"))), F.lit(0).cast("bigint")).alias("n_negative"),
        F.coalesce(F.sum(F.when(value.between(97, 99), F.col("n"))), F.lit(0).cast("bigint")).alias(
            "n_high_codes"
        ),
    )
    summary = lv.level_summary(levels).select(
        "variable",
        "n_unique",
        "missing_count",
        _percent(F.col("missing_count"), F.col("n_rows")).alias("missing_pct"),
    )
    uniques = _joined(lv.first_levels(levels, first), lv.level_text(), "unique_values")
    tops = _joined(lv.top_levels(levels, top), _counted(), "value_counts")
    is_num = F.col("variable").isin(numeric) if numeric else F.lit(False)
    # every side has one row per column of the table
    out = _dtypes(df, cols)
    for part in (summary, uniques, tops, codes):
        out = out.join(part, "variable", "left")
    return out.select(
        "variable",
        "dtype",
        "n_unique",
        "missing_count",
        "missing_pct",
        F.coalesce("unique_values", F.lit("")).alias("unique_values"),
        "value_counts",
        F.when(is_num, F.col("n_negative")).otherwise(0).alias("has_negative_codes"),
        F.when(is_num, F.col("n_high_codes")).otherwise(0).alias("has_high_codes"),
    )


def profile_categorical(df: DataFrame, cols: list[str], top: int = 5, rare_share: float = 0.01) -> DataFrame:
    """Cardinality and its tier, missingness, rare levels, imbalance, most frequent levels.

    A level is rare below ``rare_share`` of the non-null rows; the null group
    counts as a level for rarity and imbalance.
    """
    cols = _present(df, cols)
    levels = cut_lineage(lv.level_counts(df, cols))
    summary = lv.level_summary(levels)
    limits = summary.select(
        "variable", (F.lit(rare_share) * (F.col("n_rows") - F.col("missing_count"))).alias("limit")
    )
    # one row per column on the right
    rare = (
        levels.join(F.broadcast(limits), "variable")
        .groupBy("variable")
        .agg(F.count_if(F.col("n") < F.col("limit")).alias("rare_categories"))
    )
    tops = _joined(lv.top_levels(levels, top), _counted(), "top_categories")
    out = _dtypes(df, cols)
    for part in (summary, rare, tops):
        out = out.join(part, "variable", "left")
    return out.select(
        "variable",
        "dtype",
        F.col("n_unique").alias("cardinality"),
        "missing_count",
        _percent(F.col("missing_count"), F.col("n_rows")).alias("missing_pct"),
        "rare_categories",
        F.coalesce(F.try_divide("max_count", "min_count"), F.lit(0.0)).alias("imbalance_ratio"),
        "top_categories",
        cardinality_tier(F.col("n_unique")).alias("cardinality_type"),
    )


def high_cardinality(df: DataFrame, name_parts: list[str], top: int = 10) -> DataFrame:
    """Most frequent levels of the columns whose name contains one of ``name_parts``."""
    cols = [c for c in df.columns if any(p in c for p in name_parts)]
    ranked = lv.top_levels(lv.level_counts(df, cols), top)
    return ranked.select("variable", "rank", lv.level_text().alias("value"), "n")


def scale_types(df: DataFrame, cols: list[str]) -> DataFrame:
    """Scale family of each column (see :func:`sparkprep.functions.scalar.scale_type`)."""
    levels = lv.level_counts(df, _present(df, cols)).where(~lv.level_is_null())
    value = F.coalesce(F.col("v_int").cast("double"), F.col("v_dbl"))
    return (
        levels.groupBy("variable")
        .agg(
            F.count(F.lit(1)).alias("n_levels"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.bool_and(F.coalesce(value == F.floor(value), F.lit(False))).alias("whole"),
        )
        .select(
            "variable",
            "n_levels",
            scale_type(F.col("n_levels"), F.col("low"), F.col("high"), F.col("whole")).alias("scale_type"),
        )
    )


def profile_summary(profile: DataFrame, cardinality: str = "cardinality") -> DataFrame:
    """One row over a profile table (which has one row per column)."""
    stat = lambda c, name: [
        F.avg(c).alias(f"mean_{name}"),
        F.median(c).alias(f"median_{name}"),
        F.max(F.col(c).cast("double")).alias(f"max_{name}"),
    ]
    return profile.agg(
        F.count(F.lit(1)).alias("n_variables"),
        *stat("missing_pct", "missing_pct"),
        *stat(cardinality, "cardinality"),
        F.count_if(F.col("missing_pct") > 50).alias("n_missing_over_50"),
        *(
            [
                F.count_if(F.col("rare_categories") > 0).alias("n_with_rare"),
                F.avg("rare_categories").alias("mean_rare"),
            ]
            if "rare_categories" in profile.columns
            else []
        ),
    )


def cardinality_tiers(profile: DataFrame) -> DataFrame:
    """How many columns fall in each cardinality tier, and how many exceed 50 levels."""
    return profile.groupBy("cardinality_type").agg(
        F.count(F.lit(1)).alias("n_variables"), F.count_if(F.col("cardinality") > 50).alias("n_over_50")
    )


def constant_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Columns with a single distinct value (null counts as one)."""
    return n_unique(df, cols).where(F.col("n_unique") == 1).select("variable")


def encoded_width(profile: DataFrame, max_levels: int = 10) -> DataFrame:
    """Columns a profile's variables become: one-hot for all, or one-hot up to ``max_levels`` only."""
    n = F.col("cardinality")
    reduced = F.when(n.between(3, max_levels), n).otherwise(F.lit(1).cast("bigint"))
    return profile.agg(
        F.count(F.lit(1)).alias("n_variables"), F.sum(n).alias("one_hot_width"), F.sum(reduced).alias("encoded_width")
    )
