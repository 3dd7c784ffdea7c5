"""Derived features; all row-local."""

from __future__ import annotations

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, efficiency, fast_guess, leading_digit, row_mean
from sparkprep.operators.base import RowStep, keyword_only, project
from sparkprep.operators.joins import join_levels
from sparkprep.operators.scale import PopulationScaler
from sparkprep.session import cut_lineage

#: The default composite scores and their sources.
COMPOSITES = {
    "Score_Support_Parental": ["PA003", "ST300"],
    "Score_Support_Enseignant": ["ST100", "ST270"],
}

#: Occupation code columns that are grouped by default.
OCCUPATION_COLUMNS = ["OCOD1", "OCOD2"]


class CompositeMean(RowStep):
    """Row mean of related columns; needs two present sources, which are then dropped."""

    definitions: "Param[dict]" = Param(Params._dummy(), "definitions", "name -> sources", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, inputCols=None, definitions=None):
        super().__init__()
        self._configure({"definitions": COMPOSITES}, self._input_kwargs)

    def applicable(self, names: list[str]) -> dict[str, list[str]]:
        """Composites that can be built from these column names, with their sources."""
        have, out = set(names), {}
        for score, sources in self.getOrDefault(self.definitions).items():
            usable = [s for s in sources if s in have]
            if len(usable) >= 2:
                out[score] = usable
                have -= set(usable)
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        made = self.applicable(df.columns)
        used = [s for sources in made.values() for s in sources]
        return project(df, {}, drop=used, append={n: row_mean([col(s) for s in src]) for n, src in made.items()})


class OccupationGrouper(RowStep):
    """Occupation code to its major group in ``<name>_grouped``; the code is dropped."""

    width: "Param[int]" = Param(Params._dummy(), "width", "zero-pad to this width, 0 = off", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, width=None):
        super().__init__()
        self._configure({"width": 0, "inputCols": OCCUPATION_COLUMNS}, self._input_kwargs)

    def mapping(self, names: list[str]) -> dict[str, str]:
        return {c: f"{c}_grouped" for c in self.getInputCols() if c in set(names)}

    def _transform(self, df: DataFrame) -> DataFrame:
        made = self.mapping(df.columns)
        width = self.getOrDefault(self.width) or None
        return project(df, {}, drop=made, append={n: leading_digit(col(c), width) for c, n in made.items()})


class InteractionFeatures(RowStep):
    """For each score column with its timing column: a fast-guess flag and score per second.

    Both sources are dropped.  ``respectFlag`` keeps a flagged score (-1) flagged.
    """

    respectFlag: "Param[bool]" = Param(Params._dummy(), "respectFlag", "keep -1 scores", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, respectFlag=None):
        super().__init__()
        self._configure({"respectFlag": False}, self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        flag = -1.0 if self.getOrDefault(self.respectFlag) else None
        have, new, used = set(df.columns), {}, []
        for score in df.columns:
            name = lambda part: score.replace("average_score", part)
            if "average_score" in score and name("total_timing") in have:
                time = name("total_timing")
                new[name("is_fast_guesser")] = fast_guess(col(time))
                new[name("efficiency")] = efficiency(col(score), col(time), flag)
                used += [score, time]
        return project(df, {}, drop=used, append=new)


def mismatch(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Boolean column: the two columns differ (null equals null)."""
    return df.withColumn(name, ~col(a).eqNullSafe(col(b)))


def offset_from_group_mode(df: DataFrame, value: str, group: str, name: str) -> DataFrame:
    """``value`` minus the most frequent value of its group (smallest on ties).

    Value counts per group are combined before the shuffle; rows without a group
    get null.
    """
    counts = (
        df.where(col(value).isNotNull() & col(group).isNotNull())
        .groupBy(col(group).alias(group), col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    best = counts.groupBy(group).agg(
        F.sum("_n").alias("n"), F.min(F.struct((-F.col("_n")).alias("neg"), F.col("_v").alias("v"))).alias("_b")
    )
    lookup = cut_lineage(best.select(group, "n", F.col("_b.v").alias("_mode")))
    return join_levels(df, lookup, group).select(
        *[col(c) for c in df.columns], (col(value) - F.col("_mode")).alias(name)
    )


def weighted_sum(df: DataFrame, weights: dict[str, float], name: str) -> DataFrame:
    """Weighted mean of the present columns of a row; null when all are null."""
    num = sum((F.coalesce(col(c).cast("double"), F.lit(0.0)) * F.lit(float(w)) for c, w in weights.items()), F.lit(0.0))
    den = sum((F.when(col(c).isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for c, w in weights.items()), F.lit(0.0))
    return df.withColumn(name, F.try_divide(num, F.when(den != 0, den)))


def missing_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    """Append ``<name>_is_missing`` (0/1) for each column."""
    return project(df, {}, append={f"{c}_is_missing": col(c).isNull().cast("int") for c in cols})


def pca_composite(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """First principal component of the standardised columns; missing cells count as the mean.

    The sign is chosen so that the first column has a positive loading.
    """
    model = PopulationScaler(inputCols=cols).fit(df)
    scaled = model.transform(df.select(*[col(c) for c in cols])).select(
        *[F.coalesce(col(c), F.lit(0.0)).alias(c) for c in cols]
    )
    vectors = VectorAssembler(inputCols=cols, outputCol="v").transform(scaled)
    loadings = PCA(k=1, inputCol="v", outputCol="p").fit(vectors).pc.toArray()[:, 0].tolist()
    sign = -1.0 if loadings[0] < 0 else 1.0
    state = model.getState()
    score = F.lit(0.0)
    for c, w in zip(cols, loadings):
        mean, std = state.get(c, (0.0, 1.0))
        score = score + F.coalesce((col(c).cast("double") - F.lit(mean)) / F.lit(std), F.lit(0.0)) * F.lit(sign * w)
    return df.select("*", score.alias(name))
