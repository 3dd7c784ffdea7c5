"""Categorical and ordinal encoders, fitted on one table and applied to any.

A fit reads the data once, as a level-frequency table.  Columns with few levels
are written into the projection; columns with many levels use a lookup table
that is stored as parquet and joined (see :func:`join_levels`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions.scalar import col, free_names, is_integral
from sparkprep.operators import levels as lv
from sparkprep.operators.base import FitStep, StateModel, keyword_only, project
from sparkprep.operators.joins import join_levels
from sparkprep.operators.ranking import running_totals
from sparkprep.session import cut_lineage

#: Columns with at most this many levels are encoded inside the projection.
INLINE_LEVELS = 64


def level_key(name: str, dtype: T.DataType) -> Column:
    """Text form of a column that equals :func:`level_text` of its level table."""
    c = col(name)
    if is_integral(dtype):
        return c.cast("bigint").cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # the grouping normalises -0.0, so does adding zero
        return (c.cast("double") + F.lit(0.0)).cast("string")
    return c.cast("string")


def inline_map(key: Column, values: dict[str, object], default: Column) -> Column:
    """``CASE`` over a short map of levels."""
    if not values:
        return default
    chain = reduce(lambda w, kv: w.when(key == F.lit(kv[0]), F.lit(kv[1])), values.items(), F)
    return chain.otherwise(default)


class _LevelWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        if self.instance.table is not None:
            self.instance.table.write.parquet(f"{path}/levels")


class _LevelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        if model.getState().get("sizes"):
            model.table = self.sparkSession.read.parquet(f"{path}/levels")
        return model


class LevelModel(StateModel):
    """Model with a value per level.

    ``state["inline"]`` maps a column with few levels to ``{level: value}``;
    ``state["sizes"]`` holds the level count of the columns kept in ``table``
    ``(variable, level, n, value)``.
    """

    def __init__(self, state: dict | None = None, table: DataFrame | None = None):
        super().__init__(state)
        self.table = table

    def copy(self, extra=None):
        out = super().copy(extra)
        out.table = self.table
        return out

    def write(self):
        return _LevelWriter(self)

    @classmethod
    def read(cls):
        return _LevelReader(cls)

    def encoded(self, c: str, key: Column, value: Column) -> Column:
        """Output for a column, given its key and the looked-up value (null if unknown)."""
        raise NotImplementedError

    append_encoded = False

    def _transform(self, df: DataFrame) -> DataFrame:
        state, types = self.getState(), {f.name: f.dataType for f in df.schema}
        names = df.columns
        exprs: dict[str, Column] = {}
        for c, values in state["inline"].items():
            if c in types:
                key = level_key(c, types[c])
                exprs[c] = self.encoded(c, key, inline_map(key, values, F.lit(None)))
        for i, (c, rows) in enumerate(state["sizes"].items()):
            if c not in types:
                continue
            key, value = free_names(df.columns, f"_key{i}", f"_value{i}")
            part = self.table.where(F.col("variable") == c).select(
                F.col("level").alias(key), "n", F.col("value").alias(value)
            )
            df = join_levels(df.withColumn(key, level_key(c, types[c])), part, key, rows)
            exprs[c] = self.encoded(c, F.col(key), F.col(value))
        # in the order of the input columns, however many levels each has
        exprs = {c: exprs[c] for c in state.get("order", exprs) if c in exprs}
        if self.append_encoded:
            keep = [col(c) for c in names if c not in exprs]
            return df.select(*keep, *[e.alias(c) for c, e in exprs.items()])
        return df.select(*[exprs[c].alias(c) if c in exprs else col(c) for c in names])


class LevelFit(FitStep):
    """Fit that reads the level-frequency table once."""

    def level_table(self, df: DataFrame) -> tuple[DataFrame, dict[str, object]]:
        cols = self.present(df)
        levels = cut_lineage(lv.level_counts(df, cols))
        summary = {r.variable: r for r in lv.level_summary(levels).collect()}
        # a table without rows has no levels
        return levels, {c: summary[c] for c in cols if c in summary}

    def pack(self, valued: DataFrame, sizes: dict[str, int], extra: dict | None = None):
        """Model state from ``valued(variable, v_*, n, value)`` without null levels."""
        small = [c for c, s in sizes.items() if s <= INLINE_LEVELS]
        large = {c: s for c, s in sizes.items() if s > INLINE_LEVELS}
        keyed = valued.select("variable", lv.level_text().alias("level"), "n", "value", *lv.LEVEL_PARTS)
        inline: dict[str, dict] = {c: {} for c in small}
        if small:
            # at most INLINE_LEVELS rows per column
            for r in keyed.where(F.col("variable").isin(small)).orderBy("variable", *lv.level_order()).collect():
                inline[r.variable][r.level] = r.value
        table = None
        if large:
            table = cut_lineage(
                keyed.where(F.col("variable").isin(list(large))).select("variable", "level", "n", "value")
            )
        return {"inline": inline, "sizes": large, "order": list(sizes), **(extra or {})}, table


class OrdinalModel(LevelModel):
    def encoded(self, c, key, value):
        return F.when(key.isNotNull(), F.coalesce(value.cast("double"), F.lit(-1.0)))


class OrdinalCoder(LevelFit):
    """Code = position among the sorted levels of the fit table.

    Numbers sort by value.  Unknown levels give -1, missing stays missing.
    """

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._configure({}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> OrdinalModel:
        levels, summary = self.level_table(df)
        known = levels.where(~lv.level_is_null())
        valued = running_totals(known).withColumn("value", F.col("position").cast("double"))
        state, table = self.pack(valued, {c: s.n_levels for c, s in summary.items()})
        return OrdinalModel(state, table)


class FrequencyModel(LevelModel):
    append_encoded = True

    def encoded(self, c, key, value):
        return F.coalesce(value.cast("double"), F.lit(0.0))


class FrequencyCoder(LevelFit):
    """Level share of the fit table for columns with more than ``minLevels`` distinct values.

    Null counts as a distinct value.  Unknown and null give 0; encoded columns
    move to the end.
    """

    minLevels: "Param[int]" = Param(Params._dummy(), "minLevels", "encode above", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, minLevels=None):
        super().__init__()
        self._configure({"minLevels": 10}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> FrequencyModel:
        levels, summary = self.level_table(df)
        wide = {c: s for c, s in summary.items() if s.n_unique > self.getOrDefault(self.minLevels)}
        n_rows = max([s.n_rows for s in summary.values()], default=0)
        valued = levels.where(~lv.level_is_null() & F.col("variable").isin(list(wide))).withColumn(
            "value", F.col("n") / F.lit(n_rows or 1)
        )
        state, table = self.pack(valued, {c: s.n_levels for c, s in wide.items()})
        return FrequencyModel(state, table)


class RareModel(LevelModel):
    def encoded(self, c, key, value):
        return F.when(value.cast("boolean"), F.lit(self.getState()["other"])).otherwise(key)


class RareGrouper(LevelFit):
    """Levels below ``threshold`` of the rows of the fit table become ``other``.

    Unknown levels and nulls are untouched; a column is turned into text only
    when it has rare levels.
    """

    threshold: "Param[float]" = Param(Params._dummy(), "threshold", "row share", TypeConverters.toFloat)
    other: "Param[str]" = Param(Params._dummy(), "other", "replacement", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, threshold=None, other=None):
        super().__init__()
        self._configure({"threshold": 0.01, "other": "Other"}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> RareModel:
        levels, summary = self.level_table(df)
        n_rows = max([s.n_rows for s in summary.values()], default=0)
        rare = levels.where(
            ~lv.level_is_null() & (F.col("n") / F.lit(n_rows or 1) < F.lit(self.getOrDefault(self.threshold)))
        ).withColumn("value", F.lit(True))
        counts = rare.groupBy("variable").agg(F.count(F.lit(1)).alias("rare")).collect()
        sizes = {r.variable: r.rare for r in counts}
        state, table = self.pack(
            rare, {c: sizes[c] for c in summary if c in sizes}, {"other": self.getOrDefault(self.other)}
        )
        return RareModel(state, table)


class BinaryModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        state, types = self.getState(), {f.name: f.dataType for f in df.schema}
        exprs = {}
        for c, (first, second) in state["pairs"].items():
            if c not in types:
                continue
            key = level_key(c, types[c])
            if state["invalid"] == "error":
                text = F.concat(F.lit(f"unseen value in binary column {c}: "), F.coalesce(key, F.lit("null")))
                other = F.raise_error(text).cast("int")
            else:
                other = F.lit(None).cast("int")
            is_second = key.isNull() if second is None else key == second
            exprs[c] = F.when(key == first, 0).when(is_second, 1).otherwise(other)
        return project(df, exprs)


class BinaryCoder(LevelFit):
    """0/1 for columns with exactly two distinct values, ordered as text.

    Null counts as a value and comes last: one level and null give 0 and 1.

    ``handleInvalid``: ``error`` stops on a value the fit table did not have,
    ``null`` maps it to null.
    """

    handleInvalid: "Param[str]" = Param(Params._dummy(), "handleInvalid", "error|null", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, handleInvalid=None):
        super().__init__()
        self._configure({"handleInvalid": "error"}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> BinaryModel:
        levels, summary = self.level_table(df)
        two = [c for c, s in summary.items() if s.n_unique == 2]
        pairs: dict[str, list[str]] = {c: [] for c in two}
        rows = levels.where(F.col("variable").isin(two)).select("variable", lv.level_text().alias("level")).collect() if two else []
        for r in rows:
            pairs[r.variable].append(r.level)
        return BinaryModel(
            {"pairs": {c: sorted(p, key=lambda v: (v is None, v or "")) for c, p in pairs.items()}, "invalid": self.getOrDefault(self.handleInvalid)}
        )


class OneHotModel(StateModel):
    def output_names(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self.getState()["levels"].items() for v in values]

    def _transform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema}
        new = {}
        for c, values in self.getState()["levels"].items():
            if c not in types:
                continue
            # a null is the level "None", as in the text form of a missing value
            key = F.coalesce(level_key(c, types[c]), F.lit("None"))
            for v in values:
                new[f"{c}_{v}"] = F.when(key == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0))
        return project(df, {}, drop=[c for c in self.getState()["levels"] if c in types], append=new)


class OneHotCoder(LevelFit):
    """One column per level for columns with 3 to ``maxLevels`` distinct values.

    Null counts as the level ``None``.  Sources are dropped, the new columns
    stand at the end; an unknown level is all zeros.
    """

    maxLevels: "Param[int]" = Param(Params._dummy(), "maxLevels", "largest cardinality", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, maxLevels=None):
        super().__init__()
        self._configure({"maxLevels": 10}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> OneHotModel:
        levels, summary = self.level_table(df)
        chosen = [c for c, s in summary.items() if 3 <= s.n_unique <= self.getOrDefault(self.maxLevels)]
        found: dict[str, list[str]] = {c: [] for c in chosen}
        if chosen:
            text = F.coalesce(lv.level_text(), F.lit("None"))
            for r in levels.where(F.col("variable").isin(chosen)).select("variable", text.alias("level")).collect():
                found[r.variable].append(r.level)
        return OneHotModel({"levels": {c: sorted(set(v)) for c, v in found.items()}})


def label_missing(df: DataFrame, cols: list[str], label) -> DataFrame:
    """Missing as a level of its own."""
    return project(df, {c: F.coalesce(col(c), F.lit(label)) for c in cols if c in set(df.columns)})


def target_encode(df: DataFrame, column: str, target: str, fold: Column, n_folds: int, name: str) -> DataFrame:
    """Out-of-fold target mean: each row gets the mean of its level over the other folds.

    Sums per (level, fold) are combined before the shuffle; the mean of the other
    folds is the level total minus the own fold.  A level seen in one fold only
    gets the mean of all rows outside that fold.
    """
    keyed = df.withColumn("_fold", fold).withColumn("_level", F.coalesce(col(column).cast("string"), F.lit("None")))
    y = col(target)
    cells = cut_lineage(
        keyed.groupBy("_level", "_fold").agg(F.sum(y).alias("s"), F.count(y).alias("c"), F.count(F.lit(1)).alias("n"))
    )
    overall = cells.groupBy("_fold").agg(F.sum("s").alias("s"), F.sum("c").alias("c")).collect()
    s_all, c_all = sum(r.s or 0.0 for r in overall), sum(r.c for r in overall)
    outside = {r._fold: ((s_all - (r.s or 0.0)) / (c_all - r.c) if c_all > r.c else None) for r in overall}
    totals = cells.groupBy("_level").agg(F.sum("s").alias("ts"), F.sum("c").alias("tc"))
    rest = cells.join(totals, "_level").select(
        "_level",
        "_fold",
        "n",
        F.try_divide(F.col("ts") - F.coalesce("s", F.lit(0.0)), F.col("tc") - F.col("c")).alias("_m"),
    )
    joined = join_levels(keyed, rest, ["_level", "_fold"])
    default = inline_map(F.col("_fold").cast("string"), {str(k): v for k, v in outside.items()}, F.lit(None))
    return joined.select(*[col(c) for c in df.columns], F.coalesce("_m", default.cast("double")).alias(name))
