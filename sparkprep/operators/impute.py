"""Imputation.  Every fit is a few fused aggregates, every transform one projection."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, is_integral, is_numeric
from sparkprep.operators import levels as lv
from sparkprep.operators.base import FitStep, RowStep, StateModel, keyword_only, project
from sparkprep.operators.quantiles import exact_medians
from sparkprep.operators.stats import null_rates


class SentinelFill(RowStep):
    """Nulls of the columns whose name contains a given text become a flag value."""

    nameParts: "Param[list]" = Param(Params._dummy(), "nameParts", "texts in names", TypeConverters.toListString)
    flag: "Param[float]" = Param(Params._dummy(), "flag", "flag value", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, nameParts=None, flag=None):
        super().__init__()
        self._configure({"nameParts": ["score", "timing"], "flag": -1.0}, self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        parts, flag = self.getOrDefault(self.nameParts), self.getOrDefault(self.flag)
        names = self.present(df) or [c for c in df.columns if any(p in c for p in parts)]
        return project(df, {c: F.coalesce(col(c).cast("double"), F.lit(flag)) for c in names})


class FillModel(StateModel):
    """Fill nulls with one value per column.

    State: ``fill`` maps a column to its value and ``as_type`` to the type the
    column is cast to first (a fractional median turns an integer column into
    double, a text label turns any column into string).
    """

    def values(self) -> dict[str, object]:
        return dict(self.getState()["fill"])

    def _transform(self, df: DataFrame) -> DataFrame:
        types = self.getState().get("as_type", {})
        have = set(df.columns)
        exprs = {}
        for c, v in self.values().items():
            if c in have:
                t = types.get(c)
                base = col(c).cast(t) if t else col(c)
                exprs[c] = F.coalesce(base, F.lit(v).cast(t) if t else F.lit(v))
        return project(df, exprs)


def median_rule(medians: dict[str, float | None], default: float = 0.0) -> dict:
    """Fill state of the numeric rule: the median, or ``default`` for an empty column."""
    fill = {c: (default if m is None else float(m)) for c, m in medians.items()}
    return {"fill": fill, "as_type": {c: "double" for c in fill}}


def mode_rule(df: DataFrame, cols: list[str], modes: dict[str, object], unknown: str, numeric_unknown: float) -> dict:
    """Fill state of the categorical rule: the mode, or a label for an empty column."""
    types = {f.name: f.dataType for f in df.schema}
    fill, as_type, found = {}, {}, {}
    for c in cols:
        t = types[c]
        m = modes.get(c)
        if m is not None:
            found[c] = fill[c] = m
            as_type[c] = t.simpleString()
        elif is_numeric(t):
            fill[c] = int(numeric_unknown) if is_integral(t) else float(numeric_unknown)
            as_type[c] = t.simpleString()
        else:
            fill[c], as_type[c] = unknown, "string"
    return {"fill": fill, "as_type": as_type, "modes": found}


def _modes(df: DataFrame, cols: list[str], null_candidate: bool = False) -> dict[str, object]:
    return lv.mode_values(lv.level_counts(df, cols), null_candidate) if cols else {}


class MedianFill(FitStep):
    """Exact median per column; an empty column is filled with 0."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._configure({}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> FillModel:
        return FillModel(median_rule(exact_medians(df, self.present(df))))


class TieredFill(FitStep):
    """Numeric columns with nulls: the median below a null rate, a flag from there on."""

    threshold: "Param[float]" = Param(Params._dummy(), "threshold", "null rate", TypeConverters.toFloat)
    flag: "Param[float]" = Param(Params._dummy(), "flag", "flag value", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, threshold=None, flag=None):
        super().__init__()
        self._configure({"threshold": 0.05, "flag": -1.0}, self._input_kwargs)

    def rule(self, df: DataFrame, names: list[str], rates: dict[str, float]) -> dict:
        """Fill state, given null rates that are known already."""
        flag, limit = self.getOrDefault(self.flag), self.getOrDefault(self.threshold)
        low = [c for c in names if 0 < rates[c] < limit]
        medians = exact_medians(df, low)
        fill = {c: (medians[c] if c in medians else flag) for c in names if rates[c] > 0}
        return {"fill": fill, "as_type": {c: "double" for c in fill}}

    def _fit(self, df: DataFrame) -> FillModel:
        names = [f.name for f in df.schema if is_numeric(f.dataType)]
        wanted = set(self.getInputCols())
        names = [c for c in names if not wanted or c in wanted]
        return FillModel(self.rule(df, names, null_rates(df, names) if names else {}))


class ModeFill(FitStep):
    """Most frequent value per column; ties go to the smallest value.

    A column without a mode is filled with ``unknown`` (text) or -1 (numbers),
    or left alone when ``fillEmpty`` is false.  ``nullCandidate`` lets null
    compete for the mode.
    """

    unknown: "Param[str]" = Param(Params._dummy(), "unknown", "label", TypeConverters.toString)
    fillEmpty: "Param[bool]" = Param(Params._dummy(), "fillEmpty", "fill empty columns", TypeConverters.toBoolean)
    nullCandidate: "Param[bool]" = Param(Params._dummy(), "nullCandidate", "null may win", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, unknown=None, fillEmpty=None, nullCandidate=None):
        super().__init__()
        self._configure({"unknown": "Unknown", "fillEmpty": True, "nullCandidate": False}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> FillModel:
        cols = self.present(df)
        modes = _modes(df, cols, self.getOrDefault(self.nullCandidate))
        if not self.getOrDefault(self.fillEmpty):
            cols = [c for c in cols if modes.get(c) is not None]
        return FillModel(mode_rule(df, cols, modes, self.getOrDefault(self.unknown), -1))


class RemainingFill(FitStep):
    """Fill every column that still has nulls: median (or 0) for numbers, mode or a label else."""

    unknown: "Param[str]" = Param(Params._dummy(), "unknown", "label", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, unknown=None):
        super().__init__()
        self._configure({"unknown": "Unknown"}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> FillModel:
        rates = null_rates(df, self.present(df) or df.columns)
        types = {f.name: f.dataType for f in df.schema}
        with_null = [c for c in df.columns if rates.get(c, 0) > 0]
        numeric = [c for c in with_null if is_numeric(types[c])]
        other = [c for c in with_null if c not in set(numeric)]
        state = median_rule(exact_medians(df, numeric))
        text = mode_rule(df, other, _modes(df, other), self.getOrDefault(self.unknown), -1)
        return FillModel({k: {**state.get(k, {}), **text[k]} for k in text})


