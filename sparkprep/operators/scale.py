"""Units, outliers and scaling."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import cap_timing, clip, col, minmax_keeping_flag, number
from sparkprep.operators.base import FitStep, RowStep, StateModel, keyword_only, project
from sparkprep.operators.quantiles import exact_quantiles
from sparkprep.operators.stats import aggregate_long, numeric_columns


class TimingCap(RowStep):
    """Timing columns: milliseconds to seconds, capped above; the flag stays."""

    namePart: "Param[str]" = Param(Params._dummy(), "namePart", "text in names", TypeConverters.toString)
    capSeconds: "Param[float]" = Param(Params._dummy(), "capSeconds", "upper limit", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, namePart=None, capSeconds=None):
        super().__init__()
        self._configure({"namePart": "timing", "capSeconds": 1800.0}, self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        part = self.getOrDefault(self.namePart)
        names = self.present(df) or [c for c in df.columns if part in c]
        cap = self.getOrDefault(self.capSeconds)
        return project(df, {c: cap_timing(col(c).cast("double"), cap) for c in names})


class ClipModel(StateModel):
    def limits(self) -> dict[str, tuple[float, float]]:
        return {c: tuple(v) for c, v in self.getState().items()}

    def _transform(self, df: DataFrame) -> DataFrame:
        have, types = set(df.columns), dict(df.dtypes)
        return project(
            df,
            {c: clip(col(c), lo, hi, types[c]) for c, (lo, hi) in self.limits().items() if c in have},
        )


class Winsorizer(FitStep):
    """Clip at the ``lower`` and ``1 - upper`` quantiles (nearest element) of the fit table."""

    lower: "Param[float]" = Param(Params._dummy(), "lower", "share cut below", TypeConverters.toFloat)
    upper: "Param[float]" = Param(Params._dummy(), "upper", "share cut above", TypeConverters.toFloat)
    interpolation: "Param[str]" = Param(Params._dummy(), "interpolation", "nearest|linear", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, lower=None, upper=None, interpolation=None):
        super().__init__()
        self._configure({"lower": 0.01, "upper": 0.01, "interpolation": "nearest"}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> ClipModel:
        probs = [self.getOrDefault(self.lower), 1 - self.getOrDefault(self.upper)]
        found = exact_quantiles(df, self.present(df), probs, self.getOrDefault(self.interpolation))
        return ClipModel({c: v for c, v in found.items() if v is not None})


class FlagMinMaxModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        state, have = self.getState(), set(df.columns)
        flag = state["flag"]

        def scaled(c: str, lo: float, hi: float):
            x = col(c).cast("double")
            return (x - F.lit(lo)) / F.lit(hi - lo) if flag is None else minmax_keeping_flag(x, lo, hi, flag)

        return project(df, {c: scaled(c, *ends) for c, ends in state["range"].items() if c in have})


class FlagMinMaxScaler(FitStep):
    """Scale to [0, 1] over the values that are not the flag; the flag stays.

    Constant and empty columns are left alone; null becomes the flag in a scaled
    column.  Without columns given, all numeric ones are scaled.  ``keepFlag=False``
    scales all values and leaves null alone.
    """

    flag: "Param[float]" = Param(Params._dummy(), "flag", "flag value", TypeConverters.toFloat)
    keepFlag: "Param[bool]" = Param(Params._dummy(), "keepFlag", "treat the flag apart", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, flag=None, keepFlag=None):
        super().__init__()
        self._configure({"flag": -1.0, "keepFlag": True}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> FlagMinMaxModel:
        flag = self.getOrDefault(self.flag) if self.getOrDefault(self.keepFlag) else None
        names = self.present(df) or numeric_columns(df)
        valid = lambda c: number(c) if flag is None else F.when(c != F.lit(flag), number(c))
        rows = aggregate_long(
            df,
            names,
            {"lo": (lambda c: F.min(valid(c)), "double"), "hi": (lambda c: F.max(valid(c)), "double")},
        ).collect()
        spans = {r.variable: [r.lo, r.hi] for r in rows if r.lo is not None and r.lo != r.hi}
        return FlagMinMaxModel({"flag": flag, "range": spans})


class StandardModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return project(
            df,
            {
                c: (col(c).cast("double") - F.lit(m)) / F.lit(s)
                for c, (m, s) in self.getState().items()
                if c in have
            },
        )


class PopulationScaler(FitStep):
    """Centre on the mean and divide by the population deviation (1 when it is 0)."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._configure({}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> StandardModel:
        names = self.present(df)
        if not names:
            return StandardModel({})
        rows = aggregate_long(
            df,
            names,
            {"mean": (lambda c: F.avg(number(c)), "double"), "std": (lambda c: F.stddev_pop(number(c)), "double")},
        ).collect()
        return StandardModel({r.variable: [r.mean, r.std or 1.0] for r in rows if r.mean is not None})
