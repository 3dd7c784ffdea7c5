"""Column selection, removal, casting and rebuilding."""

from __future__ import annotations

import re

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions.scalar import col, is_numeric, lenient_double
from sparkprep.operators.base import FitStep, RowStep, StateModel, keyword_only, project
from sparkprep.operators.stats import null_rates


def names_matching(names: list[str], pattern: str) -> list[str]:
    found = re.compile(pattern)
    return [n for n in names if found.search(n)]


def select_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Project the named columns; a missing one is an error."""
    missing = [n for n in names if n not in set(df.columns)]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select(*[col(n) for n in names])


def split_present(df: DataFrame, names: list[str]) -> tuple[list[str], list[str]]:
    """Names that are columns of ``df``, and those that are not."""
    have = set(df.columns)
    return [n for n in names if n in have], [n for n in names if n not in have]


def select_present(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[col(n) for n in split_present(df, names)[0]])


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[col(n) for n in names_matching(df.columns, pattern)])


def select_by_type(df: DataFrame, kind: str) -> DataFrame:
    """Project the ``numeric`` or the ``string`` columns."""
    tests = {"numeric": is_numeric, "string": lambda t: isinstance(t, T.StringType)}
    return df.select(*[col(f.name) for f in df.schema if tests[kind](f.dataType)])


def drop_by_prefix(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """Drop columns whose name starts with one of the prefixes."""
    return df.drop(*[c for c in df.columns if c.startswith(tuple(prefixes))])


def pairwise_complete(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where none of the columns is null, projected on these columns."""
    return select_columns(df, cols).dropna(subset=cols)


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Treat NaN as missing in the floating-point columns (all of them by default)."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    names = [c for c in floating if cols is None or c in set(cols)]
    return project(df, {c: F.when(~F.isnan(col(c)), col(c)) for c in names})


class ColumnDropper(RowStep):
    """Drop the listed columns; with ``strict`` an absent one is an error."""

    strict: "Param[bool]" = Param(Params._dummy(), "strict", "fail on absent columns", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, strict=None):
        super().__init__()
        self._configure({"strict": False}, self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.getOrDefault(self.strict):
            absent = split_present(df, self.getInputCols())[1]
            if absent:
                raise ValueError(f"columns not found: {absent}")
        return df.drop(*self.getInputCols())


class DropModel(StateModel):
    def dropped(self) -> list[str]:
        return list(self.getState()["drop"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.dropped())


class SparseColumnDropper(FitStep):
    """Learn which columns have a null rate strictly above ``threshold`` and drop them."""

    threshold: "Param[float]" = Param(Params._dummy(), "threshold", "null rate", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, threshold=None):
        super().__init__()
        self._configure({"threshold": 0.8}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> DropModel:
        rates = null_rates(df, self.present(df) or df.columns)
        limit = self.getOrDefault(self.threshold)
        return DropModel({"drop": [c for c in df.columns if rates.get(c, 0.0) > limit]})


class LenientCaster(RowStep):
    """Cast columns (all by default) to double; what is no number becomes null."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._configure({}, self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.present(df) or df.columns
        types = {f.name: f.dataType for f in df.schema}
        return project(df, {c: lenient_double(col(c), types[c]) for c in names})


class GroupingCleaner(RowStep):
    """Cast the grouping columns to double and drop those that hold text codes."""

    dropCols: "Param[list]" = Param(Params._dummy(), "dropCols", "text codes", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, dropCols=None):
        super().__init__()
        self._configure({"dropCols": ["CNT", "STRATUM"]}, self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = select_columns(df, self.getInputCols()).columns if self.getInputCols() else df.columns
        gone = set(self.getOrDefault(self.dropCols))
        types = {f.name: f.dataType for f in df.schema}
        return df.select(*[lenient_double(col(c), types[c]).alias(c) for c in names if c not in gone])


def rebuild_columns(df: DataFrame, cleaned: dict[str, list[tuple[str, object]]], raw: list[str]) -> DataFrame:
    """Untouched columns first, then each cleaned family in the order given.

    ``raw`` names the columns to take out; ``cleaned`` maps a family to
    ``(name, expression over df)`` pairs.  A cleaned column whose name is taken
    already is left out.  All on the same table, so rows need no matching.
    """
    out, seen = [], set()
    for c in df.columns:
        if c not in set(raw):
            out.append(col(c))
            seen.add(c)
    for family in cleaned.values():
        for name, expr in family:
            if name not in seen:
                out.append(expr.alias(name))
                seen.add(name)
    return df.select(*out)
