"""Shared base of the Estimator / Model pairs.

Fitted state is a JSON-able dict held in the ``state`` param (one entry per
column), so every model saves and loads through the standard ML writers.  A
model's ``transform`` is a single projection.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame

from sparkprep.functions.scalar import col

__all__ = ["ColumnStep", "FitStep", "RowStep", "StateModel", "keyword_only", "project"]


def project(df: DataFrame, replace: dict[str, Column], drop=(), append: dict[str, Column] | None = None) -> DataFrame:
    """One ``select``: replaced columns keep their place, new ones go to the end."""
    gone = set(drop)
    kept = [replace[c].alias(c) if c in replace else col(c) for c in df.columns if c not in gone]
    return df.select(*kept, *[e.alias(n) for n, e in (append or {}).items()])


class ColumnStep(Params):
    """A step with an ``inputCols`` param; names that are no column are skipped."""

    inputCols: "Param[list]" = Param(
        Params._dummy(), "inputCols", "columns to work on; empty means chosen by the step", TypeConverters.toListString
    )

    def __init__(self):
        super().__init__()
        self._setDefault(inputCols=[])

    def _configure(self, defaults: dict, given: dict):
        self._setDefault(**defaults)
        self._set(**{k: v for k, v in given.items() if v is not None})

    def getInputCols(self) -> list[str]:
        return list(self.getOrDefault(self.inputCols))

    def present(self, df: DataFrame) -> list[str]:
        have = set(df.columns)
        return [c for c in self.getInputCols() if c in have]


class RowStep(ColumnStep, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A stateless, row-local step."""


class FitStep(ColumnStep, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """A step that learns its state from a table."""


class StateModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted step: its state is a dict, its transform one projection."""

    state: "Param[dict]" = Param(Params._dummy(), "state", "fitted values by column", TypeConverters.identity)

    def __init__(self, state: dict | None = None):
        super().__init__()
        self._setDefault(state={})
        if state is not None:
            self._set(state=state)

    def getState(self) -> dict:
        return dict(self.getOrDefault(self.state))

    def output_schema(self, df: DataFrame):
        """Schema after this step; reads no data."""
        return self.transform(df).schema
