"""Stage 1: clean the numeric and grouping columns of the wide table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame

from sparkprep.functions.scalar import col, lenient_double
from sparkprep.operators.base import FitStep, RowStep, keyword_only
from sparkprep.operators.columns import ColumnDropper, DropModel, LenientCaster, rebuild_columns, select_columns
from sparkprep.operators.impute import FillModel, SentinelFill, TieredFill
from sparkprep.operators.scale import TimingCap
from sparkprep.operators.stats import null_rates
from sparkprep.plans.roles import NUMERIC_CURATED, VariableRoles


class NumericCleaner(FitStep):
    """Cast, drop sparse columns, flag scores and timings, cap timings, fill the rest.

    Works on ``inputCols`` (all columns when empty) and leaves the others alone.
    The null rates of all columns come from one aggregate; only the columns that
    get a median are read again.
    """

    sparseThreshold: "Param[float]" = Param(Params._dummy(), "sparseThreshold", "null rate", TypeConverters.toFloat)
    medianThreshold: "Param[float]" = Param(Params._dummy(), "medianThreshold", "null rate", TypeConverters.toFloat)
    capSeconds: "Param[float]" = Param(Params._dummy(), "capSeconds", "timing cap", TypeConverters.toFloat)
    dropCols: "Param[list]" = Param(Params._dummy(), "dropCols", "curated drops", TypeConverters.toListString)
    strict: "Param[bool]" = Param(Params._dummy(), "strict", "curated drops must exist", TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self, *, inputCols=None, sparseThreshold=None, medianThreshold=None, capSeconds=None, dropCols=None, strict=None
    ):
        super().__init__()
        self._configure(
            {
                "sparseThreshold": 0.8,
                "medianThreshold": 0.05,
                "capSeconds": 1800.0,
                "dropCols": list(NUMERIC_CURATED),
                "strict": False,
            },
            self._input_kwargs,
        )

    def _fit(self, df: DataFrame) -> PipelineModel:
        names = self.getInputCols() or df.columns
        cast = LenientCaster().transform(select_columns(df, names))
        rates = null_rates(cast)
        sparse = [c for c in names if rates[c] > self.getOrDefault(self.sparseThreshold)]
        kept = [c for c in names if c not in set(sparse)]
        timings = [c for c in kept if "timing" in c]
        flagged = [c for c in kept if "score" in c or "timing" in c]
        strict = self.getOrDefault(self.strict)
        curated = [c for c in self.getOrDefault(self.dropCols) if strict or c in set(kept)]
        rest = [c for c in kept if c not in set(flagged) | set(curated)]
        tiered = TieredFill(threshold=self.getOrDefault(self.medianThreshold))
        stages = [LenientCaster(inputCols=names), DropModel({"drop": sparse})]
        # an empty list would mean "choose by name"
        if flagged:
            stages.append(SentinelFill(inputCols=flagged))
        if timings:
            stages.append(TimingCap(inputCols=timings, capSeconds=self.getOrDefault(self.capSeconds)))
        stages.append(ColumnDropper(inputCols=curated, strict=strict))
        stages.append(FillModel(tiered.rule(cast, rest, rates)))
        return PipelineModel(stages)


class Stage1Layout(RowStep):
    """Column order of stage 1: untouched columns, cleaned numeric, cleaned grouping.

    Grouping columns are cast to double, the text codes among them dropped.
    """

    numericCols: "Param[list]" = Param(Params._dummy(), "numericCols", "cleaned numeric", TypeConverters.toListString)
    dropCols: "Param[list]" = Param(Params._dummy(), "dropCols", "text codes", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, numericCols=None, dropCols=None):
        super().__init__()
        self._configure({"numericCols": [], "dropCols": ["CNT", "STRATUM"]}, self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema}
        gone = set(self.getOrDefault(self.dropCols))
        numeric = [(c, col(c)) for c in self.getOrDefault(self.numericCols)]
        grouping = [(c, lenient_double(col(c), types[c])) for c in self.getInputCols() if c not in gone]
        raw = [c for c, _ in numeric] + self.getInputCols()
        return rebuild_columns(df, {"numeric": numeric, "grouping": grouping}, raw)


def fit_stage1(
    train: DataFrame, roles: VariableRoles, cleaner: NumericCleaner | None = None, text_codes=("CNT", "STRATUM")
) -> PipelineModel:
    """Learn stage 1 from the training table; all later tables get its columns."""
    cleaner = cleaner or NumericCleaner()
    model = cleaner.fit(train, {cleaner.inputCols: roles.numeric})
    numeric = select_columns(train, roles.numeric)
    for step in model.stages:
        numeric = step.transform(numeric)
    layout = Stage1Layout(inputCols=roles.grouping, numericCols=numeric.columns, dropCols=list(text_codes))
    return PipelineModel([*model.stages, layout])


def stage1(train: DataFrame, test: DataFrame, roles: VariableRoles, **settings) -> tuple[DataFrame, DataFrame]:
    """Fit on train, clean train and test."""
    model = fit_stage1(train, roles, **settings)
    return model.transform(train), model.transform(test)
