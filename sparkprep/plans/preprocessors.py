"""Ordinal and categorical preprocessors and the stage 2 plan built from them."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame

from sparkprep.functions.scalar import is_numeric
from sparkprep.operators import levels as lv
from sparkprep.operators.base import FitStep, StateModel
from sparkprep.operators.derive import COMPOSITES, OCCUPATION_COLUMNS, CompositeMean, OccupationGrouper
from sparkprep.operators.impute import FillModel, RemainingFill, median_rule, mode_rule
from sparkprep.operators.quantiles import exact_medians
from sparkprep.operators.stats import null_rates
from sparkprep.plans.roles import CATEGORICAL_REDUNDANT, METADATA, ORDINAL_REDUNDANT


def _without(names: list[str], gone) -> list[str]:
    return [n for n in names if n not in set(gone)]


class OrdinalPreprocessorModel(StateModel):
    """Fitted ordinal step: drop redundant columns, build composites, fill medians."""

    @property
    def variables_to_drop(self) -> list[str]:
        return self.getState()["drop"]

    @property
    def composite_scores(self) -> dict[str, list[str]]:
        return self.getState()["composites"]

    @property
    def ordinal_vars(self) -> list[str]:
        return self.getState()["vars"]

    def shape(self, df: DataFrame) -> DataFrame:
        """Drops and composites only, without imputation."""
        state = self.getState()
        return CompositeMean(definitions=state["definitions"]).transform(df.drop(*state["redundant"]))

    def _transform(self, df: DataFrame) -> DataFrame:
        return FillModel(self.getState()["fill"]).transform(self.shape(df))


class OrdinalPreprocessor(FitStep):
    """Ordinal preparation; ``inputCols`` are the ordinal columns.

    The model fills nulls with the medians of the fit table; its ``shape`` gives
    the columns without any imputation.
    """

    redundantCols: "Param[list]" = Param(Params._dummy(), "redundantCols", "drops", TypeConverters.toListString)
    definitions: "Param[dict]" = Param(Params._dummy(), "definitions", "composites", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, inputCols=None, redundantCols=None, definitions=None):
        super().__init__()
        self._configure(
            {"redundantCols": list(ORDINAL_REDUNDANT), "definitions": dict(COMPOSITES)}, self._input_kwargs
        )

    def plan(self, df: DataFrame) -> dict:
        """State that follows from the schema alone."""
        redundant = self.getOrDefault(self.redundantCols)
        dropped = [c for c in redundant if c in set(df.columns)]
        definitions = self.getOrDefault(self.definitions)
        made = CompositeMean(definitions=definitions).applicable(_without(df.columns, dropped))
        used = [s for sources in made.values() for s in sources]
        return {
            "redundant": redundant,
            "drop": dropped,
            "definitions": definitions,
            "composites": made,
            "vars": _without(self.getInputCols(), dropped + used) + list(made),
        }

    def _fit(self, df: DataFrame) -> OrdinalPreprocessorModel:
        state = self.plan(df)
        shaped = OrdinalPreprocessorModel(state).shape(df)
        names = [c for c in state["vars"] if c in set(shaped.columns)]
        return OrdinalPreprocessorModel({**state, "fill": median_rule(exact_medians(shaped, names))})


class CategoricalPreprocessorModel(StateModel):
    """Fitted categorical step: drop metadata and redundant columns, group codes, fill modes."""

    @property
    def metadata_columns(self) -> list[str]:
        return self.getState()["metadata"]

    @property
    def redundant_columns(self) -> list[str]:
        return self.getState()["redundant"]

    @property
    def variables_to_drop(self) -> list[str]:
        return self.getState()["drop"]

    @property
    def isco_mapping(self) -> dict[str, str]:
        return self.getState()["grouped"]

    @property
    def categorical_vars(self) -> list[str]:
        return self.getState()["vars"]

    @property
    def mode_values(self) -> dict[str, object]:
        return self.getState()["fill"]["modes"]

    def shape(self, df: DataFrame) -> DataFrame:
        """Drops and code grouping only, without imputation."""
        state = self.getState()
        kept = df.drop(*state["metadata"], *state["redundant"])
        if not state["codes"]:
            return kept
        return OccupationGrouper(inputCols=state["codes"], width=state["width"]).transform(kept)

    def _transform(self, df: DataFrame) -> DataFrame:
        return FillModel(self.getState()["fill"]).transform(self.shape(df))


class CategoricalPreprocessor(FitStep):
    """Categorical preparation; ``inputCols`` are the categorical columns."""

    metadataCols: "Param[list]" = Param(Params._dummy(), "metadataCols", "drops", TypeConverters.toListString)
    redundantCols: "Param[list]" = Param(Params._dummy(), "redundantCols", "drops", TypeConverters.toListString)
    codeCols: "Param[list]" = Param(Params._dummy(), "codeCols", "occupation codes", TypeConverters.toListString)
    width: "Param[int]" = Param(Params._dummy(), "width", "zero-pad codes, 0 = off", TypeConverters.toInt)
    unknown: "Param[str]" = Param(Params._dummy(), "unknown", "label", TypeConverters.toString)
    nullCandidate: "Param[bool]" = Param(Params._dummy(), "nullCandidate", "null may win", TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self, *, inputCols=None, metadataCols=None, redundantCols=None, codeCols=None, width=None, unknown=None, nullCandidate=None
    ):
        super().__init__()
        self._configure(
            {
                "metadataCols": list(METADATA),
                "redundantCols": list(CATEGORICAL_REDUNDANT),
                "codeCols": list(OCCUPATION_COLUMNS),
                "width": 0,
                "unknown": "Unknown",
                "nullCandidate": False,
            },
            self._input_kwargs,
        )

    def plan(self, df: DataFrame) -> dict:
        """State that follows from the schema alone."""
        have = set(df.columns)
        metadata, redundant = self.getOrDefault(self.metadataCols), self.getOrDefault(self.redundantCols)
        dropped = [c for c in metadata + redundant if c in have]
        codes = [c for c in self.getOrDefault(self.codeCols) if c in have - set(dropped)]
        grouped = {c: f"{c}_grouped" for c in codes}
        return {
            "metadata": metadata,
            "redundant": redundant,
            "drop": dropped,
            "codes": codes,
            "width": self.getOrDefault(self.width),
            "grouped": grouped,
            "vars": _without(self.getInputCols(), dropped + codes) + list(grouped.values()),
        }

    def rule(self, shaped: DataFrame, names: list[str], modes: dict) -> dict:
        return mode_rule(shaped, names, modes, self.getOrDefault(self.unknown), -1)

    def _fit(self, df: DataFrame) -> CategoricalPreprocessorModel:
        state = self.plan(df)
        shaped = CategoricalPreprocessorModel(state).shape(df)
        names = [c for c in state["vars"] if c in set(shaped.columns)]
        modes = (
            lv.mode_values(lv.level_counts(shaped, names), self.getOrDefault(self.nullCandidate)) if names else {}
        )
        return CategoricalPreprocessorModel({**state, "fill": self.rule(shaped, names, modes)})


class Stage2Model(StateModel):
    """Fitted stage 2; all tables get the columns and the statistics of the fit table."""

    @property
    def ordinal(self) -> OrdinalPreprocessorModel:
        return OrdinalPreprocessorModel(self.getState()["ordinal"])

    @property
    def categorical(self) -> CategoricalPreprocessorModel:
        return CategoricalPreprocessorModel(self.getState()["categorical"])

    def _transform(self, df: DataFrame) -> DataFrame:
        state = self.getState()
        composed = CompositeMean(definitions=state["ordinal"]["definitions"]).transform(df)
        kept = composed.drop(*state["drop"])
        # composites exist by now, so the ordinal step only drops and fills
        prepared = self.categorical.transform(self.ordinal.transform(kept))
        return FillModel(state["remaining"]).transform(prepared)

    def transform_refit(self, df: DataFrame) -> DataFrame:
        """Shape ``df`` as fitted, keep its sparse columns, and fill all nulls from ``df`` itself."""
        shaped = self.categorical.shape(self.ordinal.shape(df))
        return RemainingFill().fit(shaped).transform(shaped)


class Stage2(Estimator):
    """Composites, drop of columns above a null rate, ordinal and categorical steps, final fill.

    Composites and drops are row-local or follow from the schema, so all
    statistics come from one null count, one median search and one
    level-frequency table over the shaped input.
    """

    def __init__(self, ordinal: OrdinalPreprocessor, categorical: CategoricalPreprocessor, threshold: float = 0.5):
        super().__init__()
        self.ordinal, self.categorical, self.threshold = ordinal, categorical, threshold

    def _fit(self, df: DataFrame) -> Stage2Model:
        present = lambda step: step.copy({step.inputCols: step.present(df)})
        ordinal, categorical = present(self.ordinal), present(self.categorical)

        composer = CompositeMean(definitions=ordinal.getOrDefault(ordinal.definitions))
        made = composer.applicable(df.columns)
        composed = composer.transform(df)
        rates = null_rates(composed)
        sparse = [c for c in composed.columns if rates[c] > self.threshold]
        kept = composed.drop(*sparse)

        o_state, c_state = ordinal.plan(kept), categorical.plan(kept)
        used = [s for sources in made.values() for s in sources]
        o_state["composites"] = made
        o_state["vars"] = _without(o_state["vars"], used) + list(made)
        o_model = OrdinalPreprocessorModel(o_state)
        shaped = CategoricalPreprocessorModel(c_state).shape(o_model.shape(kept))

        names, types = set(shaped.columns), {f.name: f.dataType for f in shaped.schema}
        by_median = [c for c in o_state["vars"] if c in names]
        by_mode = [c for c in c_state["vars"] if c in names and c not in set(by_median)]
        rest = [c for c in shaped.columns if rates.get(c, 0) > 0 and c not in set(by_median) | set(by_mode)]
        rest_numeric = [c for c in rest if is_numeric(types[c])]
        rest_other = [c for c in rest if c not in set(rest_numeric)]

        medians = exact_medians(shaped, by_median + rest_numeric)
        counted = by_mode + rest_other
        modes = lv.mode_values(lv.level_counts(shaped, counted)) if counted else {}
        o_state["fill"] = median_rule({c: medians[c] for c in by_median})
        c_state["fill"] = categorical.rule(shaped, by_mode, modes)
        remaining = median_rule({c: medians[c] for c in rest_numeric})
        text = categorical.rule(shaped, rest_other, modes)
        return Stage2Model(
            {
                "drop": sparse,
                "ordinal": o_state,
                "categorical": c_state,
                "remaining": {k: {**remaining[k], **text[k]} for k in ("fill", "as_type")},
            }
        )
