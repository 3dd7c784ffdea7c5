"""The documented order end to end: clean, split, fit on train, apply to all parts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.operators.columns import SparseColumnDropper, drop_by_prefix
from sparkprep.operators.encode import BinaryCoder, FrequencyCoder, OneHotCoder, OrdinalCoder, RareGrouper
from sparkprep.operators.impute import ModeFill
from sparkprep.operators.knn import KnnFill
from sparkprep.operators.scale import PopulationScaler, Winsorizer
from sparkprep.operators.split import split_simple
from sparkprep.plans.preprocessors import CategoricalPreprocessor, CategoricalPreprocessorModel, OrdinalPreprocessor, OrdinalPreprocessorModel
from sparkprep.plans.roles import LEAKAGE_PREFIXES
from sparkprep.session import materialise


def prepare_and_split(
    df: DataFrame,
    ordinal: OrdinalPreprocessor,
    categorical: CategoricalPreprocessor,
    id_cols: list[str],
    leakage_prefixes=(),
    missing_threshold: float = 0.5,
    seed: int = 42,
) -> tuple[DataFrame, list[str], list[str]]:
    """Cleaned table with a ``split`` column, and the ordinal and categorical names left."""
    df = drop_by_prefix(df, list(leakage_prefixes)) if leakage_prefixes else df
    kept = SparseColumnDropper(threshold=missing_threshold).fit(df).transform(df)
    o_state, c_state = ordinal.plan(kept), categorical.plan(kept)
    shaped = CategoricalPreprocessorModel(c_state).shape(OrdinalPreprocessorModel(o_state).shape(kept))
    have = set(shaped.columns)
    names = lambda s: [c for c in s["vars"] if c in have]
    return split_simple(shaped, id_cols, seed=seed), names(o_state), names(c_state)


def fit_encoders(train: DataFrame, ordinal: list[str], categorical: list[str], k: int = 5, invalid="error") -> PipelineModel:
    """Imputation, outliers, encoding and scaling, each fitted on the output of the one before.

    After the neighbour fill the training table is stored once, so that the later
    fits do not repeat the search.
    """
    stages = []
    current = train
    steps = [
        KnnFill(inputCols=ordinal, k=k),
        ModeFill(inputCols=categorical, fillEmpty=False),
        Winsorizer(inputCols=ordinal),
        RareGrouper(inputCols=categorical),
        OrdinalCoder(inputCols=ordinal),
        BinaryCoder(inputCols=categorical, handleInvalid=invalid),
        OneHotCoder(inputCols=categorical),
        FrequencyCoder(inputCols=categorical),
        PopulationScaler(inputCols=ordinal),
    ]
    binary: set[str] = set()
    for i, step in enumerate(steps):
        if isinstance(step, (OneHotCoder, FrequencyCoder)):
            left = [c for c in categorical if c not in binary and c in set(current.columns)]
            step = type(step)(inputCols=left)
        if not [c for c in step.getInputCols() if c in set(current.columns)]:
            continue
        model = step.fit(current)
        if isinstance(step, BinaryCoder):
            binary = set(model.getState()["pairs"])
        stages.append(model)
        current = model.transform(current)
        if isinstance(step, KnnFill):
            current = materialise(current, "filled")
    return PipelineModel(stages)


def full_plan(
    df: DataFrame,
    ordinal: OrdinalPreprocessor,
    categorical: CategoricalPreprocessor,
    id_cols: list[str],
    leakage_prefixes=tuple(LEAKAGE_PREFIXES),
    k: int = 5,
    seed: int = 42,
    invalid: str = "null",
) -> tuple[DataFrame, PipelineModel]:
    """Prepared rows of all three parts (with ``split``) and the fitted encoders.

    ``invalid`` says what a level of a binary column becomes that the training
    part does not have: ``null``, or an ``error``.
    """
    split, o_names, c_names = prepare_and_split(df, ordinal, categorical, id_cols, leakage_prefixes, seed=seed)
    split = materialise(split, "split")
    model = fit_encoders(split.where(F.col("split") == "train"), o_names, c_names, k, invalid=invalid)
    return model.transform(split), model
