"""Feature selection job: split, rank twice, merge, report and project."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.operators import select as sel
from sparkprep.operators.split import split_stratified


@dataclass
class SelectionResult:
    selected: list[str]
    report: dict
    data: DataFrame


def project_splits(df: DataFrame, id_cols: list[str], features: list[str], target: str, split: str = "split") -> DataFrame:
    """Ids, selected features, target and part of every row."""
    return df.select(*[col(c) for c in [*id_cols, *features, target, split]])


def run_selection(
    df: DataFrame,
    features: list[str],
    target: str,
    id_cols: list[str],
    n_features: int = 30,
    folds: int = 5,
    trees=sel.TREES,
    depths=sel.DEPTHS,
    step: int | float = 1,
    parallelism: int = 2,
    seed: int = 42,
) -> SelectionResult:
    """Select features on the training part; ``data`` is the projected table of all parts.

    All lists here are column names; the data never leaves the executors.
    """
    split = split_stratified(df, target, id_cols, seed=seed)
    train = split.where(F.col("split") == "train")
    mi = sel.mutual_information(train, features, target).collect()  # one row per feature
    table = sel.training_table(train, features, target, id_cols, folds, seed)
    grid, best = sel.search_forest(table, features, list(trees), list(depths), folds, parallelism, seed)
    rfe = sel.eliminate(
        train, features, target, id_cols, n_features, step, best["n_estimators"], best["max_depth"], seed, table
    )
    spark = df.sparkSession
    mi_rank = sel.ranked(spark.createDataFrame([(r.variable, r.mi) for r in mi], "variable string, mi double"), "mi", n_features)
    kept = rfe.where(F.col("rank") == 1)
    rfe_rank = sel.ranked(kept, "importance")
    sets = sel.feature_sets(mi_rank, rfe_rank)
    chosen = [r.variable for r in sel.merge_features(sets, n_features).orderBy("position").collect()]
    names = lambda side: [r.variable for r in sets.where(F.col("side") == side).orderBy("rank_mi", "rank_rfe", "variable").collect()]
    scores = {r.variable: r.mi for r in mi}
    report = {
        "n_features_original": len(features),
        "n_features_selected": len(chosen),
        "method": "hybrid_mi_rfe",
        "selected_features": chosen,
        "features_mi_only": names("mi_only"),
        "features_rfe_only": names("rfe_only"),
        "intersection": names("both"),
        "mi_scores": scores,
        "best_rf_params": best,
        "top_10_mi": [[r.variable, r.mi] for r in mi[:10]],
    }
    return SelectionResult(chosen, report, project_splits(split, id_cols, chosen, target))
