"""Feature selection: mutual information, forest search, recursive elimination, merge."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, right_open_bin
from sparkprep.operators.encode import OrdinalCoder
from sparkprep.operators.quantiles import exact_quantiles
from sparkprep.operators.shuffle import with_partner
from sparkprep.operators.split import fold_number
from sparkprep.session import materialise, scratch_path

#: The searched forest sizes and depths (None = as deep as allowed).
TREES = [50, 100, 200]
DEPTHS = [5, 10, 15, 20, None]
#: Deepest tree Spark builds.
MAX_DEPTH = 30


def mutual_information(df: DataFrame, features: list[str], target: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each numeric feature with the target, best first.

    Both sides are cut at their percentile edges.  A null feature value is a bin
    of its own; rows without a target are left out.  After the first aggregate
    only ``features x bins x bins`` counts remain.
    """
    edges = exact_quantiles(df, [*features, target], [i / bins for i in range(bins + 1)])

    def binned(c: str):
        if edges[c] is None:
            return F.lit(-1)
        inner = sorted(set(edges[c][1:-1]))
        return F.coalesce(right_open_bin(col(c).cast("double"), inner), F.lit(-1))

    args = [a for c in features for a in (F.lit(c), binned(c))]
    cells = (
        df.where(col(target).isNotNull())
        .select(binned(target).alias("ybin"), F.stack(F.lit(len(features)), *args).alias("variable", "xbin"))
        .groupBy("variable", "xbin", "ybin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    over = lambda *by: F.sum("n").over(Window.partitionBy(*by)).cast("double")
    marked = cells.select(
        "variable",
        F.col("n").cast("double").alias("n"),
        over("variable").alias("total"),
        over("variable", "xbin").alias("nx"),
        over("variable", "ybin").alias("ny"),
    )
    term = F.col("n") / F.col("total") * F.log(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))
    return marked.groupBy("variable").agg(F.sum(term).alias("mi")).orderBy(F.col("mi").desc(), "variable")


def ranked(scores: DataFrame, score: str, top: int | None = None) -> DataFrame:
    """``(variable, score, rank)``, highest score first, name on ties.

    ``scores`` has one row per column of a table.
    """
    w = Window.partitionBy(F.lit(0)).orderBy(F.col(score).desc(), "variable")
    out = scores.select("variable", F.col(score).alias("score"), F.row_number().over(w).alias("rank"))
    return out.where(F.col("rank") <= top) if top else out


def training_table(df: DataFrame, features: list[str], target: str, id_cols: list[str], folds: int, seed: int) -> DataFrame:
    """Only the needed columns plus the fold, stored once: a forest reads it many times."""
    table = df.select(
        *[col(c).cast("double").alias(c) for c in features],
        col(target).cast("double").alias("_label"),
        fold_number(id_cols, folds, seed).alias("_fold"),
    )
    return materialise(table, "training")


def assembled(table: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_features").transform(table).select("_features", "_label", "_fold")


def forest(trees: int, depth: int | None, seed: int) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="_features",
        labelCol="_label",
        numTrees=trees,
        maxDepth=MAX_DEPTH if depth is None else depth,
        featureSubsetStrategy="all",
        seed=seed,
    )


def _node_arrays(spark: SparkSession, model) -> list[tuple]:
    """``(left, right, feature, threshold, prediction)`` of each tree, as arrays over its nodes; a leaf leads to itself.

    A forest of Spark lives in the driver, so its nodes fit there.
    """
    path = scratch_path(spark, "forest")
    model.write().save(path)
    n = F.col("nodeData")
    split = n["split"]
    stored = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("prediction"),
        split["featureIndex"].alias("feature"), F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
    )
    nodes = stored.toPandas().sort_values(["treeID", "id"])
    out = []
    for _, t in nodes.groupby("treeID", sort=True):
        own, inner = t["id"].to_numpy(), t["left"].to_numpy() >= 0
        pick = lambda c, leaf: np.where(inner, t[c].to_numpy(), leaf)
        out.append((pick("left", own), pick("right", own), pick("feature", 0).astype(int), pick("threshold", np.inf), t["prediction"].to_numpy()))
    return out


def nested_errors(model, table: DataFrame, trees: list[int], depths: list[int]) -> dict[tuple[int, int], float]:
    """Mean squared error on ``table`` of each ``(trees, depth)``, all read from one forest that holds the others.

    Its first ``t`` trees are a forest of ``t`` trees.  Cut at depth ``d``, a tree is the one that grows to depth
    ``d`` on the same draw: splits are found from the root on, and no feature is drawn.  Without rows there are no errors.
    """
    sent = table.sparkSession.sparkContext.broadcast(_node_arrays(table.sparkSession, model))
    counts, levels = sorted(set(trees)), sorted(set(depths))

    def errors(batches):
        total, rows = np.zeros((len(counts), len(levels))), 0
        for batch in batches:
            if batch.empty:
                continue
            x, y = np.stack(batch["x"].to_numpy()), batch["y"].to_numpy()
            at = np.arange(len(y))
            sums, rows = np.zeros((len(levels), len(y))), rows + len(y)
            for k, (left, right, feature, threshold, prediction) in enumerate(sent.value[: counts[-1]], 1):
                node, depth = np.zeros(len(y), dtype=int), 0
                for i, level in enumerate(levels):
                    for depth in range(depth, level):
                        node = np.where(x[at, feature[node]] <= threshold[node], left[node], right[node])
                    depth = level
                    sums[i] += prediction[node]
                if k in counts:
                    total[counts.index(k)] += ((sums / k - y) ** 2).sum(axis=1)
        yield pd.DataFrame(
            [(t, d, float(total[i, j]), rows) for i, t in enumerate(counts) for j, d in enumerate(levels)], columns=["t", "d", "e", "n"]
        )

    cells = table.select(vector_to_array("_features").alias("x"), F.col("_label").alias("y"))
    found = cells.mapInPandas(errors, "t int, d int, e double, n bigint").groupBy("t", "d").agg(F.sum("e").alias("e"), F.sum("n").alias("n"))
    # one row for each setting
    return {(r.t, r.d): r.e / r.n for r in found.collect() if r.n}


def search_forest(table: DataFrame, features, trees, depths, folds, parallelism, seed):
    """Errors of all settings over the folds: one forest a fold, as large as the largest setting, holds all the others."""
    depths = [MAX_DEPTH if d is None else d for d in depths]
    rows = assembled(table, features)

    def of_fold(k: int) -> dict[tuple[int, int], float]:
        model = forest(max(trees), max(depths), seed).fit(rows.where(F.col("_fold") != k))
        return nested_errors(model, rows.where(F.col("_fold") == k), trees, depths)

    with ThreadPool(min(parallelism, folds)) as pool:
        found = pool.map(inheritable_thread_target(table.sparkSession)(of_fold), range(folds))
    means = {(t, d): [f[(t, d)] for f in found if f] for t in trees for d in depths}
    rows = [(t, d, sum(m) / len(m)) for (t, d), m in means.items()]
    best = min(rows, key=lambda r: (r[2], r[0], r[1]))
    return rows, {"n_estimators": best[0], "max_depth": best[1], "mse": best[2]}


def forest_grid(
    df: DataFrame, features: list[str], target: str, id_cols: list[str],
    trees=TREES, depths=DEPTHS, folds=5, parallelism=2, seed=42,
) -> DataFrame:
    """Mean squared error of each forest setting over seeded folds."""
    table = training_table(df, features, target, id_cols, folds, seed)
    rows, best = search_forest(table, features, trees, depths, folds, parallelism, seed)
    found = (best["n_estimators"], best["max_depth"])
    return df.sparkSession.createDataFrame(
        [(t, d, m, (t, d) == found) for t, d, m in rows], "n_estimators int, max_depth int, mse double, best boolean"
    )


def eliminate(
    df: DataFrame, features: list[str], target: str, id_cols: list[str],
    n_features=30, step: int | float = 1, trees=TREES[0], depth: int | None = DEPTHS[0], seed=42, table: DataFrame | None = None,
) -> DataFrame:
    """Recursive elimination ``(variable, rank, importance)``; kept features have rank 1.

    Each round fits one distributed forest on the features left and drops the
    ``step`` least important (a share of all features when below 1).
    """
    if table is None:
        table = training_table(df, features, target, id_cols, 2, seed)
    per_round = max(1, int(step * len(features)) if step < 1 else int(step))
    left, gone, scores = list(features), [], {}
    while True:
        model = forest(trees, depth, seed).fit(assembled(table, left))
        scores.update(zip(left, model.featureImportances.toArray().tolist()))
        if len(left) <= n_features:
            break
        order = sorted(left, key=lambda f: (scores[f], f))
        dropped = order[: min(per_round, len(left) - n_features)]
        gone.append(dropped)
        left = [f for f in left if f not in set(dropped)]
    rows = [(f, 1, float(scores[f])) for f in left]
    for back, dropped in enumerate(reversed(gone)):
        rows += [(f, 2 + back, float(scores[f])) for f in dropped]
    return df.sparkSession.createDataFrame(rows, "variable string, rank int, importance double")


def forest_importance(
    df: DataFrame, categorical: list[str], target: str, id_cols: list[str], trees=20, depth=5, seed=42
) -> DataFrame:
    """Importance of each categorical column, coded by level order, in one baseline forest."""
    coded = OrdinalCoder(inputCols=categorical).fit(df).transform(df)
    # a missing level is a code of its own
    filled = coded.select(*[F.coalesce(col(c), F.lit(-1.0)).alias(c) for c in categorical], *[col(c) for c in [target, *id_cols]])
    table = training_table(filled, categorical, target, id_cols, 2, seed)
    model = forest(trees, depth, seed).fit(assembled(table, categorical))
    scores = zip(categorical, model.featureImportances.toArray().tolist())
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in scores], "variable string, importance double")


def feature_sets(mi: DataFrame, rfe: DataFrame) -> DataFrame:
    """Union of two ranked name tables ``(variable, rank)`` with the side each name is on."""
    a = mi.select("variable", F.col("rank").alias("rank_mi"))
    b = rfe.select("variable", F.col("rank").alias("rank_rfe"))
    side = (
        F.when(F.col("rank_mi").isNotNull() & F.col("rank_rfe").isNotNull(), "both")
        .when(F.col("rank_mi").isNotNull(), "mi_only")
        .otherwise("rfe_only")
    )
    return a.join(b, "variable", "full_outer").select("variable", side.alias("side"), "rank_mi", "rank_rfe")


def merge_features(sets: DataFrame, n_features: int) -> DataFrame:
    """Final list ``(variable, position)``: the intersection, then both sides in turn.

    Order inside a side is (rank, name); when one side ends the other goes on.
    """
    own_rank = F.coalesce("rank_mi", "rank_rfe")
    in_side = sets.select(
        "variable",
        "side",
        F.row_number().over(Window.partitionBy("side").orderBy(own_rank, "variable")).alias("k"),
    )
    turn = F.when(F.col("side") == "both", 0).when(F.col("side") == "mi_only", 1).otherwise(2)
    first = F.when(F.col("side") == "both", 0).otherwise(1)
    # at most one row per column of the table
    w = Window.partitionBy(F.lit(0)).orderBy(first, "k", turn)
    return in_side.select("variable", F.row_number().over(w).alias("position")).where(F.col("position") <= n_features)


def permutation_importance(df: DataFrame, model, features: list[str], target: str, id_cols: list[str], seed=42) -> DataFrame:
    """Increase of the squared error when one feature is permuted among the rows.

    ``model`` is a fitted forest on an assembled ``_features`` column.  One
    shuffle in hash order gives every row the features of another row; the table
    is stored once, and each feature is exchanged in a projection of its own.
    """
    evaluator = RegressionEvaluator(labelCol="_label", metricName="mse")
    rows = df.select(
        *[col(c) for c in id_cols],
        *[col(c).cast("double").alias(c) for c in features if c not in id_cols],
        col(target).cast("double").alias("_label"),
    )
    table = materialise(with_partner(rows, features, id_cols, seed).select("_label", *[col(c) for c in features], "_partner"), "permutation")
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    error = lambda t: evaluator.evaluate(model.transform(assembler.transform(t)))
    base = error(table)
    found = [(f, error(table.withColumn(f, F.col("_partner").getField(f))) - base) for f in features]
    return df.sparkSession.createDataFrame(found, "variable string, importance double")
