"""Splits, samples, bins and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Source, query, with_survey
from sparkprep.functions.scalar import col
from sparkprep.operators import assoc
from sparkprep.operators import select as sel
from sparkprep.operators import split as sp
from sparkprep.operators.impute import RemainingFill
from sparkprep.operators.information import neighbour_information
from sparkprep.plans.selection import project_splits, run_selection
from sparkprep.session import scratch_path
from sparkprep.sources import tables


@query("split_simple", with_survey("SELECT id, target, split FROM parts"))
def _(s: Source):
    return s.parts.select("id", "target", "split")


_EDGES = "edges AS (SELECT quantile_cont(target, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM survey)"
_BINNED = (
    f"WITH {_EDGES}, binned AS (SELECT s.*, "
    + " + ".join(f"CAST(target >= e[{i}] AS INT)" for i in range(1, 11))
    + " AS bin FROM survey s, edges), "
    "inbin AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5(concat(CAST(id AS VARCHAR), '#42')), id) - 1 AS rk2, "
    "count(*) OVER (PARTITION BY bin) AS nb FROM binned), "
    "strat AS (SELECT *, CASE WHEN rk2 < trunc(nb * 0.2) THEN 'test' WHEN rk2 < 2 * trunc(nb * 0.2) THEN 'val' ELSE 'train' END AS split FROM inbin) "
)


@query("split_stratified", with_survey(_BINNED + "SELECT id, target, bin, split FROM strat"))
def _(s: Source):
    return sp.split_stratified(s.survey.select("id", "target"), "target", ["id"])


@query(
    "stratified_folds",
    with_survey(
        _BINNED + "SELECT id, CAST(" + " + ".join(f"CAST(rk2 >= (nb * {i}) // 5 AS INT)" for i in range(1, 5)) + " AS INT) AS fold FROM strat"
    ),
)
def _(s: Source):
    return sp.stratified_folds(s.survey.select("id", "target"), "target", ["id"]).select("id", "fold")


@query(
    "undersample",
    with_survey(
        "SELECT id, cat_rare FROM (SELECT id, cat_rare, row_number() OVER (PARTITION BY cat_rare ORDER BY md5(concat(CAST(id AS VARCHAR), '#42')), id) AS k FROM survey) "
        "WHERE k <= (SELECT min(n) FROM (SELECT count(*) AS n FROM survey GROUP BY cat_rare))"
    ),
)
def _(s: Source):
    return sp.undersample(s.survey.select("id", "cat_rare"), "cat_rare", ["id"])


@query("sample_n", with_survey("SELECT id, target FROM placed WHERE rk < 1000"))
def _(s: Source):
    return sp.sample_rows(s.survey.select("id", "target"), ["id"], n=1000)


@query("sample_fraction", with_survey("SELECT id, target FROM placed WHERE rk < trunc(nn * 0.1)"))
def _(s: Source):
    return sp.sample_rows(s.survey.select("id", "target"), ["id"], fraction=0.1)


@query("slice_rows", with_survey("SELECT id, target FROM placed WHERE rk >= 600 AND rk < 800"))
def _(s: Source):
    return sp.slice_rows(s.survey.select("id", "target"), ["id"], 600, 200)


@query(
    "qcut5",
    with_survey(
        "WITH e AS (SELECT quantile_cont(ord_a, [0.2, 0.4, 0.6, 0.8]) AS a, quantile_cont(target, [0.2, 0.4, 0.6, 0.8]) AS t FROM survey) "
        "SELECT id, concat('bin_', CAST("
        + " + ".join(f"CAST(target > t[{i}] AS INT)" for i in range(1, 5))
        + " AS VARCHAR)) AS target_bin, CASE WHEN ord_a IS NOT NULL THEN concat('bin_', CAST("
        + " + ".join(f"CAST(ord_a > a[{i}] AS INT)" for i in range(1, 5))
        + " AS VARCHAR)) END AS ord_bin FROM survey, e"
    ),
)
def _(s: Source):
    labels = [f"bin_{i}" for i in range(5)]
    df = sp.quantile_bins(s.survey.select("id", "target", "ord_a"), "target", labels, "target_bin")
    return sp.quantile_bins(df, "ord_a", labels, "ord_bin").select("id", "target_bin", "ord_bin")


# --- feature selection -------------------------------------------------------

FEATURES = ["q1_average_score", "q1_total_timing", "num_low_missing", "num_high_missing", "num_sparse", "ord_a", "ord_b", "country_id"]
_TENTHS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"


def _xbin(c: str) -> str:
    return (
        f"SELECT '{c}' AS variable, s.id, CASE WHEN s.{c} IS NULL THEN -1 ELSE "
        f"(SELECT count(*) FROM (SELECT DISTINCT unnest(quantile_cont({c}, {_TENTHS})) AS e FROM survey) q WHERE q.e <= s.{c}) END AS b FROM survey s"
    )


_MI = (
    "ybins AS (" + _xbin("target") + "), xbins AS (" + "\nUNION ALL\n".join(_xbin(c) for c in FEATURES) + "), "
    "cells AS (SELECT x.variable, x.b AS xb, y.b AS yb, count(*) AS n FROM xbins x JOIN ybins y USING (id) GROUP BY 1, 2, 3), "
    "marked AS (SELECT *, sum(n) OVER (PARTITION BY variable) AS total, sum(n) OVER (PARTITION BY variable, xb) AS nx, "
    "sum(n) OVER (PARTITION BY variable, yb) AS ny FROM cells), "
    "mi AS (SELECT variable, sum(n / total * ln(CAST(n AS DOUBLE) * total / (CAST(nx AS DOUBLE) * ny))) AS mi FROM marked GROUP BY variable)"
)


@query("mi_rank", with_survey(f"WITH {_MI} SELECT variable, round(mi, 6) AS score, CAST(row_number() OVER (ORDER BY mi DESC, variable) AS INT) AS rank FROM mi"))
def _(s: Source):
    out = sel.ranked(sel.mutual_information(s.survey, FEATURES, "target"), "mi")
    return out.withColumn("score", F.round("score", 6))


def _digamma(m: str) -> str:
    small = ", ".join(repr(sum(1.0 / i for i in range(1, k)) - 0.5772156649015329) for k in range(1, 10))
    x = f"CAST({m} AS DOUBLE)"
    series = f"ln({x}) - 1 / (2 * {x}) - 1 / (12 * {x} ** 2) + 1 / (120 * {x} ** 4) - 1 / (252 * {x} ** 6) + 1 / (240 * {x} ** 8)"
    return f"CASE WHEN {m} < 10 THEN [{small}][CAST({m} AS INT)] ELSE {series} END"


_KNN_FEATURES = ["p_size", "p_partkey", "brand", "sparse"]
_KNN_TABLE = (
    "(SELECT p_partkey, p_size, p_retailprice, CAST(substr(p_brand, 7) AS DOUBLE) AS brand, "
    "CASE WHEN p_partkey % 3 = 0 THEN p_size * p_retailprice END AS sparse FROM part)"
)


def _knn_mi(c: str) -> str:
    return (
        f"SELECT '{c}' AS variable, any_value(n) AS n, greatest(any_value({_digamma('n')}) + {_digamma('5')} - avg({_digamma('nx')} + {_digamma('ny')}), 0) AS mi "
        "FROM (SELECT r.id, r.n, count(*) FILTER (WHERE abs(q.x - r.x) <= greatest(r.r - 1, 0)) AS nx, "
        "count(*) FILTER (WHERE abs(q.y - r.y) <= greatest(r.r - 1, 0)) AS ny FROM "
        f"(SELECT p.id, any_value(p.x) AS x, any_value(p.y) AS y, any_value(p.n) AS n, list_sort(list(greatest(abs(p.x - q.x), abs(p.y - q.y))))[5] AS r FROM g_{c} p JOIN g_{c} q ON p.id <> q.id GROUP BY p.id) r, "
        f"g_{c} q GROUP BY r.id, r.n)"
    )


def _on_grid(c: str) -> str:
    grid = lambda v: f"CAST(floor({v} * (1073741824.0 / stddev_pop({v}) OVER ()) + 0.5) AS BIGINT)"
    return (
        f"g_{c} AS (SELECT p_partkey AS id, {grid(f'CAST({c} AS DOUBLE)')} AS x, {grid('p_retailprice')} AS y, count(*) OVER () AS n "
        f"FROM {_KNN_TABLE} WHERE {c} IS NOT NULL AND p_retailprice IS NOT NULL)"
    )


@query(
    "mi_neighbours",
    "WITH " + ", ".join(_on_grid(c) for c in _KNN_FEATURES) + " SELECT variable, CAST(n AS BIGINT) AS n, round(mi, 6) AS mi FROM ("
    + "\nUNION ALL\n".join(_knn_mi(c) for c in _KNN_FEATURES) + ")",
)
def _(s: Source):
    df = s.spark.sql("SELECT * FROM " + _KNN_TABLE.replace("FROM part", "FROM {part}"), part=s.table("part"))
    return neighbour_information(df, _KNN_FEATURES, "p_retailprice").withColumn("mi", F.round("mi", 6))


_CR = "cr AS (" + "\nUNION ALL\n".join(f"SELECT '{c}' AS variable, abs(corr({c}, target)) AS r FROM survey" for c in FEATURES) + ")"
_SETS = (
    f"WITH {_MI}, {_CR}, a AS (SELECT variable, CAST(row_number() OVER (ORDER BY mi DESC, variable) AS INT) AS rank_mi FROM mi QUALIFY rank_mi <= 4), "
    "b AS (SELECT variable, CAST(row_number() OVER (ORDER BY r DESC, variable) AS INT) AS rank_rfe FROM cr QUALIFY rank_rfe <= 4), "
    "sets AS (SELECT coalesce(a.variable, b.variable) AS variable, CASE WHEN rank_mi IS NOT NULL AND rank_rfe IS NOT NULL THEN 'both' "
    "WHEN rank_mi IS NOT NULL THEN 'mi_only' ELSE 'rfe_only' END AS side, rank_mi, rank_rfe FROM a FULL JOIN b ON a.variable = b.variable) "
)


def _sets(s: Source):
    mi = sel.ranked(sel.mutual_information(s.survey, FEATURES, "target"), "mi", 4)
    corr = assoc.pearson_matrix(s.survey, ["target", *FEATURES]).where("var_a = 'target'")
    other = sel.ranked(corr.select(F.col("var_b").alias("variable"), F.abs("r").alias("r")), "r", 4)
    return sel.feature_sets(mi, other)


@query("feature_sets", with_survey(_SETS + "SELECT * FROM sets"))
def _(s: Source):
    return _sets(s)


@query(
    "feature_merge",
    with_survey(
        _SETS + "SELECT variable, CAST(row_number() OVER (ORDER BY CASE WHEN side = 'both' THEN 0 ELSE 1 END, k, side) AS INT) AS position FROM "
        "(SELECT variable, side, row_number() OVER (PARTITION BY side ORDER BY coalesce(rank_mi, rank_rfe), variable) AS k FROM sets) QUALIFY position <= 5"
    ),
)
def _(s: Source):
    return sel.merge_features(_sets(s), 5)


def _complete(s: Source):
    """The survey without nulls, as the forest needs it."""
    df = s.survey.select("id", "target", *FEATURES)
    return RemainingFill().fit(df).transform(df)


@query("rf_grid")
def _(s: Source):
    return sel.forest_grid(_complete(s), FEATURES, "target", ["id"], trees=[5, 10], depths=[3, 5], folds=3)


@query("rfe_rank")
def _(s: Source):
    return sel.eliminate(_complete(s), FEATURES, "target", ["id"], n_features=4, trees=10, depth=5)


@query("forest_importance")
def _(s: Source):
    return sel.forest_importance(s.survey, ["cat_low", "cat_rare", "country", "ord_a"], "target", ["id"])


@query("fs_project_splits", with_survey(_BINNED + "SELECT id, num_low_missing, ord_a, target, split FROM strat"))
def _(s: Source):
    split = sp.split_stratified(s.survey, "target", ["id"])
    root = scratch_path(s.spark, "splits")
    tables.write_splits(project_splits(split, ["id"], ["num_low_missing", "ord_a"], "target"), root, "20240101_000000")
    return tables.read_latest_run(s.spark, root)


@query("fs_job")
def _(s: Source):
    result = run_selection(_complete(s), FEATURES, "target", ["id"], n_features=5, folds=2, trees=[5], depths=[3, 5])
    return result.data


@query("fs_report")
def _(s: Source):
    result = run_selection(_complete(s), FEATURES, "target", ["id"], n_features=5, folds=2, trees=[5], depths=[5])
    path = scratch_path(s.spark, "report")
    tables.selection_frame(s.spark, result.report, "20240101_000000").write.json(path)
    return s.spark.read.json(path).select("method", "n_features_original", "n_features_selected", F.explode("selected_features").alias("feature"))


@query("permutation_importance")
def _(s: Source):
    df = _complete(s)
    names = FEATURES
    table = sel.training_table(df, names, "target", ["id"], 2, 42)
    model = sel.forest(10, 5, 42).fit(sel.assembled(table, names))
    return sel.permutation_importance(df, model, names, "target", ["id"])


# --- forests on planted signal: ranks and exact zeros follow from the data ----

#: ``country_id`` alone makes the target; ``flat`` is constant; ``cat_bin`` splits in two.
_PLANTED = (
    "planted AS (SELECT id, CAST(10 * country_id AS DOUBLE) AS y, country_id, coalesce(num_low_missing, 0) AS num, 1 AS flat, "
    "cat_bin, coalesce(cat_low, '') AS cat_low, meta_const, CASE WHEN cat_bin = 'O' THEN 1 ELSE 0 END AS half, "
    "CASE WHEN cat_bin = 'O' THEN 100.0 ELSE 0.0 END AS step FROM {survey}) "
)


def _planted(s: Source):
    return s.spark.sql("WITH " + _PLANTED + "SELECT * FROM planted", survey=s.survey)


def _planted_sql(body: str) -> str:
    return with_survey("WITH " + _PLANTED.format(survey="survey") + body)


@query(
    "rf_grid_planted",
    _planted_sql(
        ", rest AS (SELECT avg((step - m) * (step - m)) AS mse FROM (SELECT step, avg(step) OVER (PARTITION BY half) AS m FROM planted)) "
        "SELECT CAST(t AS INT) AS n_estimators, CAST(d AS INT) AS max_depth, mse, t = 5 AND d = 1 AS best FROM rest, (VALUES (5), (10)) AS a(t), (VALUES (1), (3)) AS b(d)"
    ),
)
def _(s: Source):
    out = sel.forest_grid(_planted(s), ["half"], "step", ["id"], trees=[5, 10], depths=[1, 3])
    return out.withColumn("mse", F.round("mse", 6))


_BY_CORR = ", ".join(f"CASE WHEN var_pop({c}) > 0 THEN pow(corr({c}, y), 2) ELSE 0.0 END AS {c}" for c in ("country_id", "num", "flat"))


@query(
    "rfe_rank_planted",
    _planted_sql(
        f", r AS (SELECT {_BY_CORR} FROM planted) SELECT variable, CAST(row_number() OVER (ORDER BY r DESC, variable) AS INT) AS rank "
        "FROM (UNPIVOT r ON country_id, num, flat INTO NAME variable VALUE r)"
    ),
)
def _(s: Source):
    return sel.eliminate(_planted(s), ["country_id", "num", "flat"], "y", ["id"], n_features=1, trees=10, depth=5).select("variable", "rank")


_BETWEEN = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, (SELECT sum(n * (m - a) * (m - a)) FROM (SELECT count(*) AS n, avg(step) AS m FROM planted GROUP BY {c}), (SELECT avg(step) AS a FROM planted)) AS between"
    for c in ("cat_bin", "cat_low", "meta_const")
)


@query(
    "forest_importance_planted",
    _planted_sql(
        f", b AS ({_BETWEEN}) SELECT variable, CAST(row_number() OVER (ORDER BY round(between, 6) DESC, variable) AS INT) AS rank FROM b"
    ),
)
def _(s: Source):
    found = sel.forest_importance(_planted(s), ["cat_bin", "cat_low", "meta_const"], "step", ["id"])
    return sel.ranked(found, "importance", 3).select("variable", "rank")


@query(
    "permutation_planted",
    _planted_sql(
        "SELECT 'country_id' AS variable, CAST(var_pop(country_id) > 0 AS INT) AS sign FROM planted "
        "UNION ALL SELECT 'flat', CAST(var_pop(flat) > 0 AS INT) FROM planted"
    ),
)
def _(s: Source):
    df, names = _planted(s), ["country_id", "flat"]
    model = sel.forest(10, 5, 42).fit(sel.assembled(sel.training_table(df, names, "y", ["id"], 2, 42), names))
    found = sel.permutation_importance(df, model, names, "y", ["id"])
    return found.select("variable", F.signum("importance").cast("int").alias("sign"))


_BEST = f", r AS (SELECT {_BY_CORR} FROM planted), best AS (SELECT variable FROM (UNPIVOT r ON country_id, num, flat INTO NAME variable VALUE r) ORDER BY r DESC, variable LIMIT 1)"


def _selected(s: Source):
    """One of three columns, by the whole job over the default folds and depths."""
    return run_selection(_planted(s), ["country_id", "num", "flat"], "y", ["id"], n_features=1, trees=[5, 10])


@query(
    "fs_job_planted",
    _planted_sql(
        _BEST + " SELECT id, y, variable, CASE variable WHEN 'country_id' THEN CAST(country_id AS DOUBLE) WHEN 'num' THEN num ELSE flat END AS value "
        "FROM planted, best"
    ),
)
def _(s: Source):
    data = _selected(s).data
    # which column it is, the job says
    (found,) = set(data.columns) - {"id", "y", "split"}
    return data.select("id", "y", F.lit(found).alias("variable"), F.col(found).cast("double").alias("value"))


@query(
    "fs_report_planted",
    _planted_sql(
        _BEST + " SELECT 'hybrid_mi_rfe' AS method, CAST(3 AS BIGINT) AS n_features_original, count(*) AS n_features_selected, "
        "min(variable) AS feature, min(variable) AS shared FROM best"
    ),
)
def _(s: Source):
    path = scratch_path(s.spark, "report")
    tables.selection_frame(s.spark, _selected(s).report, "20240101_000000").write.json(path)
    report = s.spark.read.json(path)
    return report.select("method", "n_features_original", "n_features_selected", F.explode("selected_features").alias("feature"), F.array_join("intersection", ",").alias("shared"))
