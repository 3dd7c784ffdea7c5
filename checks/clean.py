"""Imputation, outliers, scaling, derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Source, query, with_survey
from sparkprep.functions.scalar import col
from sparkprep.operators import derive, impute, scale
from sparkprep.operators.columns import ColumnDropper
from sparkprep.operators.knn import KnnFill
from sparkprep.operators.stats import group_counts

NUM = ["num_low_missing", "num_high_missing"]
ORDINAL = ["ord_a", "ord_b"]


def _r6(df, names):
    return df.withColumns({c: F.round(col(c), 6) for c in names})


@query(
    "fill_sentinel",
    with_survey("SELECT id, coalesce(q1_average_score, -1) AS q1_average_score, coalesce(q1_total_timing, -1) AS q1_total_timing FROM survey"),
)
def _(s: Source):
    return impute.SentinelFill().transform(s.survey.select("id", "q1_average_score", "q1_total_timing"))


@query(
    "timing_cap",
    with_survey(
        "SELECT id, CASE WHEN coalesce(q1_total_timing, -1) <> -1 THEN least(q1_total_timing / 1000, 1800) ELSE -1 END AS q1_total_timing FROM survey"
    ),
)
def _(s: Source):
    df = s.survey.select("id", "q1_total_timing")
    return scale.TimingCap().transform(impute.SentinelFill().transform(df))


@query(
    "num_clean_other",
    with_survey(
        "SELECT id, coalesce(num_low_missing, (SELECT median(num_low_missing) FROM survey)) AS num_low_missing, "
        "coalesce(num_high_missing, -1) AS num_high_missing, target FROM survey"
    ),
)
def _(s: Source):
    df = s.survey.select("id", *NUM, "num_sparse", "target")
    kept = ColumnDropper(inputCols=["num_sparse"], strict=True).transform(df)
    return impute.TieredFill().fit(kept).transform(kept)


@query(
    "impute_median",
    with_survey(
        "SELECT id, CAST(coalesce(ord_a, (SELECT median(ord_a) FROM survey)) AS DOUBLE) AS ord_a, "
        "CAST(coalesce(ord_b, (SELECT median(ord_b) FROM survey)) AS DOUBLE) AS ord_b FROM survey"
    ),
)
def _(s: Source):
    df = s.survey.select("id", *ORDINAL)
    return impute.MedianFill(inputCols=ORDINAL).fit(df).transform(df)


def _mode(c: str, table: str) -> str:
    return f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "impute_mode",
    with_survey(
        f"SELECT id, coalesce(ord_a, {_mode('ord_a', 'survey')}) AS ord_a, coalesce(cat_low, {_mode('cat_low', 'survey')}) AS cat_low, "
        f"coalesce(isco, {_mode('isco', 'survey')}) AS isco FROM survey"
    ),
)
def _(s: Source):
    df = s.survey.select("id", "ord_a", "cat_low", "isco")
    return impute.ModeFill(inputCols=["ord_a", "cat_low", "isco"]).fit(df).transform(df)


@query(
    "impute_mode_fit",
    with_survey(
        f"SELECT id, split, coalesce(ord_a, {_mode('ord_a', 'train')}) AS ord_a, coalesce(cat_low, {_mode('cat_low', 'train')}) AS cat_low, "
        f"coalesce(isco, {_mode('isco', 'train')}) AS isco FROM parts"
    ),
)
def _(s: Source):
    names = ["ord_a", "cat_low", "isco"]
    model = impute.ModeFill(inputCols=names, fillEmpty=False).fit(s.train)
    return model.transform(s.parts.select("id", "split", *names))


@query(
    "impute_remaining",
    with_survey(
        "SELECT id, coalesce(q1_average_score, (SELECT median(q1_average_score) FROM survey)) AS q1_average_score, "
        "round(coalesce(num_high_missing, (SELECT median(num_high_missing) FROM survey)), 6) AS num_high_missing, "
        "CAST(coalesce(ord_a, (SELECT median(ord_a) FROM survey)) AS DOUBLE) AS ord_a, "
        f"coalesce(cat_low, {_mode('cat_low', 'survey')}) AS cat_low, cat_bin FROM survey"
    ),
)
def _(s: Source):
    df = s.survey.select("id", "q1_average_score", "num_high_missing", "ord_a", "cat_low", "cat_bin")
    return _r6(impute.RemainingFill().fit(df).transform(df), ["num_high_missing"])


_NEAR = """(SELECT sum(t * y) / sum(t) FROM (
    SELECT y, least(n, 5 - coalesce(sum(n) OVER (ORDER BY d2, da, db ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS t
    FROM (SELECT {y} AS y, d.n, {d2} AS d2, coalesce(d.a, 1e9) AS da, coalesce(d.b, 1e9) AS db
          FROM donors d WHERE {y} IS NOT NULL AND {d2} IS NOT NULL)) WHERE t > 0)"""


#: ``filled``: each (ord_a, ord_b) profile of the survey with its neighbour fill from the training rows.
KNN_CTES = (
    "donors AS (SELECT ord_a AS a, ord_b AS b, count(*) AS n FROM train GROUP BY ord_a, ord_b),\n"
    "seen AS (SELECT DISTINCT ord_a AS a, ord_b AS b FROM survey),\n"
    "filled AS (SELECT s.a, s.b, "
    "CASE WHEN s.a IS NOT NULL THEN s.a WHEN s.b IS NULL THEN (SELECT avg(ord_a) FROM train) ELSE "
    + _NEAR.format(y="d.a", d2="(2 * (s.b - d.b) * (s.b - d.b))")
    + " END AS fa, CASE WHEN s.b IS NOT NULL THEN s.b WHEN s.a IS NULL THEN (SELECT avg(ord_b) FROM train) ELSE "
    + _NEAR.format(y="d.b", d2="(2 * (s.a - d.a) * (s.a - d.a))")
    + " END AS fb FROM seen s)"
)


@query(
    "impute_knn",
    with_survey(
        f"WITH {KNN_CTES}\nSELECT v.id, round(f.fa, 6) AS ord_a, round(f.fb, 6) AS ord_b FROM survey v "
        "JOIN filled f ON v.ord_a IS NOT DISTINCT FROM f.a AND v.ord_b IS NOT DISTINCT FROM f.b"
    ),
)
def _(s: Source):
    model = KnnFill(inputCols=ORDINAL, k=5).fit(s.train)
    return _r6(model.transform(s.survey.select("id", *ORDINAL)), ORDINAL)


@query(
    "missing_flags",
    with_survey(
        "SELECT id, ord_a, cat_low, CAST(ord_a IS NULL AS INT) AS ord_a_is_missing, CAST(cat_low IS NULL AS INT) AS cat_low_is_missing FROM survey"
    ),
)
def _(s: Source):
    return derive.missing_flags(s.survey.select("id", "ord_a", "cat_low"), ["ord_a", "cat_low"])


# --- outliers and scaling ----------------------------------------------------


def _at(c: str, q: float, table: str) -> str:
    return (
        f"(SELECT max(CASE WHEN rn = floor({q} * (n - 1) + 0.5) THEN x END) FROM (SELECT {c} AS x, "
        f"row_number() OVER (ORDER BY {c}) - 1 AS rn, count(*) OVER () AS n FROM {table} WHERE {c} IS NOT NULL))"
    )


def _clipped(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN greatest({_at(c, 0.01, 'train')}, least({c}, {_at(c, 0.99, 'train')})) END AS {c}"


@query("winsorize", with_survey(f"SELECT id, split, {_clipped('num_low_missing')}, {_clipped('q1_total_timing')} FROM parts"))
def _(s: Source):
    names = ["num_low_missing", "q1_total_timing"]
    return scale.Winsorizer(inputCols=names).fit(s.train).transform(s.parts.select("id", "split", *names))


def _minmax(c: str) -> str:
    lo, hi = (f"(SELECT {f}({c}) FROM survey WHERE {c} <> -1)" for f in ("min", "max"))
    return f"round(CASE WHEN {c} <> -1 THEN ({c} - {lo}) / ({hi} - {lo}) ELSE -1 END, 9) AS {c}"


@query(
    "minmax_flag",
    with_survey(f"SELECT id, {_minmax('q1_total_timing')}, {_minmax('num_high_missing')}, {_minmax('target')} FROM survey"),
)
def _(s: Source):
    names = ["q1_total_timing", "num_high_missing", "target"]
    df = s.survey.select("id", *names)
    out = scale.FlagMinMaxScaler(inputCols=names).fit(df).transform(df)
    return out.withColumns({c: F.round(c, 9) for c in names})


def _plain(c: str) -> str:
    lo, hi = (f"(SELECT {f}({c}) FROM survey)" for f in ("min", "max"))
    return f"round(({c} - {lo}) / ({hi} - {lo}), 9) AS {c}"


@query("minmax_plain", with_survey(f"SELECT id, {_plain('num_low_missing')}, {_plain('ord_a')} FROM survey"))
def _(s: Source):
    names = ["num_low_missing", "ord_a"]
    df = s.survey.select("id", *names)
    out = scale.FlagMinMaxScaler(inputCols=names, keepFlag=False).fit(df).transform(df)
    return out.withColumns({c: F.round(c, 9) for c in names})


def _standard(c: str) -> str:
    return f"round(({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train), 6) AS {c}"


@query("standardize", with_survey(f"SELECT id, split, {', '.join(_standard(c) for c in ('ord_a', 'num_low_missing'))} FROM parts"))
def _(s: Source):
    names = ["ord_a", "num_low_missing"]
    model = scale.PopulationScaler(inputCols=names).fit(s.train)
    return _r6(model.transform(s.parts.select("id", "split", *names)), names)


# --- derived features --------------------------------------------------------


@query(
    "composite_mean",
    with_survey(
        "SELECT id, cat_low, CASE WHEN ord_a IS NULL AND ord_b IS NULL THEN NULL ELSE (coalesce(ord_a, 0) + coalesce(ord_b, 0)) / "
        "(CAST(ord_a IS NOT NULL AS INT) + CAST(ord_b IS NOT NULL AS INT)) END AS support FROM survey"
    ),
)
def _(s: Source):
    step = derive.CompositeMean(definitions={"support": ["ord_a", "ord_b"], "unused": ["cat_low", "ST999"]})
    return step.transform(s.survey.select("id", "ord_a", "ord_b", "cat_low"))


@query("isco_group", with_survey("SELECT id, TRY_CAST(substr(isco, 1, 1) AS BIGINT) AS isco_grouped FROM survey"))
def _(s: Source):
    return derive.OccupationGrouper(inputCols=["isco"]).transform(s.survey.select("id", "isco"))


@query(
    "code_distribution",
    with_survey("SELECT TRY_CAST(substr(isco, 1, 1) AS BIGINT) AS isco_grouped, count(*) AS n FROM survey GROUP BY 1"),
)
def _(s: Source):
    grouped = derive.OccupationGrouper(inputCols=["isco"]).transform(s.survey)
    return group_counts(grouped, "isco_grouped", ordered=True)


@query(
    "isco_group_padded",
    with_survey("SELECT id, TRY_CAST(substr(lpad(CAST(CAST(isco AS INT) AS VARCHAR), 4, '0'), 1, 1) AS BIGINT) AS isco_grouped FROM survey"),
)
def _(s: Source):
    as_number = s.survey.select("id", F.col("isco").cast("int").alias("isco"))
    return derive.OccupationGrouper(inputCols=["isco"], width=4).transform(as_number)


_TIME = "(SELECT id, coalesce(q1_average_score, -1) AS s, CASE WHEN q1_total_timing IS NULL THEN -1 ELSE least(q1_total_timing / 1000, 1800) END AS t FROM survey)"


@query(
    "interaction_features",
    with_survey(
        "SELECT id, CASE WHEN t > 0 AND t < 5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS q1_is_fast_guesser, "
        f"round(CASE WHEN t > 0 THEN s / t ELSE -1 END, 9) AS q1_efficiency FROM {_TIME}"
    ),
)
def _(s: Source):
    df = s.survey.select("id", "q1_average_score", "q1_total_timing")
    out = derive.InteractionFeatures().transform(scale.TimingCap().transform(impute.SentinelFill().transform(df)))
    return out.withColumn("q1_efficiency", F.round("q1_efficiency", 9))


@query("mismatch", with_survey("SELECT id, cat_bin IS DISTINCT FROM cat_rare AS differs FROM survey"))
def _(s: Source):
    return derive.mismatch(s.survey.select("id", "cat_bin", "cat_rare"), "cat_bin", "cat_rare", "differs").select("id", "differs")


@query(
    "offset_from_group_mode",
    with_survey(
        "WITH m AS (SELECT country, ord_a AS mode FROM (SELECT country, ord_a, row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, ord_a) AS k "
        "FROM survey WHERE ord_a IS NOT NULL GROUP BY country, ord_a) WHERE k = 1) "
        "SELECT id, ord_a - m.mode AS grade FROM survey s LEFT JOIN m ON s.country = m.country"
    ),
)
def _(s: Source):
    return derive.offset_from_group_mode(s.survey.select("id", "ord_a", "country"), "ord_a", "country", "grade").select("id", "grade")


@query(
    "weighted_composite",
    with_survey(
        "SELECT id, round((coalesce(ord_a, 0) * 2.0 + coalesce(ord_b, 0) * 0.5) / nullif(CASE WHEN ord_a IS NULL THEN 0.0 ELSE 2.0 END + "
        "CASE WHEN ord_b IS NULL THEN 0.0 ELSE 0.5 END, 0), 6) AS ses FROM survey"
    ),
)
def _(s: Source):
    out = derive.weighted_sum(s.survey.select("id", "ord_a", "ord_b"), {"ord_a": 2.0, "ord_b": 0.5}, "ses")
    return out.select("id", F.round("ses", 6).alias("ses"))
