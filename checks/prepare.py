"""Whole plans, validation reports, model storage and streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks.base import SURVEY_COLUMNS, SURVEY_SQL, Source, query, with_survey
from checks.clean import KNN_CTES
from sparkprep.functions.scalar import col
from sparkprep.operators import derive
from sparkprep.operators import validate as va
from sparkprep.operators.component import fit_component
from sparkprep.operators.impute import RemainingFill
from sparkprep.operators.knn import KnnFill
from sparkprep.plans import full, numeric, preprocessors
from sparkprep.plans.roles import VariableRoles
from sparkprep.session import scratch_path
from sparkprep.streaming.apply import write_transformed

NUMERIC = ["q1_average_score", "q1_total_timing", "num_low_missing", "num_high_missing", "num_sparse"]
ROLES = VariableRoles(
    numeric=NUMERIC,
    grouping=["country_id", "country"],
    ordinal=["ord_a", "ord_b"],
    categorical=["cat_bin", "cat_low", "cat_rare", "isco", "meta_const"],
)
_CLEAN = (
    "CAST(coalesce(q1_average_score, -1) AS DOUBLE) AS q1_average_score, "
    "CASE WHEN coalesce(q1_total_timing, -1) <> -1 THEN least(q1_total_timing / 1000, 1800) ELSE -1 END AS q1_total_timing, "
    "coalesce(num_low_missing, (SELECT median(num_low_missing) FROM {t})) AS num_low_missing, "
    "coalesce(num_high_missing, -1) AS num_high_missing"
)


@query("numeric_clean", with_survey(f"SELECT id, {_CLEAN.format(t='survey')} FROM survey"))
def _(s: Source):
    df = s.survey.select("id", *NUMERIC)
    return numeric.NumericCleaner(inputCols=NUMERIC).fit(df).transform(df)


@query("model_store", with_survey(f"SELECT id, {_CLEAN.format(t='survey')} FROM survey"))
def _(s: Source):
    df = s.survey.select("id", *NUMERIC)
    path = scratch_path(s.spark, "model")
    numeric.NumericCleaner(inputCols=NUMERIC).fit(df).save(path)
    return PipelineModel.load(path).transform(df)


@query("stream_apply", with_survey(f"SELECT id, {_CLEAN.format(t='survey')} FROM survey"))
def _(s: Source):
    df = s.survey.select("id", *NUMERIC)
    model = numeric.NumericCleaner(inputCols=NUMERIC).fit(df)
    orders = s.table("orders")
    arriving = s.spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet").parquet(s.sf_dir)
    stream = s.spark.sql(SURVEY_SQL, orders=arriving, customer=s.table("customer"), nation=s.table("nation"))
    out = scratch_path(s.spark, "stream")
    write_transformed(model, stream.select("id", *NUMERIC), out, scratch_path(s.spark, "progress")).awaitTermination()
    return s.spark.read.parquet(out)


@query(
    "stage1",
    with_survey(
        "SELECT id, target, ord_a, ord_b, cat_bin, cat_low, cat_rare, isco, meta_const, split, "
        + _CLEAN.format(t="train")
        + ", CAST(country_id AS DOUBLE) AS country_id FROM parts"
    ),
)
def _(s: Source):
    model = numeric.fit_stage1(s.train, ROLES, text_codes=["country"])
    return model.transform(s.parts)


ORDINAL = preprocessors.OrdinalPreprocessor(
    inputCols=["ord_a", "ord_b", "country_id"], redundantCols=["meta_const"], definitions={"support": ["ord_a", "ord_b"]}
)
CATEGORICAL = preprocessors.CategoricalPreprocessor(
    inputCols=["cat_bin", "cat_low", "cat_rare", "isco", "country", "meta_const"],
    metadataCols=["meta_const"],
    redundantCols=["country"],
    codeCols=["isco"],
)
_SUPPORT = (
    "CASE WHEN ord_a IS NULL AND ord_b IS NULL THEN NULL ELSE (coalesce(ord_a, 0) + coalesce(ord_b, 0)) / "
    "(CAST(ord_a IS NOT NULL AS INT) + CAST(ord_b IS NOT NULL AS INT)) END"
)


@query(
    "ordinal_fit_transform",
    with_survey(
        f"WITH c AS (SELECT *, {_SUPPORT} AS support FROM survey) SELECT id, cat_low, CAST(country_id AS DOUBLE) AS country_id, "
        "coalesce(support, (SELECT median(support) FROM c)) AS support FROM c"
    ),
)
def _(s: Source):
    df = s.survey.select("id", "ord_a", "ord_b", "country_id", "cat_low", "meta_const")
    return ORDINAL.fit(df).transform(df)


@query("ordinal_transform", with_survey(f"SELECT id, cat_low, country_id, {_SUPPORT} AS support FROM parts WHERE split = 'test'"))
def _(s: Source):
    df = s.parts.select("id", "ord_a", "ord_b", "country_id", "cat_low", "meta_const", "split")
    model = ORDINAL.fit(df.where("split = 'train'"))
    return model.shape(df.where("split = 'test'").drop("split"))


_CODE = "TRY_CAST(substr(isco, 1, 1) AS BIGINT)"


def _mode(c: str, table: str) -> str:
    return f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "categorical_fit_transform",
    with_survey(
        f"WITH c AS (SELECT *, {_CODE} AS isco_grouped FROM survey) SELECT id, cat_bin, coalesce(cat_low, {_mode('cat_low', 'c')}) AS cat_low, "
        f"cat_rare, coalesce(isco_grouped, {_mode('isco_grouped', 'c')}) AS isco_grouped FROM c"
    ),
)
def _(s: Source):
    df = s.survey.select("id", "country", "cat_bin", "cat_low", "cat_rare", "isco", "meta_const")
    return CATEGORICAL.fit(df).transform(df)


@query("categorical_transform", with_survey(f"SELECT id, cat_bin, cat_low, cat_rare, {_CODE} AS isco_grouped FROM parts WHERE split = 'test'"))
def _(s: Source):
    df = s.parts.select("id", "country", "cat_bin", "cat_low", "cat_rare", "isco", "meta_const", "split")
    model = CATEGORICAL.fit(df.where("split = 'train'"))
    return model.shape(df.where("split = 'test'").drop("split"))


def _stage2_fit(df):
    ordinal = preprocessors.OrdinalPreprocessor(
        inputCols=["ord_a", "ord_b"], redundantCols=["num_high_missing"], definitions={"support": ["ord_a", "ord_b"]}
    )
    return preprocessors.Stage2(ordinal, CATEGORICAL).fit(df)


_C = f"c AS (SELECT *, {_SUPPORT} AS support, {_CODE} AS isco_grouped FROM {{t}})"


def _stage2_row(t: str) -> str:
    med = lambda c: f"coalesce({c}, (SELECT median({c}) FROM {t})) AS {c}"
    return (
        f"id, country_id, target, {med('q1_average_score')}, {med('q1_total_timing')}, {med('num_low_missing')}, "
        f"cat_bin, coalesce(cat_low, {_mode('cat_low', t)}) AS cat_low, cat_rare, {med('support')}, "
        f"coalesce(isco_grouped, {_mode('isco_grouped', t)}) AS isco_grouped"
    )


@query("stage2", with_survey(f"WITH {_C.format(t='survey')} SELECT {_stage2_row('c')} FROM c"))
def _(s: Source):
    return _stage2_fit(s.survey).transform(s.survey)


@query(
    "stage2_apply",
    with_survey(
        f"WITH {_C.format(t='parts')}, t AS (SELECT * FROM c WHERE split = 'train') SELECT {_stage2_row('t')} FROM c WHERE split = 'test'"
    ),
)
def _(s: Source):
    test = s.parts.where("split = 'test'").drop("split")
    return _stage2_fit(s.train.drop("split")).transform(test)


@query(
    "stage2_apply_refit",
    with_survey(
        f"WITH {_C.format(t='parts')}, t AS (SELECT * FROM c WHERE split = 'test') SELECT {_stage2_row('t')}, "
        "coalesce(num_sparse, (SELECT median(num_sparse) FROM t)) AS num_sparse FROM t"
    ).replace("coalesce(isco_grouped, (SELECT isco_grouped FROM t WHERE isco_grouped IS NOT NULL GROUP BY isco_grouped ORDER BY count(*) DESC, isco_grouped LIMIT 1)) AS isco_grouped",
              "coalesce(isco_grouped, (SELECT median(isco_grouped) FROM t)) AS isco_grouped"),
)
def _(s: Source):
    test = s.parts.where("split = 'test'").drop("split")
    return _stage2_fit(s.train.drop("split")).transform_refit(test)


def _nearest(c: str, q: float) -> str:
    return (
        f"(SELECT max(CASE WHEN rn = floor({q} * (n - 1) + 0.5) THEN x END) FROM (SELECT {c} AS x, "
        f"row_number() OVER (ORDER BY {c}) - 1 AS rn, count(*) OVER () AS n FROM base WHERE split = 'train'))"
    )


def _coded(c: str) -> str:
    return f"code_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS code FROM clipped WHERE split = 'train' GROUP BY {c})"


def _scaled(c: str, name: str) -> str:
    part = f"(SELECT {{f}}({c}) FROM coded WHERE split = 'train')"
    return f"round(({c} - {part.format(f='avg')}) / {part.format(f='stddev_pop')}, 6) AS {name}"


_LEVELS = {
    "cat_low": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "cat_rare": ["F", "O", "Other", "P"],
    "isco_grouped": [str(i) for i in range(10)],
}


@query(
    "full_pipeline",
    with_survey(
        f"WITH {KNN_CTES},\n"
        f"digits AS (SELECT *, {_CODE} AS g FROM parts),\n"
        "base AS (SELECT p.id, p.split, p.country_id, p.target, p.num_low_missing, CAST(f.fa AS DOUBLE) AS a, CAST(f.fb AS DOUBLE) AS b, p.cat_bin, "
        f"coalesce(p.cat_low, {_mode('cat_low', 'train')}) AS cat_low, p.cat_rare, "
        "coalesce(p.g, (SELECT g FROM digits WHERE split = 'train' AND g IS NOT NULL GROUP BY g ORDER BY count(*) DESC, g LIMIT 1)) AS isco_grouped "
        "FROM digits p JOIN filled f ON p.ord_a IS NOT DISTINCT FROM f.a AND p.ord_b IS NOT DISTINCT FROM f.b),\n"
        "clipped AS (SELECT * REPLACE ("
        + ", ".join(f"greatest({_nearest(c, 0.01)}, least({c}, {_nearest(c, 0.99)})) AS {c}" for c in "ab")
        + "), CASE WHEN cat_rare IN (SELECT cat_rare FROM base WHERE split = 'train' GROUP BY cat_rare "
        "HAVING count(*) / (SELECT count(*) FROM base WHERE split = 'train') < 0.01) THEN 'Other' ELSE cat_rare END AS rare FROM base),\n"
        + ",\n".join(_coded(c) for c in "ab")
        + ",\ncoded AS (SELECT c.* REPLACE (coalesce(x.code, -1) AS a, coalesce(y.code, -1) AS b) FROM clipped c "
        "LEFT JOIN code_a x ON c.a = x.a LEFT JOIN code_b y ON c.b = y.b)\n"
        f"SELECT id, split, country_id, target, num_low_missing, {_scaled('a', 'ord_a')}, {_scaled('b', 'ord_b')}, CAST(cat_bin = 'O' AS INT) AS cat_bin, "
        + ", ".join(
            f"""CAST({'rare' if c == 'cat_rare' else f'CAST({c} AS VARCHAR)'} = '{v}' AS DOUBLE) AS "{c}_{v}\""""
            for c, vs in _LEVELS.items()
            for v in vs
        )
        + " FROM coded"
    ),
)
def _(s: Source):
    ordinal = preprocessors.OrdinalPreprocessor(inputCols=["ord_a", "ord_b"], redundantCols=["num_high_missing"], definitions={})
    out, _ = full.full_plan(s.survey, ordinal, CATEGORICAL, ["id"], leakage_prefixes=["q1_"])
    return out.withColumns({c: F.round(c, 6) for c in ("ord_a", "ord_b")})


@query("knn_profiles", with_survey("SELECT ord_a, ord_b, count(*) AS n FROM train GROUP BY ord_a, ord_b"))
def _(s: Source):
    table = KnnFill(inputCols=["ord_a", "ord_b"]).fit(s.train).table
    return table.select(F.col("x")[0].cast("int").alias("ord_a"), F.col("x")[1].cast("int").alias("ord_b"), "n")


@query(
    "pca_composite",
    with_survey(
        "WITH z AS (SELECT id, coalesce((num_low_missing - (SELECT avg(num_low_missing) FROM survey)) / (SELECT stddev_pop(num_low_missing) FROM survey), 0) AS a, "
        "coalesce((num_high_missing - (SELECT avg(num_high_missing) FROM survey)) / (SELECT stddev_pop(num_high_missing) FROM survey), 0) AS b FROM survey), "
        "m AS (SELECT var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS c FROM z), "
        "w AS (SELECT c, ((va + vb) / 2 + sqrt((va - vb) * (va - vb) / 4 + c * c)) - va AS d FROM m) "
        "SELECT id, round((a * c + b * d) / sqrt(c * c + d * d), 5) AS wealth FROM z, w"
    ),
)
def _(s: Source):
    out = derive.pca_composite(s.survey.select("id", "num_low_missing", "num_high_missing"), ["num_low_missing", "num_high_missing"], "wealth")
    return out.select("id", F.round("wealth", 5).alias("wealth"))


@query("component_missing")
def _(s: Source):
    names = ["num_low_missing", "num_high_missing", "target", "ord_a"]
    out = fit_component(s.survey, names).score(s.survey, "wealth")
    return out.select("id", F.round("wealth", 5).alias("wealth"))


# --- validation --------------------------------------------------------------

_COUNT_NULLS = "(" + " + ".join(f"(SELECT count(*) - count({c}) FROM survey)" for c in SURVEY_COLUMNS) + ")"


_VALIDATED = (
    "missing_values target_changed_rows n_features_before n_features_after features_dropped n_numeric_features n_non_numeric_features"
).split()


@query(
    "validate_report",
    with_survey(
        "SELECT 'filled' AS run, true AS validation_passed, 0 AS missing_values, 0 AS target_changed_rows, CAST(16 AS BIGINT) AS n_features_before, CAST(15 AS BIGINT) AS n_features_after, "
        "CAST(1 AS BIGINT) AS features_dropped, CAST(10 AS BIGINT) AS n_numeric_features, CAST(5 AS BIGINT) AS n_non_numeric_features, true AS all_checks_passed, "
        "'5 non-numeric columns: country, cat_bin, cat_low, cat_rare, isco' AS warnings "
        f"UNION ALL SELECT 'spoiled', {_COUNT_NULLS} = 0, {_COUNT_NULLS}, (SELECT count(*) FROM survey WHERE id % 100 = 0), 16, 16, 0, 10, 6, false, "
        "'6 non-numeric columns: country, cat_bin, cat_low, cat_rare, isco'"
    ),
)
def _(s: Source):
    rows = []
    filled = RemainingFill().fit(s.survey).transform(s.survey).drop("meta_const")
    spoiled = s.survey.withColumn("target", F.when(F.col("id") % 100 == 0, F.col("target") + 1).otherwise(F.col("target")))
    for run, after in (("filled", filled), ("spoiled", spoiled)):
        r = va.report_values(va.validate_preparation(s.survey, after, "target", ["id"]))
        passed = [r["result", n] == "true" for n in ("validation_passed", "all_checks_passed")]
        numbers = [int(r["stats", n]) for n in _VALIDATED]
        rows.append((run, passed[0], *numbers, passed[1], r["warnings", "all_numeric"]))
    return s.spark.createDataFrame(
        rows,
        "run string, validation_passed boolean, missing_values bigint, target_changed_rows bigint, n_features_before bigint, n_features_after bigint, "
        "features_dropped bigint, n_numeric_features bigint, n_non_numeric_features bigint, all_checks_passed boolean, warnings string",
    )


_FIXED_REPORT = {
    ("preprocessing_summary", "n_features_before"): "16",
    ("preprocessing_summary", "n_features_after"): "11",
    ("preprocessing_summary", "features_dropped_count"): "5",
    ("preprocessing_summary", "reduction_percentage"): "31.250000",
    ("ordinal_transformations", "variables_dropped"): "num_high_missing",
    ("ordinal_transformations", "composite_scores_created"): "support",
    ("ordinal_transformations", "composite_scores_definitions.support"): "ord_a, ord_b",
    ("ordinal_transformations", "n_ordinal_vars_before"): "2",
    ("ordinal_transformations", "n_ordinal_vars_after"): "1",
    ("categorical_transformations", "metadata_dropped"): "meta_const",
    ("categorical_transformations", "redundant_dropped"): "country",
    ("categorical_transformations", "isco_regrouped"): "isco",
    ("categorical_transformations", "isco_mapping.isco"): "isco_grouped",
    ("categorical_transformations", "n_categorical_vars_before"): "6",
    ("categorical_transformations", "n_categorical_vars_after"): "4",
    ("feature_changes", "features_added"): "isco_grouped, support",
    ("feature_changes", "features_removed"): "country, isco, meta_const, num_high_missing, num_sparse, ord_a, ord_b",
    ("feature_changes", "features_unchanged"): "cat_bin, cat_low, cat_rare, country_id, id, num_low_missing, q1_average_score, q1_total_timing, target",
    ("data_quality", "missing_after"): "0",
    ("data_quality", "missing_percentage_after"): "0.000000",
}


@query(
    "prep_report",
    with_survey(
        "SELECT 'preprocessing_summary' AS section, 'n_samples' AS metric, CAST(count(*) AS VARCHAR) AS value FROM survey "
        f"UNION ALL SELECT 'data_quality', 'missing_before', CAST({_COUNT_NULLS} AS VARCHAR) "
        f"UNION ALL SELECT 'data_quality', 'missing_percentage_before', printf('%.6f', {_COUNT_NULLS} * 100.0 / (16 * (SELECT count(*) FROM survey))) "
        + "".join(f"UNION ALL SELECT '{a}', '{b}', '{v}' " for (a, b), v in _FIXED_REPORT.items())
    ),
)
def _(s: Source):
    model = _stage2_fit(s.survey)
    return va.preparation_report(s.survey, model.transform(s.survey), model.ordinal, model.categorical)


@query(
    "audit_transform",
    with_survey(
        "SELECT 'dropped_ordinal' AS \"check\", CAST(1 AS BIGINT) AS actual, CAST(1 AS BIGINT) AS expected, true AS ok, count(num_high_missing) AS values_before, CAST(0 AS BIGINT) AS values_after FROM survey "
        "UNION ALL SELECT 'dropped_metadata', 1, 1, true, count(meta_const), 0 FROM survey "
        "UNION ALL SELECT 'dropped_redundant', 1, 1, true, count(country), 0 FROM survey "
        "UNION ALL SELECT 'composites_created', 1, 1, true, count(ord_a) + count(ord_b), count(*) FROM survey "
        "UNION ALL SELECT 'composite_sources_removed', 2, 2, true, count(ord_a) + count(ord_b), 0 FROM survey "
        "UNION ALL SELECT 'codes_grouped', 1, 1, true, count(isco), count(*) FROM survey "
        "UNION ALL SELECT 'code_sources_removed', 1, 1, true, count(isco), 0 FROM survey"
    ),
)
def _(s: Source):
    after = _stage2_fit(s.survey).transform(s.survey)
    expected = {
        "dropped": {"ordinal": ["num_high_missing", "ST005"], "metadata": ["meta_const", "CYC"], "redundant": ["country", "PA008"]},
        "composites": {"support": ["ord_a", "ord_b"]},
        "grouped": {"isco": "isco_grouped", "OCOD2": "OCOD2_grouped"},
    }
    return va.audit(s.survey, after, expected)


@query(
    "grouping_effect",
    with_survey(
        f"SELECT 'isco' AS source, 'isco_grouped' AS grouped, a AS n_before, b AS n_after, round((a - b) * 100.0 / a, 6) AS reduction_pct FROM "
        f"(SELECT (SELECT count(*) FROM (SELECT DISTINCT isco FROM survey)) AS a, (SELECT count(*) FROM (SELECT DISTINCT {_CODE} FROM survey)) AS b)"
    ),
)
def _(s: Source):
    after = derive.OccupationGrouper(inputCols=["isco"]).transform(s.survey)
    out = va.grouping_effect(s.survey, after, {"isco": "isco_grouped"})
    return out.withColumn("reduction_pct", F.round(col("reduction_pct"), 6))
