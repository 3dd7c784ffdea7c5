"""Aggregations, column profiles and missing-value analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import SURVEY_COLUMNS, Source, query, union_all, with_survey
from sparkprep.operators import levels as lv
from sparkprep.operators import profile as pr
from sparkprep.operators import stats as st
from sparkprep.operators.columns import SparseColumnDropper
from sparkprep.operators.frequent import frequent_levels, frequent_values
from sparkprep.operators.grouped import group_quantiles
from sparkprep.operators.quantiles import exact_medians, exact_quantiles
from sparkprep.plans.roles import VariableRoles

NUMERIC = ["target", "q1_average_score", "q1_total_timing", "num_low_missing", "num_high_missing", "num_sparse"]
ORDINAL = ["ord_a", "ord_b"]
CATEGORICAL = ["country", "cat_bin", "cat_low", "cat_rare", "isco", "meta_const"]
LEVELLED = ["country_id", *ORDINAL, *CATEGORICAL]

# rounding to the same digits on both sides keeps float noise out of the comparison
r6 = lambda c: F.round(c, 6)


_MISSING = union_all(
    "SELECT '{c}' AS variable, count(*) - count({c}) AS missing_count, count(*) AS n_rows FROM survey", SURVEY_COLUMNS
)


@query("agg_null_count", with_survey(_MISSING))
def _(s: Source):
    return st.null_counts(s.survey)


_MISSING_PCT = f"(SELECT variable, missing_count, missing_count * 100.0 / n_rows AS missing_pct FROM ({_MISSING}))"


@query(
    "missing_table",
    with_survey(
        f"SELECT variable, missing_count, round(missing_pct, 6) AS missing_pct FROM {_MISSING_PCT} "
        "ORDER BY missing_pct DESC, variable LIMIT 10"
    ),
)
def _(s: Source):
    return st.missing_table(s.survey, top=10).withColumn("missing_pct", r6("missing_pct"))


@query(
    "missing_total",
    with_survey(
        "SELECT CAST(sum(missing_count) AS BIGINT) AS missing_cells, CAST(sum(n_rows) AS BIGINT) AS total_cells, "
        f"round(sum(missing_count) * 100.0 / sum(n_rows), 6) AS missing_pct FROM ({_MISSING})"
    ),
)
def _(s: Source):
    return st.missing_total(s.survey).withColumn("missing_pct", r6("missing_pct"))


@query("group_count", with_survey("SELECT cat_low, count(*) AS n FROM survey GROUP BY cat_low"))
def _(s: Source):
    return st.group_counts(s.survey, "cat_low")


@query(
    "value_counts_all",
    with_survey(
        union_all("SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM survey GROUP BY {c}", LEVELLED)
    ),
)
def _(s: Source):
    return st.value_counts(s.survey, LEVELLED)


@query(
    "value_scope",
    with_survey(
        union_all(
            "SELECT '{c}' AS variable, round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max, "
            "round(median({c}), 6) AS median, round(avg({c}), 6) AS mean, trunc(max({c})) > 7200 AS suspicious FROM survey",
            [*NUMERIC, *ORDINAL],
        )
    ),
)
def _(s: Source):
    out = st.value_scope(s.survey, [*NUMERIC, *ORDINAL])
    return out.select("variable", *[r6(c).alias(c) for c in ("min", "max", "median", "mean")], "suspicious")


@query(
    "agg_median",
    with_survey(union_all("SELECT '{c}' AS variable, round(median({c}), 6) AS median FROM survey", NUMERIC)),
)
def _(s: Source):
    rows = list(exact_medians(s.survey, NUMERIC).items())
    return s.spark.createDataFrame(rows, "variable string, median double").withColumn("median", r6("median"))


_NEAREST = (
    "SELECT '{c}' AS variable, "
    + ", ".join(
        f"max(CASE WHEN rn = floor({q} * (n - 1) + 0.5) THEN x END) AS {name}"
        for q, name in ((0.01, "p01"), (0.25, "p25"), (0.99, "p99"))
    )
    + " FROM (SELECT CAST({c} AS DOUBLE) AS x, row_number() OVER (ORDER BY {c}) - 1 AS rn, count(*) OVER () AS n"
    " FROM survey WHERE {c} IS NOT NULL)"
)


@query("agg_quantile_nearest", with_survey(union_all(_NEAREST, [*NUMERIC, *ORDINAL])))
def _(s: Source):
    found = exact_quantiles(s.survey, [*NUMERIC, *ORDINAL], [0.01, 0.25, 0.99], "nearest")
    return s.spark.createDataFrame(
        [(c, *v) for c, v in found.items()], "variable string, p01 double, p25 double, p99 double"
    )


_LINEAR = (
    "SELECT l_returnflag AS g, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 6) AS {n}" for q, n in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90")))
    + " FROM lineitem GROUP BY l_returnflag"
)


@query("agg_quantile_grouped", _LINEAR)
def _(s: Source):
    from sparkprep.operators.quantiles import grouped_quantiles

    values = s.table("lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_extendedprice").cast("double").alias("x"))
    found = grouped_quantiles(values, [0.1, 0.5, 0.9])
    out = s.spark.createDataFrame([(g, *v) for g, v in found.items()], "g string, p10 double, p50 double, p90 double")
    return out.select("g", *[r6(c).alias(c) for c in ("p10", "p50", "p90")])


_BY_PART = "CASE WHEN l_orderkey % 3 > 0 THEN l_partkey END"


@query(
    "agg_quantile_many_groups",
    # the null group holds a third of the rows
    f"SELECT {_BY_PART} AS part, l_returnflag, count(*) AS n, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 6) AS {n}" for q, n in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90")))
    + " FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY ALL",
)
def _(s: Source):
    rows = s.table("lineitem").select(F.expr(_BY_PART).alias("part"), "l_returnflag", "l_extendedprice")
    out = group_quantiles(rows, ["part", "l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return out.withColumns({c: r6(c) for c in ("p10", "p50", "p90")})


_MODE = (
    "(SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS mode, count(*) AS n FROM survey "
    "WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
)


@query("agg_mode", with_survey(union_all(_MODE, LEVELLED)))
def _(s: Source):
    return lv.modes(lv.level_counts(s.survey, LEVELLED)).select("variable", lv.level_text().alias("mode"), "n")


@query(
    "agg_mode_null_candidate",
    with_survey(
        union_all(
            "(SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS mode, count(*) AS n FROM survey "
            "GROUP BY {c} ORDER BY count(*) DESC, {c} NULLS LAST LIMIT 1)",
            ["ord_a", "num_sparse", "isco", "cat_low"],
        )
    ),
)
def _(s: Source):
    levels = lv.level_counts(s.survey, ["ord_a", "num_sparse", "isco", "cat_low"])
    return lv.modes(levels, null_candidate=True).select("variable", lv.level_text().alias("mode"), "n")


@query(
    "agg_n_unique",
    with_survey(
        union_all(
            "SELECT '{c}' AS variable, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique FROM survey",
            SURVEY_COLUMNS,
        )
    ),
)
def _(s: Source):
    return st.n_unique(s.survey)


@query("distinct_pairs", with_survey("SELECT DISTINCT country, country_id FROM survey"))
def _(s: Source):
    return st.distinct_pairs(s.survey, "country", "country_id")


@query(
    "special_codes",
    with_survey(
        union_all(
            "SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} < 0) AS n_negative, "
            "count(*) FILTER (WHERE {c} BETWEEN 97 AND 99) AS n_high_codes FROM survey",
            ["id", "ord_a", "num_low_missing", "num_high_missing"],
        )
    ),
)
def _(s: Source):
    return st.special_codes(s.survey, ["id", "ord_a", "num_low_missing", "num_high_missing", "cat_low"])


_LINEITEM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_P = "(SELECT list_sort(list({c})) AS v FROM lineitem)"


@query(
    "describe_numeric",
    union_all(
        "SELECT '{c}' AS variable, count({c}) AS count, count(*) - count({c}) AS null_count, "
        "round(CAST(avg({c}) AS DOUBLE), 6) AS mean, round(CAST(stddev_samp({c}) AS DOUBLE), 6) AS std, "
        "CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        + ", ".join(
            f"CAST(list_extract(list_sort(list({{c}})), CAST(floor({q} * (count({{c}}) - 1) + 0.5) AS BIGINT) + 1) AS DOUBLE) AS {n}"
            for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        )
        + " FROM lineitem",
        _LINEITEM,
    ),
)
def _(s: Source):
    out = st.describe(s.table("lineitem"), _LINEITEM)
    return out.withColumns({"mean": r6("mean"), "std": r6("std")})


@query(
    "topk_levels",
    with_survey("SELECT isco, count(*) AS n FROM survey GROUP BY isco ORDER BY n DESC, isco NULLS LAST LIMIT 10"),
)
def _(s: Source):
    return st.top_values(s.survey, "isco", 10)


def _frequent(columns: list[str], table: str, k: int, where: str = "true") -> str:
    return "\nUNION ALL\n".join(
        f"(SELECT '{c}' AS variable, CAST(row_number() OVER (ORDER BY n DESC, v) AS INT) AS rank, CAST(v AS VARCHAR) AS value, n FROM "
        f"(SELECT {c} AS v, count(*) AS n FROM {table} WHERE {where.format(c=c)} GROUP BY {c}) QUALIFY rank <= {k})"
        for c in columns
    )


_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]


@query("topk_frequent", _frequent(_KEYS, "lineitem", 10))
def _(s: Source):
    return frequent_values(s.table("lineitem"), _KEYS, 10)


_TEXTS = ["text", "lang", "source", "n_chars", "doc_id"]


@query(
    "topk_frequent_texts",
    "SELECT variable, rank, md5(value) AS value_md5, n FROM ("
    + _frequent(_TEXTS, "documents", 20, "{c} IS NOT NULL") + ")",
)
def _(s: Source):
    found = frequent_levels(s.table("documents"), _TEXTS, 20, nulls=False)
    return found.select("variable", "rank", F.md5(lv.level_text()).alias("value_md5"), "n")


@query(
    "modes_frequent",
    "SELECT variable, value, n FROM (" + _frequent(["event_id", "user_id", "event_type", "props"], "events", 1, "{c} IS NOT NULL") + ")",
)
def _(s: Source):
    found = frequent_values(s.table("events"), ["event_id", "user_id", "event_type", "props"], 1, nulls=False)
    return found.drop("rank")


_HIST = (
    "SELECT '{c}' AS variable, CAST(least(floor(({c} - lo) / ((hi - lo) / 30)), 29) AS INT) AS bin, count(*) AS n "
    "FROM survey, (SELECT min({c}) AS lo, max({c}) AS hi FROM survey) WHERE {c} IS NOT NULL GROUP BY bin"
)


@query("histogram30", with_survey(union_all(_HIST, NUMERIC)))
def _(s: Source):
    return st.histogram(s.survey, NUMERIC)


_FILLED = "(SELECT coalesce(num_low_missing, -1) AS num_low_missing, coalesce(ord_a, 3) AS ord_a FROM survey)"


def _stage_hist(stage: str, table: str) -> str:
    body = union_all(_HIST, ["num_low_missing", "ord_a"]).replace("FROM survey", f"FROM {table}")
    return f"SELECT '{stage}' AS stage, * FROM ({body})"


@query("histogram_compare", with_survey(_stage_hist("before", "survey") + " UNION ALL " + _stage_hist("after", _FILLED)))
def _(s: Source):
    before = s.survey.select("num_low_missing", "ord_a")
    after = before.select(
        F.coalesce("num_low_missing", F.lit(-1.0)).alias("num_low_missing"), F.coalesce("ord_a", F.lit(3)).alias("ord_a")
    )
    return st.compare_histograms(before, after, ["num_low_missing", "ord_a"])


@query(
    "dtype_counts",
    with_survey(
        "SELECT CASE t WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' ELSE lower(t) END AS dtype, "
        "count(*) AS n_columns, CAST(sum(n) AS BIGINT) AS n_values FROM ("
        + union_all("SELECT typeof(max({c})) AS t, count({c}) AS n FROM survey", SURVEY_COLUMNS)
        + ") GROUP BY 1"
    ),
)
def _(s: Source):
    return st.dtype_counts(s.survey)


# --- profiles ----------------------------------------------------------------


def _text_list(item: str, order: str, k: int, alias: str, cond: str = "TRUE") -> str:
    return (
        f"(SELECT string_agg(item, ', ' ORDER BY rk) FROM (SELECT {item} AS item, row_number() OVER (ORDER BY {order}) AS rk "
        f"FROM (SELECT {{c}} AS v, count(*) AS n FROM survey GROUP BY {{c}}) WHERE {cond}) WHERE rk <= {k}) AS {alias}"
    )


_COUNTED = "concat(coalesce(CAST(v AS VARCHAR), 'None'), ': ', CAST(n AS VARCHAR))"

_PROFILE_ORDINAL = (
    "SELECT '{c}' AS variable, '{t}' AS dtype, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique, "
    "count(*) - count({c}) AS missing_count, round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct, "
    + _text_list("CAST(v AS VARCHAR)", "v", 20, "unique_values", "v IS NOT NULL")
    + ", "
    + _text_list(_COUNTED, "n DESC, v NULLS LAST", 10, "value_counts")
    + ", count(*) FILTER (WHERE {c} < 0) AS has_negative_codes, count(*) FILTER (WHERE {c} BETWEEN 97 AND 99) AS has_high_codes "
    "FROM survey"
)


@query(
    "profile_ordinal",
    with_survey(
        "\nUNION ALL\n".join(
            _PROFILE_ORDINAL.replace("{c}", c).replace("{t}", t)
            for c, t in (("ord_a", "int"), ("ord_b", "int"), ("id", "bigint"))
        )
    ),
)
def _(s: Source):
    return pr.profile_ordinal(s.survey, ["ord_a", "ord_b", "id", "ST999"]).withColumn("missing_pct", r6("missing_pct"))


_PROFILE_CATEGORICAL = (
    "SELECT '{c}' AS variable, 'string' AS dtype, count(*) AS cardinality, "
    "CAST(coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS BIGINT) AS missing_count, "
    "round(coalesce(sum(n) FILTER (WHERE v IS NULL), 0) * 100.0 / sum(n), 6) AS missing_pct, "
    "count(*) FILTER (WHERE n < 0.01 * (SELECT count({c}) FROM survey)) AS rare_categories, "
    "round(max(n) / min(n), 6) AS imbalance_ratio, "
    + _text_list(_COUNTED, "n DESC, v NULLS LAST", 5, "top_categories")
    + ", CASE WHEN count(*) < 10 THEN 'faible' WHEN count(*) <= 50 THEN 'moyenne' ELSE 'haute' END AS cardinality_type "
    "FROM (SELECT {c} AS v, count(*) AS n FROM survey GROUP BY {c})"
)
_PROFILES = union_all(_PROFILE_CATEGORICAL, CATEGORICAL)


@query("profile_categorical", with_survey(_PROFILES))
def _(s: Source):
    out = pr.profile_categorical(s.survey, [*CATEGORICAL, "OCOD9"])
    return out.withColumns({"missing_pct": r6("missing_pct"), "imbalance_ratio": r6("imbalance_ratio")})


@query(
    "high_cardinality",
    with_survey(
        "SELECT 'isco' AS variable, CAST(row_number() OVER (ORDER BY n DESC, v NULLS LAST) AS INT) AS rank, v AS value, n FROM "
        "(SELECT isco AS v, count(*) AS n FROM survey GROUP BY isco) QUALIFY rank <= 10"
    ),
)
def _(s: Source):
    return pr.high_cardinality(s.survey, ["isco"])


_SCALE = (
    "SELECT '{c}' AS variable, n AS n_levels, CASE WHEN n IN (3, 4, 5, 7) AND whole AND hi - lo + 1 = n THEN concat('likert_', CAST(n AS VARCHAR)) "
    "WHEN lo < 0 THEN 'with_special_codes' WHEN n BETWEEN 5 AND 10 THEN 'quantity_ranges' ELSE 'other' END AS scale_type "
    "FROM (SELECT count(DISTINCT {c}) AS n, min({c}) AS lo, max({c}) AS hi, bool_and({c} = floor({c})) AS whole FROM survey)"
)


@query("scale_type", with_survey(union_all(_SCALE, ["ord_a", "ord_b", "country_id", "num_low_missing", "num_sparse"])))
def _(s: Source):
    return pr.scale_types(s.survey, ["ord_a", "ord_b", "country_id", "num_low_missing", "num_sparse"])


@query(
    "profile_summary",
    with_survey(
        "SELECT count(*) AS n_variables, round(avg(missing_pct), 6) AS mean_missing_pct, round(median(missing_pct), 6) AS median_missing_pct, "
        "max(missing_pct) AS max_missing_pct, round(avg(cardinality), 6) AS mean_cardinality, median(cardinality) AS median_cardinality, "
        "CAST(max(cardinality) AS DOUBLE) AS max_cardinality, count(*) FILTER (WHERE missing_pct > 50) AS n_missing_over_50, "
        f"count(*) FILTER (WHERE rare_categories > 0) AS n_with_rare, round(avg(rare_categories), 6) AS mean_rare FROM ({_PROFILES})"
    ),
)
def _(s: Source):
    out = pr.profile_summary(pr.profile_categorical(s.survey, CATEGORICAL))
    rounded = ("mean_missing_pct", "median_missing_pct", "max_missing_pct", "mean_cardinality", "mean_rare")
    return out.withColumns({c: r6(c) for c in rounded})


@query(
    "cardinality_tiers",
    with_survey(
        "SELECT cardinality_type, count(*) AS n_variables, count(*) FILTER (WHERE cardinality > 50) AS n_over_50 "
        f"FROM ({_PROFILES}) GROUP BY cardinality_type"
    ),
)
def _(s: Source):
    return pr.cardinality_tiers(pr.profile_categorical(s.survey, CATEGORICAL))


# --- missing values ----------------------------------------------------------


def _kept(limit: float) -> str:
    gone = {"num_sparse"} if limit >= 0.5 else {"num_sparse", "q1_average_score", "q1_total_timing"}
    return ", ".join(c for c in SURVEY_COLUMNS if c not in gone)


@query("drop_sparse", with_survey(f"SELECT {_kept(0.8)} FROM survey"))
def _(s: Source):
    return SparseColumnDropper(threshold=0.8).fit(s.survey).transform(s.survey)


@query("drop_high_missing", with_survey(f"SELECT {_kept(0.5)} FROM survey"))
def _(s: Source):
    return SparseColumnDropper(threshold=0.5).fit(s.survey).transform(s.survey)


@query(
    "cols_with_null", with_survey(f"SELECT variable, missing_count FROM ({_MISSING}) WHERE missing_count > 0")
)
def _(s: Source):
    return st.columns_with_null(s.survey)


_INCOMPLETE = ["q1_average_score", "num_low_missing", "num_high_missing", "num_sparse", "ord_a", "ord_b", "cat_low", "isco"]


@query(
    "missing_matrix",
    with_survey("SELECT id, " + ", ".join(f"CAST({c} IS NULL AS INT) AS {c}" for c in _INCOMPLETE) + " FROM survey"),
)
def _(s: Source):
    return st.missing_matrix(s.survey, _INCOMPLETE, ["id"])


_TIER = (
    "CASE WHEN missing_pct > 80 THEN 'drop' WHEN missing_pct > 50 THEN 'complex' WHEN missing_pct > 20 THEN 'simple' "
    "WHEN missing_pct > 0 THEN 'minimal' ELSE 'none' END"
)


@query(
    "impute_strategy",
    with_survey(f"SELECT variable, round(missing_pct, 6) AS missing_pct, {_TIER} AS strategy FROM {_MISSING_PCT}"),
)
def _(s: Source):
    return st.imputation_tiers(s.survey).withColumn("missing_pct", r6("missing_pct"))


@query(
    "missing_over80",
    with_survey(
        f"SELECT variable, round(missing_pct, 6) AS missing_pct, CASE WHEN variable = 'num_sparse' THEN 'numeric' END AS role "
        f"FROM {_MISSING_PCT} WHERE missing_pct > 80"
    ),
)
def _(s: Source):
    roles = VariableRoles(numeric=NUMERIC, grouping=["country_id"], ordinal=ORDINAL, categorical=CATEGORICAL)
    return st.missing_above(s.survey, roles.rows(s.spark)).withColumn("missing_pct", r6("missing_pct"))


@query("missing_labels", "SELECT 'quality' AS variable, count(*) - count(l.quality) AS missing_count, count(*) AS n_rows "
       "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id UNION ALL SELECT 'toxic', count(*) - count(l.toxic), count(*) "
       "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(s: Source):
    joined = s.table("documents").select("doc_id").join(s.table("labels"), "doc_id", "left")
    return st.null_counts(joined, ["quality", "toxic"])
