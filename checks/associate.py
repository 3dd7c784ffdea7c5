"""Correlation, association, redundancy and key checks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from checks.base import SURVEY_COLUMNS, Source, query, union_all, with_survey
from sparkprep.operators import assoc
from sparkprep.operators import profile as pr
from sparkprep.operators import stats as st
from sparkprep.operators import validate as va
from sparkprep.operators.dependencies import dependencies
from sparkprep.operators.split import quantile_bins
from sparkprep.operators.together import missing_together

NUMERIC = ["target", "q1_average_score", "q1_total_timing", "num_low_missing", "num_high_missing", "num_sparse"]


def _r6(df, *names):
    return df.withColumns({c: F.round(c, 6) for c in names})


def _pearson(a: str, b: str, table: str) -> str:
    return (
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
        f"corr({a}, {b}) AS r FROM {table}"
    )


def _pearson_all(names, table: str) -> str:
    return "\nUNION ALL\n".join(_pearson(a, b, table) for a, b in combinations(names, 2))


@query(
    "corr_pearson_pairs",
    with_survey(f"SELECT var_a, var_b, n, round(r, 6) AS r FROM ({_pearson_all(NUMERIC, 'survey')}) WHERE abs(r) > 0.9"),
)
def _(s: Source):
    return _r6(assoc.correlated_pairs(s.survey, NUMERIC, 0.90), "r")


_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey"]


@query("corr_pearson_matrix", f"SELECT var_a, var_b, n, round(r, 6) AS r FROM ({_pearson_all(_LINE, 'lineitem')})")
def _(s: Source):
    return _r6(assoc.pearson_matrix(s.table("lineitem"), _LINE), "r")


#: 17 columns, so 136 pairs: beyond the aggregates of few pairs.
_WIDE = dict(enumerate("""l_orderkey
l_partkey
l_suppkey
l_linenumber
l_quantity
l_extendedprice
l_discount
l_tax
l_quantity * l_discount
l_extendedprice * l_tax
l_extendedprice * (1 - l_discount)
CASE WHEN l_orderkey % 3 = 0 THEN l_quantity END
CASE WHEN l_orderkey % 5 <> 0 THEN l_extendedprice + 1000000000 END
CASE WHEN l_linenumber <> 2 THEN l_tax END
CASE WHEN l_linenumber = 3 OR l_quantity > 40 THEN l_discount - l_tax END
l_partkey % 97
l_suppkey % 13""".splitlines()))
_WIDE_TABLE = "(SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS c{i}" for i, e in _WIDE.items()) + " FROM lineitem)"


@query("corr_pearson_wide", f"SELECT var_a, var_b, n, round(r, 6) AS r FROM ({_pearson_all([f'c{i}' for i in _WIDE], _WIDE_TABLE)})")
def _(s: Source):
    df = s.table("lineitem").select(*[F.expr(e).cast("double").alias(f"c{i}") for i, e in _WIDE.items()])
    return _r6(assoc.pearson_matrix(df), "r")


_FLAGGED = "(SELECT coalesce(q1_average_score, -1) AS a, coalesce(q1_total_timing, -1) AS b FROM survey)"


@query(
    "corr_flagged",
    with_survey(
        f"SELECT 'with_flag' AS kind, count(*) AS n, round(corr(a, b), 6) AS r FROM {_FLAGGED} UNION ALL "
        f"SELECT 'without_flag', count(*), round(corr(a, b), 6) FROM {_FLAGGED} WHERE a <> -1 AND b <> -1"
    ),
)
def _(s: Source):
    df = s.survey.select(
        F.coalesce("q1_average_score", F.lit(-1.0)).alias("a"), F.coalesce("q1_total_timing", F.lit(-1.0)).alias("b")
    )
    out = lambda kind, flag: assoc.pearson_matrix(df, ["a", "b"], exclude_flag=flag).select(F.lit(kind).alias("kind"), "n", "r")
    return _r6(out("with_flag", None).unionByName(out("without_flag", -1.0)), "r")


def _spearman(a: str, b: str, table: str) -> str:
    rank = lambda x: f"(rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0)"
    return (
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, count(*) AS n, corr(ra, rb) AS r FROM (SELECT {rank(a)} AS ra, {rank(b)} AS rb "
        f"FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


_DUP = "(SELECT *, CASE WHEN id % 25 <> 0 THEN ord_a ELSE 6 - ord_a END AS ord_a_duplicated_0, -num_low_missing AS num_low_missing_duplicated_0 FROM survey)"
_DUP_PAIRS = [("ord_a", "ord_a_duplicated_0"), ("num_low_missing", "num_low_missing_duplicated_0")]


@query(
    "spearman_dup",
    with_survey(
        "\nUNION ALL\n".join(
            f"SELECT var_a, var_b, n, round(r, 6) AS r, (SELECT count(*) FROM {_DUP} WHERE {a} = {b}) AS n_identical, abs(r) > 0.95 AS redundant, "
            "abs(r) * sqrt((n - 2) / greatest(1 - r * r, 1e-12)) > 1.96 AS significant "
            f"FROM ({_spearman(a, b, _DUP)})"
            for a, b in _DUP_PAIRS
        )
    ),
)
def _(s: Source):
    copy = F.when(F.col("id") % 25 != 0, F.col("ord_a")).otherwise(6 - F.col("ord_a"))
    df = s.survey.withColumns({"ord_a_duplicated_0": copy, "num_low_missing_duplicated_0": -F.col("num_low_missing")})
    pairs = assoc.duplicate_candidates(df.columns)
    found = assoc.duplicate_report(df, pairs).withColumn("significant", F.col("p_value") < 0.05)
    return _r6(found.drop("p_value"), "r")


_SP = ["ord_a", "ord_b", "country_id", "rank_a", "half_a"]
_SP_TABLE = "(SELECT ord_a, ord_b, country_id, ord_a * 10 + country_id % 3 AS rank_a, -ord_a AS half_a FROM survey)"


@query(
    "spearman_pairs",
    with_survey(
        "SELECT var_a, var_b, n, round(r, 6) AS r FROM ("
        + "\nUNION ALL\n".join(_spearman(a, b, _SP_TABLE) for a, b in combinations(_SP, 2))
        + ") WHERE abs(r) > 0.8"
    ),
)
def _(s: Source):
    df = s.survey.select(
        "ord_a", "ord_b", "country_id",
        (F.col("ord_a") * 10 + F.col("country_id") % 3).alias("rank_a"), (-F.col("ord_a")).alias("half_a"),
    )
    return _r6(assoc.spearman_pairs(df, _SP, levels=(5, 50)), "r")


@query(
    "spearman_continuous",
    f"SELECT var_a, var_b, n, round(r, 6) AS r FROM ({_spearman('l_extendedprice', 'l_quantity', 'lineitem')})",
)
def _(s: Source):
    return _r6(assoc.spearman(s.table("lineitem"), [("l_extendedprice", "l_quantity")]), "r")


#: 36 pairs: beyond the rows of few pairs, counted in tables that each task keeps.
_MANY = ["ord_a", "ord_b", "country_id", "target", "q1_average_score", "q1_total_timing", "num_low_missing", "num_high_missing", "num_sparse"]


@query(
    "spearman_wide",
    with_survey("SELECT var_a, var_b, n, round(r, 6) AS r FROM (" + "\nUNION ALL\n".join(_spearman(a, b, "survey") for a, b in combinations(_MANY, 2)) + ")"),
)
def _(s: Source):
    return _r6(assoc.spearman(s.survey.select(*_MANY), list(combinations(_MANY, 2))), "r")


def _cramers(a: str, b: str, table: str, yates: bool = False) -> str:
    term = "greatest(abs(o - e) - 0.5, 0) * greatest(abs(o - e) - 0.5, 0) / e" if yates else "(o - e) * (o - e) / e"
    return (
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, CAST(sum(o) AS BIGINT) AS n, count(DISTINCT x) AS levels_a, count(DISTINCT y) AS levels_b, "
        f"round(sum({term}), 6) AS chi2, CASE WHEN least(count(DISTINCT x), count(DISTINCT y)) > 1 THEN "
        f"round(sqrt(sum({term}) / (sum(o) * (least(count(DISTINCT x), count(DISTINCT y)) - 1))), 6) ELSE 0 END AS v "
        f"FROM (SELECT rx.x, cy.y, coalesce(c.o, 0) AS o, rx.m * cy.m / t.n AS e FROM "
        f"(SELECT {a} AS x, count(*) AS m FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) rx CROSS JOIN "
        f"(SELECT {b} AS y, count(*) AS m FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) cy CROSS JOIN "
        f"(SELECT count(*) AS n FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL) t LEFT JOIN "
        f"(SELECT {a} AS x, {b} AS y, count(*) AS o FROM {table} GROUP BY 1, 2) c ON c.x = rx.x AND c.y = cy.y)"
    )


_CV = [("cat_low", "cat_rare"), ("cat_low", "country"), ("cat_low", "meta_const"), ("cat_bin", "cat_rare")]


@query("cramers_v", with_survey("\nUNION ALL\n".join(_cramers(a, b, "survey") for a, b in _CV)))
def _(s: Source):
    return _r6(assoc.cramers_v(s.survey, _CV), "chi2", "v")


_LEVELS = ["cat_bin", "cat_low", "cat_rare", "country", "ord_a", "ord_b", "country_id", "meta_const", "q1_average_score"]


@query("cramers_v_wide", with_survey("\nUNION ALL\n".join(_cramers(a, b, "survey") for a, b in combinations(_LEVELS, 2))))
def _(s: Source):
    return _r6(assoc.cramers_v(s.survey, list(combinations(_LEVELS, 2)), yates=False), "chi2", "v")


@query("cramers_v_yates", _cramers("quality", "toxic", "labels", yates=True))
def _(s: Source):
    return _r6(assoc.cramers_v(s.table("labels"), [("quality", "toxic")]), "chi2", "v")


@query(
    "cramers_v_lineitem",
    "\nUNION ALL\n".join(
        _cramers(a, b, "lineitem") for a, b in (("l_returnflag", "l_linestatus"), ("l_returnflag", "l_suppkey"))
    ),
)
def _(s: Source):
    pairs = [("l_returnflag", "l_linestatus"), ("l_returnflag", "l_suppkey")]
    return _r6(assoc.cramers_v(s.table("lineitem"), pairs, yates=False), "chi2", "v")


_BINS = "(SELECT *, CASE WHEN target IS NOT NULL THEN concat('b', CAST({} AS VARCHAR)) END AS target_bin FROM survey, (SELECT quantile_cont(target, [0.2, 0.4, 0.6, 0.8]) AS e FROM survey))".format(
    " + ".join(f"CAST(target > e[{i}] AS INT)" for i in (1, 2, 3, 4))
)


@query("association_with_target", with_survey("\nUNION ALL\n".join(_cramers(c, "target_bin", _BINS) for c in ("cat_low", "cat_rare", "country"))))
def _(s: Source):
    df = quantile_bins(s.survey, "target", [f"b{i}" for i in range(5)], "target_bin")
    return _r6(assoc.cramers_v(df, [(c, "target_bin") for c in ("cat_low", "cat_rare", "country")]), "chi2", "v")


@query(
    "weak_associations",
    with_survey(
        "SELECT var_a AS variable, v FROM ("
        + "\nUNION ALL\n".join(_cramers(c, "target_bin", _BINS) for c in ("cat_low", "cat_rare", "isco"))
        + ") WHERE v < 0.05"
    ),
)
def _(s: Source):
    df = quantile_bins(s.survey, "target", [f"b{i}" for i in range(5)], "target_bin")
    return _r6(assoc.weak_associations(df, ["cat_low", "cat_rare", "isco"], "target_bin"), "v")


@query(
    "point_biserial",
    with_survey("SELECT 'cat_bin' AS var_a, 'target' AS var_b, count(*) AS n, round(corr(CAST(cat_bin = 'O' AS INT), target), 6) AS r FROM survey"),
)
def _(s: Source):
    return _r6(assoc.point_biserial(s.survey, "cat_bin", "O", "target"), "r")


def _fd(a: str, b: str) -> str:
    p = f"(SELECT DISTINCT {a} AS a, {b} AS b FROM survey)"
    fan = lambda x: f"(SELECT max(k) FROM (SELECT count(*) AS k FROM {p} GROUP BY {x}))"
    n = lambda x: f"(SELECT count(*) FROM (SELECT DISTINCT {x} FROM {p}))"
    return (
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, {n('a')} AS n_a, {n('b')} AS n_b, (SELECT count(*) FROM {p}) AS n_pairs, "
        f"{fan('a')} = 1 AS perfect, {fan('a')} = 1 AND {fan('b')} = 1 AS one_to_one"
    )


@query("fd_check", with_survey(_fd("country", "country_id")))
def _(s: Source):
    return assoc.functional_mapping(s.survey, "country", "country_id")


@query("hierarchy_check", with_survey(_fd("id", "country_id") + "\nUNION ALL\n" + _fd("country_id", "country") + "\nUNION ALL\n" + _fd("country", "isco")))
def _(s: Source):
    chain = [("id", "country_id"), ("country_id", "country"), ("country", "isco")]
    parts = [assoc.functional_mapping(s.survey, a, b) for a, b in chain]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_ITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()
_DISTINCT = "SELECT {names}, count(*) AS k FROM (SELECT DISTINCT {cols} FROM {table})"


def _all_dependencies(table: str, cols: list[str]) -> str:
    levels = " UNION ALL ".join(_DISTINCT.format(names=f"'{c}' AS v", cols=c, table=table) for c in cols)
    pairs = " UNION ALL ".join(
        _DISTINCT.format(names=f"'{a}' AS a, '{b}' AS b", cols=f"{a}, {b}", table=table) for a, b in combinations(cols, 2)
    )
    return (
        f"WITH lv AS ({levels}), pr AS ({pairs}), rows_in AS (SELECT count(*) AS n FROM {table}), "
        "both_ways AS (SELECT a, b, k FROM pr UNION ALL SELECT b, a, k FROM pr) "
        "SELECT a AS lhs, b AS rhs, x.k AS lhs_levels, y.k AS rhs_levels, x.k = n AS lhs_is_key "
        "FROM both_ways p JOIN lv x ON x.v = p.a JOIN lv y ON y.v = p.b, rows_in WHERE p.k = x.k AND x.k > 1 AND y.k > 1"
    )


@query("dependency_search", _all_dependencies("lineitem", _ITEM))
def _(s: Source):
    return dependencies(s.table("lineitem"), _ITEM)


@query("dependency_search_survey", with_survey(_all_dependencies("survey", SURVEY_COLUMNS)))
def _(s: Source):
    return dependencies(s.survey, SURVEY_COLUMNS)


@query(
    "missing_together",
    with_survey(
        "SELECT var_a, var_b, n_rows, n_a, n_b, n_both, round(r, 6) AS r FROM ("
        + "\nUNION ALL\n".join(
            f"SELECT '{a}' AS var_a, '{b}' AS var_b, count(*) AS n_rows, count(*) - count({a}) AS n_a, count(*) - count({b}) AS n_b, "
            f"count(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS n_both, "
            f"CASE WHEN count({a}) BETWEEN 1 AND count(*) - 1 AND count({b}) BETWEEN 1 AND count(*) - 1 "
            f"THEN corr(CAST({a} IS NULL AS INT), CAST({b} IS NULL AS INT)) END AS r FROM survey"
            for a, b in combinations(SURVEY_COLUMNS, 2)
        )
        + ")"
    ),
)
def _(s: Source):
    return _r6(missing_together(s.survey, SURVEY_COLUMNS), "r")


_MISS = ["q1_average_score", "q1_total_timing", "num_high_missing"]


@query(
    "missing_corr",
    with_survey(
        "SELECT var_a, var_b, n, round(r, 6) AS r FROM ("
        + _pearson_all(_MISS, "(SELECT " + ", ".join(f"CAST({c} IS NULL AS INT) AS {c}" for c in _MISS) + " FROM survey)")
        + ") WHERE abs(r) > 0.5"
    ),
)
def _(s: Source):
    return _r6(assoc.missing_correlations(s.survey), "r")


@query("removal_list", with_survey("SELECT 'country_id' AS variable UNION SELECT 'num_sparse' WHERE (SELECT count(num_sparse) / count(*) FROM survey) < 0.2"))
def _(s: Source):
    mapping = assoc.functional_mapping(s.survey, "country", "country_id")
    redundant = mapping.where("perfect").select(F.col("var_b").alias("variable"))
    over = st.missing_table(s.survey).where("missing_pct > 80").select("variable")
    return assoc.removal_list(redundant, over)


@query("zero_variance", with_survey("SELECT variable FROM (" + union_all(
    "SELECT '{c}' AS variable, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n FROM survey", SURVEY_COLUMNS) + ") WHERE n = 1"))
def _(s: Source):
    return pr.constant_columns(s.survey)


@query(
    "encoded_width",
    with_survey(
        "SELECT count(*) AS n_variables, CAST(sum(n) AS BIGINT) AS one_hot_width, CAST(sum(CASE WHEN n BETWEEN 3 AND 10 THEN n ELSE 1 END) AS BIGINT) AS encoded_width FROM ("
        + union_all("SELECT count(*) AS n FROM (SELECT DISTINCT {c} FROM survey)", ["cat_bin", "cat_low", "cat_rare", "isco", "country"]) + ")"
    ),
)
def _(s: Source):
    return pr.encoded_width(pr.profile_categorical(s.survey, ["cat_bin", "cat_low", "cat_rare", "isco", "country"]))


@query("repeated_ids", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(s: Source):
    return va.repeated_keys(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("repeated_codes", with_survey("SELECT isco, count(*) AS n FROM survey GROUP BY isco HAVING count(*) > 1"))
def _(s: Source):
    return va.repeated_keys(s.survey, ["isco"])
