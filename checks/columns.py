"""Sources, sinks, projections and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import SURVEY_COLUMNS, Source, query, with_survey
from sparkprep.functions.scalar import lenient_double
from sparkprep.operators import columns as cols
from sparkprep.operators import joins
from sparkprep.operators.split import head_rows
from sparkprep.plans.roles import role_rows
from sparkprep.session import scratch_path
from sparkprep.sources import tables

NUMERIC = ["q1_average_score", "q1_total_timing", "num_low_missing", "num_high_missing", "num_sparse"]
GROUPING = ["country_id", "country"]


# --- sources and sinks -------------------------------------------------------


@query(
    "src_csv_lenient",
    with_survey(
        "SELECT id, target, TRY_CAST(CASE WHEN ord_a IS NULL THEN 'n/a' ELSE CAST(ord_a AS VARCHAR) END AS INT) AS mixed,"
        " TRY_CAST(cat_low AS DOUBLE) AS words, isco FROM survey"
    ),
)
def _(s: Source):
    path = scratch_path(s.spark, "csv")
    mixed = F.coalesce(F.col("ord_a").cast("string"), F.lit("n/a"))
    tables.write_csv(s.survey.select("id", "target", mixed.alias("mixed"), F.col("cat_low").alias("words"), "isco"), path)
    return tables.read_csv(s.spark, path, {"id": "bigint", "target": "double", "mixed": "int", "words": "double"})


@query("src_csv_strict", with_survey("SELECT id, target, cat_low, isco FROM survey"))
def _(s: Source):
    path = scratch_path(s.spark, "csv")
    tables.write_csv(s.survey.select("id", "target", "cat_low", "isco"), path)
    return tables.read_csv(s.spark, path, {"id": "bigint", "target": "double"}, strict=True)


@query("src_head_n", with_survey("SELECT id, country, target FROM survey ORDER BY id LIMIT 1000"))
def _(s: Source):
    return head_rows(s.survey.select("id", "country", "target"), ["id"], 1000)


@query("src_latest_run", with_survey("SELECT id, target, cat_rare FROM survey"))
def _(s: Source):
    root = scratch_path(s.spark, "runs")
    rows = s.survey.select("id", "target", "cat_rare")
    tables.write_run(rows.where("cat_rare = 'F'"), root, "20240101_000000")
    tables.write_run(rows, root, "20240102_000000")
    return tables.read_latest_run(s.spark, root)


@query("src_attach_target", with_survey("SELECT id, ord_a, cat_low, target AS score FROM survey"))
def _(s: Source):
    companion = s.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"))
    return tables.attach_target(s.survey.select("id", "ord_a", "cat_low"), companion, "score", ["id"])


@query(
    "dim_decode",
    with_survey(
        "SELECT s.id, s.country_id, n.n_name AS country_id_n_name FROM survey s LEFT JOIN nation n ON s.country_id = n.n_nationkey"
    ),
)
def _(s: Source):
    return joins.decode_dimension(s.survey.select("id", "country_id"), "country_id", s.table("nation"), "n_nationkey", "n_name")


@query(
    "roles_from_table",
    "SELECT r.r_name AS role, n.n_name AS variable FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey",
)
def _(s: Source):
    # a sheet with one column per region, listing its nations
    nation = s.table("nation").join(s.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = [r.r_name for r in s.table("region").orderBy("r_regionkey").collect()]
    sheet = nation.groupBy("n_nationkey").pivot("r_name", names).agg(F.first("n_name"))
    return role_rows(sheet, {n: n for n in names})


# --- projections -------------------------------------------------------------


def _survey_select(names) -> str:
    return with_survey(f"SELECT {', '.join(names)} FROM survey")


@query("sel_numeric", _survey_select(NUMERIC))
def _(s: Source):
    return cols.select_columns(s.survey, NUMERIC)


@query("sel_grouping", _survey_select(["id", *GROUPING]))
def _(s: Source):
    return cols.select_columns(s.survey, ["id", *GROUPING])


@query("sel_present", _survey_select(["id", "ord_a", "cat_low"]))
def _(s: Source):
    return cols.select_present(s.survey, ["id", "ord_a", "ST999", "cat_low", "OCOD9"])


@query("sel_regex", _survey_select(["q1_average_score", "q1_total_timing"]))
def _(s: Source):
    return cols.select_matching(s.survey, "score|timing")


@query(
    "sel_by_dtype",
    _survey_select(
        ["id", "country_id", "target", *NUMERIC, "ord_a", "ord_b"]
    ),
)
def _(s: Source):
    return cols.select_by_type(s.survey, "numeric")


@query("sel_strings", _survey_select(["country", "cat_bin", "cat_low", "cat_rare", "isco", "meta_const"]))
def _(s: Source):
    return cols.select_by_type(s.survey, "string")


def _without(*gone):
    return [c for c in SURVEY_COLUMNS if c not in gone]


@query("drop_metadata", _survey_select(_without("meta_const")))
def _(s: Source):
    return cols.ColumnDropper(inputCols=["meta_const", "Option_CT"]).transform(s.survey)


@query("drop_redundant_cat", _survey_select(_without("cat_rare", "country")))
def _(s: Source):
    return cols.ColumnDropper(inputCols=["cat_rare", "country", "PA008"]).transform(s.survey)


@query("drop_redundant_ord", _survey_select(_without("ord_b")))
def _(s: Source):
    return cols.ColumnDropper(inputCols=["ord_b", "ST253"]).transform(s.survey)


@query("drop_by_prefix", _survey_select(_without("num_low_missing", "num_high_missing", "num_sparse")))
def _(s: Source):
    return cols.drop_by_prefix(s.survey, ["num_", "PV"])


@query("grouped_clean", with_survey("SELECT CAST(country_id AS DOUBLE) AS country_id, CAST(id AS DOUBLE) AS id FROM survey"))
def _(s: Source):
    return cols.GroupingCleaner(inputCols=["country_id", "country", "id"], dropCols=["country"]).transform(s.survey)


@query(
    "cast_lenient",
    with_survey(
        "SELECT id, TRY_CAST(isco AS DOUBLE) AS isco, TRY_CAST(cat_low AS DOUBLE) AS cat_low, CAST(ord_a AS DOUBLE) AS ord_a FROM survey"
    ),
)
def _(s: Source):
    return cols.LenientCaster(inputCols=["isco", "cat_low", "ord_a"]).transform(s.survey.select("id", "isco", "cat_low", "ord_a"))


@query(
    "rebuild_columns",
    with_survey(
        "SELECT id, cat_low, coalesce(num_low_missing, -1) AS num_low_missing, CAST(country_id AS DOUBLE) AS country_id FROM survey"
    ),
)
def _(s: Source):
    df = s.survey.select("id", "num_low_missing", "country_id", "cat_low")
    cleaned = {
        "numeric": [("num_low_missing", F.coalesce("num_low_missing", F.lit(-1.0))), ("cat_low", F.lit("clash"))],
        "grouping": [("country_id", lenient_double(F.col("country_id"), df.schema["country_id"].dataType))],
    }
    return cols.rebuild_columns(df, cleaned, ["num_low_missing", "country_id"])


@query(
    "pairwise_complete",
    with_survey("SELECT ord_a, ord_b FROM survey WHERE ord_a IS NOT NULL AND ord_b IS NOT NULL"),
)
def _(s: Source):
    return cols.pairwise_complete(s.survey, ["ord_a", "ord_b"])


# --- joins -------------------------------------------------------------------


@query(
    "join_left_map",
    with_survey(
        "WITH f AS (SELECT isco AS level, count(*) / (SELECT count(*) FROM train) AS freq FROM train GROUP BY isco) "
        "SELECT p.id, p.isco, round(coalesce(f.freq, 0), 9) AS freq FROM parts p LEFT JOIN f ON p.isco = f.level"
    ),
)
def _(s: Source):
    train = s.train
    n = train.count()
    lookup = train.groupBy("isco").agg(F.count(F.lit(1)).alias("n")).where("isco IS NOT NULL")
    joined = joins.join_levels(s.parts.select("id", "isco"), lookup.withColumn("freq", F.col("n") / n), "isco")
    return joined.select("id", "isco", F.round(F.coalesce("freq", F.lit(0.0)), 9).alias("freq"))


@query(
    "join_anti",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def _(s: Source):
    other = s.table("orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.only_unmatched(s.table("customer").select("c_custkey", "c_name"), other, "c_custkey")


@query(
    "join_semi",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def _(s: Source):
    other = s.table("orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.only_matched(s.table("customer").select("c_custkey", "c_name"), other, "c_custkey")


@query("filter_members", with_survey("SELECT id, cat_rare FROM survey WHERE cat_rare IN ('R1', 'R2')"))
def _(s: Source):
    return joins.only_members(s.survey.select("id", "cat_rare"), "cat_rare", ["R1", "R2"])


@query("join_on_id", with_survey("SELECT id, ord_a, cat_low, target FROM survey"))
def _(s: Source):
    return joins.join_on_id(s.survey.select("id", "ord_a"), s.survey.select("id", "cat_low", "target"), ["id"])
