"""Query registry, the ``survey`` view and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

#: A survey-like wide table over the order tables; the text is valid in both
#: engines.  Missing values follow from the key.
SURVEY_SQL = """
SELECT o.o_orderkey AS id,
       c.c_nationkey AS country_id,
       n.n_name AS country,
       o.o_totalprice AS target,
       CASE WHEN o.o_orderkey % 10 < 6 THEN CAST(o.o_custkey % 101 AS DOUBLE) / 100 END AS q1_average_score,
       CASE WHEN o.o_orderkey % 10 < 6 THEN CAST((o.o_orderkey * 7919) % 2500000 AS DOUBLE) END AS q1_total_timing,
       CASE WHEN o.o_orderkey % 50 <> 0 THEN c.c_acctbal END AS num_low_missing,
       CASE WHEN o.o_orderkey % 4 <> 0 THEN c.c_acctbal * 2 + 1 END AS num_high_missing,
       CASE WHEN o.o_orderkey % 10 = 0 THEN o.o_totalprice END AS num_sparse,
       CASE WHEN o.o_orderkey % 7 <> 0 THEN CAST(substr(o.o_orderpriority, 1, 1) AS INT) END AS ord_a,
       CASE WHEN o.o_orderkey % 11 <> 0 THEN CAST(1 + o.o_custkey % 4 AS INT) END AS ord_b,
       CASE WHEN o.o_orderstatus = 'P' THEN 'O' ELSE o.o_orderstatus END AS cat_bin,
       CASE WHEN o.o_orderkey % 13 <> 0 THEN c.c_mktsegment END AS cat_low,
       CASE WHEN o.o_orderkey % 200 = 0 THEN 'R1' WHEN o.o_orderkey % 150 = 0 THEN 'R2' ELSE o.o_orderstatus END AS cat_rare,
       CASE WHEN o.o_orderkey % 17 <> 0 THEN lpad(CAST((o.o_custkey * 37) % 10000 AS VARCHAR(10)), 4, '0') END AS isco,
       'C8' AS meta_const
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

SURVEY_COLUMNS = (
    "id country_id country target q1_average_score q1_total_timing num_low_missing num_high_missing num_sparse "
    "ord_a ord_b cat_bin cat_low cat_rare isco meta_const"
).split()

#: CTEs every oracle text may use: ``survey`` and ``parts`` (survey plus its split).
_CTES = f"""survey AS ({SURVEY_SQL.format(orders="orders", customer="customer", nation="nation")}),
placed AS (SELECT *, row_number() OVER (ORDER BY md5(concat(CAST(id AS VARCHAR), '#42')), id) - 1 AS rk,
                  count(*) OVER () AS nn FROM survey),
parts AS (SELECT * EXCLUDE (rk, nn),
                 CASE WHEN rk < trunc(nn * 0.2) THEN 'test' WHEN rk < 2 * trunc(nn * 0.2) THEN 'val' ELSE 'train' END AS split
          FROM placed),
train AS (SELECT * FROM parts WHERE split = 'train')"""


def with_survey(body: str) -> str:
    """Oracle text over the survey CTEs; ``body`` may add CTEs with ``WITH`` first."""
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {_CTES},\n{body[5:]}"
    return f"WITH {_CTES}\n{body}"


def union_all(template: str, names) -> str:
    """One SELECT per name, with ``{c}`` replaced."""
    return "\nUNION ALL\n".join(template.replace("{c}", n) for n in names)


class Source:
    """Test tables of one scale folder, read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def survey(self) -> DataFrame:
        tables = {t: self.table(t) for t in ("orders", "customer", "nation")}
        return self.spark.sql(SURVEY_SQL, **tables)

    @cached_property
    def parts(self) -> DataFrame:
        from sparkprep.operators.split import split_simple

        return split_simple(self.survey, ["id"])

    @property
    def train(self) -> DataFrame:
        return self.parts.where("split = 'train'")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(source)`` under a name, with its oracle text if there is one."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add
