"""Encoders fitted on the training rows and applied to all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Source, query, with_survey
from sparkprep.functions.scalar import col
from sparkprep.operators import encode
from sparkprep.operators.split import fold_number


def _codes(c: str) -> str:
    return f"c_{c} AS (SELECT {c} AS level, CAST(row_number() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS code FROM train WHERE {c} IS NOT NULL GROUP BY {c})"


_ORD = ["ord_a", "country_id", "isco", "num_low_missing"]


@query(
    "encode_ordinal",
    with_survey(
        "WITH " + ",\n".join(_codes(c) for c in _ORD) + "\nSELECT p.id, p.split, "
        + ", ".join(f"CASE WHEN p.{c} IS NOT NULL THEN coalesce(c_{c}.code, -1) END AS {c}" for c in _ORD)
        + " FROM parts p " + " ".join(f"LEFT JOIN c_{c} ON p.{c} = c_{c}.level" for c in _ORD)
    ),
)
def _(s: Source):
    return encode.OrdinalCoder(inputCols=_ORD).fit(s.train).transform(s.parts.select("id", "split", *_ORD))


@query("encode_binary", with_survey("SELECT id, split, CAST(cat_bin = 'O' AS INT) AS cat_bin, cat_low FROM parts"))
def _(s: Source):
    names = ["cat_bin", "cat_low"]
    return encode.BinaryCoder(inputCols=names).fit(s.train).transform(s.parts.select("id", "split", *names))


_HOT = {
    "cat_low": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "None"],
    "cat_rare": ["F", "O", "P", "R1", "R2"],
    "ord_b": ["1", "2", "3", "4", "None"],
}


@query(
    "encode_onehot",
    with_survey(
        "SELECT id, split, cat_bin, "
        + ", ".join(
            f"""CASE WHEN coalesce(CAST({c} AS VARCHAR), 'None') = '{v}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS "{c}_{v}\""""
            for c, vs in _HOT.items()
            for v in vs
        )
        + " FROM parts"
    ),
)
def _(s: Source):
    names = [*_HOT, "cat_bin"]
    return encode.OneHotCoder(inputCols=names).fit(s.train).transform(s.parts.select("id", "split", *names))


def _freq(c: str) -> str:
    return f"f_{c} AS (SELECT {c} AS level, count(*) / (SELECT count(*) FROM train) AS f FROM train WHERE {c} IS NOT NULL GROUP BY {c})"


@query(
    "encode_frequency",
    with_survey(
        f"WITH {_freq('country')}, {_freq('isco')} SELECT p.id, p.split, p.cat_low, round(coalesce(f_country.f, 0), 9) AS country, "
        "round(coalesce(f_isco.f, 0), 9) AS isco FROM parts p LEFT JOIN f_country ON p.country = f_country.level "
        "LEFT JOIN f_isco ON p.isco = f_isco.level"
    ),
)
def _(s: Source):
    names = ["country", "isco", "cat_low"]
    out = encode.FrequencyCoder(inputCols=names).fit(s.train).transform(s.parts.select("id", "split", *names))
    return out.withColumns({c: F.round(c, 9) for c in ("country", "isco")})


def _rare(c: str) -> str:
    return (
        f"CASE WHEN {c} IN (SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} "
        f"HAVING count(*) / (SELECT count(*) FROM train) < 0.01) THEN 'Other' ELSE {c} END AS {c}"
    )


@query("group_rare", with_survey(f"SELECT id, split, {_rare('cat_rare')}, {_rare('isco')}, cat_low FROM parts"))
def _(s: Source):
    names = ["cat_rare", "isco", "cat_low"]
    return encode.RareGrouper(inputCols=names).fit(s.train).transform(s.parts.select("id", "split", *names))


@query(
    "label_missing",
    with_survey("SELECT id, coalesce(ord_a, 99) AS ord_a, coalesce(cat_low, 'Unknown') AS cat_low FROM survey"),
)
def _(s: Source):
    df = s.survey.select("id", "ord_a", "cat_low")
    return encode.label_missing(encode.label_missing(df, ["ord_a"], 99), ["cat_low"], "Unknown")


@query(
    "target_encode",
    with_survey(
        "WITH f AS (SELECT id, coalesce(isco, 'None') AS level, target, "
        "CAST(concat('0x', substr(md5(concat(CAST(id AS VARCHAR), '#42')), 1, 13)) AS BIGINT) % 5 AS fold FROM survey), "
        "cell AS (SELECT level, fold, sum(target) AS s, count(*) AS c FROM f GROUP BY level, fold), "
        "lvl AS (SELECT level, sum(s) AS s, sum(c) AS c FROM cell GROUP BY level), "
        "part AS (SELECT fold, sum(s) AS s, sum(c) AS c FROM cell GROUP BY fold), "
        "al AS (SELECT sum(s) AS s, sum(c) AS c FROM cell) "
        "SELECT f.id, round(CASE WHEN lvl.c > cell.c THEN (lvl.s - cell.s) / (lvl.c - cell.c) "
        "ELSE (al.s - part.s) / (al.c - part.c) END, 6) AS isco_target FROM f JOIN cell USING (level, fold) "
        "JOIN lvl USING (level) JOIN part USING (fold), al"
    ),
)
def _(s: Source):
    df = s.survey.select("id", "isco", "target")
    out = encode.target_encode(df, "isco", "target", fold_number(["id"], 5), 5, "isco_target")
    return out.select("id", F.round(col("isco_target"), 6).alias("isco_target"))
