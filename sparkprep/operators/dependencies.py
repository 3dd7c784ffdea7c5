"""Search of functional dependencies between single columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col

#: Columns tested in one grouping.
STEP = 16

SCHEMA = "lhs string, rhs string, lhs_levels bigint, rhs_levels bigint, lhs_is_key boolean"


def _levels(df: DataFrame, cols: list[str]) -> tuple[int, dict[str, int]]:
    """Row count and distinct values of each column, null included."""
    out, n = {}, df.count()
    for c in cols:
        out[c] = df.select(col(c).alias("v")).groupBy("v").count().count()
    return n, out


def dependencies(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(lhs, rhs, lhs_levels, rhs_levels, lhs_is_key)``: all ``lhs -> rhs`` that hold, each with a single column on the left.

    Null is a value.  Constant columns (and any column of an empty table) depend on nothing at all, so they are no
    ``rhs`` and no ``lhs``: what is listed is minimal.  A column with different values in all rows (``lhs_is_key``)
    determines every other one.

    Distinct counts rule out most pairs: a column can't determine one with more values.  The rest of a column's
    pairs are tested in groupings by it, of hashes, combined before the shuffle, that read only the columns in
    question; a pair that passes is confirmed by the distinct values of both.
    Columns are taken from few values to many, so what a column determines is also known of those that determine it.
    """
    cols = cols or df.columns
    n, levels = _levels(df, cols)
    live = sorted((c for c in cols if levels[c] > 1), key=lambda c: levels[c])
    holds: dict[str, set[str]] = {}
    for a in live:
        if levels[a] == n:
            holds[a] = {b for b in live if b != a}
            continue
        known: set[str] = set()
        open_pairs = [b for b in live if b != a and levels[b] <= levels[a]]
        while open_pairs:
            # the finest columns first: whatever they determine, a does too
            step = open_pairs[-STEP:]
            hashes = [F.xxhash64(col(b)).alias(f"b{i}") for i, b in enumerate(step)]
            one = [(F.min(f"b{i}") == F.max(f"b{i}")).alias(f"f{i}") for i in range(len(step))]
            alike = df.select(col(a).alias("a"), *hashes).groupBy("a").agg(*one)
            alike = alike.agg(*[F.min(f"f{i}").alias(f"f{i}") for i in range(len(step))]).first()
            for b in reversed([b for b, same in zip(step, alike, strict=True) if same]):
                # different hashes are different values; equal ones are looked at again
                if b not in known and df.select(col(a).alias("a"), col(b).alias("b")).distinct().count() == levels[a]:
                    known |= {b} | (holds.get(b, set()) - {a})
            open_pairs = [b for b in open_pairs if b not in step and b not in known]
        holds[a] = known
    rows = [(a, b, levels[a], levels[b], levels[a] == n) for a in live for b in live if b in holds[a]]
    return df.sparkSession.createDataFrame(rows, SCHEMA)
