"""Lookups of per-level values, anti and semi membership, joins by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.session import cut_lineage

#: A lookup table of at most this many rows and bytes is broadcast (both are measured first).
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: A level is hot when it holds more than 1/HOT_PARTS of the counted rows, so
#: there are fewer than HOT_PARTS hot levels whatever the data.
HOT_PARTS = 1000


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: the text length of each cell and a fixed part."""
    cells = [F.coalesce(F.octet_length(col(c).cast("string")), F.lit(0)) + F.lit(16) for c in df.columns]
    return sum(cells[1:], cells[0]).cast("bigint")


def is_small(lookup: DataFrame, rows: int | None = None) -> bool:
    """Whether a table may be broadcast; ``rows`` is its size where that is known."""
    if rows is not None and rows > BROADCAST_ROWS:
        return False
    size = lookup.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(lookup)).alias("b")).first()
    return size.n <= BROADCAST_ROWS and (size.b or 0) <= BROADCAST_BYTES


def join_levels(df: DataFrame, lookup: DataFrame, key: str | list[str], lookup_rows: int | None = None) -> DataFrame:
    """Left join of ``df`` with ``lookup(key, n, ...)``, one lookup row per key.

    ``n`` is the number of rows the level had when it was counted; it is dropped.
    A small lookup is broadcast.  Beyond that, hot levels (fewer than
    :data:`HOT_PARTS`) are still broadcast and only the rest is shuffled, so no
    level sends more than a small share of the rows to one task.  Null keys
    match nothing and are kept out of the shuffle.  ``df`` may be a stream.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in lookup.columns if c not in (*keys, "n")]
    if is_small(lookup.select(*keys, *payload), lookup_rows):
        return df.join(F.broadcast(lookup.select(*keys, *payload)), keys, "left")
    total = lookup.agg(F.sum("n")).first()[0]
    # a level whose own row is very long is not broadcast, so the hot part is bounded in bytes too
    short = _row_bytes(lookup) <= F.lit(BROADCAST_BYTES // HOT_PARTS)
    is_hot = (F.col("n") * F.lit(HOT_PARTS) > F.lit(total)) & short
    hot = lookup.where(is_hot).select(*keys, *payload)
    cold = lookup.where(~is_hot).select(*keys, *payload)
    types = {f.name: f.dataType for f in lookup.schema}
    complete = F.lit(True)
    for k in keys:
        complete = complete & col(k).isNotNull()
    known = df.where(complete)
    nothing = df.where(~complete).select("*", *[F.lit(None).cast(types[p]).alias(p) for p in payload])
    on_hot = known.join(F.broadcast(hot), keys)
    on_cold = known.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, "left")
    return on_hot.unionByName(on_cold).unionByName(nothing)


def decode_dimension(df: DataFrame, column: str, dimension: DataFrame, key: str, label: str) -> DataFrame:
    """Append the label of a code from a dimension table; unknown codes give null.

    The dimension has one row per code.  Its size is counted first; a large one
    is joined with the hot codes of ``df`` kept apart.
    """
    name = f"{column}_{label}"
    dim = dimension.select(col(key).alias(column), col(label).alias(name))
    small = is_small(dim)
    if not small:
        used = df.where(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)).alias("n"))
        dim = cut_lineage(dim.join(used, column))
    else:
        dim = dim.withColumn("n", F.lit(1))
    return join_levels(df, dim, column).select(*[col(c) for c in df.columns], col(name))


def only_unmatched(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``other`` (rows without a key are dropped)."""
    return df.where(col(key).isNotNull()).join(other.select(col(key)).distinct(), key, "left_anti")


def only_matched(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return df.join(other.select(col(key)).distinct(), key, "left_semi")


def only_members(df: DataFrame, column: str, members: list) -> DataFrame:
    """Rows whose value is in a short list."""
    return df.where(col(column).isin(members))


def ids_off(left: DataFrame, right: DataFrame, id_cols: list[str]) -> int:
    """Ids that do not occur exactly once in each of two tables (one pass over the ids of both)."""
    side = lambda df, x, y: df.select(*[col(c) for c in id_cols], F.lit(x).alias("_x"), F.lit(y).alias("_y"))
    seen = (
        side(left, 1, 0).unionByName(side(right, 0, 1)).groupBy(*[col(c) for c in id_cols])
        .agg(F.sum("_x").alias("_x"), F.sum("_y").alias("_y"))
    )
    return seen.agg(F.count_if((F.col("_x") != 1) | (F.col("_y") != 1)).alias("n")).first().n


def join_on_id(left: DataFrame, right: DataFrame, id_cols: list[str]) -> DataFrame:
    """Columns of two tables side by side, matched by id instead of by row position.

    Every id must occur once in each table; otherwise this raises.
    """
    bad = ids_off(left, right, id_cols)
    if bad:
        raise ValueError(f"the tables do not match one to one: {bad} ids differ")
    return left.join(right, id_cols, "inner")
