"""Permutation of columns among the rows of a table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, free_names, order_key

#: Rows one window task sorts.
ROWS_PER_BLOCK = 500_000


def with_partner(df: DataFrame, columns: list[str], id_cols: list[str], seed: int, name: str = "_partner") -> DataFrame:
    """Append ``name``, the ``columns`` of another row: every row is the partner of one row.

    ``id_cols`` must identify a row.  The rows are put into a seeded hash order and
    each takes the next one, inside even ranges of the hash; the last of a range
    takes the first.  So one shuffle serves all columns, and nothing is numbered.
    """
    blocks = max(1, math.ceil(df.count() / ROWS_PER_BLOCK))
    key = order_key(id_cols, seed)
    lead = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
    block = F.floor(lead * F.lit(blocks) / F.lit(16.0**8)).cast("int")
    of_block, of_key = free_names(df.columns, "_block", "_key")
    w = Window.partitionBy(of_block).orderBy(of_key)
    values = F.struct(*[col(c) for c in columns])
    partner = F.coalesce(F.lead(values).over(w), F.first(values).over(w))
    keep = [col(c) for c in df.columns]
    return df.withColumns({of_key: key, of_block: block}).select(*keep, partner.alias(name))


def permuted_column(df: DataFrame, column: str, id_cols: list[str], seed: int) -> DataFrame:
    """The same rows with the values of one column moved by a seeded permutation."""
    (name,) = free_names(df.columns, "_partner")
    moved = F.col(name).getField(column)
    return with_partner(df, [column], id_cols, seed, name).select(*[moved.alias(c) if c == column else col(c) for c in df.columns])
