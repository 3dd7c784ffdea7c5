"""Exact most frequent levels of columns with nearly as many levels as rows.

A level table of such a column is as large as the data.  Here each task keeps a
bounded summary of level hashes, the summaries are added up by hash, and only
the levels that can still be among the first are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.operators import levels as lv
from sparkprep.session import materialise

#: Hashes that a task keeps of a column.  A task of r rows undercounts none by more than r / (ENTRIES + 1).
ENTRIES = 16_384
#: Most candidates of a column that are broadcast (12 bytes each) to be counted.
CANDIDATES = 10_000

SUMMARY = "c int, h bigint, n bigint, e bigint"


def _summaries(p: int, entries: int):
    """One summary a column in each task: ``(c, h, n)`` undercounts ``h`` by at most the ``e`` of the row without a hash.

    When more than twice ``entries`` hashes are held, the count next below the kept ones is taken from all.
    """
    import numpy as np
    import pyarrow as pa

    def cut(h, n):
        if len(h) <= entries:
            return h, n, 0
        taken = int(np.partition(n, len(n) - entries - 1)[len(n) - entries - 1])
        kept = n > taken
        return h[kept], n[kept] - taken, taken

    def run(batches):
        held = [(np.empty(0, np.int64), np.empty(0, np.int64), 0) for _ in range(p)]
        for batch in batches:
            for c in range(p):
                h, n, e = held[c]
                own, counts = np.unique(batch.column(c).drop_null().to_numpy(zero_copy_only=False), return_counts=True)
                merged, at = np.unique(np.concatenate([h, own]), return_inverse=True)
                total = np.zeros(len(merged), np.int64)
                total[at[: len(h)]] += n
                total[at[len(h) :]] += counts
                taken = 0
                if len(merged) > 2 * entries:
                    merged, total, taken = cut(merged, total)
                held[c] = (merged, total, e + taken)
        for c, (h, n, e) in enumerate(held):
            h, n, taken = cut(h, n)
            yield pa.RecordBatch.from_pydict(
                {
                    "c": pa.array(np.full(len(h) + 1, c), pa.int32()),
                    "h": pa.array([None, *h.tolist()], pa.int64()),
                    "n": pa.array(np.append([0], n), pa.int64()),
                    "e": pa.array(np.append([e + taken], np.zeros(len(h), np.int64)), pa.int64()),
                }
            )

    return run


def _hashed(df: DataFrame, cols: list[str], nulls: bool) -> list:
    """One hash of the level of each column; without ``nulls`` a null level has none."""
    types = {f.name: f.dataType for f in df.schema}
    # zero has two signs and one level
    parts = [[F.when(p != 0, p).otherwise(F.abs(p)) if i == 1 else p for i, p in enumerate(lv._parts(c, types[c]))] for c in cols]
    return [F.xxhash64(*ps) if nulls else F.when(col(c).isNotNull(), F.xxhash64(*ps)) for c, ps in zip(cols, parts)]


def _bounds(summary: DataFrame, k: int, candidates: int) -> dict[int, tuple[int, int]]:
    """``{column: (cut, error)}`` of the columns whose candidates, hashes counted ``cut`` times or more, are few enough.

    Any other level occurs less than ``cut + error`` times.
    """
    seen = summary.where("h is not null")
    errors = {r.c: r.e for r in summary.where("h is null").collect()}  # one row a column
    kth = seen.select("c", "n", F.row_number().over(Window.partitionBy("c").orderBy(F.col("n").desc(), "h")).alias("i")).where(f"i <= {k}")
    # one row a column
    at = {r.c: (r.n if r.k == k else 0) for r in kth.groupBy("c").agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()}
    cuts = {c: max(at.get(c, 0) - e, 1) for c, e in errors.items() if e == 0 or at.get(c, 0) > e}
    if not cuts:
        return {}
    reached = seen.join(F.broadcast(summary.sparkSession.createDataFrame(list(cuts.items()), "c int, cut bigint")), "c").where("n >= cut")
    few = {r.c for r in reached.groupBy("c").count().collect() if r["count"] <= candidates}
    return {c: (cut, errors[c]) for c, cut in cuts.items() if c in few}


def _chunk(df: DataFrame, cols: list[str], k: int, nulls: bool, entries: int, candidates: int) -> tuple[DataFrame | None, list[str]]:
    """The first levels of those columns that the summaries settle, and the names of these columns."""
    spark, hashes = df.sparkSession, _hashed(df, cols, nulls)
    rows = df.select(*[h.alias(f"h{i}") for i, h in enumerate(hashes)]).mapInArrow(_summaries(len(cols), entries), SUMMARY)
    summary = materialise(rows.groupBy("c", "h").agg(F.sum("n").alias("n"), F.sum("e").alias("e")), "frequent")
    bounds = _bounds(summary, k, candidates)
    if not bounds:
        return None, []
    limits = spark.createDataFrame([(c, cut) for c, (cut, _) in bounds.items()], "c int, cut bigint")
    wanted = summary.where("h is not null").join(F.broadcast(limits), "c").where("n >= cut").select("c", "h")
    types = {f.name: f.dataType for f in df.schema}
    args = [a for c in bounds for a in (F.lit(c), F.lit(cols[c]), hashes[c], *lv._parts(cols[c], types[cols[c]]))]
    long = df.select(F.stack(F.lit(len(bounds)), *args).alias("c", "variable", "h", *lv.LEVEL_PARTS))
    # at most ``candidates`` hashes for each of at most CHUNK columns
    counted = long.join(F.broadcast(wanted), ["c", "h"], "left_semi").groupBy("variable", *lv.LEVEL_PARTS).agg(F.count(F.lit(1)).alias("n"))
    first = materialise(lv.top_levels(counted, k), "frequent")
    last = {r.variable: (r.n, r.k) for r in first.groupBy("variable").agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()}
    # levels that share a hash can be fewer than the hash was counted; without an error and a cut nothing was left out
    whole = lambda c, cut, e: (cut, e) == (1, 0) or (cols[c] in last and last[cols[c]][1] == k and last[cols[c]][0] >= cut + e)
    settled = [cols[c] for c, (cut, e) in bounds.items() if whole(c, cut, e)]
    return first.where(F.col("variable").isin(settled)), settled


def frequent_levels(
    df: DataFrame, cols: list[str], k: int = 10, nulls: bool = True, entries: int = ENTRIES, candidates: int = CANDIDATES
) -> DataFrame:
    """The ``k`` most frequent levels of each column ``(variable, v_int, v_dbl, v_str, n, rank)``, exact, ties by level.

    A column is settled by summaries if its k-th level occurs more often than the summaries can miss, at most one
    ``entries``-th of the rows, and at most ``candidates`` levels come near it.  Other columns have no frequent levels
    and get the whole level table.  Equals :func:`~sparkprep.operators.levels.top_levels`; null is a level unless
    ``nulls`` is false.  ``df`` is read twice, and once more for the columns left: store a costly one first.
    """
    if not cols or k < 1:
        raise ValueError("no columns or levels asked for")
    out, done = [], set()
    for start in range(0, len(cols), lv.CHUNK):
        found, settled = _chunk(df, cols[start : start + lv.CHUNK], k, nulls, entries, candidates)
        if settled:
            out.append(found)
            done |= set(settled)
    left = [c for c in cols if c not in done]
    if left:
        out.append(lv.top_levels(lv.level_counts(df, left), k, nulls))
    table = out[0]
    for other in out[1:]:
        table = table.unionByName(other)
    return table


def frequent_values(df: DataFrame, cols: list[str], k: int = 10, nulls: bool = True) -> DataFrame:
    """``(variable, rank, value, n)`` with the level as text; see :func:`frequent_levels`."""
    return frequent_levels(df, cols, k, nulls).select("variable", "rank", lv.level_text().alias("value"), "n")
