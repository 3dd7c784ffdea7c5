"""Nearest-neighbour imputation over distinct profiles.

Rows with equal values in the imputed columns are one profile, counted once, so
the distance work depends on the number of distinct profiles and not on the
number of rows.  The search is exact: profiles are cut into blocks by missing
pattern and ranges of their values.  For each column that it misses, a block of
receivers meets its nearest block of donors first, and a further one is passed
over only if its bounding box, in the columns that both patterns have, is farther
away than the neighbours found by then.
"""

from __future__ import annotations

import math

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions.scalar import col, free_names, number
from sparkprep.operators.base import FitStep, keyword_only
from sparkprep.operators.encode import LevelModel
from sparkprep.operators.joins import join_levels
from sparkprep.operators.stats import aggregate_long
from sparkprep.session import cut_lineage, materialise

#: Distinct profiles of each side in one block; a task compares one block of
#: receivers with one block of donors.
DONOR_BLOCK = 20_000
RECEIVER_BLOCK = 2_000
#: A missing pattern with one part in so many of a range, or more, has a block of its own.
PATTERNS = 16
#: Columns that order the blocks.
LEAD = 4
#: Each block of receivers meets its nearest block of donors, then the next few, then the rest;
#: after each round the blocks beyond the neighbours found are passed over.
ROUNDS = (0, 1, 8)
#: Cells of one distance matrix in a task.
MATRIX_CELLS = 2_000_000

FOUND = "rb int, profile string, feature int, d2 double, donor array<double>, value double, n bigint"


def _profile_key(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce((col(c).cast("double") + F.lit(0.0)).cast("string"), F.lit("")) for c in cols])


def _profiles(df: DataFrame, cols: list[str]) -> DataFrame:
    values = F.array(*[col(c).cast("double") + F.lit(0.0) for c in cols])
    return df.groupBy(_profile_key(cols).alias("profile")).agg(
        F.first(values).alias("x"), F.count(F.lit(1)).alias("n")
    )


def _block_search(n_cols: int, k: int):
    """Search of one receiver block in one donor block, for ``cogroup``.

    Everything the workers need is inside, so the package need not be installed there.
    """
    import numpy as np
    import pandas as pd

    columns = ["rb", "profile", "feature", "d2", "donor", "value", "n"]

    def matrix(values):
        return np.array([[np.nan if v is None else v for v in row] for row in values], dtype=float)

    def search(receivers: pd.DataFrame, donors: pd.DataFrame) -> pd.DataFrame:
        if receivers.empty or donors.empty:
            return pd.DataFrame(columns=columns)
        y = matrix(donors["x"])
        tidy = np.where(np.isnan(y), np.inf, y)
        order = np.lexsort(tidy.T[::-1])  # first column is the main key
        y, tidy, counts = y[order], tidy[order], donors["n"].to_numpy()[order]
        my, y0 = (~np.isnan(y)).astype(float), np.nan_to_num(y)
        x_all, names = matrix(receivers["x"]), receivers["profile"].to_numpy()
        block = int(receivers["rb"].iloc[0]) if "rb" in receivers else 0
        step, out = max(1, MATRIX_CELLS // len(y)), []
        for start in range(0, len(x_all), step):
            x = x_all[start : start + step]
            mx, x0 = (~np.isnan(x)).astype(float), np.nan_to_num(x)
            both = mx @ my.T
            # direct differences: an expanded square loses the digits of large values
            gap = np.zeros(both.shape)
            for f in range(x.shape[1]):
                gap += np.square(x0[:, f, None] - y0[None, :, f]) * (mx[:, f, None] * my[None, :, f])
            with np.errstate(divide="ignore", invalid="ignore"):
                d2 = np.where(both > 0, n_cols / both * np.maximum(gap, 0.0), np.inf)
            for f in range(x.shape[1]):
                rows, usable = np.flatnonzero(mx[:, f] == 0), np.flatnonzero(my[:, f] > 0)
                if not len(rows) or not len(usable):
                    continue
                d = d2[np.ix_(rows, usable)]
                # all that are as near as the k-th, then in order: donors are sorted, ties go to the smaller one
                edge = np.partition(d, k - 1, axis=1)[:, k - 1 : k] if len(usable) > k else np.inf
                i, j = np.nonzero(np.isfinite(d) & (d <= edge))
                order = np.lexsort((j, d[i, j], i))
                i, j = i[order], j[order]
                near = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, j = i[near], j[near]
                n = counts[usable[j]]
                before = np.cumsum(n) - n
                need = before - before[np.searchsorted(i, i)] < k
                i, j = i[need], j[need]
                at = usable[j]
                if not len(at):
                    continue
                found = (names[start + rows[i]], f, d[i, j], tidy[at].tolist(), y[at, f], counts[at])
                out.append(pd.DataFrame(dict(zip(columns, (block, *found), strict=True))))
        return pd.concat(out) if out else pd.DataFrame(columns=columns)

    return search


def _dealt(profiles: DataFrame, size: int, lead: list[int], name: str) -> tuple[DataFrame, int]:
    """Profiles with the number of their block, and a number that all blocks lie below.

    A range of (missing pattern, leading columns) is cut by pattern: each pattern with a sixteenth of its
    rows or more is a block of its own, the others share one.  Profiles are distinct, so no range can be hot.
    """
    ranges = max(1, math.ceil(profiles.count() / size))
    if ranges == 1:
        return profiles.withColumn("block", F.lit(0)), 1
    pattern = F.array_join(F.transform("x", lambda v: F.when(v.isNull(), "0").otherwise("1")), "")
    spread = profiles.repartitionByRange(ranges, pattern, *[F.col("x")[i] for i in lead], "profile")
    # the range number must not change between two reads
    spread = materialise(spread.select("*", F.spark_partition_id().alias("part"), pattern.alias("pattern")), name)
    rows = lambda *by: F.count(F.lit(1)).over(Window.partitionBy("part", *by))
    often = rows("pattern") * PATTERNS >= F.greatest(rows(), F.lit(size))
    keyed = spread.select("*", F.when(often, F.col("pattern")).otherwise("").alias("own"))
    place = F.dense_rank().over(Window.partitionBy("part").orderBy("own")) - 1
    block = (F.col("part") * (PATTERNS + 1) + place).cast("int")
    blocks = keyed.select(*profiles.columns, block.alias("block"))
    return materialise(blocks, name), ranges * (PATTERNS + 1)


def _boxes(dealt: DataFrame, n_cols: int, prefix: str) -> DataFrame:
    """Per block and column: least and greatest value, whether all rows have one, how many table rows do, and how many profiles don't."""
    each = lambda f: F.array(*[f(F.col("x")[i]) for i in range(n_cols)])
    return dealt.groupBy(F.col("block").alias(f"{prefix}b")).agg(
        each(F.min).alias(f"{prefix}_lo"),
        each(F.max).alias(f"{prefix}_hi"),
        each(lambda v: F.count(v) == F.count(F.lit(1))).alias(f"{prefix}_all"),
        each(lambda v: F.sum(F.when(v.isNotNull(), F.col("n")).otherwise(0))).alias(f"{prefix}_n"),
        each(lambda v: F.count_if(v.isNull())).alias(f"{prefix}_open"),
    )


def _block_pairs(receivers: DataFrame, donors: DataFrame, n_cols: int, k: int, d_blocks: int) -> DataFrame:
    """``(rb, db, feature, bound, open, place)``: which donor blocks can fill a column of a receiver block, nearest first.

    The bound of the squared distance comes from the columns that all rows of both blocks have.  It is scaled up
    like the distance, by the most columns that two rows can share; in blocks of one pattern these are the same
    columns.  Pairs that share no column, or whose donors lack what the receivers miss, don't appear.  Blocks with
    fewer than ``k`` values of a column come after the others.
    """
    left = _boxes(receivers, n_cols, "r").withColumn("db", F.explode(F.sequence(F.lit(0), F.lit(d_blocks - 1))))
    both = left.join(_boxes(donors, n_cols, "d"), "db")

    def gap(i: Column) -> Column:
        far = F.greatest(F.col("r_lo")[i] - F.col("d_hi")[i], F.col("d_lo")[i] - F.col("r_hi")[i], F.lit(0.0))
        return F.when(F.col("r_all")[i] & F.col("d_all")[i], far * far).otherwise(F.lit(0.0))

    every = F.sequence(F.lit(0), F.lit(n_cols - 1))
    shared = F.size(F.filter(every, lambda i: (F.col("r_n")[i] > 0) & (F.col("d_n")[i] > 0)))
    bound = F.aggregate(every, F.lit(0.0), lambda s, i: s + gap(i)) * F.try_divide(F.lit(float(n_cols)), "shared")
    fills = F.filter(every, lambda i: (F.col("r_open")[i] > 0) & (F.col("d_n")[i] > 0))
    by_column = both.withColumn("shared", shared).where("shared > 0").select(
        "rb", "db", bound.alias("bound"), "r_open", "d_n", F.explode(fills).alias("feature")
    )
    near = Window.partitionBy("rb", "feature").orderBy(F.col("d_n")[F.col("feature")] < k, "bound", "db")
    return by_column.select(
        "rb", "db", "feature", "bound", F.col("r_open")[F.col("feature")].alias("open"), F.row_number().over(near).alias("place")
    )


def _search_pairs(receivers: DataFrame, donors: DataFrame, pairs: DataFrame, n_cols: int, k: int) -> DataFrame:
    """At most ``k`` candidates per block pair, profile and missing column."""
    left = receivers.select(F.col("block").alias("rb"), "profile", "x").join(pairs.select("rb", "db"), "rb")
    right = donors.select(F.col("block").alias("db"), "x", "n").join(pairs.select("rb", "db"), "db")
    return left.groupBy("rb", "db").cogroup(right.groupBy("rb", "db")).applyInPandas(_block_search(n_cols, k), FOUND)


def _search_one(receivers: DataFrame, donors: DataFrame, n_cols: int, k: int) -> DataFrame:
    """Candidates from the only block of donors, sent once to each worker; receivers stay where they are."""
    # at most DONOR_BLOCK profiles
    block = donors.select("x", "n").toPandas()
    block["x"] = [list(row) for row in block["x"]]
    sent = receivers.sparkSession.sparkContext.broadcast(block)
    search = _block_search(n_cols, k)

    def over(batches):
        for batch in batches:
            found = search(batch, sent.value)
            if len(found):
                yield found

    return receivers.select(F.col("block").alias("rb"), "profile", "x").mapInPandas(over, FOUND)


def _reach(found: DataFrame, k: int) -> DataFrame:
    """Per receiver block and column: how many missing cells have ``k`` candidates, and the greatest ``k``-th distance of these."""
    w = Window.partitionBy("rb", "profile", "feature").orderBy("d2").rowsBetween(Window.unboundedPreceding, 0)
    kth = F.min(F.when(F.col("upto") >= k, F.col("d2"))).alias("kth")
    cells = found.withColumn("upto", F.sum("n").over(w)).groupBy("rb", "profile", "feature").agg(kth)
    return cells.groupBy("rb", "feature").agg(F.count("kth").alias("closed"), F.max("kth").alias("reach"))


def impute_profiles(receivers: DataFrame, donors: DataFrame, n_cols: int, k: int, lead: list[int] | None = None) -> DataFrame:
    """``(profile, feature, value)``: mean of the ``k`` nearest donor rows per missing feature.

    The squared distance over the shared columns is scaled up to all columns;
    ties go to the smaller donor profile.  ``lead`` are the columns that order
    the blocks, best those with the widest values; they don't change the result.
    """
    lead = list(range(min(n_cols, LEAD))) if lead is None else lead
    right, d_blocks = _dealt(donors, DONOR_BLOCK, lead, "donor_blocks")
    if d_blocks == 1:
        found = _search_one(receivers.withColumn("block", F.lit(0)), right, n_cols, k)
    else:
        left, _ = _dealt(receivers, RECEIVER_BLOCK, lead, "receivers")
        pairs = materialise(_block_pairs(left, right, n_cols, k, d_blocks), "block_pairs")
        visited = found = None
        # a pair of blocks is visited in the round of the column it is nearest for
        for after, upto in zip(ROUNDS, [*ROUNDS[1:], None]):
            nearer = pairs.where(F.col("place") > after)
            nearer = nearer if upto is None else nearer.where(F.col("place") <= upto)
            if found is not None:
                nearer = nearer.join(_reach(found, k), ["rb", "feature"], "left").where(
                    F.col("closed").isNull() | (F.col("closed") < F.col("open")) | (F.col("bound") <= F.col("reach") * (1 + 1e-9))
                )
            nearer = nearer.select("rb", "db").distinct()
            nearer = nearer if visited is None else nearer.join(visited, ["rb", "db"], "left_anti")
            nearer = materialise(nearer, "visits")
            visited = nearer if visited is None else visited.unionByName(nearer)
            more = materialise(_search_pairs(left, right, nearer, n_cols, k), "candidates")
            found = more if found is None else found.unionByName(more)
    # at most k candidates per donor block, profile and feature
    w = Window.partitionBy("profile", "feature").orderBy("d2", "donor")
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        found.withColumn("t", F.least(F.col("n"), F.lit(k) - before))
        .where(F.col("t") > 0)
        .groupBy("profile", "feature")
        .agg((F.sum(F.col("t") * F.col("value")) / F.sum("t")).alias("value"))
    )


class KnnModel(LevelModel):
    """Donor profiles in ``table(profile, x, n)`` and the column means for rows without donors.

    The transform searches for the profiles of the given table, so it runs jobs
    and needs a batch table; a stream is filled batch by batch.
    """

    row_local = False

    def output_schema(self, df: DataFrame) -> T.StructType:
        """Schema after this step, from the given schema alone."""
        filled = set(self.getState()["cols"])
        return T.StructType([T.StructField(f.name, T.DoubleType(), False) if f.name in filled else f for f in df.schema])

    def _transform(self, df: DataFrame) -> DataFrame:
        state = self.getState()
        cols, k, means = state["cols"], state["k"], state["means"]
        names = df.columns
        key, *found = free_names(names, "_profile", *[f"_v{i}" for i in range(len(cols))])
        keyed = df.withColumn(key, _profile_key(cols))
        incomplete = F.lit(False)
        for c in cols:
            incomplete = incomplete | col(c).isNull()
        seen = cut_lineage(_profiles(df.where(incomplete), cols))
        values = impute_profiles(seen, self.table, len(cols), k, state.get("lead"))
        wide = values.groupBy("profile").agg(
            *[F.max(F.when(F.col("feature") == i, F.col("value"))).alias(found[i]) for i in range(len(cols))]
        )
        lookup = cut_lineage(
            seen.select("profile", "n").join(wide, "profile", "left").withColumnRenamed("profile", key)
        )
        joined = join_levels(keyed, lookup, key)
        filled = {
            c: F.coalesce(col(c).cast("double"), F.col(found[i]), F.lit(means[c]).cast("double"))
            for i, c in enumerate(cols)
        }
        return joined.select(*[filled[c].alias(c) if c in filled else col(c) for c in names])


class KnnFill(FitStep):
    """Fill each null with the mean of the ``k`` nearest rows of the fit table that have the value.

    Distances use the columns both rows have, scaled up to all columns.  A row
    that shares no column with any donor gets the column mean; a column without
    any value is filled with 0.
    """

    k: "Param[int]" = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, k=None):
        super().__init__()
        self._configure({"k": 5}, self._input_kwargs)

    def _fit(self, df: DataFrame) -> KnnModel:
        cols = self.present(df)
        measures = {"m": (lambda c: F.avg(number(c)), "double"), "s": (lambda c: F.stddev_pop(number(c)), "double")}
        found = {r.variable: r for r in aggregate_long(df, cols, measures).collect()} if cols else {}
        means = {c: found[c].m for c in cols}
        wide = sorted(range(len(cols)), key=lambda i: -(found[cols[i]].s or 0.0))
        state = {
            "cols": cols,
            "k": self.getOrDefault(self.k),
            "lead": wide[:LEAD],
            "means": {c: 0.0 if means[c] is None else means[c] for c in cols},
            "inline": {},
            "sizes": {"profiles": 1},
        }
        return KnnModel(state, materialise(_profiles(df, cols), "donors"))
