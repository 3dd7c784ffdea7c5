"""Association and redundancy between columns."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions.scalar import col, lenient_double
from sparkprep.operators.joins import join_levels
from sparkprep.operators.ranking import running_totals
from sparkprep.operators.stats import missing_matrix, missing_table, n_unique, null_rates, numeric_columns
from sparkprep.session import materialise

#: Up to this many pairs are computed as JVM aggregates; wider tables use
#: per-partition moment matrices.  Both merge centred moments and treat nulls,
#: NaN, constants and empty tables alike.
JVM_PAIRS = 120
#: Up to this many pairs are counted from one row per row and pair; more in
#: tables that each task keeps.  Counts are the same.
ROW_PAIRS = 24
#: Cells that a task keeps before it hands them on, and widest dense table.
TASK_CELLS, DENSE = 2_000_000, 65_536

PAIR_SCHEMA = "var_a string, var_b string, n bigint, r double"


def _pearson_pair(a: Column, b: Column, i: int) -> list[Column]:
    """Moments of one pair over the rows where both are present."""
    both = a.isNotNull() & b.isNotNull()

    def spread(x: Column) -> Column:
        # the deviation of a constant may come out as rounding noise
        x = F.when(both, x)
        return F.when(F.min(x) != F.max(x), F.stddev_pop(x))

    return [
        F.count_if(both).alias(f"n{i}"),
        F.covar_pop(a, b).alias(f"c{i}"),
        spread(a).alias(f"a{i}"),
        spread(b).alias(f"b{i}"),
    ]


def _pearson_jvm(df: DataFrame, pairs: list[tuple[str, str]], value) -> DataFrame:
    aggs = [e for i, (a, b) in enumerate(pairs) for e in _pearson_pair(value(a), value(b), i)]
    args = []
    for i, (a, b) in enumerate(pairs):
        r = F.try_divide(F.col(f"c{i}"), F.col(f"a{i}") * F.col(f"b{i}"))
        args += [F.lit(a), F.lit(b), F.col(f"n{i}"), r]
    return df.agg(*aggs).select(F.stack(F.lit(len(pairs)), *args).alias("var_a", "var_b", "n", "r"))


def _task_moments(batches, p: int):
    """Means, centred squares and products, least and greatest values of all column pairs over the rows of a task.

    Rows of one missing pattern are centred on their own means, then merged by the update formula for parts, so digits
    survive wherever the values lie and whatever is missing.
    """
    import numpy as np

    n, mean, square, cross = np.zeros((p, p)), np.zeros((p, p)), np.zeros((p, p)), np.zeros((p, p))
    low, high = np.full((p, p), np.inf), np.full((p, p), -np.inf)
    for pdf in batches:
        x = pdf.to_numpy(dtype=float, na_value=np.nan)
        pattern, of = np.unique(~np.isnan(x), axis=0, return_inverse=True)
        order = np.argsort(of.ravel(), kind="stable")
        ends = np.cumsum(np.bincount(of.ravel(), minlength=len(pattern)))
        for mask, end, start in zip(pattern, ends, np.concatenate(([0], ends[:-1])), strict=True):
            has = np.flatnonzero(mask)
            if len(has) < 2:
                continue
            at, rows = np.ix_(has, has), x[order[start:end]][:, has]
            k, m = end - start, rows.mean(axis=0)
            z = rows - m
            c = z.T @ z
            total = n[at] + k
            gap = m[:, None] - mean[at]
            weight = n[at] * k / total
            # mean[i, j] and square[i, j] are those of column i where column j is present
            square[at] += np.diag(c)[:, None] + gap * gap * weight
            cross[at] += c + gap * gap.T * weight
            mean[at] += gap * k / total
            n[at] = total
            low[at] = np.minimum(low[at], rows.min(axis=0)[:, None])
            high[at] = np.maximum(high[at], rows.max(axis=0)[:, None])
    return n, mean, square, cross, low, high


def pearson_moments(df: DataFrame, cols: list[str], value) -> DataFrame:
    """All pairs of many columns: centred co-moments of each task, merged by pair."""
    import numpy as np
    import pandas as pd

    p, spark = len(cols), df.sparkSession
    data = df.select(*[value(c).alias(f"c{i}") for i, c in enumerate(cols)])
    upper = np.triu_indices(p, 1)

    def moments(batches):
        n, mean, square, cross, low, high = _task_moments(batches, p)
        i, j = upper
        some = n[i, j] > 0
        i, j = i[some], j[some]
        parts = {"ma": mean[i, j], "mb": mean[j, i], "qa": square[i, j], "qb": square[j, i], "xy": cross[i, j]}
        varies = {"la": low[i, j], "ha": high[i, j], "lb": low[j, i], "hb": high[j, i]}
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], **parts, **varies})

    parts = data.mapInPandas(moments, "i int, j int, " + ", ".join(f"{c} double" for c in "n ma mb qa qb xy la ha lb hb".split()))
    parts = materialise(parts, "moments")
    of_pair = Window.partitionBy("i", "j")
    # one row for each task and pair; parts are moved to the mean of all of them
    whole = lambda m: F.col(m) - F.sum(F.col("n") * F.col(m)).over(of_pair) / F.sum("n").over(of_pair)
    moved = parts.withColumns({"da": whole("ma"), "db": whole("mb")})
    shifted = lambda q, a, b: F.sum(F.col(q) + F.col("n") * F.col(a) * F.col(b))
    total = moved.groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        shifted("qa", "da", "da").alias("qa"),
        shifted("qb", "db", "db").alias("qb"),
        shifted("xy", "da", "db").alias("xy"),
        ((F.min("la") < F.max("ha")) & (F.min("lb") < F.max("hb"))).alias("varies"),
    )
    pairs = spark.range(p * p).select(F.floor(F.col("id") / p).cast("int").alias("i"), (F.col("id") % p).cast("int").alias("j")).where("i < j")
    label = lambda k: F.element_at(F.array(*[F.lit(c) for c in cols]), F.col(k) + 1)
    r = F.when(F.col("varies"), F.try_divide("xy", F.sqrt("qa") * F.sqrt("qb")))
    return pairs.join(total, ["i", "j"], "left").select(
        label("i").alias("var_a"), label("j").alias("var_b"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), r.alias("r")
    )


def pearson_matrix(
    df: DataFrame, cols: list[str] | None = None, exclude_flag: float | None = None, nulls: str = "pairwise"
) -> DataFrame:
    """Pearson correlation of every column pair ``(var_a, var_b, n, r)``, a before b.

    ``pairwise`` uses the rows where both are present; ``propagate`` gives no
    value to a pair with any null, as a plain matrix computation does.  A
    constant column has no correlation (null); NaN counts as missing.
    """
    cols = cols or numeric_columns(df)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)

    def value(c: str) -> Column:
        x = col(c).cast("double")
        x = F.when(~F.isnan(x), x)  # NaN is missing, however many columns there are
        return x if exclude_flag is None else F.when(x != F.lit(exclude_flag), x)

    pairs = list(combinations(cols, 2))
    out = _pearson_jvm(df, pairs, value) if len(pairs) <= JVM_PAIRS else pearson_moments(df, cols, value)
    if nulls == "propagate":
        full = [c for c, rate in null_rates(df, cols).items() if rate == 0]
        ok = F.col("var_a").isin(full) & F.col("var_b").isin(full)
        out = out.select("var_a", "var_b", "n", F.when(ok, F.col("r")).alias("r"))
    return out


def correlated_pairs(
    df: DataFrame, cols: list[str] | None = None, threshold: float = 0.90, exclude_flag=None, nulls="pairwise"
) -> DataFrame:
    """Pairs with an absolute Pearson correlation above the threshold."""
    out = pearson_matrix(df, cols, exclude_flag, nulls)
    return out.where(F.abs("r") > threshold)


def missing_correlations(
    df: DataFrame, cols: list[str] | None = None, low=20.0, high=80.0, threshold=0.5, limit: int | None = None
) -> DataFrame:
    """Pairs of moderately missing columns that tend to be missing together."""
    pct = {r.variable: r.missing_pct for r in missing_table(df, cols).collect()}
    chosen = [c for c in (cols or df.columns) if low <= pct[c] <= high][:limit]
    return correlated_pairs(missing_matrix(df, chosen), chosen, threshold)


# --- rank correlation --------------------------------------------------------


def _cells(df: DataFrame, pairs: list[tuple[str, str]], value) -> DataFrame:
    """Counts of the value pairs of each column pair, rows with a null left out."""
    if len(pairs) > ROW_PAIRS:
        return _cells_by_task(df, pairs, value)
    args = [a for i, (x, y) in enumerate(pairs) for a in (F.lit(i), value(x), value(y))]
    long = df.select(F.stack(F.lit(len(pairs)), *args).alias("pair", "x", "y"))
    return (
        long.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("pair", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )


class _TaskTables:
    """Contingency tables of many column pairs: codes by column, dense counts for few levels, sorted keys for many."""

    def __init__(self, n_cols: int, pairs: list[tuple[int, int]]):
        self.codes: list[dict] = [{} for _ in range(n_cols)]
        self.pairs, self.dense, self.keyed = pairs, {}, {}

    def add(self, columns: list) -> None:
        import numpy as np
        import pandas as pd

        coded = []
        for known, c in zip(self.codes, columns, strict=True):
            at, levels = pd.factorize(c)
            place = np.array([known.setdefault(v, len(known)) for v in levels.tolist()] + [-1], dtype=np.int64)
            coded.append(place[at])
        for k, (a, b) in enumerate(self.pairs):
            both = (coded[a] >= 0) & (coded[b] >= 0)
            x, y = coded[a][both], coded[b][both]
            shape = (len(self.codes[a]), len(self.codes[b]))
            if k not in self.keyed and shape[0] * shape[1] <= DENSE:
                table = np.bincount(x * max(shape[1], 1) + y, minlength=shape[0] * shape[1]).reshape(shape)
                if k in self.dense:
                    old = self.dense[k]
                    table[: old.shape[0], : old.shape[1]] += old
                self.dense[k] = table
                continue
            keys, n = np.unique(x << 32 | y, return_counts=True)
            if k in self.dense:
                old = self.dense.pop(k)
                i, j = np.nonzero(old)
                self.keyed[k] = (i << 32 | j, old[i, j])
            if k in self.keyed:
                keys, place = np.unique(np.concatenate([keys, self.keyed[k][0]]), return_inverse=True)
                n = np.bincount(place, weights=np.concatenate([n, self.keyed[k][1]])).astype(np.int64)
            self.keyed[k] = (keys, n)

    def size(self) -> int:
        return sum(t.size for t in self.dense.values()) + sum(len(keys) for keys, _ in self.keyed.values()) + sum(map(len, self.codes))

    def cells(self):
        """``(pair, x, y, n)`` by pair."""
        import numpy as np

        names = [np.array(list(c), dtype=object) for c in self.codes]
        for k, (a, b) in enumerate(self.pairs):
            if k in self.dense:
                i, j = np.nonzero(self.dense[k])
                n = self.dense[k][i, j]
            elif k in self.keyed:
                keys, n = self.keyed[k]
                i, j = keys >> 32, keys & 0xFFFFFFFF
            else:
                continue
            yield k, names[a][i], names[b][j], n


def _cells_by_task(df: DataFrame, pairs: list[tuple[str, str]], value) -> DataFrame:
    """The same counts without a row for each row and pair: a task keeps the tables of its rows and hands on their cells."""
    import pandas as pd

    names = sorted({c for p in pairs for c in p})
    data = df.select(*[value(c).alias(f"c{i}") for i, c in enumerate(names)])
    places = [(names.index(a), names.index(b)) for a, b in pairs]
    kind = "double" if data.schema and isinstance(data.schema[0].dataType, T.DoubleType) else "string"

    def tables(batches):
        def frames(t):
            for k, x, y, n in t.cells():
                for at in range(0, len(n), 100_000):
                    part = slice(at, at + 100_000)
                    yield pd.DataFrame({"pair": k, "x": x[part], "y": y[part], "n": n[part]}).astype({"pair": "int32", "n": "int64"})

        held = _TaskTables(len(names), places)
        for pdf in batches:
            held.add([pdf[c] for c in pdf.columns])
            if held.size() > TASK_CELLS:
                yield from frames(held)
                held = _TaskTables(len(names), places)
        yield from frames(held)

    found = data.mapInPandas(tables, f"pair int, x {kind}, y {kind}, n long")
    return found.groupBy("pair", "x", "y").agg(F.sum("n").alias("n"))


def _rankable(c: str, dtype) -> Column:
    """A value as a number; NaN is missing, and adding zero merges -0.0 with 0.0, as grouping does."""
    x = lenient_double(col(c), dtype) + F.lit(0.0)
    return F.when(~F.isnan(x), x)


def spearman(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Spearman correlation ``(var_a, var_b, n, r)`` of each pair on its complete rows.

    Equal values share their average rank; NaN is missing.  The data is read
    once; ranks come from the distinct values of each side.
    """
    types = {f.name: f.dataType for f in df.schema}
    cells = materialise(_cells(df, pairs, lambda c: _rankable(c, types[c])), "cells")

    def ranked(side: str) -> tuple[DataFrame, int]:
        # shape of a level table: the pair is the variable, the weight is the row count
        levels = materialise(
            cells.groupBy("pair", side)
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells"))
            .select(
                "pair",
                F.col("pair").cast("string").alias("variable"),
                F.lit(None).cast("bigint").alias("v_int"),
                F.col(side).alias("v_dbl"),
                F.lit(None).cast("string").alias("v_str"),
                "n",
                "cells",
            ),
            "levels",
        )
        rows = levels.count()
        ranks = running_totals(levels, rows).select(
            "pair",
            F.col("v_dbl").alias(side),
            F.col("cells").alias("n"),
            (F.col("before") + (F.col("n") + 1) / 2.0).alias(f"r{side}"),
        )
        return ranks, rows

    joined = cells
    for side in ("x", "y"):
        ranks, rows = ranked(side)
        joined = join_levels(joined, ranks, ["pair", side], rows)
    # ranks average to (rows + 1) / 2, so they can be centred without another pass
    totals = cells.groupBy("pair").agg(F.sum("n").alias("rows_of_pair"))
    mid = (F.col("rows_of_pair") + 1) / 2.0
    dx, dy = F.col("rx") - mid, F.col("ry") - mid
    sums = (
        # one row per pair on the right
        joined.join(F.broadcast(totals), "pair")
        .groupBy("pair")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * dx * dy).alias("xy"),
            F.sum(F.col("n") * dx * dx).alias("xx"),
            F.sum(F.col("n") * dy * dy).alias("yy"),
        )
    )
    label = lambda k: F.element_at(F.array(*[F.lit(p[k]) for p in pairs]), F.col("pair") + 1)
    return sums.select(
        label(0).alias("var_a"),
        label(1).alias("var_b"),
        F.col("n"),
        F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("r"),
    )


def spearman_pairs(
    df: DataFrame, cols: list[str], levels=(5, 50), max_missing_pct=70.0, threshold=0.8, limit: int | None = None
) -> DataFrame:
    """Strong rank correlations among columns of moderate cardinality and missingness.

    Cardinality counts null as a value.
    """
    card = {r.variable: r.n_unique for r in n_unique(df, cols).collect()}
    pct = {r.variable: r.missing_pct for r in missing_table(df, cols).collect()}
    chosen = [c for c in cols if levels[0] <= card[c] <= levels[1] and pct[c] < max_missing_pct][:limit]
    pairs = list(combinations(chosen, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    return spearman(df, pairs).where(F.abs("r") > threshold)


def correlation_p_value(r: float, n: int) -> float:
    """Two-sided p-value of a correlation from the t distribution with n - 2 degrees."""
    if n < 3:
        return float("nan")
    if abs(r) >= 1.0:
        return 0.0
    dof = n - 2
    x = 1.0 - r * r
    # P(|T| > t) is the regularised incomplete beta function at (dof / 2, 1 / 2, x)
    return _beta_share(dof / 2.0, 0.5, x)


def _beta_share(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_share(b, a, 1.0 - x)
    front = math.exp(
        a * math.log(x) + b * math.log(1.0 - x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    )
    # continued fraction, evaluated from the tail
    tail = 1.0
    for m in range(200, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        tail = 1.0 + even / (1.0 + odd / tail)
    first = -(a + b) * x / (a + 1)
    return front / (a * (1.0 + first / tail))


def duplicate_report(df: DataFrame, pairs: list[tuple[str, str]], threshold: float = 0.95) -> DataFrame:
    """Rank correlation, equal values and redundancy of a column and its suspected copy."""
    have = set(df.columns)
    pairs = [p for p in pairs if p[0] in have and p[1] in have]
    if not pairs:
        return df.sparkSession.createDataFrame(
            [], PAIR_SCHEMA + ", n_identical bigint, p_value double, redundant boolean"
        )
    equal = df.agg(*[F.count_if(col(a) == col(b)).alias(f"e{i}") for i, (a, b) in enumerate(pairs)]).first()
    same = {p: equal[i] for i, p in enumerate(pairs)}
    rows = []
    for r in spearman(df, pairs).collect():  # one row per pair
        p = correlation_p_value(r.r, r.n) if r.r is not None else None
        strong = r.r is not None and abs(r.r) > threshold
        rows.append((r.var_a, r.var_b, r.n, r.r, same[(r.var_a, r.var_b)], p, strong))
    return df.sparkSession.createDataFrame(
        rows, PAIR_SCHEMA + ", n_identical bigint, p_value double, redundant boolean"
    )


def duplicate_candidates(names: list[str], marker: str = "duplicated") -> list[tuple[str, str]]:
    """Pairs of a column and the column that carries its name plus ``_<marker>``."""
    have = set(names)
    found = [(n[: n.lower().index(f"_{marker}")], n) for n in names if f"_{marker}" in n.lower()]
    return [(a, b) for a, b in found if a in have]


# --- categorical association -------------------------------------------------


def cramers_v(df: DataFrame, pairs: list[tuple[str, str]], yates: bool = True) -> DataFrame:
    """Cramer's V ``(var_a, var_b, n, levels_a, levels_b, chi2, v)`` of each pair.

    Rows with a null are left out.  A 2x2 table gets the Yates correction unless
    switched off; a side with one level gives 0.
    """
    cells = materialise(_cells(df, pairs, lambda c: col(c).cast("string")), "cells")

    def margin(side: str) -> DataFrame:
        return materialise(
            cells.groupBy("pair", side).agg(F.sum("n").alias(f"m{side}"), F.count(F.lit(1)).alias("n")), "margin"
        )

    mx, my = margin("x"), margin("y")
    joined = join_levels(cells, mx, ["pair", "x"])
    joined = join_levels(joined, my, ["pair", "y"])
    share = F.col("n").cast("double") * F.col("n") / (F.col("mx").cast("double") * F.col("my"))
    sums = {
        r.pair: r
        for r in joined.groupBy("pair").agg(F.sum("n").alias("n"), F.sum(share).alias("s")).collect()
    }
    count = lambda m: {r.pair: r.c for r in m.groupBy("pair").agg(F.count(F.lit(1)).alias("c")).collect()}
    rows_of, cols_of = count(mx), count(my)
    square = [p for p in sums if rows_of[p] == 2 and cols_of[p] == 2] if yates else []
    corrected: dict[int, float] = {}
    if square:
        # four cells at most per pair
        by_pair: dict[int, dict] = {}
        for r in cells.where(F.col("pair").isin(square)).collect():
            by_pair.setdefault(r.pair, {})[(r.x, r.y)] = r.n
        for p, cell in by_pair.items():
            xs, ys = sorted({k[0] for k in cell}), sorted({k[1] for k in cell})
            total = sum(cell.values())
            chi2 = 0.0
            for x in xs:
                for y in ys:
                    expected = (
                        sum(cell.get((x, b), 0) for b in ys) * sum(cell.get((a, y), 0) for a in xs) / total
                    )
                    gap = abs(cell.get((x, y), 0) - expected)
                    # the correction never moves a cell past its expected count
                    chi2 += (gap - min(0.5, gap)) ** 2 / expected
            corrected[p] = chi2
    out = []
    for i, (a, b) in enumerate(pairs):
        if i not in sums:
            out.append((a, b, 0, 0, 0, None, None))
            continue
        n, low = sums[i].n, min(rows_of[i], cols_of[i]) - 1
        chi2 = corrected.get(i, max(n * (sums[i].s - 1.0), 0.0))
        out.append((a, b, n, rows_of[i], cols_of[i], chi2, math.sqrt(chi2 / (n * low)) if low else 0.0))
    return df.sparkSession.createDataFrame(
        out, "var_a string, var_b string, n bigint, levels_a bigint, levels_b bigint, chi2 double, v double"
    )


def weak_associations(df: DataFrame, cols: list[str], target_bin: str, threshold: float = 0.05) -> DataFrame:
    """Columns hardly associated with a binned target: candidates to drop."""
    found = cramers_v(df, [(c, target_bin) for c in cols])
    return found.where(F.col("v") < threshold).select(F.col("var_a").alias("variable"), "v")


def point_biserial(df: DataFrame, binary: str, one, target: str) -> DataFrame:
    """Correlation of a two-valued column (``one`` counts as 1) with a numeric target."""
    flag = F.when(col(binary).isNotNull(), (col(binary) == F.lit(one)).cast("double"))
    pair = df.select(flag.alias(binary), col(target).cast("double").alias(target))
    return pearson_matrix(pair, [binary, target])


def functional_mapping(df: DataFrame, a: str, b: str) -> DataFrame:
    """Does each value of ``a`` have one ``b``, and the reverse?  Null is a value.

    ``perfect`` holds when every ``a`` maps to a single ``b``; ``one_to_one`` when
    the reverse holds too.
    """
    pairs = df.groupBy(col(a).alias("a"), col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    def fan(side: str) -> DataFrame:
        per_value = pairs.groupBy(side).agg(F.count(F.lit(1)).alias("k"))
        return per_value.agg(
            F.lit(side).alias("side"),
            F.count(F.lit(1)).alias("levels"),
            F.coalesce(F.sum("k"), F.lit(0)).alias("links"),
            F.coalesce(F.max("k"), F.lit(0)).alias("widest"),
        )

    # one row per side, brought into one row
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return (
        fan("a")
        .unionByName(fan("b"))
        .agg(
            of("a", "levels").alias("n_a"),
            of("b", "levels").alias("n_b"),
            of("a", "links").alias("n_pairs"),
            (of("a", "widest") == 1).alias("perfect"),
            ((of("a", "widest") == 1) & (of("b", "widest") == 1)).alias("one_to_one"),
        )
        .select(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), "*")
    )


def removal_list(redundant: DataFrame, over_missing: DataFrame) -> DataFrame:
    """Names to remove: redundant or too often missing, each once."""
    return redundant.select("variable").unionByName(over_missing.select("variable")).distinct()
