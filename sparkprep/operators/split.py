"""Deterministic splits, samples and quantile bins.

Rows are ordered by an md5 of their id and a seed.  A split needs only the key
at a few exact ranks (found with :func:`select_ranks`), after which every row
decides on its own which part it belongs to: no row is sorted or moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions.scalar import KEY_DIGITS, col, free_names, key_number, order_key, right_closed_bin, right_open_bin
from sparkprep.operators.joins import join_levels
from sparkprep.operators.quantiles import exact_quantiles, select_ranks
from sparkprep.session import materialise

PARTS = ("test", "val", "train")
#: Rows expected in one hash range of a class, the most that one window numbers.
ROWS_PER_CUT = 50_000


def key_cuts(df: DataFrame, group: Column, key: Column, ranks) -> dict[str, tuple[int, dict[int, str]]]:
    """Key text at chosen ranks of each group: rows with a smaller key are those before it.

    ``ranks(group, n)`` names the ranks; a rank of ``n`` or more has no cut.
    """
    keyed = df.select(group.cast("string").alias("g"), key.alias("k")).where(F.col("g").isNotNull())
    values = keyed.select("g", key_number(F.col("k")).alias("x"))
    found = select_ranks(values, lambda g, n: [r for r in ranks(g, n) if r < n], span=(0.0, 16.0**KEY_DIGITS))
    cuts: dict[str, tuple[int, dict[int, str]]] = {}
    ties = []
    for g, (n, by_rank) in found.items():
        cuts[g] = (n, {})
        for r, hit in by_rank.items():
            cuts[g][1][r] = format(int(hit.value), f"0{KEY_DIGITS}x")
            if hit.below != r:
                ties.append((g, r, hit.value, r - hit.below))
    if ties:
        # keys that share their leading digits: compare the whole text; a handful
        # of distinct keys, as the digits are 52 bits of a hash
        table = df.sparkSession.createDataFrame(ties, "g string, r bigint, x double, skip bigint")
        same = (
            keyed.withColumn("x", key_number(F.col("k")))
            .join(F.broadcast(table), ["g", "x"])
            .groupBy("g", "r", "k")
            .agg(F.count(F.lit(1)).alias("c"))
        )
        left = {(g, r): skip for g, r, _, skip in ties}
        for row in same.orderBy("g", "r", "k").collect():
            remaining = left[(row.g, row.r)]
            if remaining is None:
                continue
            if remaining < row.c:
                cuts[row.g][1][row.r] = row.k
                left[(row.g, row.r)] = None
            else:
                left[(row.g, row.r)] = remaining - row.c
    return cuts


def _part(key: Column, cuts: dict[int, str], n_test: int, n_val: int) -> Column:
    """Part of a row from its key and the cuts after the test and validation rows."""
    upto = lambda r: F.lit(True) if r not in cuts else key < F.lit(cuts[r])
    test, val, train = PARTS
    return F.when(upto(n_test), test).when(upto(n_test + n_val), val).otherwise(train)


def split_simple(
    df: DataFrame, id_cols: list[str], test_size=0.2, val_size=0.2, seed=42, name="split"
) -> DataFrame:
    """Append the part of each row: the first share is test, the next validation.

    ``id_cols`` must identify a row; equal ids share their part.
    """
    sizes = lambda n: (int(n * test_size), int(n * val_size))
    key = order_key(id_cols, seed)
    cuts = key_cuts(df, F.lit("all"), key, lambda _, n: [sizes(n)[0], sum(sizes(n))])
    if not cuts:
        return df.withColumn(name, F.lit(PARTS[2]))
    n, by_rank = cuts["all"]
    return df.withColumn(name, _part(key, by_rank, *sizes(n)))


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """``bins + 1`` linear percentile edges."""
    return exact_quantiles(df, [column], [i / bins for i in range(bins + 1)])[column]


def split_stratified(
    df: DataFrame, target: str, id_cols: list[str], test_size=0.2, val_size=0.2, bins=10, seed=42, name="split"
) -> DataFrame:
    """Append the percentile bin of the target and the part of each row.

    Inside each bin the first share of the hash order is test, the next
    validation.  Rows without a target get neither bin nor part.
    """
    edges = quantile_edges(df, target, bins)
    b = right_open_bin(col(target), edges[:-1])
    key = order_key(id_cols, seed)
    sizes = lambda n: (int(n * test_size), int(n * val_size))
    cuts = key_cuts(df, b, key, lambda _, n: [sizes(n)[0], sum(sizes(n))])
    part = F.lit(None).cast("string")
    of_bin, of_key = free_names(df.columns, "_bin", "_key")
    for g, (n, by_rank) in cuts.items():
        part = F.when(F.col(of_bin) == int(g), _part(F.col(of_key), by_rank, *sizes(n))).otherwise(part)
    return (
        df.select("*", b.alias(of_bin), key.alias(of_key))
        .select(*[col(c) for c in df.columns], F.col(of_bin).alias("bin"), part.alias(name))
    )


def parts_of(df: DataFrame, name: str = "split") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows of a split table, without the split column."""
    return tuple(df.where(F.col(name) == p).drop(name) for p in ("train", "val", "test"))


def sample_rows(df: DataFrame, id_cols: list[str], n: int | None = None, fraction: float | None = None, seed=42) -> DataFrame:
    """Exactly ``n`` rows (or ``floor(fraction * rows)``), without replacement, repeatable."""
    want = (lambda total: n) if n is not None else (lambda total: int(total * fraction))
    key = order_key(id_cols, seed)
    cuts = key_cuts(df, F.lit("all"), key, lambda _, total: [want(total)])
    if not cuts or not cuts["all"][1]:
        return df
    return df.where(key < F.lit(next(iter(cuts["all"][1].values()))))


def slice_rows(df: DataFrame, id_cols: list[str], offset: int, length: int, seed=42) -> DataFrame:
    """Rows at places ``offset`` to ``offset + length`` of the hash order."""
    key = order_key(id_cols, seed)
    cuts = key_cuts(df, F.lit("all"), key, lambda _, n: [offset, offset + length])
    if not cuts:
        return df
    n, by_rank = cuts["all"]
    if offset >= n:
        return df.limit(0)
    out = df.where(key >= F.lit(by_rank[offset]))
    return out.where(key < F.lit(by_rank[offset + length])) if offset + length in by_rank else out


def head_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order (a table has none of its own)."""
    return df.orderBy(*[col(c) for c in order]).limit(n)


def quantile_bins(df: DataFrame, column: str, labels: list[str], name: str) -> DataFrame:
    """Labelled quantile bins, right-closed; equal edges merge, equal values stay together."""
    edges = quantile_edges(df, column, len(labels))
    b = right_closed_bin(col(column).cast("double"), edges[1:-1])
    label = F.element_at(F.array(*[F.lit(x) for x in labels]), b + 1)
    return df.withColumn(name, F.when(col(column).isNotNull(), label))


def fold_number(id_cols: list[str], folds: int, seed=42) -> Column:
    """Fold 0..folds-1 of a row from its id."""
    return F.pmod(key_number(order_key(id_cols, seed)).cast("bigint"), F.lit(folds)).cast("int")


def stratified_folds(df: DataFrame, target: str, id_cols: list[str], folds=5, bins=10, seed=42, name="fold") -> DataFrame:
    """Append a fold 0..folds-1 of equal size inside each percentile bin of the target."""
    edges = quantile_edges(df, target, bins)
    b = right_open_bin(col(target), edges[:-1])
    key = order_key(id_cols, seed)
    starts = lambda n: [n * i // folds for i in range(1, folds)]
    cuts = key_cuts(df, b, key, lambda _, n: starts(n))
    fold = F.lit(None).cast("int")
    of_bin, of_key = free_names(df.columns, "_bin", "_key")
    for g, (n, by_rank) in cuts.items():
        passed = [(F.col(of_key) >= F.lit(by_rank[r])).cast("int") for r in starts(n) if r in by_rank]
        fold = F.when(F.col(of_bin) == int(g), sum(passed, F.lit(0))).otherwise(fold)
    return df.select("*", b.alias(of_bin), key.alias(of_key)).select(*[col(c) for c in df.columns], fold.alias(name))


def undersample(df: DataFrame, column: str, id_cols: list[str], seed=42) -> DataFrame:
    """Keep as many rows of every class as the smallest class has, by hash order.

    Rows without a class are dropped.  There may be many classes and any of them
    may be large: a class is cut into even ranges of the hash, whole ranges are
    kept up to the cut and only the range the cut falls in is numbered.
    """
    keyed = df.where(col(column).isNotNull()).select(
        F.struct(*[col(c) for c in df.columns]).alias("_row"),
        F.struct(*[col(c) for c in id_cols]).alias("_id"),
        col(column).cast("string").alias("_class"),
        order_key(id_cols, seed).alias("_key"),
    )
    sizes = materialise(keyed.groupBy("_class").agg(F.count(F.lit(1)).alias("n")), "classes")
    smallest = sizes.agg(F.min("n")).first()[0]
    if smallest is None:
        return df.limit(0)
    sizes = sizes.withColumn("_ranges", F.ceil(F.col("n") / F.lit(ROWS_PER_CUT)))
    place = F.floor(key_number(F.col("_key")) / F.lit(16.0**KEY_DIGITS) * F.col("_ranges"))
    counts = (
        join_levels(keyed.select("_class", "_key"), sizes, "_class")
        .groupBy("_class", place.alias("_cut"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    upto = F.sum("_rows").over(Window.partitionBy("_class").orderBy("_cut"))
    cuts = (
        counts.select("*", (upto - F.col("_rows")).alias("_before"))
        .where((F.col("_before") < smallest) & (F.col("_before") + F.col("_rows") >= smallest))
        .select("_class", "_cut", (F.lit(smallest) - F.col("_before")).alias("_need"))
        .join(sizes, "_class")
    )
    placed = join_levels(keyed, materialise(cuts, "cuts"), "_class").withColumn("_place", place)
    order = Window.partitionBy("_class").orderBy("_key", "_id")
    edge = (
        placed.where(F.col("_place") == F.col("_cut"))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= F.col("_need"))
    )
    names = [F.col("_row").getField(c).alias(c) for c in df.columns]
    return placed.where(F.col("_place") < F.col("_cut")).select(*names).unionByName(edge.select(*names))
