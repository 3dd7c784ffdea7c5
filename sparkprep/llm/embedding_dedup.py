"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine ``c`` lie at distance ``sqrt(2 - 2c)``.  The vectors are rotated onto their leading principal
dimensions, put into grid cells of that side, and sorted by cell, dimension by dimension.  The sorted sequence is cut
into intervals.  Interval pairs whose bounding boxes are farther apart than the distance are skipped; the others are
joined in tasks of their own, which halve the intervals again and again with the same test before they multiply.

Defined results: null, empty and zero vectors and vectors with null or non-finite components link with nothing and are
their own component.  Vectors of different lengths never link.  Rows with a null id get 0 links, a null component and
``kept = false``.  Copies are one vector with a count; rows that repeat an id count as vectors of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkprep.functions.scalar import col
from sparkprep.llm.graph import components
from sparkprep.session import materialise

#: Vectors that the rotation is fitted on.  It only decides how much is skipped, never the result.
ROTATION_SAMPLE = 20_000
#: Vectors of an interval; a task holds two intervals.
INTERVAL = 4096
#: Intervals are halved down to this many vectors.
LEAF = 256


def _valid(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0)


def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _rotation(vectors: DataFrame, total: int, dims: int) -> np.ndarray:
    """Leading principal directions of a hash sample."""
    step = max(1, total // ROTATION_SAMPLE)
    sample = vectors.where(F.pmod("h1", F.lit(step)) == 0).select("vec").repartition(8)

    def moments(frames):
        total_m = None
        for pdf in frames:
            if len(pdf):
                u = _unit(pdf["vec"])
                part = np.vstack([u.T @ u, u.sum(axis=0), np.full(u.shape[1], float(len(u)))])
                total_m = part if total_m is None else total_m + part
        if total_m is not None:
            yield pd.DataFrame({"m": [total_m.tobytes()]})

    parts = [np.frombuffer(r.m, dtype=np.float64) for r in sample.mapInPandas(moments, "m binary").collect()]
    if not parts:
        width = len(vectors.select("vec").first().vec)
        return np.eye(width)[:, : min(dims, width)]
    m = np.sum(parts, axis=0)
    width = int((np.sqrt(1 + 4 * (1 + m.size)) - 1) // 2)
    while width * (width + 2) != m.size:
        width += -1 if width * (width + 2) > m.size else 1
    m = m.reshape(width + 2, width)
    mean = m[width] / m[width + 1, 0]
    values, directions = np.linalg.eigh(m[:width] / m[width + 1, 0] - np.outer(mean, mean))
    return directions[:, np.argsort(-values)][:, : min(dims, width)].copy()


def _ordered(vectors: DataFrame, rotation: np.ndarray, eps: float, total: int) -> DataFrame:
    """``(rep, n, vec, y, block)``: intervals of the epsilon grid order."""
    p = rotation.shape[1]
    schema = T.StructType(
        [
            T.StructField("rep", T.LongType()),
            T.StructField("n", T.LongType()),
            vectors.schema["vec"],
            T.StructField("y", T.ArrayType(T.DoubleType())),
            T.StructField("cell", T.ArrayType(T.IntegerType())),
        ]
    )

    def rotate(frames):
        for pdf in frames:
            if len(pdf):
                y = _unit(pdf["vec"]) @ rotation
                cell = np.floor(y / eps).astype(np.int32)
                yield pd.DataFrame({"rep": pdf["rep"], "n": pdf["n"], "vec": pdf["vec"], "y": list(y), "cell": list(cell)})

    rotated = vectors.select("rep", "n", "vec").mapInPandas(rotate, schema)
    keys = [F.col("cell")[i] for i in range(p)] + [F.col("y")[0], F.col("rep")]
    parts = max(1, -(-total // INTERVAL))
    part = F.spark_partition_id().alias("part")
    dealt = rotated.repartitionByRange(parts, *keys).select(part, "rep", "n", "vec", "y", "cell")
    dealt = materialise(dealt, "ego")
    place = Window.partitionBy("part").orderBy(*keys)
    sizes = dealt.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    offset = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    numbered = dealt.select("*", (F.row_number().over(place) - 1).alias("at")).join(F.broadcast(offset), "part")
    at = F.col("offset") + F.col("at")
    return numbered.select("rep", "n", "vec", "y", F.floor(at / INTERVAL).cast("long").alias("block"), at.alias("at"))


def _near_blocks(members: DataFrame, p: int, eps: float) -> DataFrame:
    """``(i, j)`` with ``i <= j``: interval pairs whose boxes come within ``eps`` of each other."""
    lows = [F.min(F.col("y")[k]).alias(f"lo{k}") for k in range(p)]
    highs = [F.max(F.col("y")[k]).alias(f"hi{k}") for k in range(p)]
    box = materialise(members.groupBy("block").agg(*lows, *highs), "boxes")
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / eps).cast("int"), F.floor(hi / eps).cast("int")))
    left = box.select("*", cells(F.col("lo0"), F.col("hi0")).alias("cell"))
    right = box.select(
        *[F.col(c).alias(f"r_{c}") for c in box.columns], cells(F.col("lo0") - F.lit(eps), F.col("hi0") + F.lit(eps)).alias("cell")
    )
    gap = [F.greatest(F.col(f"lo{k}") - F.col(f"r_hi{k}"), F.col(f"r_lo{k}") - F.col(f"hi{k}"), F.lit(0.0)) for k in range(p)]
    far = sum((g * g for g in gap), F.lit(0.0))
    return (
        left.join(right, "cell")
        .where((F.col("block") <= F.col("r_block")) & (far <= eps * eps * (1 + 1e-9)))
        .select(F.col("block").alias("i"), F.col("r_block").alias("j"))
        .distinct()
    )


class _PairJoin:
    """Joins two intervals in one task: weighted link counts, and links enough to connect what is connected."""

    def __init__(self, rotation: np.ndarray, eps: float, threshold: float):
        self.rotation, self.eps, self.threshold = rotation, eps, threshold

    def __call__(self, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "at"], kind="stable")
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        same = len(right) == 0
        right = left if same else right
        a, b = _unit(left["vec"]), _unit(right["vec"])
        ya, yb = a @ self.rotation, b @ self.rotation
        ra, rb = left["rep"].to_numpy(np.int64), right["rep"].to_numpy(np.int64)
        na, nb = left["n"].to_numpy(np.int64), right["n"].to_numpy(np.int64)
        count_a, count_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        edges: list[np.ndarray] = []
        work = [(0, len(a), 0, len(b))]
        while work:
            s, e, t, f = work.pop()
            if same and f <= s:  # the mirrored half
                continue
            gap = np.maximum(ya[s:e].min(0) - yb[t:f].max(0), yb[t:f].min(0) - ya[s:e].max(0))
            gap = np.maximum(gap, 0)
            if float(gap @ gap) > self.eps**2 * (1 + 1e-9):
                continue
            if e - s > LEAF or f - t > LEAF:
                if same and (s, e) == (t, f):
                    m = (s + e) // 2
                    work += [(s, m, s, m), (s, m, m, e), (m, e, m, e)]
                elif e - s >= f - t:
                    m = (s + e) // 2
                    work += [(s, m, t, f), (m, e, t, f)]
                else:
                    m = (t + f) // 2
                    work += [(s, e, t, m), (s, e, m, f)]
                continue
            hit = a[s:e] @ b[t:f].T >= self.threshold
            diagonal = same and (s, e) == (t, f)
            if diagonal:
                np.fill_diagonal(hit, False)
            if not hit.any():
                continue
            count_a[s:e] += hit @ nb[t:f]
            if not diagonal:
                (count_a if same else count_b)[t:f] += na[s:e] @ hit
            edges.append(self._forest(hit, ra[s:e], rb[t:f]))
        out = [pd.DataFrame({"rep": ra, "links": count_a, "other": pd.array([None] * len(ra), dtype="Int64")})]
        if not same:
            out.append(pd.DataFrame({"rep": rb, "links": count_b, "other": pd.array([None] * len(rb), dtype="Int64")}))
        out = [x[x["links"] > 0] for x in out]
        if edges:
            pairs = np.unique(np.concatenate(edges), axis=0)
            out.append(pd.DataFrame({"rep": pairs[:, 0], "links": 0, "other": pd.array(pairs[:, 1], dtype="Int64")}))
        return pd.concat(out, ignore_index=True)

    @staticmethod
    def _forest(hit: np.ndarray, ra: np.ndarray, rb: np.ndarray) -> np.ndarray:
        """Each linked vector with the least vector that it reaches inside this leaf."""
        big = np.iinfo(np.int64).max
        la, lb = np.where(hit.any(1), ra, big), np.where(hit.any(0), rb, big)
        while True:
            new_b = np.minimum(lb, np.where(hit, la[:, None], big).min(0))
            new_a = np.minimum(la, np.where(hit, new_b[None, :], big).min(1))
            if (new_a == la).all() and (new_b == lb).all():
                break
            la, lb = new_a, new_b
        pairs = np.concatenate([np.stack([ra, la], 1), np.stack([rb, lb], 1)])
        return pairs[(pairs[:, 1] != big) & (pairs[:, 0] != pairs[:, 1])]


def _links_of_width(vectors: DataFrame, threshold: float, dims: int) -> DataFrame:
    """``(rep, links, other)`` of distinct vectors of one length."""
    total = vectors.count()
    eps = float(np.sqrt(max(1e-12, 2 - 2 * threshold)))  # equal directions still differ by rounding
    rotation = _rotation(vectors, total, dims)
    members = materialise(_ordered(vectors, rotation, eps, total), "intervals")
    pairs = materialise(_near_blocks(members, rotation.shape[1], eps), "interval_pairs")
    sides = pairs.select("i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.where("i < j").select("i", "j", F.col("j").alias("block"), F.lit(1).alias("side"))
    )
    rows = members.select("block", "at", "rep", "n", "vec").join(sides, "block").drop("block")
    join = _PairJoin(rotation, eps, threshold)
    return rows.groupBy("i", "j").applyInPandas(lambda pdf: join(pdf), "rep long, links long, other long")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95, dims: int = 8) -> DataFrame:
    """One row for each row of ``df``: id, ``n_links``, ``component_id``, ``kept`` (see the module for special cases)."""
    spark = df.sparkSession
    vec = col(vec_col)
    valid = _valid(vec) & col(id_col).isNotNull()
    keyed = df.select(
        col(id_col).cast("long").alias("id"),
        F.when(valid, F.xxhash64(vec)).alias("h1"),
        F.when(valid, F.xxhash64(F.lit(1), vec)).alias("h2"),  # the seed in front: a hash of its own, not one of h1
        F.when(valid, vec).alias("vec"),
    )
    distinct = keyed.where("h1 is not null").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    distinct = materialise(distinct, "vectors")
    widths = [r.w for r in distinct.select(F.size("vec").alias("w")).distinct().collect()]
    found = spark.createDataFrame([], "rep long, links long, other long")
    for w in sorted(widths):
        found = found.unionByName(_links_of_width(distinct.where(F.size("vec") == w), threshold, dims))
    found = materialise(found, "vector_links")
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    of_rep = (
        distinct.select("h1", "h2", "rep", "n")
        .join(counted, "rep", "left")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "h1",
            "h2",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = keyed.select("id", "h1", "h2").join(of_rep, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
