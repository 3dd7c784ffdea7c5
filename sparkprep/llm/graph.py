"""Connected components over a table of links; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.session import materialise


def _fingerprint(df: DataFrame):
    r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the neighbours of every node at its least neighbour.

    The least neighbour is an aggregate that is combined before the shuffle, so a node with many neighbours costs one
    row for each task; the neighbours themselves are never gathered.
    """
    near = edges
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = near.join(least, "a")
    if large:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every node that has a link; the component is its least node.

    Large-star and small-star steps alternate until no edge changes; each step is one aggregate and one join.  Links
    with a null end and links of a node to itself are ignored.  An empty table gives an empty table.
    """
    edges = (
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .where("a <> b")
        .distinct()
    )
    edges = materialise(edges, "links")
    before = _fingerprint(edges)
    while before[0]:
        edges = materialise(_star(_star(edges, large=True), large=False), "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    # at the end every edge leads from a node to the least node of its component
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
