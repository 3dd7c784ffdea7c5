"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

The documents of a source, in a shuffled order, form blocks.  With target weight ``w`` the ``k``-th block of a source
(from 1) is released at slot ``floor((k - 1) / w)`` and due at ``ceil(k / w)``.  In every slot the released block with
the earliest deadline goes out (ties: the source with the least name).  So after any number ``t`` of slots a source has
sent less than one block more or less than ``t * w``.

Weights are whole shares ``p`` of a period of ``SHARES`` slots; all windows repeat after that many slots, so the schedule
of one period is built once, on one row with a step for each slot, and every block finds its slot from its number by a
lookup.  With more than ``FEW`` sources, or a weight below one share, the period is a multiple of ``SHARES`` in which the
least weight has ``LEAST`` shares (as far as ``MOST`` slots, or ``MOST_EACH`` for each source, allow).  The bound of one
block holds against ``p``, which differs from the target by less than a share (more only if weights fall below one share
of the longest period: they are lifted to 1, and all others give up the same fraction of what they have above 1).

``repeat=True``: the schedule ends when every source has been sent at least once, and a source that runs out starts
again from its first block (``epoch`` counts its uses from 0).  ``repeat=False``: every document goes out once; slots of
a source that has run out stay empty, and the others keep their proportions.

Defined results: null sources are a source of their own.  Sources that ``weights`` doesn't name get weight 0; with
``repeat=True`` they are left out as asked for, with ``repeat=False`` they follow at the end.  Rows that repeat an id
are documents of their own.  An empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkprep.functions.scalar import col, key_number
from sparkprep.session import materialise

#: Slots of a period, or of its parts; target weights are rounded to whole shares of it.
SHARES = 1000
#: Sources that one part always does for, if no weight is below a share.
FEW = 100
#: Shares of the least weight in longer periods, and the bounds of such periods: in all, and for each source.
LEAST, MOST, MOST_EACH = 10, 20_000, 20
#: Consecutive documents of a source that go out together.
BLOCK = 16
#: Columns that the mix adds; input columns of these names are replaced.
ADDED = ("mix_slot", "mix_place", "mix_epoch", "mix_block", "mix_release", "mix_due")
#: Documents that one task numbers.
PART_ROWS = 20_000


def _name(source: Column) -> Column:
    """Source as text that tells null from every name."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _weighed(sizes: DataFrame, weights: dict | None) -> DataFrame:
    """``(s, n, w)``: without ``weights`` a source weighs the square root of its size."""
    if weights is None:
        w = F.sqrt(F.col("n").cast("double"))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit("" if k is None else f"={k}"), F.lit(float(v)))]
        w = F.coalesce(F.create_map(*pairs)[F.col("s")], F.lit(0.0)) if pairs else F.lit(0.0)
    return sizes.select("s", "n", w.alias("w"))


def slots_for(sizes: DataFrame, weights: dict | None, shares: int = SHARES) -> int:
    """Slots of a period that does justice to the least weight.  ``sizes`` has one row for each source."""
    x = _weighed(sizes, weights).where("w > 0").agg(F.count("*").alias("n"), F.sum("w").alias("total"), F.min("w").alias("least")).first()
    if not x.n or (x.n <= FEW * shares / SHARES and x.least * shares >= x.total):
        return shares
    most = max(MOST, MOST_EACH * x.n)
    return shares * max(1, math.ceil(min(LEAST * x.total / x.least, most) / shares))


def shares_of(sizes: DataFrame, weights: dict | None, shares: int = SHARES) -> DataFrame:
    """``(s, n, p)``: whole shares by largest remainder, at least 1 for a positive weight.

    If weights are below one share, all that are above give up the same fraction of what they have above 1.
    There may be at most ``shares`` positive weights.  ``sizes`` has one row for each source.
    """
    everything = Window.partitionBy()
    weighed = _weighed(sizes, weights).withColumn("total", F.sum("w").over(everything))
    weighed = weighed.withColumn("exact", F.when(F.col("w") > 0, F.col("w") * shares / F.col("total")).otherwise(0.0))
    small = (F.col("w") > 0) & (F.col("exact") < 1)
    above = F.sum(F.when(F.col("exact") > 1, F.col("exact") - 1)).over(everything)
    free = F.lit(shares) - F.sum((F.col("w") > 0).cast("long")).over(everything)
    fair = weighed.withColumns({"lifted": F.max(small).over(everything), "above": above, "free": free})
    lifted = 1 + F.greatest(F.col("exact") - 1, F.lit(0.0)) * F.col("free") / F.greatest("above", F.lit(1e-300))
    fair = fair.withColumn("exact", F.when(F.col("lifted") & (F.col("w") > 0), lifted).otherwise(F.col("exact")))
    cut = fair.withColumn("p", F.when(F.col("w") > 0, F.greatest(F.lit(1), F.floor("exact"))).otherwise(0).cast("long"))
    # shares still to give
    cut = cut.withColumn("rest", F.lit(shares) - F.sum("p").over(everything))
    most = Window.orderBy(F.desc(F.when(F.col("w") > 0, F.col("exact") - F.col("p")).otherwise(F.lit(-math.inf))), "s")
    return cut.withColumn("up", F.row_number().over(most)).select(
        "s", "n", F.when((F.col("w") > 0) & (F.col("up") <= F.col("rest")), F.col("p") + 1).otherwise(F.col("p")).alias("p")
    )


def period(plan: DataFrame, shares: int = SHARES) -> DataFrame:
    """``(s, i, slot)``: the slot of the ``i``-th block (from 0) of each source inside one period."""
    row = plan.where("p > 0").agg(F.array_sort(F.collect_list(F.struct("s", "p"))).alias("src"))
    src = F.col("src")

    # sent[j]: blocks of source j so far; a slot goes to the least (deadline, source) among the released blocks
    def step(state, t):
        chosen = F.array(_chosen(src, state["sent"], t, shares))
        return F.transform(chosen, lambda j: F.struct(_raised(state["sent"], j).alias("sent"), F.concat(state["order"], F.array(j)).alias("order")))[0]

    # parts, so that the order isn't copied whole for each slot
    def part(state, at):
        inner = F.aggregate(F.sequence(at, F.least(at + SHARES, F.lit(shares)) - 1), F.struct(state["sent"].alias("sent"), none.alias("order")), step)
        return F.transform(F.array(inner), lambda x: F.struct(x["sent"].alias("sent"), F.concat(state["order"], x["order"]).alias("order")))[0]

    none = F.array().cast("array<int>")
    start = F.struct(F.transform(src, lambda x: F.lit(0).cast("long")).alias("sent"), none.alias("order"))
    parts = F.sequence(F.lit(0), F.lit(shares - 1), F.lit(SHARES))
    built = row.where(F.size("src") > 0).select("src", F.aggregate(parts, start, part)["order"].alias("order"))
    slots = built.select("src", F.posexplode("order").alias("slot", "j")).select(F.col("src")[F.col("j")]["s"].alias("s"), "slot")
    place = Window.partitionBy("s").orderBy("slot")
    return slots.select("s", "slot", (F.row_number().over(place) - 1).alias("i"))


def _chosen(src: Column, sent: Column, t: Column, shares: int) -> Column:
    """Index of the source for slot ``t``."""
    due = F.transform(
        src,
        lambda x, j: F.when(
            (sent[j] < x["p"]) & (F.floor(sent[j] * shares / x["p"]) <= t),
            F.struct(F.ceil((sent[j] + 1) * shares / x["p"]).alias("due"), j.alias("j")),
        ),
    )
    return F.array_min(due)["j"]


def _raised(sent: Column, j: Column) -> Column:
    return F.transform(sent, lambda n, k: F.when(k == j, n + 1).otherwise(n))


def _numbered(df: DataFrame, source: Column, key: list[Column], n: int) -> DataFrame:
    """``(row, s, at)``: the input row, its source and its place in the shuffled order of the source, from 0.

    The order is that of an md5 of the id.  Ranges of the hash are numbered in tasks of their own and shifted
    by the documents in the ranges before, so no source is sorted in one task.
    """
    ranges = max(1, math.ceil(n / PART_ROWS))
    h = F.md5(F.concat(F.coalesce(key[0].cast("string"), F.lit("")), F.lit("#42")))
    row, keys = F.struct(*[col(c) for c in df.columns]).alias("row"), F.struct(*key).alias("key")
    dealt = df.select(row, keys, _name(source).alias("s"), h.alias("h"))
    dealt = dealt.withColumn("part", F.floor(key_number(F.col("h")) * ranges / 2.0**52).cast("int"))
    sizes = dealt.groupBy("s", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each source and range
    shift = sizes.select("s", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    place = Window.partitionBy("s", "part").orderBy("h", "key")
    inside = dealt.withColumn("inside", F.row_number().over(place) - 1)
    return inside.join(shift, ["s", "part"]).select("row", "s", (F.col("shift") + F.col("inside")).alias("at"))


def mix(
    df: DataFrame,
    weights: dict | None = None,
    source_col: str = "source",
    order_cols: tuple[str, ...] = ("doc_id", "text"),
    block: int = BLOCK,
    repeat: bool = True,
    shares: int = SHARES,
) -> DataFrame:
    """``df`` with ``mix_slot``, ``mix_place`` (in the block), ``mix_epoch``, ``mix_block``, ``mix_release`` and ``mix_due``.

    Sorted by slot and place the rows are the mix.  The order columns tell rows apart in the shuffled order;
    the first of them is hashed.  ``shares`` is the least length of the period.
    """
    key = [col(c) for c in order_cols if c in df.columns]
    slim = df.select(_name(col(source_col)).alias("s"))
    sizes = materialise(slim.groupBy("s").agg(F.count("*").alias("n")), "mix_sizes")
    shares = slots_for(sizes, weights, shares)
    plan = shares_of(sizes, weights, shares)
    plan = materialise(plan.withColumn("blocks", F.ceil(F.col("n") / block)), "mix_plan")
    # end: slots until every source has been sent once
    ends = F.max(F.when(F.col("p") > 0, F.ceil(F.col("blocks") * shares / F.col("p"))))
    size = plan.agg(F.sum("n").alias("total"), ends.alias("end")).first()
    total, end = size.total or 0, size.end or 0
    slots = materialise(period(plan, shares), "mix_period")
    rows = _numbered(df, col(source_col), key, total).join(F.broadcast(plan.select("s", "p", "blocks")), "s")
    first = F.floor(F.col("at") / block)
    if repeat:
        wanted = F.ceil(F.lit(end) * F.col("p") / shares)  # blocks of the source in the whole schedule
        uses = F.ceil((wanted - first) / F.col("blocks"))
        rows = rows.where("p > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(uses, F.lit(1)) - 1)))
    else:
        rows = rows.withColumn("epoch", F.lit(0).cast("long"))
    rows = rows.withColumn("number", first + F.col("epoch") * F.col("blocks"))
    share = F.when(F.col("p") > 0, F.col("p"))
    rows = rows.withColumns({"cycle": F.floor(F.col("number") / share), "i": F.pmod("number", share).cast("int")})
    rows = rows.join(F.broadcast(slots.select("s", "i", "slot")), ["s", "i"], "left")
    return rows.select(
        *[F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in ADDED],
        # without a weight: after everything else
        F.coalesce(F.col("cycle") * shares + F.col("slot"), F.lit(2**40) + F.col("number")).cast("long").alias("mix_slot"),
        F.pmod("at", F.lit(block)).cast("long").alias("mix_place"),
        F.col("epoch").alias("mix_epoch"),
        F.col("number").alias("mix_block"),
        F.floor(F.col("number") * shares / share).alias("mix_release"),
        F.ceil((F.col("number") + 1) * shares / share).alias("mix_due"),
    )
