"""Hard negatives by inner product, searched in a packed R-tree.

Vectors are scaled to whole numbers, so scores are exact.  Rows are packed by sort-tile-recursive: quantiles cut the table
by label, then by the coordinates that vary most, into tiles; a tile of more than ``PAGE`` rows (ties) is dealt over several
pages by hash.  Each page is packed in one task in the same way down to leaves and keeps the bounding boxes of all its nodes.
A box bounds every inner product with an anchor from both sides, coordinate by coordinate.

Anchors search in two rounds.  In the first each visits the page of greatest upper bound, which gives it a k-th score; in the
second it visits all other pages whose bounds reach into its score window and aren't strictly below that score.  Inside a page a queue
takes the nodes by upper bound and passes over boxes outside the windows or strictly below the k-th score.  Two searches
follow each other: positives (same label), then negatives, whose windows come from the scores of the positives.

Work is cut in blocks: pages, blocks of page bounds and blocks of anchors are bounded whatever the labels or the ties, and
every anchor is routed against the bounds of every page, none of the rows of which move unless a bound asks for it.

Defined results: rows with a null id or label, a null vector or a null or non-finite component take no part.  Vectors of different
lengths don't meet.  "Other" rows have another id; rows that repeat an id count each, and a repeated anchor gets the rows of
each.  Ties go to the smaller id.  A negative positive score leaves an empty window.  An empty table gives an empty table.  Only the
three named columns are read.  Scores must fit 64 bits.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkprep.functions.scalar import col
from sparkprep.session import materialise

#: Rows of a page, of a leaf, and nodes below a node of a page.
PAGE, LEAF, FANOUT = 4096, 64, 8
#: Anchors of a block, and page bounds of a block.
ANCHORS, BOUNDS = 2048, 2048
#: Coordinates (besides the label) that the tiles are cut by.
DIMS = 2


def whole_vectors(df: DataFrame, id_col: str, label: Column, vec_col: str, scale: int) -> DataFrame:
    """``(id, label, vec)`` of the rows that take part; components are ``floor(scale * x)``."""
    vec = col(vec_col)
    finite = vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.when(finite, vec).alias("vec"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    return rows.select("id", "label", F.transform("vec", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")).alias("vec"))


def _widest(rows: DataFrame, dims: int) -> list[int]:
    """Coordinates of greatest variance; they decide what is skipped, never the result."""
    spread = rows.select(F.posexplode("vec").alias("k", "x")).groupBy("k").agg(F.var_pop(F.col("x").cast("double")).alias("v"))
    return [r.k for r in spread.orderBy(F.desc("v"), "k").limit(dims).collect()]


def _tiles(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``page``, by quantile cuts of label and widest coordinates."""
    pages = -(-total // PAGE)
    keys = [F.col("label"), *[F.coalesce(F.get(F.col("vec"), F.lit(k)), F.lit(0)) for k in _widest(rows, DIMS)]]
    slabs = max(1, round(pages ** (1 / len(keys)) + 0.499))
    tiled = rows.withColumn("tile", F.size("vec").cast("long"))
    for key in keys if slabs > 1 else []:
        q = [i / slabs for i in range(1, slabs)]
        cuts = tiled.groupBy("tile").agg(F.percentile_approx(key, q, 1000).alias("cuts"))
        # before the last cut there are at most slabs ** 2 tiles, pages ** (2 / 3), with slabs cuts each
        tiled = tiled.join(F.broadcast(cuts), "tile").withColumn(
            "tile", F.col("tile") * (slabs + 1) + F.size(F.filter("cuts", _below(key)))
        ).drop("cuts")
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / PAGE).alias("parts"))
    # no hint: Spark broadcasts the sizes only if they are measured to be small
    dealt = tiled.join(sizes.where("parts > 1"), "tile", "left")
    part = F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1)))
    return dealt.select("id", "label", "vec", F.xxhash64(F.size("vec"), "tile", part).alias("page"))


def _below(key: Column):
    return lambda cut: cut < key


def _bounds(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner products of ``q`` (rows) with boxes (rows); exact."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return _dot(up, low) + _dot(down, high), _dot(up, high) + _dot(down, low)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows: in doubles where all sums stay below 2**53, else in whole numbers without a limit."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    return a.astype(object) @ b.astype(object).T


class Tree:
    """A packed page: rows in leaf order, and for each level the boxes of its nodes (the first level holds the leaves)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray):
        order = self._packed(labels, vecs)
        self.ids, self.labels, self.vecs = ids[order], labels[order], vecs[order]
        starts = np.arange(0, len(ids), LEAF)
        self.levels = [(np.minimum.reduceat(self.vecs, starts), np.maximum.reduceat(self.vecs, starts))]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    @staticmethod
    def _packed(labels: np.ndarray, vecs: np.ndarray) -> np.ndarray:
        """Sort-tile-recursive order by label and the coordinates that vary most in this page."""
        keys = [labels, *[vecs[:, k] for k in np.argsort(-vecs.astype(np.float64).var(axis=0), kind="stable")[: DIMS + 1]]]

        def tile(rows: np.ndarray, depth: int) -> np.ndarray:
            rows = rows[np.argsort(keys[depth][rows], kind="stable")]
            if depth + 1 == len(keys) or len(rows) <= LEAF:
                return rows
            leaves = -(-len(rows) // LEAF)
            slab = LEAF * max(1, -(-leaves // max(1, round(leaves ** (1 / (len(keys) - depth))))))
            return np.concatenate([tile(rows[s : s + slab], depth + 1) for s in range(0, len(rows), slab)])

        return tile(np.arange(len(labels)), 0)

    def search(self, anchor: int, label: int, q: np.ndarray, same: bool, windows: list, k: int) -> list[list[tuple[int, int]]]:
        """For each window ``(low, high, kth)`` the best ``(score, id)``; ``kth`` is a score known to be reached k times."""
        best: list[list[tuple[int, int]]] = [[] for _ in windows]

        def floor(w: int) -> int | None:
            low, _, kth = windows[w]
            held = [x for x in (low, kth, best[w][-1][0] if len(best[w]) == k else None) if x is not None]
            return max(held) if held else None

        def wanted(least: int, most: int) -> bool:
            for w, (_, high, _) in enumerate(windows):
                f = floor(w)
                if (f is None or most >= f) and (high is None or least <= high):
                    return True
            return False

        top = len(self.levels) - 1
        queue: list = []

        def push(level: int, nodes: np.ndarray) -> None:
            low, high = self.levels[level]
            least, most = _bounds(low[nodes], high[nodes], q[None, :])
            for node, a, b in zip(nodes.tolist(), least[0].tolist(), most[0].tolist(), strict=True):
                if wanted(a, b):
                    heapq.heappush(queue, (-b, level, node, a))

        push(top, np.arange(len(self.levels[top][0])))
        while queue:
            most, level, node, least = heapq.heappop(queue)
            if not wanted(least, -most):
                continue
            if level:
                push(level - 1, np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0]))))
                continue
            part = slice(node * LEAF, (node + 1) * LEAF)
            usable = (self.ids[part] != anchor) & ((self.labels[part] == label) == same)
            if not usable.any():
                continue
            scores = _dot(q[None, :], self.vecs[part][usable])[0]
            ids = self.ids[part][usable]
            for w, (_, high, _) in enumerate(windows):
                f = floor(w)
                fits = np.ones(len(scores), dtype=bool) if f is None else scores >= f
                fits = fits if high is None else fits & (scores <= high)
                if fits.any():
                    both = best[w] + list(zip(scores[fits].tolist(), ids[fits].tolist(), strict=True))
                    best[w] = sorted(both, key=lambda x: (-x[0], x[1]))[:k]
        return best


_PAGE = "page long, width int, first long, last long, low array<long>, high array<long>, ids binary, labels binary, vecs binary"


def _packed_page(pdf: pd.DataFrame) -> pd.DataFrame:
    vecs = np.array(pdf["vec"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
    ids, labels = pdf["id"].to_numpy(np.int64), pdf["label"].to_numpy(np.int64)
    order = np.lexsort((ids, labels))
    return pd.DataFrame(
        {
            "page": [int(pdf["page"].iloc[0])],
            "width": [vecs.shape[1]],
            "first": [int(labels.min())],
            "last": [int(labels.max())],
            "low": [vecs.min(axis=0).tolist() if vecs.shape[1] else []],
            "high": [vecs.max(axis=0).tolist() if vecs.shape[1] else []],
            "ids": [ids[order].tobytes()],
            "labels": [labels[order].tobytes()],
            "vecs": [vecs[order].tobytes()],
        }
    )


def pack(rows: DataFrame) -> DataFrame:
    """One row for each page: its bounds and its rows."""
    return rows.groupBy("page").applyInPandas(_packed_page, _PAGE)


def _matrix(arrays, width: int) -> np.ndarray:
    return np.array([np.asarray(a, dtype=np.int64) for a in arrays], dtype=np.int64).reshape(len(arrays), width)


def _route(probes: DataFrame, bounds: DataFrame, same: bool, first: bool) -> DataFrame:
    """``(probe, page)``: the page of greatest upper bound of each probe (``first``), or all pages that its windows ask for."""

    def route(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for width, at in right.groupby("width") if len(left) and len(right) else []:
            of = left[left["vec"].map(len) == width]
            if not len(of):
                continue
            least, most = _bounds(_matrix(at["low"], width), _matrix(at["high"], width), _matrix(of["vec"], width))
            lo_label, hi_label, label = at["first"].to_numpy(), at["last"].to_numpy(), of["label"].to_numpy()[:, None]
            ok = (lo_label <= label) & (label <= hi_label) if same else (lo_label != label) | (hi_label != label)
            if first:
                # the greatest upper bound below the windows' end, else any page that fits
                most = np.where(ok, most.astype(np.float64), -np.inf)
                pick = most.argmax(axis=1)
                i = np.flatnonzero(ok[np.arange(len(of)), pick])
                out.append(pd.DataFrame({"probe": of["probe"].to_numpy()[i], "page": at["page"].to_numpy()[pick[i]], "most": most[i, pick[i]]}))
                continue
            reach = np.zeros_like(ok)
            for r, windows in enumerate(of["windows"]):
                for w in windows:
                    hit = np.ones(len(at), dtype=bool)
                    for f in (w["low"], w["kth"]):
                        hit &= True if f is None else most[r] >= f
                    hit &= True if w["high"] is None else least[r] <= w["high"]
                    reach[r] |= hit
            i, j = np.nonzero(ok & reach)
            out.append(pd.DataFrame({"probe": of["probe"].to_numpy()[i], "page": at["page"].to_numpy()[j], "most": 0.0}))
        empty = pd.DataFrame({"probe": pd.Series(dtype="int64"), "page": pd.Series(dtype="int64"), "most": pd.Series(dtype="float64")})
        return pd.concat(out, ignore_index=True) if out else empty

    n_bounds, n_parts = _blocks(bounds, "bounds"), _blocks(probes, "part")
    # a block of bounds meets each block of probes: the bounds of the pages, never their rows
    asked = probes.withColumn("bounds", _each(n_bounds))
    known = bounds.withColumnRenamed("bounds", "of_bounds").withColumn("of_part", _each(n_parts))
    met = asked.groupBy("part", "bounds").cogroup(known.groupBy("of_part", "of_bounds"))
    routed = met.applyInPandas(lambda left, right: route(left, right), "probe long, page long, most double")
    if first:
        routed = routed.groupBy("probe").agg(F.max(F.struct("most", "page")).alias("m")).select("probe", F.col("m.page").alias("page"))
    return routed.select("probe", "page")


def _blocks(df: DataFrame, name: str) -> int:
    return (df.agg(F.max(name).alias("n")).first().n or 0) + 1


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _visit(routed: DataFrame, probes: DataFrame, pages: DataFrame, same: bool, k: int) -> DataFrame:
    """``(probe, w, score, id)``: the best of each visited page; one task for each page and block of probes."""

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            r = right.iloc[0]
            ids = np.frombuffer(r["ids"], dtype=np.int64)
            tree = Tree(ids, np.frombuffer(r["labels"], dtype=np.int64), np.frombuffer(r["vecs"], dtype=np.int64).reshape(len(ids), int(r["width"])))
            for probe, anchor, label, vec, windows in zip(left["probe"], left["id"], left["label"], left["vec"], left["windows"], strict=True):
                asked = [(w["low"], w["high"], w["kth"]) for w in windows]
                q = np.asarray(vec, dtype=np.int64)
                for w, found in enumerate(tree.search(int(anchor), int(label), q, same, asked, k)):
                    out += [(int(probe), w, s, i) for s, i in found]
        return pd.DataFrame(out, columns=["probe", "w", "score", "id"]).astype("int64")

    visits = routed.join(probes, "probe")
    wanted = visits.select("page", F.col("part").alias("of_part")).distinct().join(pages.withColumnRenamed("page", "of_page"), F.col("page") == F.col("of_page")).drop("page")
    return visits.groupBy("page", "part").cogroup(wanted.groupBy("of_page", "of_part")).applyInPandas(visit, "probe long, w long, score long, id long")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each window; a task hands on at most ``k`` of a page."""
    place = Window.partitionBy("probe", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _search(probes: DataFrame, pages: DataFrame, bounds: DataFrame, same: bool, k: int) -> DataFrame:
    """``(probe, w, rank, score, id)`` of the first ``k`` rows in each window ``w`` of each probe."""
    routed = materialise(_route(probes, bounds, same, first=True), "first_pages")
    early = materialise(_visit(routed, probes, pages, same, k), "first_found")
    held = early.groupBy("probe", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    kths = held.groupBy("probe").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kths"))
    known = probes.join(kths, "probe", "left")
    window = lambda x, i: F.struct(x["low"].alias("low"), x["high"].alias("high"), F.try_element_at("kths", i.cast("long")).alias("kth"))
    known = materialise(known.select("probe", "id", "label", "vec", "part", F.transform("windows", window).alias("windows")), "probes")
    more = materialise(_route(known, bounds, same, first=False).join(routed, ["probe", "page"], "left_anti"), "pages_left")
    late = _visit(more, known, pages, same, k)
    return materialise(_merged(early.unionByName(late), k), "found")


_WINDOWS = "array<struct<low:bigint,high:bigint,kth:bigint>>"


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label: Column | str = "label",
    vec_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` tells the anchors by ``id``.  A negative of a positive scores from ``low`` to ``high`` per cent of it.
    """
    rows = materialise(whole_vectors(df, id_col, col(label) if isinstance(label, str) else label, vec_col, scale), "whole_vectors")
    pages = materialise(pack(_tiles(rows, rows.count())), "pages")
    blocks = -(-max(1, pages.count()) // BOUNDS)
    block = F.pmod(F.xxhash64("page"), F.lit(blocks)).cast("long").alias("bounds")
    bounds = materialise(pages.select("page", "width", "first", "last", "low", "high", block), "page_bounds")
    chosen = rows.where(anchor)
    parts = -(-max(1, chosen.count()) // ANCHORS)
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("long").alias("part")
    # the number is drawn once, as the table is written; a repeated anchor is searched for each of its rows
    probes = materialise(chosen.select(F.monotonically_increasing_id().alias("probe"), "id", "label", "vec", part), "anchors")
    everything = F.array(F.struct(*[F.lit(None).cast("long").alias(c) for c in ("low", "high", "kth")])).cast(_WINDOWS)
    near = _search(probes.withColumn("windows", everything), pages, bounds, True, positives)
    scores = F.array_sort(F.collect_set("score"))  # at most one for each positive
    wanted = near.groupBy("probe").agg(F.transform(scores, lambda s: _window(s, low, high)).alias("windows"))
    found = _search(probes.join(wanted, "probe"), pages, bounds, False, negatives)
    place = wanted.select("probe", F.posexplode("windows").alias("w", "window")).select("probe", F.col("w").cast("long").alias("w"), F.col("window.of").alias("of"))
    found = found.join(place, ["probe", "w"]).select("probe", "of", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    positive = near.select("probe", F.col("score").alias("of"), F.col("id").alias("positive_id"))
    return (
        positive.join(found, ["probe", "of"])
        .join(probes.select("probe", F.col("id").alias("anchor_id")), "probe")
        .select("anchor_id", "positive_id", "rank", "negative_id", F.col("of").alias("positive_score"), "negative_score")
    )


def _hundredth(c: Column) -> Column:
    """Exact division of multiples of 100, in whole numbers."""
    return F.call_function("div", c, F.lit(100).cast("long"))


def _window(score: Column, low: int, high: int) -> Column:
    """Whole scores from ``low`` to ``high`` per cent of ``score``."""
    a, b = score * low, score * high
    return F.struct(
        _hundredth(a + F.pmod(-a, F.lit(100).cast("long"))).alias("low"),
        _hundredth(b - F.pmod(b, F.lit(100).cast("long"))).alias("high"),
        F.lit(None).cast("long").alias("kth"),
        score.alias("of"),
    )
