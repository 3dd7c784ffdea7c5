"""Near-duplicate texts by weighted MinHash signatures over shingle counts.

A text is the multiset of its runs of five words (lower case, split at ASCII white space).  The similarity of two texts
is their weighted Jaccard index, ``sum min / sum max`` of the counts.

Signatures: the weights of a shingle are cut into the levels 1, 2, 3-4, 5-8, ...  Every level range of every shingle
has a Poisson process of its own (seeded by shingle and range) whose points carry a level inside the range, found by
halving it once per random bit, and one of the signature's components.  A point counts for a text if its level is not
above the shingle's count.  A component keeps its first point.  Two texts agree in a component with probability equal to
their weighted Jaccard index.  Points are made in order and only up to the text's latest component, so a text with
``n`` words costs about ``n + m log m`` points instead of ``n * m``.

Texts with equal multisets are one class.  Classes that agree in a whole band share a bucket, and every link is verified
on the exact counts.  The members of a bucket are compared with its least member first, so copies of one text cost one
comparison each.  Members that the least one doesn't link are then matched with the whole bucket, in tasks that hold at
most two blocks of it.  Such a pair is passed over only if it is connected already, if an earlier band offers it, if the
distances of both to the least member differ by more than the limit (weighted Jaccard distance is a metric), or if the
signatures agree in too few components (``SURE`` standard deviations below the threshold).  So after that every pair of a
bucket is connected or ruled out, and no list of pairs is written.

Defined results: texts with fewer than five words are one shingle of all their words; null and empty texts have none and
are alone.  Rows that repeat an id share a class if their texts are alike, and count as one document.  Null ids belong
to no class: component null, ``kept`` true.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, free_names
from sparkprep.llm.frames import map_texts, text_of
from sparkprep.llm.graph import components
from sparkprep.llm.text import GOLDEN, SPACED, mix, shingles, stride, words
from sparkprep.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
#: With 25 bands of 5 a pair at 0.8 is missed with probability 5e-5, at 0.85 with 1e-6.
BANDS, ROWS = 25, 5
#: Components of a signature; the bands use the first ``BANDS * ROWS``.
COMPONENTS = 250
#: A true link is ruled out by its signatures with probability 3e-6.
SURE = 4.5
#: Members of a bucket that a task takes on each side.
BLOCK = 512


def multisets(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, shingle, count)``, sorted by text and shingle."""
    code, doc = shingles(words([t.lower() for t in texts], SPACED), size)
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], code[at], np.diff(np.append(at, len(code)))


def signatures(doc: np.ndarray, code: np.ndarray, count: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """``n`` rows of ``m`` components (the names of the winning points); rows of texts without shingles are 0."""
    first_x = np.full((n, m), np.inf)
    winner = np.zeros((n, m), dtype=np.uint64)
    # one process for each level range that the count reaches: range 0 is level 1, range r is levels 2^(r-1)+1 .. 2^r
    top = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))), 0).astype(np.int64)
    which = np.repeat(np.arange(len(code)), top + 1)
    begin = np.cumsum(top + 1) - (top + 1)
    level = np.arange(len(which)) - begin[which]
    width = np.where(level > 0, 1 << np.maximum(level - 1, 0), 1).astype(np.int64)
    low = np.where(level > 0, width, 0)
    seed = mix(code[which] + GOLDEN * (level + 1).astype(np.uint64))
    d, c = doc[which], count[which]
    x = np.zeros(len(which))
    limit = np.full(n, np.inf)
    step = 0
    while len(d):
        step += 1
        r = mix(seed + stride(step))
        x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
        alive = x < limit[d]
        d, c, x, seed, width, low, r = d[alive], c[alive], x[alive], seed[alive], width[alive], low[alive], r[alive]
        if not len(d):
            break
        name = mix(r + GOLDEN)
        # width is a power of two: its low bits are one halving each
        inside = (name & (width - 1).astype(np.uint64)).astype(np.int64)
        valid = low + inside < c
        slot = d[valid] * m + ((name[valid] >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
        flat_x, flat_w = first_x.ravel(), winner.ravel()
        xv, nv = x[valid], name[valid]
        np.minimum.at(flat_x, slot, xv)
        won = flat_x[slot] == xv
        flat_w[slot[won]] = nv[won]
        if step < 8 or step % 4 == 0:
            live = np.unique(d)
            limit[live] = first_x[live].max(axis=1)
    return winner


def _profile(texts: list[str]):
    n = len(texts)
    doc, code, count = multisets(texts)
    # the class: two sums over all (shingle, count)
    term = mix(code ^ mix(count.astype(np.uint64)))
    edge = np.searchsorted(doc, np.arange(n + 1))
    total = np.zeros((2, len(term) + 1), dtype=np.uint64)
    np.cumsum(term, out=total[0, 1:])
    np.cumsum(mix(term + GOLDEN), out=total[1, 1:])
    h = (total[:, edge[1:]] - total[:, edge[:-1]]).view(np.int64)
    whole = signatures(doc, code, count, n)
    sig = whole[:, : BANDS * ROWS].reshape(n, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
    for k in range(ROWS):
        key = mix(key + sig[:, :, k] * np.uint64(3))
    full = edge[1:] > edge[:-1]
    bands = [row if f else None for row, f in zip(key.view(np.int64), full, strict=True)]
    short = (whole >> np.uint64(16)).astype(np.uint16)
    return h[0], h[1], bands, [k.tobytes() + x.tobytes() for k, x in zip(key, short, strict=True)]


def similarity(a: str, b: str, size: int = SHINGLE) -> float:
    """Weighted Jaccard index of two texts; 0 if either has no word."""
    _, sa, ca = multisets([a], size)
    _, sb, cb = multisets([b], size)
    if not len(sa) or not len(sb):
        return 0.0
    return _overlap(sa, ca, sb, cb)


def _overlap(sa: np.ndarray, ca: np.ndarray, sb: np.ndarray, cb: np.ndarray) -> float:
    """Weighted Jaccard index of two sorted multisets."""
    at = np.minimum(np.searchsorted(sb, sa), len(sb) - 1)
    common = int(np.where(sb[at] == sa, np.minimum(ca, cb[at]), 0).sum())
    return common / (int(ca.sum()) + int(cb.sum()) - common)


def _scored(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, s)``: the exact similarity of the pairs."""
    both = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b"
    )

    def score(left, right):
        return [[similarity(x, y) for x, y in zip(left, right, strict=True)]]

    return map_texts(both, ["a", "b"], ["ta", "tb"], score, "s double")


def _bucket_links(rows: list[dict], threshold: float) -> list[tuple[int, int]]:
    """Links between the ``outside`` rows and all others of one bucket, enough to connect what is connected."""
    rows = list({(r["outside"], r["rep"]): r for r in rows}.values())
    outside, every = [r for r in rows if r["outside"]], [r for r in rows if not r["outside"]]
    if not outside or not every:
        return []
    wide = 8 * BANDS
    bands = np.array([np.frombuffer(r["sig"][:wide], dtype=np.uint64) for r in every])
    sigs = np.array([np.frombuffer(r["sig"][wide:], dtype=np.uint16) for r in every])
    reps, first_s = np.array([r["rep"] for r in every]), np.array([r["s"] for r in every])
    least = COMPONENTS * threshold - SURE * float(np.sqrt(COMPONENTS * threshold * (1 - threshold)))
    pairs = []
    for i, o in enumerate(outside):
        near = np.flatnonzero((reps != o["rep"]) & (np.abs(first_s - o["s"]) <= 1 - threshold + 1e-9))
        if len(near):
            agree = (sigs[near] == np.frombuffer(o["sig"][wide:], dtype=np.uint16)).sum(axis=1)
            near, agree = near[agree >= least], agree[agree >= least]
        if len(near):
            earlier = (bands[near] == np.frombuffer(o["sig"][:wide], dtype=np.uint64)).argmax(axis=1) == o["band"]
            pairs += [(-int(n), i, int(j)) for j, n in zip(near[earlier], agree[earlier], strict=True)]
    if not pairs:
        return []
    needed = sorted({outside[i]["rep"] for _, i, _ in pairs} | {every[j]["rep"] for _, _, j in pairs})
    text = {r["rep"]: r["text"] for r in rows}
    doc, code, count = multisets([text[r] for r in needed])
    edge = np.searchsorted(doc, np.arange(len(needed) + 1))
    place = {r: k for k, r in enumerate(needed)}
    # what the least member links is connected from the start; the likeliest links come first
    parent = {r["rep"]: -1 if r["s"] >= threshold else r["rep"] for r in rows} | {-1: -1}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for _, i, j in sorted(pairs):
        a, b = outside[i]["rep"], every[j]["rep"]
        ra, rb = root(a), root(b)
        if ra != rb:
            p, q = place[a], place[b]
            pa, pb = slice(edge[p], edge[p + 1]), slice(edge[q], edge[q + 1])
            if _overlap(code[pa], count[pa], code[pb], count[pb]) >= threshold:
                parent[max(ra, rb)] = min(ra, rb)
                links.append((min(a, b), max(a, b)))
    return links


def _open_links(members: DataFrame, reps: DataFrame, scores: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: the links of members that aren't linked to the least member of their bucket."""
    to_first = scores.select(F.col("a").alias("first"), F.col("b").alias("rep"), "s")
    scored = materialise(members.join(to_first, ["first", "rep"], "left").withColumn("s", F.coalesce("s", F.lit(1.0))), "scored")
    low = F.col("s") < threshold
    sizes = scored.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(low, 1)).alias("n_out")).where("n_out > 0 and n > 2")
    blocks = sizes.select("key", F.ceil(F.col("n") / BLOCK).alias("nm"), F.ceil(F.col("n_out") / BLOCK).alias("no"))
    rows = scored.join(blocks, "key")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    sides = rows.select("key", "band", "rep", "s", F.lit(False).alias("outside"), own("nm").alias("mb"), every("no").alias("ob")).unionByName(
        rows.where(low).select("key", "band", "rep", "s", F.lit(True).alias("outside"), every("nm").alias("mb"), own("no").alias("ob"))
    )
    full = sides.join(reps.select("rep", "sig"), "rep").join(texts, "rep")
    names = ["key", "mb", "ob"]
    dealt = full.repartition(*names).sortWithinPartitions(*names)

    def run(batches):
        import pyarrow as pa

        now, held = None, []
        for batch in batches:
            links = []
            for row in batch.to_pylist():
                at = tuple(row[n] for n in names)
                if at != now:
                    links += _bucket_links(held, threshold)
                    now, held = at, []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], type=pa.int64()) for k in (0, 1)], names=["a", "b"])
        links = _bucket_links(held, threshold)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], type=pa.int64()) for k in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id, h1, h2, component)``, one row for each row of ``df``; the component is the least id reachable by links."""
    rows = df.select(col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    fields = "h1 long, h2 long, bands array<long>, sig binary"
    profile = materialise(map_texts(rows, ["id"], ["text"], _profile, fields), "signatures")
    known = profile.where("id is not null and bands is not null")
    first = F.min_by(F.struct("bands", "sig"), "id").alias("w")
    reps = materialise(known.groupBy("h1", "h2").agg(F.min("id").alias("rep"), first).select("h1", "h2", "rep", "w.*"), "classes")
    banded = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first <> last").select("key", "first")
    members = materialise(banded.join(shared, "key"), "buckets")
    named = members.select("rep").distinct()
    texts = rows.join(named.withColumnRenamed("rep", "id"), "id").select(F.col("id").alias("rep"), "text")
    texts = materialise(texts.dropDuplicates(["rep"]), "candidates")
    pairs = members.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    scores = materialise(_scored(pairs, texts), "scores")
    links = scores.where(F.col("s") >= threshold).select("a", "b").unionByName(_open_links(members, reps, scores, texts, threshold))
    joined = components(links)
    of_class = reps.select("h1", "h2", "rep").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    found = of_class.select("h1", "h2", F.coalesce("component", "rep").alias("c"))
    alone = F.when(F.col("bands").isNull(), F.col("id")).otherwise(F.col("c"))
    return (
        profile.join(found, ["h1", "h2"], "left")
        .select("id", "h1", "h2", F.when(F.col("id").isNotNull(), alone).alias("component"))
    )


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id, class_id, kept)`` for every row; ``kept`` marks the least id of a class."""
    found = classes(df, id_col, text_col, threshold)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return found.select(F.col("id").alias(id_col), F.col("component").alias("class_id"), kept.alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: the rows of the least id.  Rows that repeat an id stay or go together."""
    found = classes(df, id_col, text_col, threshold).where("id is not null and id <> component")
    (of_id,) = free_names(df.columns, "__id")
    gone = found.select(F.col("id").alias(of_id)).distinct()
    return df.join(gone, col(id_col).cast("long") == F.col(of_id), "left_anti")
