"""Quality selection by importance resampling with hashed n-grams.

Texts are words and runs of punctuation; their single words and pairs are hashed into ``BUCKETS``.  Two bag models are
counted: one over all documents, one over target documents (labelled good).  The importance weight of a document is the
ratio of its likelihoods; so that length doesn't decide, its logarithm is the mean over the n-grams times ``SCALE``.
Documents are sampled without replacement by the Gumbel trick: the ``k`` largest of log weight plus Gumbel noise, where
the noise comes from a hash of the text and the id.

The raw model covers all documents.  The target model is fitted on at most ``TARGET_DOCS`` labelled documents, the least
by hash.

Defined results: null texts are empty; a text without words has log weight ``-SCALE`` (it carries no evidence and is
taken last).  Rows that repeat id and text have equal keys; ties at the k-th place are all taken.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.llm.frames import fold_texts, map_texts, text_of
from sparkprep.llm.text import GOLDEN, WORD_PUNCT, mix, words
from sparkprep.session import materialise

BUCKETS = 1 << 16
SCALE = 100.0
FRACTION = 0.8
TARGET_DOCS = 20_000


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """``(bucket, text)`` of all n-grams."""
    w = words(texts, WORD_PUNCT)
    pair = np.flatnonzero(w.doc[1:] == w.doc[:-1]) if len(w.doc) else np.zeros(0, dtype=np.int64)
    two = mix(w.hash[pair] * np.uint64(3) + mix(w.hash[pair + 1] + GOLDEN)) if len(pair) else w.hash[:0]
    bucket = np.concatenate([w.hash, two]) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate([w.doc, w.doc[pair]]), w.n


def _models(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all and of the target documents, ``(text, target)`` rows."""

    def start():
        return np.zeros((2, BUCKETS), dtype=np.int64)

    def step(state, texts, target):
        bucket, doc, _ = _grams(texts)
        state[0] += np.bincount(bucket, minlength=BUCKETS)
        state[1] += np.bincount(bucket[np.array(target, dtype=bool)[doc]], minlength=BUCKETS)

    def finish(state):
        at = np.flatnonzero(state[0])
        return [at, state[0][at], state[1][at]]

    parts = fold_texts(docs, ["text", "target"], start, step, finish, "bucket int, n long, t long")
    total = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in total.collect():  # one row for each bucket
        raw[r.bucket], target[r.bucket] = r.n, r.t
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, with both models smoothed by the raw shares."""
    base = (raw + 0.5) / (raw + 0.5).sum()
    weight = 1000.0
    fitted = (target + weight * base) / (target.sum() + weight)
    return np.log(fitted / base)


def log_weights(df: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text hash, log_weight)`` for every row; ``target_ids`` has one column of ids."""
    chosen = target_ids.toDF("__t").where("__t is not null").distinct()
    # bounded by TARGET_DOCS rows, so it may go to every task
    chosen = materialise(chosen.orderBy(F.xxhash64("__t"), "__t").limit(TARGET_DOCS), "targets")
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    flagged = rows.join(F.broadcast(chosen), F.col("id") == F.col("__t"), "left").withColumn("target", F.col("__t").isNotNull())
    ratio = log_ratio(*_models(flagged))

    def score(texts):
        bucket, doc, n = _grams(texts)
        count = np.bincount(doc, minlength=n)
        total = np.bincount(doc, weights=ratio[bucket], minlength=n)
        return [np.where(count > 0, SCALE * total / np.maximum(count, 1), -SCALE), count]

    named = rows.withColumn("h", F.xxhash64("id", "text"))
    return map_texts(named, ["id", "h"], ["text"], score, "log_weight double, n_grams long")


def gumbel(h: Column) -> Column:
    """Standard Gumbel noise from a 64-bit hash."""
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, key: str, k: int, bins: int = 4096) -> float:
    """The exact ``k``-th largest value: bins of equal width are counted again and again inside the bin that holds it."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    above = 0
    while high > low:
        width = (high - low) / bins
        if width <= 0 or low + width <= low:
            break
        inside = df.where(F.col(key).between(low, high))
        number = F.least(F.floor((F.col(key) - low) / width), F.lit(bins - 1)).cast("int")
        counts = {r.b: (r.n, r.lo, r.hi) for r in inside.groupBy(number.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()}
        for b in sorted(counts, reverse=True):
            n, lo, hi = counts[b]
            if above + n >= k:
                if (lo, hi) == (low, high):
                    return _among(inside, key, k - above)
                low, high = lo, hi
                break
            above += n
    return high


def _among(df: DataFrame, key: str, k: int) -> float:
    """Values so close that bins don't part them: distinct values from above."""
    for r in df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc(key)).toLocalIterator():
        k -= r.n
        if k <= 0:
            return r[key]
    raise ValueError("fewer rows than k")


def resample(df: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION) -> DataFrame:
    """``(id, log_weight, n_grams, key, selected)`` for every row; ``ceil(fraction * rows)`` rows are selected."""
    weighed = log_weights(df, target_ids, id_col, text_col)
    keyed = materialise(weighed.withColumn("key", F.col("log_weight") + gumbel(F.col("h"))).drop("h"), "weights")
    n = keyed.count()
    k = min(n, math.ceil(fraction * n))
    limit = kth_largest(keyed, "key", k) if k else math.inf
    return keyed.withColumn("selected", F.col("key") >= F.lit(limit)).withColumnRenamed("id", id_col)
