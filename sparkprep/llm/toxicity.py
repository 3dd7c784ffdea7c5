"""Toxicity by the nearest labelled examples.

Terms are whole words (lower-case runs of word characters, marked by a space at the end) and the beginnings of words, 4
to 8 characters long, which catch stems.  The vocabulary are the ``TERMS`` terms that tell the labels of the examples
apart best (chi square, where it is beyond chance), and one term for all other words, so that a
single hit in a long text weighs less than in a short one; a text is its TF-IDF vector ``(1 + log tf) * idf`` of length 1, with document frequencies over
all documents.

The examples lie in a block-max inverted index: they are ordered by their heaviest term and cut into blocks, and each
term keeps its largest weight in every block.  The blocks are read in the order of their bound, and reading stops when no
block can hold a nearer example, so the ``NEIGHBOURS`` nearest are exact.  Their votes are weighted by cosine and by how
rare their label is among the examples; the share of the toxic votes is turned into a probability by an isotonic fit on
the examples themselves, each scored without itself.

Examples are at most ``PER_LABEL`` labelled documents of each label, the least by hash; everything else covers all
documents.  Labels, language, source and id are no inputs of a score.

Defined results: null texts are empty.  Texts without words get the score of such examples.  A
document with several labels is toxic if any says so; null labels don't count.  Equal cosines go to the example that
comes first in the index, whose order comes from the texts alone.  Without examples of both labels every score is the
share of toxic ones (0 without any).
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, free_names
from sparkprep.llm.frames import fold_texts, map_texts, text_of
from sparkprep.llm.text import latest
from sparkprep.session import materialise

PER_LABEL = 2000
TERMS = 1500
NEIGHBOURS = 15
BLOCK = 64
TOXIC_FROM = 0.7
#: Lengths of the beginnings of words.
STEMS = range(4, 9)
#: Examples that must hold a term for it to be looked at.
LEAST_EXAMPLES = 5
#: Least chi square of a term: chance reaches it for one term in ten million.
LEAST_CHI = 28.0

_WORD = re.compile(r"\w+")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_counts(text: str) -> Counter:
    return Counter(_WORD.findall(text.lower()))


def term_counts(words: Counter, vocabulary: dict | None = None) -> Counter:
    """Terms of a text, or its terms in the vocabulary by number."""
    out: Counter = Counter()
    if vocabulary is None:
        for w, n in words.items():
            out[w + " "] += n
            for k in STEMS:
                if k > len(w):
                    break
                out[w[:k]] += n
        return out
    find = vocabulary.get
    for w, n in words.items():
        i = find(w + " ")
        if i is not None:
            out[i] += n
        for k in STEMS:
            if k > len(w):
                break
            i = find(w[:k])
            if i is not None:
                out[i] += n
    return out


class Index:
    """Block-max inverted index over unit vectors ``(terms, weights)``."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, keys: list, n_terms: int, block: int = BLOCK):
        heaviest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        order = sorted(range(len(vectors)), key=lambda i: (heaviest[i], keys[i]))
        self.labels = np.asarray(labels, dtype=np.int64)[order] if len(order) else np.zeros(0, dtype=np.int64)
        self.keys = [keys[i] for i in order]
        self.vectors = [vectors[i] for i in order]
        self.block, self.n_blocks = block, max(1, -(-len(order) // block))
        term = np.concatenate([v[0] for v in self.vectors]) if order else np.zeros(0, dtype=np.int64)
        weight = np.concatenate([v[1] for v in self.vectors]) if order else np.zeros(0)
        place = np.repeat(np.arange(len(order)), [len(v[0]) for v in self.vectors])
        by = np.lexsort((place, term))
        self.place, self.weight = place[by], weight[by]
        self.most = np.zeros((n_terms, self.n_blocks))
        np.maximum.at(self.most, (term, place // block), weight)
        # postings of term t in block b: first[t * n_blocks + b] up to the next
        cell = term[by] * self.n_blocks + self.place // block
        self.first = np.searchsorted(cell, np.arange(n_terms * self.n_blocks + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``k`` nearest examples with a positive cosine; ``skip`` leaves one out."""
        bound = weights @ self.most[terms] if len(terms) else np.zeros(self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        places, cosines, worst = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0
        for b in order:
            if bound[b] <= 0 or bound[b] < worst - 1e-9:
                break
            if bound[b] <= worst + 5e-10 and b * self.block > places.max():
                continue  # at best a tie with an example that comes first
            dots = np.zeros(self.block)
            for t, w in zip(terms, weights, strict=True):
                s, e = self.first[t * self.n_blocks + b], self.first[t * self.n_blocks + b + 1]
                if s < e:
                    dots[self.place[s:e] - b * self.block] += w * self.weight[s:e]
            dots = np.round(dots, 9)  # so that equal cosines are equal in any order of the sum
            at = np.flatnonzero(dots > 0)
            new = at + b * self.block
            if skip >= 0:
                at, new = at[new != skip], new[new != skip]
            places, cosines = np.concatenate([places, new]), np.concatenate([cosines, dots[at]])
            if len(places) > k:
                best = np.lexsort((places, -cosines))[:k]
                places, cosines = places[best], cosines[best]
            if len(places) >= k:
                worst = cosines.min()
        best = np.lexsort((places, -cosines))
        return places[best], cosines[best]


class Model(NamedTuple):
    vocabulary: dict
    idf: np.ndarray
    index: Index
    vote_weight: np.ndarray
    shares: np.ndarray
    scores: np.ndarray
    without: float
    k: int

    def vector(self, words: Counter) -> tuple[np.ndarray, np.ndarray]:
        return vector(words, self.vocabulary, self.idf)

    def share(self, v: tuple, skip: int = -1) -> tuple[float | None, np.ndarray, np.ndarray]:
        place, cosine = self.index.nearest(*v, self.k, skip)
        if not len(place):
            return None, place, cosine
        vote = cosine * self.vote_weight[self.index.labels[place]]
        return float(vote[self.index.labels[place] == 1].sum() / vote.sum()), place, cosine

    def score(self, share: float | None) -> float:
        return self.without if share is None else float(np.interp(share, self.shares, self.scores))


def vector(words: Counter, vocabulary: dict, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vector of a text; its last term stands for all words.  A text without words has no term."""
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    counts = term_counts(words, vocabulary)
    terms = sorted(counts)
    w = (1 + np.log([*(counts[t] for t in terms), words.total()])) * idf[[*terms, len(vocabulary)]]
    return np.array([*terms, len(vocabulary)], dtype=np.int64), w / np.sqrt(w @ w)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step fit of ``y`` on ``x`` (pool adjacent violators), with one pseudo-row at both ends."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, weighted y, lowest x, highest x
    for a, b, w in zip(x[order], y[order], weight[order], strict=True):
        if pools and pools[-1][3] == a:
            pools[-1][0] += w
            pools[-1][1] += w * b
        else:
            pools.append([w, w * b, a, a])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w2, y2, _, high = pools.pop()
            pools[-1][0] += w2
            pools[-1][1] += y2
            pools[-1][3] = high
    base = float((weight * y).sum() / weight.sum())
    knots, values = [0.0], [0.0]
    for w, wy, low, high in pools:
        value = (wy + base) / (w + 1)
        for at in (low, high):
            if at > knots[-1]:
                knots.append(at)
                values.append(max(value, values[-1] + 1e-9))
            else:
                values[-1] = max(value, values[-1])
    if knots[-1] < 1:
        knots.append(1.0)
        values.append(values[-1] + 1e-9)
    return np.array(knots), np.minimum(np.array(values), 1.0)


def _examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, toxic)``: distinct texts of the examples; ``labels`` has ``(id, toxic)``."""
    known = labels.where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    h = F.xxhash64(F.lit(11), "id")
    chosen = [known.where(F.col("toxic") == y).orderBy(h, "id").limit(PER_LABEL) for y in (0, 1)]
    # at most 2 * PER_LABEL rows, so they may go to every task
    ids = materialise(chosen[0].unionByName(chosen[1]), "example_ids").withColumnRenamed("id", "__id")
    found = docs.join(F.broadcast(ids), docs["id"] == F.col("__id")).select("text", "toxic")
    return materialise(found.repartition(8), "examples")


def _vocabulary(examples: DataFrame, n_terms: int) -> list[str]:
    def step(state, texts, toxic):
        for t, y in zip(texts, toxic, strict=True):
            state[y].update(term_counts(word_counts(t)).keys())

    def finish(state):
        terms = sorted(set(state[0]) | set(state[1]))
        return [terms, [state[0][t] for t in terms], [state[1][t] for t in terms]]

    counted = fold_texts(examples, ["text", "toxic"], lambda: [Counter(), Counter()], step, finish, "term string, clean long, toxic long")
    total = {r.toxic: r.n for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = float(total.get(0, 0)), float(total.get(1, 0))
    if not n0 or not n1:
        return []
    a, b = F.col("toxic"), F.col("clean")
    c, d = F.lit(n1) - a, F.lit(n0) - b
    chi = (a * d - b * c) ** 2 * (n0 + n1) / ((a + b) * (c + d) * n0 * n1 + 1e-9)
    sums = counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(a + b >= LEAST_EXAMPLES)
    top = sums.select("term", "clean", "toxic", chi.alias("chi")).where(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "term").limit(3 * n_terms).collect()
    kept, seen = [], {}
    for r in top:
        # a beginning that occurs in just the examples of a longer or shorter one says nothing more
        same = seen.setdefault((r.clean, r.toxic), [])
        if not any(r.term.startswith(t.rstrip()) or t.startswith(r.term.rstrip()) for t in same):
            same.append(r.term)
            kept.append(r.term)
    return kept[:n_terms]


def _document_frequency(docs: DataFrame, vocabulary: dict) -> tuple[np.ndarray, int]:
    def start():
        return [np.zeros(len(vocabulary), dtype=np.int64), 0]

    def step(state, texts):
        for t in texts:
            state[0][list(term_counts(dict.fromkeys(_WORD.findall(t.lower()), 1), vocabulary))] += 1
        state[1] += len(texts)

    def finish(state):
        return [np.arange(-1, len(vocabulary)), np.concatenate([[state[1]], state[0]])]

    counted = fold_texts(docs, ["text"], start, step, finish, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    got = {r.term: r.n for r in counted.collect()}  # one row for each term
    return np.array([got.get(i, 0) for i in range(len(vocabulary))], dtype=np.float64), got.get(-1, 0)


def fit(docs: DataFrame, labels: DataFrame, terms: int = TERMS, k: int = NEIGHBOURS) -> Model:
    """``docs``: ``(id, text)``, texts not null; ``labels``: ``(id, toxic)``."""
    examples = _examples(docs, labels)
    vocabulary = {t: i for i, t in enumerate(_vocabulary(examples, terms))}
    frequency, n = _document_frequency(docs, vocabulary) if vocabulary else (np.zeros(0), 0)
    idf = np.append(np.log((n + 1.0) / (frequency + 1.0)) + 1.0, 1.0)

    def vectors(texts):
        out = [vector(word_counts(t), vocabulary, idf) for t in texts]
        return [[v[0] for v in out], [v[1] for v in out]]

    keyed = examples.select("toxic", F.md5("text").alias("key"), "text").dropDuplicates(["key"])
    rows = map_texts(keyed, ["toxic", "key"], ["text"], vectors, "terms array<long>, weights array<double>").orderBy("key").collect()
    labels_of = np.array([r.toxic for r in rows], dtype=np.int64)
    found = [(np.array(r.terms, dtype=np.int64), np.array(r.weights, dtype=np.float64)) for r in rows]
    index = Index(found, labels_of, [r.key for r in rows], len(idf))
    # as many votes for each label as it has among the labelled documents
    real = {r.toxic: r.n for r in labels.where("toxic is not null").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    mine = np.bincount(labels_of, minlength=2) if len(rows) else np.zeros(2)
    weight = np.array([real.get(y, 0) / mine[y] if mine[y] else 0.0 for y in (0, 1)])
    base = real.get(1, 0) / max(1, real.get(0, 0) + real.get(1, 0))
    model = Model(vocabulary, idf, index, weight, np.array([0.0, 1.0]), np.array([0.0, 1.0]), base, k)
    if not (mine > 0).all():
        return model._replace(scores=np.array([base, base]))
    shares = [model.share(v, skip=i)[0] for i, v in enumerate(index.vectors)]
    has = np.array([s is not None for s in shares])
    w, y = weight[index.labels], index.labels.astype(float)
    without = float((w[~has] * y[~has]).sum() + base) / float(w[~has].sum() + 1)
    knots, values = isotonic(np.array([s for s in shares if s is not None]), y[has], w[has])
    return model._replace(shares=knots, scores=values, without=without)


def scores(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    label_id_col: str = "doc_id",
    score_col: str = "toxic_score",
    evidence_col: str = "toxic_evidence",
) -> DataFrame:
    """``df`` with ``score_col`` and ``evidence_col`` (keys are md5 of the examples' texts), in place of columns of these names.

    Rows that :func:`held_out` marks are not learnt from.
    """
    learn = labels.where(~held_out(label_id_col)).select(col(label_id_col).alias("id"), col(label_col).cast("int").alias("toxic"))
    docs = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    model = fit(docs, learn)
    # bytes that hold the classes too: executors need no copy of this folder
    shared, stamp = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model)), uuid.uuid4().hex

    def score(texts):
        m = latest("toxicity", stamp, lambda: pickle.loads(shared.value))
        names = [*m.vocabulary, "*"]
        out, why, seen = [], [], {}
        for t in texts:
            v = m.vector(word_counts(t))
            key = v[0].tobytes() + v[1].tobytes()
            if key not in seen:
                seen[key] = m.share(v)
            share, place, cosine = seen[key]
            out.append(m.score(share))
            heavy = [names[i] for i in v[0][np.argsort(-v[1], kind="stable")[:5]]]
            near = [(m.index.keys[p], int(m.index.labels[p]), float(c)) for p, c in zip(place[:3], cosine[:3], strict=True)]
            why.append({"terms": heavy, "examples": [dict(zip(("key", "label", "cosine"), x, strict=True)) for x in near]})
        return [out, why]

    fields = "score double, evidence struct<terms:array<string>,examples:array<struct<key:string,label:int,cosine:double>>>"
    kept = [c for c in df.columns if c.lower() not in (score_col.lower(), evidence_col.lower())]
    row, text = F.struct(*[col(c) for c in kept]).alias("row"), text_of(text_col).alias("text")
    found = map_texts(df.select(row, text), ["row"], ["text"], score, fields)
    return found.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("score").alias(score_col), F.col("evidence").alias(evidence_col))


def drop_toxic(df: DataFrame, labels: DataFrame, threshold: float = TOXIC_FROM, **options) -> DataFrame:
    """The documents whose score stays below the threshold."""
    score, evidence = free_names(df.columns, "toxic_score", "toxic_evidence")
    found = scores(df, labels, score_col=score, evidence_col=evidence, **options)
    return found.where(F.col(score) < threshold).select(*[col(c) for c in df.columns])
