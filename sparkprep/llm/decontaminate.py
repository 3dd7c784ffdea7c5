"""Benchmark passages in documents: latent semantic search, then longest common subsequences.

Words are runs of letters and digits in lower case.  Passages are windows of 64 words that advance by 32.  Benchmark
items are cut into segments of at most 64 words.  The vocabulary are the words of the benchmark; a passage is the sum of
their TF-IDF vectors, with document frequencies over the 32-word pieces of all documents, and words in more than a tenth
of the pieces left out of the vectors.

A randomised SVD gives the latent space: the range of ``A^T A`` is found by power steps from a random start, each step
one Spark job over the passages of every distinct text (copies count once) and the benchmark itself; statistics and search
cover every document.  Every passage is projected and compared with every segment; cosines of ``COSINE`` or more are
candidates, and so are passages that reach that share of a segment's own length along it, however much stands around it.
Segments that weigh little beside the text around them (their words are common, be it by copies of the very
passage, or few) could stay below that: they are faint, and every passage whose words hold half of theirs is a candidate
too, so they are found by their words alone.

A candidate is checked on the words: the longest common subsequence of the segment and the passage, with a piece more at
both ends; a segment counts if at least half of it is covered.  An item is found in a document if the best subsequences of its segments cover ``COVER`` of its words, or
``COVER_WITH_ANSWER`` of them and nearly all of its answer (the ``answer`` column, or its last sentence), so paraphrases
that keep the answer count.

Defined results: null texts are empty; items with fewer than ``LEAST_WORDS`` words must be covered whole; empty items are
never found.  Repeated items are found together.  Rows that repeat an id are documents of their own.
"""

from __future__ import annotations

import pickle
import re
import uuid
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, free_names
from sparkprep.llm.frames import fold_texts, map_texts, text_of
from sparkprep.llm.text import ALNUM, latest, words
from sparkprep.session import materialise

PIECE = 32
SEGMENT = 64
RANK = 256
COSINE = 0.5
COVER, COVER_WITH_ANSWER, ANSWER = 0.7, 0.6, 0.8
#: Of a segment, to count for its item at all.
LEAST_COVER = 0.5
LEAST_WORDS = 8
MAX_SHARE = 0.1
#: Squared cosine of a whole segment with a passage around it, below which it is faint.
FAINT = 0.4
#: Items that share one latent space; a larger benchmark is searched space by space in the same pass.
SPACE_ITEMS = 1000
#: Characters of texts that a task holds as matrices at once.
CHUNK = 400_000


class Item(NamedTuple):
    item_id: int
    words: np.ndarray
    answer_at: int  # where the answer starts


def _hashes(text: str) -> np.ndarray:
    return words([text.lower()], ALNUM).hash


def _items(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None) -> list[Item]:
    """The benchmark, read by the driver: it is a fixed list of questions, and every task needs all of it."""
    answer = text_of(answer_col) if answer_col else F.lit("")
    out = []
    for r in benchmark.select(col(id_col).cast("long").alias("i"), text_of(text_col).alias("t"), answer.alias("a")).toLocalIterator():
        if answer_col:
            body, tail = _hashes(r.t), _hashes(r.a)
        else:
            sentences = [s for s in re.split(r"(?<=[.!?])\s+", r.t.strip()) if s]
            body, tail = _hashes(" ".join(sentences[:-1])), _hashes(sentences[-1] if sentences else "")
        both = np.concatenate([body, tail])
        if len(both):
            out.append(Item(r.i, both, len(body)))
    return sorted(out, key=lambda x: (x.item_id is None, x.item_id, len(x.words), x.words.tobytes()))


def _masks(a: list) -> dict:
    """For each word the bits of its places."""
    mask: dict = {}
    for i, x in enumerate(a):
        mask[x] = mask.get(x, 0) | 1 << i
    return mask


def _common(mask: dict, size: int, b: list) -> int:
    """Length of a longest common subsequence with ``size`` words given by their places; a column of the table is the bits of a number."""
    full = row = (1 << size) - 1
    for y in b:
        if y in mask:
            both = row & mask[y]
            row = (row + both | row - both) & full
    return size - row.bit_count()


def lcs_length(a: list, b: list) -> int:
    """Length of a longest common subsequence."""
    return _common(_masks(a), len(a), b)


def lcs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``a`` lie on a longest common subsequence with ``b``."""
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=np.int32)
    for i in range(len(a)):
        take = np.where(b == a[i], table[i, :-1] + 1, 0)
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], take))
    on = np.zeros(len(a), dtype=bool)
    i, j = len(a), len(b)
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            on[i - 1] = True
            i, j = i - 1, j - 1
    return on


class Lookup(NamedTuple):
    """Sorted hashes and, for each value of their leading bits, the place of the first one that isn't smaller."""

    words: np.ndarray
    first: np.ndarray
    shift: np.uint64
    longest: int  # most words with the same leading bits

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the words, -1 if it is none of them."""
        at = self.first[hashes >> self.shift]
        last = len(self.words) - 1
        for _ in range(self.longest - 1):
            at += (self.words[at] < hashes) & (at < last)
        return np.where(self.words[at] == hashes, at, -1)


def _lookup(vocabulary: np.ndarray) -> Lookup:
    bits = len(vocabulary).bit_length() + 2
    shift = np.uint64(64 - bits)
    size = np.bincount((vocabulary >> shift).astype(np.int64), minlength=1 << bits)
    first = np.minimum(np.cumsum(size) - size, len(vocabulary) - 1).astype(np.int32)
    return Lookup(vocabulary, first, shift, int(size.max()))


class _Pieces(NamedTuple):
    """Vocabulary words of texts: ``term`` is in ``piece``; piece ``p`` is of text ``doc[p]``, whose first one is ``begin[doc[p]]``."""

    term: np.ndarray
    piece: np.ndarray
    doc: np.ndarray
    last: np.ndarray
    begin: np.ndarray


def _pieces(texts: list[str], lookup: Lookup) -> _Pieces:
    w = words([t.lower() for t in texts], ALNUM)
    span = np.diff(w.first)
    number = -(-span // PIECE)
    begin = np.concatenate(([0], np.cumsum(number)))
    doc = np.repeat(np.arange(w.n), number)
    at = lookup.places(w.hash)
    known = np.flatnonzero(at >= 0)
    place = known - w.first[w.doc[known]]
    piece = begin[w.doc[known]] + place // PIECE
    last = np.zeros(len(doc), dtype=bool)
    last[begin[1:][number > 0] - 1] = True
    return _Pieces(at[known], piece, doc, last, begin)


class Faint(NamedTuple):
    """Segments that are searched by their words: ``counts`` has a row for each of their terms, a column for each segment."""

    segment: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    size: np.ndarray


def _faint(own: list[np.ndarray], whole: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray, around: float) -> Faint:
    """Segments that a passage would hide; ``around`` is the mean squared weight of a word of the documents.

    Rests of a few words of a longer item are left to the vectors; ``whole`` marks segments that are an item.
    """
    size = np.array([len(x) for x in own])
    term = np.searchsorted(vocabulary, np.concatenate(own))
    row = np.repeat(np.arange(len(own)), size)
    pair, n = np.unique(row * len(vocabulary) + term, return_counts=True)
    row, term = pair // len(vocabulary), pair % len(vocabulary)
    weight = np.bincount(row, (n * idf[term].astype(np.float64)) ** 2, len(own))
    rest = (SEGMENT - size) * around
    faint = (weight < FAINT * (weight + rest)) | (weight <= 0)
    faint &= whole | (size >= LEAST_WORDS)
    segment = np.flatnonzero(faint)
    some = faint[row]
    terms, at = np.unique(term[some], return_inverse=True)
    counts = np.zeros((len(terms), len(segment)), dtype=np.float32)
    counts[at, np.searchsorted(segment, row[some])] = n[some]
    return Faint(segment, terms, counts, size[segment])


def _holding(p: _Pieces, faint: Faint, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """``(piece, segment)``: the four pieces around it hold ``LEAST_COVER`` of the segment's words, in any order."""
    at = np.minimum(np.searchsorted(faint.terms, p.term), len(faint.terms) - 1)
    known = faint.terms[at] == p.term
    term, piece = at[known], p.piece[known]
    pairs = []
    for shift in (-2, -1, 0, 1):
        to = piece + shift
        same = (to >= 0) & (to < len(p.doc))
        same[same] = p.doc[to[same]] == p.doc[piece[same]]
        pairs.append(to[same] * len(faint.terms) + term[same])
    pair = np.unique(np.concatenate(pairs))
    row, term = pair // len(faint.terms), pair % len(faint.terms)
    found = []
    for first in range(0, len(p.doc), block):
        a, b = np.searchsorted(row, (first, first + block))
        held = _rows(term[a:b], row[a:b] - first, min(block, len(p.doc) - first), faint.counts)
        k, g = np.nonzero(held >= LEAST_COVER * faint.size)
        found.append((k + first, faint.segment[g]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (row, row)


class Space(NamedTuple):
    """A latent space over the whole vocabulary and the segments that are searched in it."""

    terms: np.ndarray  # vocabulary x rank: idf times direction
    segments: np.ndarray  # segments x rank, unit length
    length: np.ndarray  # of the segments before that, infinite if the space holds nothing of one
    item: np.ndarray  # item of a segment
    start: np.ndarray  # first word of a segment in its item
    faint: Faint


def _known(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """For each text its hash, its vocabulary words, and how many of them each piece holds, as bytes of int32."""
    lookup = _lookup(vocabulary)

    def pieces_of(texts):
        p = _pieces(texts, lookup)
        size = np.bincount(p.piece, minlength=len(p.doc)).astype(np.int32)
        ends = np.concatenate(([0], np.cumsum(size)))[p.begin]
        cut = lambda x, at: [x[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        return [cut(p.term.astype(np.int32), ends), cut(size, p.begin)]

    hashed = docs.select(F.xxhash64("text").alias("h"), "text")
    return materialise(map_texts(hashed, ["h"], ["text"], pieces_of, "term binary, size binary", CHUNK), "known_words")


def _ints(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=np.int32)


def _frequencies(known: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Pieces that hold each word, all pieces."""

    def start():
        return [np.zeros(len(vocabulary), dtype=np.int64), 0]

    def step(state, terms, sizes):
        size = _ints(sizes)
        pair = np.sort(np.repeat(np.arange(len(size)), size) * len(vocabulary) + _ints(terms))
        state[0] += np.bincount(pair[_changes(pair)] % len(vocabulary), minlength=len(vocabulary))
        state[1] += len(size)

    def finish(state):
        at = np.flatnonzero(state[0])
        return [np.append(at, -1), np.append(state[0][at], state[1])]

    counts = fold_texts(known, ["term", "size"], start, step, finish, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # one row for each benchmark word
    got = {r.term: r.n for r in counts.collect()}
    df = np.array([got.get(i, 0) for i in range(len(vocabulary))], dtype=np.float64)
    return df, got.get(-1, 0)


def _changes(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has the first of each value."""
    new = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return new


def _added(state: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``state[at] += rows``, with repeated places."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    state[at[first]] += np.add.reduceat(rows[order], first, axis=0)


def _rows(term: np.ndarray, row: np.ndarray, n: int, matrix: np.ndarray, block: int = 256) -> np.ndarray:
    """Sums of matrix rows by ``row``, which is sorted.

    Blocks of rows of like size take their first terms at once, then their second ones and so on, so that only one block
    of sums is held besides the result; a block is small enough for a core's cache.
    """
    out = np.zeros((n, matrix.shape[1]), dtype=matrix.dtype)
    if len(term):
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        size = np.diff(np.append(first, len(term)))
        order = np.argsort(-size, kind="stable")
        taken = np.empty((min(block, len(order)), matrix.shape[1]), dtype=matrix.dtype)
        for b in range(0, len(order), block):
            at, left = first[order[b : b + block]], -size[order[b : b + block]]
            sums = matrix.take(term[at], axis=0)
            for k in range(1, -left[0]):
                m = np.searchsorted(left, -k)  # those with a term number k
                # terms are places of the matrix; with "clip" numpy writes into the block directly
                sums[:m] += matrix.take(term[at[:m] + k], axis=0, out=taken[:m], mode="clip")
            out[row[at]] = sums
    return out


def _spread(state: np.ndarray, term: np.ndarray, size: np.ndarray, doc: np.ndarray, weighted: np.ndarray, block: int = 2048) -> None:
    """``state += A^T (A weighted)`` for the passages of texts, both factors ``A`` without weights: pieces of ``size`` words.

    A passage is a piece and the next one of the same text; a text of one piece is one passage.
    """
    begin = np.concatenate(([0], np.cumsum(size)))
    change = doc[1:] != doc[:-1]
    last = np.append(change, True)
    alone = last & np.concatenate(([True], change))
    for a in range(0, len(size), block):
        b = min(a + block, len(size))
        e = min(b + 1, len(size))  # the last passage of a block reaches into the next one
        t, row = term[begin[a] : begin[e]], np.repeat(np.arange(e - a), size[a:e])
        if not len(t):
            continue
        held = _rows(t, row, e - a, weighted)
        passage = np.zeros_like(held)
        np.add(held[:-1], held[1:], out=passage[:-1])
        passage[np.flatnonzero(last[a:b])] = 0
        passage[b - a :] = 0
        # each passage goes back to both of its pieces
        back = passage.copy()
        back[1:] += passage[:-1]
        single = np.flatnonzero(alone[a:b])
        back[single] = held[single]
        order = np.argsort(t.astype(np.uint16) if len(state) <= 1 << 16 else t, kind="stable")
        t = t[order]
        new = _changes(t)
        at = t[new]
        state[at] += _rows(row[order], np.cumsum(new) - 1, len(at), back)


def _gathered(passages: DataFrame, q: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """``A^T A q`` over all passages: tasks sum their own, then each word is summed in one place."""
    weighted, weighs = (q * idf[:, None]).astype(np.float32), idf != 0

    def begin():
        return np.zeros(weighted.shape, dtype=np.float32)

    def step(state, terms, sizes):
        doc = np.repeat(np.arange(len(sizes)), [len(x) // 4 for x in sizes])
        term, size = _ints(terms), _ints(sizes)
        some = weighs[term]
        left = np.bincount(np.repeat(np.arange(len(size)), size)[some], minlength=len(size))
        _spread(state, term[some], left, doc, weighted)

    def finish(state):
        at = np.flatnonzero(state.any(axis=1))
        return [at, [x.tobytes() for x in state[at]]]

    def add(sums, terms, rows):
        for t, v in zip(terms, rows, strict=True):
            sums[t] = sums.get(t, 0) + np.frombuffer(v, dtype=np.float32).astype(np.float64)

    def added(sums):
        return [list(sums), [x.tobytes() for x in sums.values()]]

    parts = fold_texts(passages, ["term", "size"], begin, step, finish, "word int, v binary").repartition("word")
    out = np.zeros(weighted.shape)
    # one row for each benchmark word
    for r in fold_texts(parts, ["word", "v"], dict, add, added, "word int, v binary").collect():
        out[r.word] = np.frombuffer(r.v, dtype=np.float64)
    return out * idf[:, None]


def _space(passages: DataFrame, items: list[Item], vocabulary: np.ndarray, idf: np.ndarray, around: float, rank: int, seed: int) -> Space:
    """Randomised SVD of the documents' and the benchmark's passages."""
    item = np.array([k for k, x in enumerate(items) for _ in range(0, len(x.words), SEGMENT)], dtype=np.int64)
    start = np.array([s for x in items for s in range(0, len(x.words), SEGMENT)], dtype=np.int64)
    own = [items[k].words[s : s + SEGMENT] for k, s in zip(item, start, strict=True)]
    term = np.searchsorted(vocabulary, np.concatenate(own))
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    rank = min(rank, len(vocabulary))
    basis = np.random.default_rng(seed).standard_normal((len(vocabulary), rank)).astype(np.float32)

    for _ in range(2):
        corpus = _gathered(passages, basis, idf)
        weighted = basis * idf[:, None]
        bench = np.zeros((len(vocabulary), rank))
        _added(bench, term, _rows(term, row, len(own), weighted)[row] * idf[term][:, None])
        # the benchmark weighs as much as the documents, whatever their sizes
        scale = np.linalg.norm(corpus) / max(np.linalg.norm(bench), 1e-12)
        basis = np.linalg.qr(corpus + max(scale, 1e-6) * bench + 1e-9 * basis)[0].astype(np.float32)
    terms = (basis * idf[:, None]).astype(np.float32)
    segments = _rows(term, row, len(own), terms)
    length = np.linalg.norm(segments, axis=1)
    whole = np.array([len(items[k].words) == len(x) for k, x in zip(item, own, strict=True)])
    faint = _faint(own, whole, vocabulary, idf, around)
    unit = (segments / np.maximum(length, 1e-12)[:, None]).astype(np.float32)
    return Space(terms, unit, np.where(length > 1e-9, length, np.inf).astype(np.float32), item, start, faint)


def _matcher(spaces: list[tuple[Space, list[Item]]], vocabulary: np.ndarray, weighs: np.ndarray, cosine: float):
    """The search; what it needs of the vocabulary and the segments is made once."""
    lookup = _lookup(vocabulary)
    parts = []
    for space, items in spaces:
        own = [np.searchsorted(vocabulary, items[i].words[a : a + SEGMENT]) for i, a in zip(space.item, space.start, strict=True)]
        parts.append([(x, _masks(x.tolist())) for x in own])

    def find(texts: list[str]):
        p = _pieces(texts, lookup)
        found: list[list[dict]] = [[] for _ in texts]
        held_at = np.concatenate(([0], np.cumsum(np.bincount(p.piece, minlength=len(p.doc)))))
        some = weighs[p.term]
        term, piece = p.term[some], p.piece[some]
        # a window is a piece and the next one of the same text; a text of one piece is one window
        alone = p.last & (np.concatenate(([True], p.doc[1:] != p.doc[:-1])) if len(p.doc) else p.last)
        window = np.flatnonzero(~p.last | alone)
        best: dict[tuple, np.ndarray] = {}
        for s, (space, items) in enumerate(spaces):
            v = _rows(term, piece, len(p.doc), space.terms)
            two = np.flatnonzero(~p.last)
            v[two] += v[two + 1]
            norm = np.linalg.norm(v, axis=1)
            some = window[norm[window] > 1e-9]
            width = len(space.segments)
            pair = np.flatnonzero(v[some] @ space.segments.T >= cosine * np.minimum(norm[some][:, None], space.length))
            at, seg = some[pair // width], pair % width
            if len(space.faint.segment):
                held, part = _holding(p, space.faint)
                some = np.isin(held, window)
                pair = np.unique(np.concatenate([at, held[some]]) * width + np.concatenate([seg, part[some]]))
                at, seg = pair // width, pair % width
            # the words of the window and of a piece more at both ends; words outside the vocabulary are in no segment
            begin = held_at[np.maximum(at - 1, p.begin[p.doc[at]])]
            end = held_at[np.minimum(at + 3, p.begin[p.doc[at] + 1])]
            for d, g, a, b in zip(p.doc[at].tolist(), seg.tolist(), begin.tolist(), end.tolist(), strict=True):
                part, mask = parts[s][g]
                near = p.term[a:b]
                if _common(mask, len(part), near.tolist()) < LEAST_COVER * len(part):
                    continue
                on = lcs(part, near)
                i, start = int(space.item[g]), int(space.start[g])
                key = (d, s, i)
                if key not in best:
                    best[key] = np.zeros(len(items[i].words), dtype=bool)
                old = best[key][start : start + SEGMENT]
                if on.sum() > old.sum():
                    best[key][start : start + SEGMENT] = on
        for (d, s, i), on in best.items():
            x = spaces[s][1][i]
            cover = float(on.mean())
            answer = float(on[x.answer_at :].mean()) if x.answer_at < len(on) else 0.0
            need = COVER if len(on) >= LEAST_WORDS else 1.0
            if cover >= need or (len(on) >= LEAST_WORDS and cover >= COVER_WITH_ANSWER and answer >= ANSWER):
                found[d].append({"item_id": x.item_id, "coverage": cover, "answer": answer})
        return [found]

    return find


def benchmark_matches(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    rank: int = RANK,
    cosine: float = COSINE,
    found_col: str = "bench_matches",
) -> DataFrame:
    """``df`` with ``found_col``, in place of a column of this name: the found items with their coverage, empty for clean documents."""
    items = _items(benchmark, item_col, item_text_col, answer_col)
    empty = F.array().cast("array<struct<item_id:bigint,coverage:double,answer:double>>")
    if not items:
        return df.withColumn(found_col, empty)
    vocabulary = np.unique(np.concatenate([x.words for x in items]))
    known = _known(df.select(text_of(text_col).alias("text")), vocabulary)
    frequency, pieces = _frequencies(known, vocabulary)
    idf = np.log((pieces + 1.0) / (frequency + 1.0)).astype(np.float32)
    # words of too many pieces weigh nothing; if that leaves nothing, all stay
    common = frequency > MAX_SHARE * max(pieces, 1)
    if not common.all():
        idf[common] = 0
    around = float((frequency * idf.astype(np.float64) ** 2).sum()) / max(pieces * PIECE, 1)
    # copies would fill the space with their own directions
    passages = materialise(known.dropDuplicates(["h", "term", "size"]).drop("h"), "passages")
    spaces = []
    for at in range(0, len(items), SPACE_ITEMS):
        part = items[at : at + SPACE_ITEMS]
        spaces.append((_space(passages, part, vocabulary, idf, around, rank, at), part))
    # bytes that hold the classes too: executors need no copy of this folder
    shared, stamp = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps((spaces, vocabulary, idf != 0))), uuid.uuid4().hex

    def find(texts):
        return latest("decontaminate", stamp, lambda: _matcher(*pickle.loads(shared.value), cosine))(texts)

    kept = [c for c in df.columns if c.lower() != found_col.lower()]
    row, text = F.struct(*[col(c) for c in kept]).alias("row"), text_of(text_col).alias("text")
    found = map_texts(df.select(row, text), ["row"], ["text"], find, "found array<struct<item_id:bigint,coverage:double,answer:double>>", CHUNK)
    return found.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("found").alias(found_col))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item."""
    (found,) = free_names(df.columns, "bench_matches")
    return benchmark_matches(df, benchmark, found_col=found, **options).where(F.size(found) == 0).select(*[col(c) for c in df.columns])
