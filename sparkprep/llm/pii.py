"""Personal data by patterns and a skip-chain conditional random field.

The base patterns (:data:`BASE`) give certain spans.  Further mentions (:data:`LOOSE`: runs of digits and signs, spelled
out mail addresses, words with a digit or dot inside) become nodes of a field over each document, with one label of
``KINDS`` or none.  A node has a potential from its shape; neighbours in the text share one, and so do distant mentions
that repeat or resemble each other: equal digits, equal last seven digits, equal local parts.  Mentions of one value are
linked one to the next, so a value that occurs a thousand times costs a thousand edges.  Loopy sum-product messages are
passed until they settle (at most ``ROUNDS`` rounds and four for each node); the nodes of base spans keep their kind.  A loose mention gets the kind whose marginal is
``SURE`` or more.  So a card without its check digit stays out, but the phone number that stands elsewhere with its plus
sign is found without it.

Words that are no mention can only be labelled none, so they drop out of the field exactly.

Training: node weights are a softmax regression on at most ``SAMPLE_DOCS`` distinct texts that hold digits or at signs (the
least by hash; copies count once), where the base patterns say the kind and features leave out what the patterns test for; the pair
potentials are smoothed log odds of linked mentions that agree, from the same sample.

Defined results: null texts are empty and have no spans.  Spans are code points, end exclusive.  Base spans are those of
the contract: leftmost and non-overlapping for each kind, failing matches dropped.  Added spans never overlap a base span
or each other.  Rows that repeat an id are documents of their own.  Without a sample nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.llm.frames import fold_texts, map_texts, text_of
from sparkprep.session import materialise

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 2000
SURE = 0.6
ROUNDS = 20

#: The base patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: An address is tried at the start of a run of digits only; inside the run it would fail or succeed alike.
_BASE = [re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}" if k == "ip" else BASE[k]) for k in KINDS]
#: Mentions that may be personal data.  Runs are tried at their start and never given back, so long words cost their length once.
LOOSE = re.compile(
    r"(?P<mail>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++[ ]?(?:@|\(at\)|\[at\]|\{at\}| at )[ ]?[A-Za-z0-9-]++(?:[ ]?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot )[ ]?[A-Za-z0-9-]++)+)"
    r"|(?P<number>\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){5,})"
    r"|(?P<word>(?<![A-Za-z])[A-Za-z]++\.[0-9]{1,4}(?![0-9.]))"
)
_SIGNS = re.compile(r"[0-9@]|\(at\)|\[at\]|\{at\}| at ")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _passes(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "email":
        return True
    digits = re.sub(r"[^0-9]", "", found)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str):
    """The email pattern, tried at its at signs only: a local part can't cross one."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and (c := text[start - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            start -= 1
        m = _BASE[0].match(text, start) if start < at else None
        if m:
            yield m
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the contract, in its order."""
    out = []
    if "@" in text:
        out += [(m.start(), 0, m.end()) for m in _emails(text)]
    if re.search("[0-9]", text):
        for k in (1, 2, 3):
            if (k == 1 and "." not in text) or (k == 3 and "+" not in text):
                continue
            out += [(m.start(), k, m.end()) for m in _BASE[k].finditer(text) if _passes(KINDS[k], m[0])]
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


class Field(NamedTuple):
    """Mentions of a text: spans, features, the clamped label (0 none known, else 1 + kind), and the links."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    clamped: np.ndarray
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


_FEATURES = 20


def _shape(text: str, start: int, end: int, group: str) -> np.ndarray:
    """Features that don't repeat the tests of the base patterns."""
    s = text[start:end]
    digits = sum(c.isdigit() for c in s)
    x = np.zeros(_FEATURES)
    x[0] = 1
    x[1 + min(digits // 3, 6)] = 1  # 0-2, 3-5, ... 18 and more digits
    x[8] = group == "mail"
    x[9] = group == "word"
    x[10] = "(" in s
    x[11] = "-" in s
    x[12] = " " in s
    dots = s.count(".")
    x[13] = dots == 3 and group == "number"
    x[14] = 0 < dots and dots != 3 and group == "number"
    x[15] = digits == len(s)
    x[16] = "@" in s
    parts = [len(p) for p in re.split(r"[^0-9]+", s) if p]
    x[17] = bool(parts) and max(parts) <= 3
    x[18] = bool(parts) and max(parts) == 4
    x[19] = bool(parts) and len(parts) > 2
    return x


def field(text: str, base: list[tuple[int, str, int]]) -> Field:
    spans = [(s, e, 1 + KINDS.index(k), "mail" if k == "email" else "number") for s, k, e in base]
    if _SIGNS.search(text):
        taken = sorted((s, e) for s, _, e in base)
        starts = np.array([s for s, _ in taken], dtype=np.int64)
        for m in LOOSE.finditer(text):
            at = int(np.searchsorted(starts, m.end()))
            # the base spans that start before its end; only long ones reach far
            if not any(e > m.start() for _, e in taken[max(0, at - 4) : at]):
                spans.append((m.start(), m.end(), 0, m.lastgroup))
    spans.sort(key=lambda x: (x[0], x[2], x[1]))
    features = np.array([_shape(text, s, e, g) for s, e, _, g in spans]).reshape(-1, _FEATURES)
    chain = [(i, i + 1) for i in range(len(spans) - 1) if spans[i + 1][0] - spans[i][1] <= 40]
    skip, last = set(), {}
    for i, (s, e, _, g) in enumerate(spans):
        said = text[s:e].lower()
        digits = re.sub(r"[^0-9]", "", said)
        keys = []
        if g == "number":
            keys.append(("all", digits))
            if len(digits) >= 9:
                keys.append(("end", digits[-7:]))
            elif len(digits) == 7:
                keys.append(("end", digits))
        else:
            keys.append(("local", re.split(r"[ ]?(?:@|\(at\)|\[at\]|\{at\}| at )", said)[0]))
        for k in keys:
            if k in last:
                skip.add((last[k], i))
            last[k] = i
    return Field([(s, e) for s, e, _, _ in spans], features, np.array([c for _, _, c, _ in spans], dtype=np.int64), chain, sorted(skip))


class Weights(NamedTuple):
    node: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray


def marginals(f: Field, w: Weights, rounds: int | None = None) -> np.ndarray:
    """Loopy sum-product; exact where the links form a tree."""
    n, labels = len(f.spans), len(KINDS) + 1
    node = f.features @ w.node
    node = node - node.max(axis=1, keepdims=True)
    potential = np.exp(node)
    # base spans keep their kind
    known = f.clamped > 0
    potential[known] = 1e-12
    potential[known, f.clamped[known]] = 1.0
    pairs = [*f.chain, *f.skip]
    if not pairs:
        return potential / potential.sum(axis=1, keepdims=True)
    e = np.array(pairs)
    kind = np.concatenate([np.zeros(len(f.chain), dtype=int), np.ones(len(f.skip), dtype=int)])
    tables = np.exp(np.stack([w.chain, w.skip]))[kind]
    source, target = np.concatenate([e[:, 0], e[:, 1]]), np.concatenate([e[:, 1], e[:, 0]])
    table = np.concatenate([tables, tables.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(e)) + len(e), np.arange(len(e))])
    message = np.full((2 * len(e), labels), 1.0 / labels)
    # evidence moves one link a round, and half of it at a time
    for _ in range(ROUNDS + 4 * n if rounds is None else rounds):
        logs = np.log(message)
        total = np.log(potential)
        np.add.at(total, target, logs)
        out = total[source] - logs[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.einsum("ei,eij->ej", out, table) + 1e-12
        new = new / new.sum(axis=1, keepdims=True)
        change, message = np.abs(new - message).max(), 0.5 * message + 0.5 * new
        if change < 1e-6:
            break
    total = np.log(potential)
    np.add.at(total, target, np.log(message))
    total = np.exp(total - total.max(axis=1, keepdims=True))
    return total / total.sum(axis=1, keepdims=True)


def all_spans(text: str, w: Weights | None) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Base spans, and base and added spans."""
    base = base_spans(text)
    if w is None or not _SIGNS.search(text):
        return base, base
    f = field(text, base)
    if not (f.clamped == 0).any():
        return base, base
    p = marginals(f, w)
    best = p[:, 1:].argmax(axis=1)
    added = [
        (s, KINDS[best[i]], e) for i, (s, e) in enumerate(f.spans) if f.clamped[i] == 0 and p[i, 1 + best[i]] >= SURE
    ]
    return base, sorted(base + added, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def train(x: np.ndarray, y: np.ndarray, n: np.ndarray, pairs: np.ndarray, steps: int = 300) -> Weights:
    """``n`` mentions each have features ``x`` and label ``y``; ``pairs``: (is skip, label, label) counts, labels x labels."""
    labels = len(KINDS) + 1
    w = np.zeros((_FEATURES, labels))
    hot, share = np.eye(labels)[y], (n / n.sum())[:, None]
    for _ in range(steps):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w -= 2.0 * (x.T @ (share * (p - hot)) + 1e-4 * w)
    tables = []
    for counts in pairs:
        smooth = counts + counts.T + 0.5
        joint = smooth / smooth.sum()
        tables.append(np.log(joint / np.outer(joint.sum(1), joint.sum(0))))
    return Weights(w, tables[0], tables[1])


def _sample(docs: DataFrame) -> DataFrame:
    """One row for each of at most ``SAMPLE_DOCS`` distinct texts."""
    some = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64(F.lit(3), "text").alias("h"))
    chosen = materialise(some.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS), "pii_sample")
    # copies share a hash and would all come back
    return some.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"]).select("text")


def _observed(sample: DataFrame) -> DataFrame:
    """``(what, key, n)``: counts of mentions by features and label, and of links by labels."""

    def step(state, texts):
        for t in texts:
            f = field(t, base_spans(t))
            y = f.clamped.tolist()
            # features are 0 or 1
            state.update(("node", f"{''.join('01'[int(v)] for v in x)} {k}") for x, k in zip(f.features, y, strict=True))
            for what, links in (("chain", f.chain), ("skip", f.skip)):
                # what a loose mention is can't be told, so links of two loose ones say nothing
                state.update((what, f"{y[a]} {y[b]}") for a, b in links if y[a] or y[b])

    def finish(state):
        seen = sorted(state)
        return [[w for w, _ in seen], [k for _, k in seen], [state[x] for x in seen]]

    counted = fold_texts(sample, ["text"], Counter, step, finish, "what string, key string, n long")
    return counted.groupBy("what", "key").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Weights | None:
    """Weights from a bounded sample of ``text`` rows."""
    labels = len(KINDS) + 1
    nodes, pairs = [], np.zeros((2, labels, labels))
    # one row for each set of features and label that occurs
    for r in _observed(_sample(docs)).orderBy("what", "key").toLocalIterator():
        a, b = r.key.split(" ")
        if r.what == "node":
            nodes.append(([float(v) for v in a], int(b), r.n))
        else:
            pairs[int(r.what == "skip"), int(a), int(b)] += r.n
    if not nodes:
        return None
    # repeated values are one entity: a link to a known mention speaks for its kind
    pairs[1] += 20 * np.eye(labels)
    pairs[1, 0, 1:] = pairs[1, 1:, 0] = 0
    x, y, n = (np.array(v) for v in zip(*nodes, strict=True))
    return train(x, y, n, pairs)


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``base`` and ``found``: arrays of ``(start, kind, end)``; ``found`` holds the base spans too."""
    docs = df.select(col(id_col), text_of(text_col).alias("__pii_text"))
    weights = fit(docs.select(F.col("__pii_text").alias("text")))

    def find(texts):
        base, found = [], []
        for t in texts:
            a, b = all_spans(t, weights)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in a])
            found.append([{"start": s, "kind": k, "end": e} for s, k, e in b])
        return [base, found]

    span = "array<struct<start:int,kind:string,end:int>>"
    return map_texts(docs, [id_col], ["__pii_text"], find, f"base {span}, found {span}")


def joined(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def digest(spans: list) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
