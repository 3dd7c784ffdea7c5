"""Words of many texts at once: numpy arrays instead of one Python object per word.

A word is a maximal run of bytes of one class in the UTF-8 text.  Its hash is made of eight bytes at a time, each piece
mixed by a function that isn't linear; equal words have equal hashes in every process.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np

#: The constants of the splitmix64 generator.
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def stride(k: int) -> np.uint64:
    """``k`` steps of the golden ratio sequence."""
    return np.uint64((int(GOLDEN) * k) & 0xFFFFFFFFFFFFFFFF)


def _table(word: bytes, punct: bool) -> np.ndarray:
    table = np.full(256, 2 if punct else 0, dtype=np.uint8)
    table[list(word)] = 1
    table[128:] = 1
    table[list(b" \t\n\r\v\f")] = 0
    return table


_ALNUM = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123))
#: Runs of anything but white space.
SPACED = _table(bytes(range(128)), punct=False)
#: Runs of letters and digits; every other ASCII byte separates.
ALNUM = _table(_ALNUM, punct=False)
#: Runs of letters and digits, and runs of punctuation.
WORD_PUNCT = _table(_ALNUM, punct=True)


def cached(key: tuple, build: Callable):
    """``build()``, kept for the life of the process (task code itself is loaded anew for every task)."""
    held = sys.modules.setdefault("_text_operator_cache", types.ModuleType("_text_operator_cache")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def latest(slot: str, key: str, build: Callable):
    """``build()``, kept in the process until the slot is asked for another key."""
    held = cached((slot,), dict)
    if key not in held:
        held.clear()
        held[key] = build()
    return held[key]


class Words(NamedTuple):
    """Words of ``n`` texts: word ``i`` belongs to text ``doc[i]``; ``first[d]:first[d + 1]`` are the words of text ``d``."""

    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    n: int


def _hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes: its pieces of eight bytes are mixed with their place, added and mixed with the length."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    length = end - start
    pieces = -(-length // 8)
    first = np.concatenate(([0], np.cumsum(pieces)))
    run = np.repeat(np.arange(len(start)), pieces)
    place = np.arange(first[-1]) - first[run]
    at = start[run] + 8 * place
    left = end[run] - at
    padded = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
    value = np.zeros(len(at), dtype=np.uint64)
    for j in range(8):
        value |= np.where(j < left, padded[at + j], np.uint8(0)).astype(np.uint64) << np.uint64(8 * j)
    part = mix(mix(value + GOLDEN) + place.astype(np.uint64) * GOLDEN)
    return mix(np.add.reduceat(part, first[:-1]) + length.astype(np.uint64) * GOLDEN)


def words(texts: Sequence[str], table: np.ndarray) -> Words:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.fromiter((len(b) for b in raw), dtype=np.int64, count=len(raw))
    begin = np.concatenate(([0], np.cumsum(lengths + 1)))
    buf = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    kind = table[buf]
    change = np.flatnonzero(np.diff(kind, prepend=np.uint8(0), append=np.uint8(0)))
    # every maximal run of one class; those of class 0 are dropped
    start, end = change[:-1], change[1:]
    real = kind[start] != 0 if len(start) else np.zeros(0, dtype=bool)
    start, end = start[real], end[real]
    code = _hashes(buf, start, end)
    first = np.searchsorted(start, begin).astype(np.int64)
    doc = np.repeat(np.arange(len(raw), dtype=np.int64), np.diff(first))
    return Words(code, doc, first, len(raw))


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, doc)`` of all runs of ``size`` words; a text with fewer words is one run, an empty one has none."""
    n = len(w.hash)
    if n == 0:
        return w.hash, w.doc
    span = np.diff(w.first)
    length = np.minimum(span[w.doc], size)
    place = np.arange(n) - w.first[w.doc]
    starts = np.flatnonzero(place <= span[w.doc] - length)
    code = np.zeros(len(starts), dtype=np.uint64)
    wide = length[starts]
    for k in range(size):
        has = k < wide
        at = np.minimum(starts + k, n - 1)
        step = mix(code * np.uint64(3) + w.hash[at] + stride(k + 1))
        code = np.where(has, step, code)
    return code, w.doc[starts]
