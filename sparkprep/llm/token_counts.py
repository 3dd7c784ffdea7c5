"""Token counts by field or section, from one encoding of the whole document.

The fields of a row are joined by line feeds and encoded once.  The tokenizer is a byte-level one whose tokens spell
the text, so the running sum of the token lengths gives the span of every token; byte positions are turned into
characters by counting first bytes of characters.  The spans are then joined with the sorted section spans by binary
search.

Rule for a token that crosses a boundary: it goes to the section that holds its first character.  The line feed after a
section belongs to that section.  So the counts of the sections sum to the count of the document.  A token inside a
character (bytes of one character in several tokens) belongs to the section of that character.

Sections are the lines of each field.  Null fields are empty; an empty field is one empty section.  Rows that repeat an
id are documents of their own.  Special tokens are never produced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from sparkprep.functions.scalar import col
from sparkprep.llm.frames import map_texts, text_of
from sparkprep.llm.text import cached

#: A folder of public vocabularies; the file is a list of byte strings and their ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level vocabularies of this kind cut a text into pieces before merging.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    length[list(ranks.values())] = [len(k) for k in ranks]
    return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}), length


def token_starts(text: str, path: str = VOCABULARY) -> tuple[list[int], np.ndarray]:
    """Token ids of a text, and the character in which each token starts."""
    enc, length = cached(("tiktoken", path), lambda: _encoding(path))
    ids = enc.encode_ordinary(text)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    start = np.concatenate(([0], np.cumsum(length[ids])))
    if int(start[-1]) != len(raw):
        raise ValueError("the tokens don't spell the text")
    # characters that have begun up to and including a byte
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return ids, character[start[:-1]] if len(ids) else np.zeros(0, dtype=np.int64)


def sections(fields: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The joined text, and ``(field, start, end)`` of every line; the end leaves out the line feed."""
    text = "\n".join(fields)
    lines = [f.split("\n") for f in fields]
    field = np.repeat(np.arange(len(fields)), [len(x) for x in lines])
    lengths = np.array([len(x) for f in lines for x in f], dtype=np.int64)
    start = np.concatenate(([0], np.cumsum(lengths[:-1] + 1)))
    return text, field, start, start + lengths


def attribute(starts: np.ndarray, section_starts: np.ndarray) -> np.ndarray:
    """Tokens of each section: those whose first character lies in it."""
    edges = np.searchsorted(starts, section_starts, side="left")
    return np.diff(np.append(edges, len(starts)))


_FIELDS = "n_tokens long, section_field array<int>, section_start array<long>, section_end array<long>, section_tokens array<long>"


def token_counts(df: DataFrame, id_col: str = "doc_id", field_cols: tuple[str, ...] = ("text",), vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each document: its id, its tokens, and its sections with their tokens, as arrays in order."""
    names = [f"__f{k}" for k in range(len(field_cols))]
    rows = df.select(col(id_col), *[text_of(c).alias(n) for c, n in zip(field_cols, names, strict=True)])

    def count(*fields):
        out = []
        for values in zip(*fields, strict=True):
            text, field, start, end = sections(list(values))
            ids, chars = token_starts(text, vocabulary)
            out.append((len(ids), field.astype(np.int32), start, end, attribute(chars, start)))
        return list(zip(*out, strict=True))

    return map_texts(rows, [id_col], names, count, _FIELDS)
