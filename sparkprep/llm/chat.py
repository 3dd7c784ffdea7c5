r"""Chat formatting with loss masks that are aligned by offsets.

A conversation is rendered whole, encoded once by a byte-level tokenizer that reports character offsets, and the spans
of the turns are intersected with the spans of the tokens by binary search.  A token belongs to the loss if it shares a
character with an assistant text.

Template: every turn is ``<|role|>``, a line feed, the text, ``<|end|>``, a line feed; a conversation starts with
``<|conv|>``.  Control strings inside a text (these, and those of common templates) get a backslash before their first
character, and so does every backslash; reading back removes one backslash before each character.  So a text can never
close a turn, and the texts come back exactly.

Rows are ordered by turn; ties by role, then text.  Null texts and null roles are empty.  Rows without a conversation id
form one conversation with a null id.  A conversation is read as a stream of rows sorted by Spark, never gathered by a
shuffle group of its own.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparkprep.functions.scalar import col
from sparkprep.llm.text import cached

#: Strings that open or close something in common chat templates.
CONTROL = ("<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>")

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

_MARK = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
OPEN, END = "<|conv|>", "<|end|>\n"


def escape(text: str) -> str:
    return _MARK.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The conversation as text, and for each turn ``(start, end)`` of its escaped text."""
    parts, spans, at = [OPEN], [], len(OPEN)
    for role, text in turns:
        head, body = f"<|{escape(role)}|>\n", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, dtype=np.int64).reshape(-1, 2)


#: A control string only counts where an even number of backslashes stands before it.
_TURN = re.compile(r"<\|((?:[^\\|]++|\\.|\|(?!>))*+)\|>\n((?:[^\\<]++|\\.|<(?!\|end\|>))*+)<\|end\|>\n", re.DOTALL)


def _turns(formatted: str) -> list[re.Match]:
    """The turns, read from the formatted text alone."""
    if not formatted.startswith(OPEN):
        raise ValueError("no conversation")
    out, at = [], len(OPEN)
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        out.append(m)
        at = m.end()
    return out


def parse(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of the turns, read from the formatted text alone."""
    return [(unescape(m[1]), unescape(m[2])) for m in _turns(formatted)]


def masked_text(formatted: str, mask, starts, ends) -> str:
    """What the tokens under the mask say: their characters, cut at the borders of the texts of the turns."""
    on = np.zeros(len(formatted) + 1, dtype=np.int64)
    chosen = np.asarray(mask, dtype=bool)
    np.add.at(on, np.asarray(starts, dtype=np.int64)[chosen], 1)
    np.add.at(on, np.asarray(ends, dtype=np.int64)[chosen], -1)
    on = np.cumsum(on) > 0
    out = []
    for m in _turns(formatted):
        s, e = m.span(2)
        part = on[s:e]
        if part.all():
            out.append(unescape(formatted[s:e]))
        elif part.any():
            out.append(unescape("".join(formatted[k] for k in range(s, e) if on[k])))
    return "".join(out)


def loss_tokens(token_spans: np.ndarray, loss_spans: np.ndarray) -> np.ndarray:
    """Which tokens share a character with a loss span; both lists are sorted and free of overlaps."""
    mask = np.zeros(len(token_spans) + 1, dtype=np.int64)
    if len(loss_spans) and len(token_spans):
        full = loss_spans[loss_spans[:, 1] > loss_spans[:, 0]]
        # the first token that ends after the span starts, and the first that starts at its end or later
        first = np.searchsorted(token_spans[:, 1], full[:, 0], side="right")
        last = np.searchsorted(token_spans[:, 0], full[:, 1], side="left")
        np.add.at(mask, first, 1)
        np.add.at(mask, last, -1)
    return np.cumsum(mask[:-1]) > 0


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


def format_one(turns: list[tuple[str, str]], tokenizer: str = TOKENIZER, loss_role: str = "assistant") -> dict:
    """Rendered text, token ids with their offsets, loss mask by token and the exact loss spans of one conversation."""
    text, spans = render(turns)
    loss = spans[[r == loss_role for r, _ in turns]] if turns else spans
    enc = cached(("tokenizer", tokenizer), lambda: _tokenizer(tokenizer)).encode(text, add_special_tokens=False)
    offsets = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)
    return {
        "formatted": text,
        "tokens": enc.ids,
        "token_start": offsets[:, 0].tolist(),
        "token_end": offsets[:, 1].tolist(),
        "loss_mask": loss_tokens(offsets, loss).tolist(),
        "loss_start": loss[:, 0].tolist(),
        "loss_end": loss[:, 1].tolist(),
    }


_FIELDS = (
    "conv_id long, formatted string, tokens array<int>, token_start array<long>, token_end array<long>, loss_mask array<boolean>, "
    "loss_start array<long>, loss_end array<long>"
)


def format_conversations(
    df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """One row for each conversation: formatted text, tokens, loss mask by token, character spans of the loss."""
    rows = df.select(
        col(id_col).cast("long").alias("conv_id"),
        col(turn_col).cast("long").alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    schema = T.StructType.fromDDL(_FIELDS)

    def run(batches):
        now, turns = None, None
        for batch in batches:
            out = []
            for i, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if turns is not None and i != now:
                    out.append({"conv_id": now} | format_one(turns, tokenizer))
                    turns = None
                if turns is None:
                    now, turns = i, []
                turns.append((role, text))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=to_arrow_schema(schema))
        if turns is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": now} | format_one(turns, tokenizer)], schema=to_arrow_schema(schema))

    return dealt.mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests that are read from the formatted text and from the tokens under the mask, not from the input."""
    fields = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    schema = to_arrow_schema(T.StructType.fromDDL(fields))

    def run(batches):
        for batch in batches:
            out = []
            # one conversation at a time: a long one is unpacked alone
            for k in range(batch.num_rows):
                conv, text, mask, starts, ends = (batch.column(c)[k].as_py() if c < 2 else batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in range(5))
                turns, loss = parse(text), masked_text(text, mask, starts, ends)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append((conv, len(turns), _sha(said), len(loss), _sha(loss), len(text)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return formatted.select("conv_id", "formatted", "loss_mask", "token_start", "token_end").mapInArrow(run, fields)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
