"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one string and encoded once, with offsets. The template's marks are special tokens, so no
token straddles a mark. The loss covers the assistants' texts: turn spans and token offsets are both sorted, so a binary
search per border finds the tokens under each span.

Template, per turn: <|im_start|>role<|im_sep|>text<|im_end|>. Roles and texts are escaped: between "<" and "|" one
backslash is added (also where some are already), so no mark can occur in them, and taking one away restores them.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLE = "assistant"

_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.DOTALL)


def escape(s: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", s)


def unescape(s: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", s)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string, and the spans of the texts under the loss, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for the tokens (rows of start, end; sorted) that share a character with a span (sorted, disjoint)."""
    out = np.zeros(len(offsets), dtype=bool)
    if len(offsets):
        starts, ends = offsets[:, 0], offsets[:, 1]
        for a, b in spans:
            # the tokens that end after a and start before b; both columns rise
            out[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = a < b
    return out


def under_mask(formatted: str, offsets: np.ndarray, masked: np.ndarray) -> list[str]:
    """The texts under the mask: neighbouring masked tokens together, unescaped."""
    out = []
    at = np.flatnonzero(masked)
    if len(at):
        for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
            out.append(unescape(formatted[offsets[run[0], 0] : offsets[run[-1], 1]]))
    return out


@functools.lru_cache(maxsize=2)
def _tokenizer(source: bytes):
    from tokenizers import AddedToken, Tokenizer

    t = Tokenizer.from_str(source.decode())
    t.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in (START, SEP, END)])
    return t


def format_one(source: bytes, turns: list[tuple[str, str]]) -> dict:
    """formatted, ids, mask (per token) of one conversation."""
    formatted, spans = render(turns)
    found = _tokenizer(source).encode(formatted, add_special_tokens=False)
    offsets = np.asarray(found.offsets, dtype=np.int64).reshape(-1, 2)
    return {"formatted": formatted, "ids": found.ids, "offsets": offsets, "mask": mask(offsets, spans)}


FIELDS = "formatted string, ids array<int>, mask array<boolean>"
DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long"


def gathered(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the rows of each conversation by turn; equal turns by role and text, so the order is fixed.

    A conversation is one output, so its rows meet in one row; null turns come first; a null role or text is empty; rows
    with a null conv_id are one conversation.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))


def _source(df: DataFrame, path: str):
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def format_conversations(conversations: DataFrame, path: str) -> DataFrame:
    """conv_id, formatted, ids, mask for each conversation of conversations(conv_id, turn, role, text)."""
    source = _source(conversations, path)

    @F.pandas_udf(FIELDS)
    def formatted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for convs in batches:
            done = [format_one(source.value, [(t["role"], t["text"]) for t in turns]) for turns in convs]
            yield pd.DataFrame([(x["formatted"], x["ids"], x["mask"].tolist()) for x in done], columns=["formatted", "ids", "mask"])

    return gathered(conversations).select("conv_id", formatted("turns").alias("f")).select("conv_id", "f.*")


def digests(conversations: DataFrame, path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the formatted string, its tokens and the mask.

    Extra columns are ignored, whatever their names; an empty table gives no rows; repeated rows are turns of their own.
    """
    source = _source(conversations, path)

    @F.pandas_udf(DIGESTS)
    def digested(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in DIGESTS.split(", ")]
        for convs in batches:
            rows = []
            for turns in convs:
                x = format_one(source.value, [(t["role"], t["text"]) for t in turns])
                back = read_back(x["formatted"])
                whole = "".join(f"{role}\n{text}\n" for role, text in back)
                loss = "".join(under_mask(x["formatted"], x["offsets"], x["mask"]))
                sha = [hashlib.sha256(s.encode()).hexdigest() for s in (whole, loss)]
                rows.append((len(back), sha[0], len(loss), sha[1], len(x["formatted"]), len(x["ids"]), int(x["mask"].sum())))
            yield pd.DataFrame(rows, columns=names)

    return gathered(conversations).select("conv_id", digested("turns").alias("f")).select("conv_id", "f.*")
