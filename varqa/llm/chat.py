"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one string and encoded once, with offsets; the spans of its assistant texts, sorted,
are intersected with the token spans by binary search. Control strings are tokens of their own, so no token crosses
the border of a text; inside roles and texts they are escaped with a backslash, which is undone on reading back.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, SAYS, CLOSE = "[INST]", "[/INST]", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_FIND = re.compile("|".join(map(re.escape, CONTROL)))
_UNDO = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(SAYS) + "(.*?)" + re.escape(CLOSE), re.S)


def escape(text: str) -> str:
    """Doubles backslashes and puts one after the first character of every control string."""
    return _FIND.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _UNDO.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The formatted conversation, and start and end of each assistant text in it."""
    out, at, spans = ["<s>"], 3, []
    for role, text in turns:
        head, body = OPEN + escape(role) + SAYS, escape(text)
        out += [head, body, CLOSE]
        at += len(head)
        if role == "assistant":
            spans.append((at, at + len(body)))
        at += len(body) + len(CLOSE)
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each token whether it lies in a span: the last span that starts at or before it, by binary search."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), bool)
    spans = spans[spans[:, 1] > spans[:, 0]]
    if not len(spans):
        return np.zeros(len(offsets), bool)
    k = np.searchsorted(spans[:, 0], offsets[:, 0], side="right") - 1
    return (k >= 0) & (offsets[:, 1] > offsets[:, 0]) & (offsets[:, 1] <= spans[np.maximum(k, 0), 1])


def parse(formatted: str) -> list[tuple[str, str]]:
    """Reads the turns back out of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def masked_text(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> str:
    """The text under the mask, unescaped: touching and shared token spans are joined, each character once."""
    out, end, start = [], -1, -1
    for s, e in offsets[mask].tolist():
        if s > end:
            if end >= 0:
                out.append(unescape(formatted[start:end]))
            start, end = s, e
        else:
            end = max(end, e)
    if end >= 0:
        out.append(unescape(formatted[start:end]))
    return "".join(out)


def format_chats(turns: DataFrame, tokenizer: str) -> DataFrame:
    """conv_id, formatted, input_ids, starts, ends (code points), loss for every conversation of turns.

    Rows of a conversation go by turn, then role and text; a null role or text is empty, a null turn comes first,
    rows with a null conv_id are one conversation; repeated rows are turns of their own; other columns are ignored.
    A conversation is one record by nature: its turns are put together in one row.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**63))).alias("turn"), "role", "text"))).alias("turns"))

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROL])
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                made = [render([(x["role"], x["text"]) for x in c]) for c in part.column(1).to_pylist()]
                enc = t.encode_batch([f for f, _ in made], add_special_tokens=False)
                at = [np.array(e.offsets, np.int32).reshape(-1, 2) for e in enc]
                mask = [loss_mask(o, s) for o, (_, s) in zip(at, made)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f for f, _ in made]), pa.array([e.ids for e in enc], pa.list_(pa.int32())), pa.array([o[:, 0] for o in at], pa.list_(pa.int32())), pa.array([o[:, 1] for o in at], pa.list_(pa.int32())), pa.array([m for m in mask], pa.list_(pa.bool_()))],
                    ["conv_id", "formatted", "input_ids", "starts", "ends", "loss"],
                )

    return whole.mapInArrow(run, "conv_id long, formatted string, input_ids array<int>, starts array<int>, ends array<int>, loss array<boolean>")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, n_loss_tokens from format_chats' output."""

    def run(batches):
        for b in batches:
            out = []
            for conv, text, starts, ends, loss in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *(b.column(i) for i in (2, 3, 4))):
                o = np.stack([starts.values.to_numpy(zero_copy_only=False), ends.values.to_numpy(zero_copy_only=False)], 1).reshape(-1, 2)
                mask = loss.values.to_numpy(zero_copy_only=False).astype(bool)
                turns, under = parse(text), masked_text(text, o, mask)
                said = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                out.append((conv, len(turns), said, len(under), hashlib.sha256(under.encode()).hexdigest(), len(text), len(mask), int(mask.sum())))
            c = list(zip(*out)) if out else [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds)], names)

    return formatted.select("conv_id", "formatted", "starts", "ends", "loss").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long")
