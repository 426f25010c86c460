"""Fill-in-middle: documents cut at two code points and put in prefix-suffix-middle or suffix-prefix-middle order.

A cut is a number of code points, but texts are bytes. Instead of an offset for each code point, a buffer of texts is
kept as its maximal runs of one class of characters (those of 1, 2, 3 or 4 bytes), with the units and bytes before each
run. The run of a cut is found by binary search, and its byte by arithmetic: start + (cut - units before) * width.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8_buffer

# The marks of the three pieces, and the shares in percent of texts transformed and of those in spm order.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
TRANSFORMED, SPM = 90, 20
#: Bytes of text whose runs are held at once, and bytes looked at in one numpy step.
SLICE, CHUNK = 8 << 20, 1 << 20
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
# Bytes of a code point by its first byte; 0 for the others.
_WIDTH = np.repeat(np.array([1, 0, 2, 3, 4], np.uint8), [0x80, 0x40, 0x20, 0x10, 0x10])


class Runs:
    """Maximal runs of equally wide code points of UTF-8 bytes: `units` and `bytes` before each, and its `width`."""

    def __init__(self, flat: np.ndarray):
        units, at, width, done = [], [], [], 0
        for lo in range(0, len(flat), CHUNK):
            here = _WIDTH[flat[lo : lo + CHUNK]]
            lead = np.flatnonzero(here)
            w = here[lead]
            if not len(w):
                continue
            start = np.concatenate(([0], np.flatnonzero(w[1:] != w[:-1]) + 1))
            units.append(start + done)
            at.append(lead[start] + lo)
            width.append(w[start].astype(np.int64))
            done += len(lead)
        cat = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(1, np.int64)
        self.units, self.bytes, self.width = cat(units), cat(at), cat(width) if width else np.ones(1, np.int64)
        first = np.concatenate(([True], self.width[1:] != self.width[:-1]))  # a run goes on across chunks
        self.units, self.bytes, self.width = self.units[first], self.bytes[first], self.width[first]

    def byte_of(self, unit: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.units, unit, "right") - 1
        return self.bytes[run] + (unit - self.units[run]) * self.width[run]

    def unit_of(self, byte: np.ndarray) -> np.ndarray:
        """Code points before a byte at which one starts (or the end)."""
        run = np.searchsorted(self.bytes, byte, "right") - 1
        return self.units[run] + (byte - self.bytes[run]) // self.width[run]


def draws(doc_ids: list, seed: int) -> np.ndarray:
    """Four unsigned numbers for each id from the SHA-256 of `seed:id`; a null id counts as no digits."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in doc_ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def _transform(batch: pa.RecordBatch, seed: int) -> pa.RecordBatch:
    flat, at = utf8_buffer(batch.column(1))
    runs, h = Runs(flat), draws(batch.column(0).to_pylist(), seed)
    base = runs.unit_of(at)
    n = np.diff(base)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    cut = np.minimum(one, two), np.maximum(one, two)
    lo, hi = (runs.byte_of(base[:-1] + c) for c in cut)
    data, forms, outputs = flat.tobytes(), [], []
    plain = (n == 0) | (h[:, 2] % 100 >= TRANSFORMED)
    spm = h[:, 3] % 100 < SPM
    for i, (s, a, b, e) in enumerate(zip(at[:-1].tolist(), lo.tolist(), hi.tolist(), at[1:].tolist())):
        if plain[i] or any(data.find(mark, s, e) >= 0 for mark in (PREFIX, SUFFIX, MIDDLE)):
            forms.append("plain")
            outputs.append(data[s:e])
        elif spm[i]:
            forms.append("spm")
            outputs.append(b"".join((SUFFIX, data[b:e], PREFIX, data[s:a], MIDDLE, data[a:b])))
        else:
            forms.append("psm")
            outputs.append(b"".join((PREFIX, data[s:a], SUFFIX, data[b:e], MIDDLE, data[a:b])))
    null = np.array([f == "plain" for f in forms], bool)
    chars = [pa.array(x, pa.int64(), mask=null) for x in (cut[0], cut[1] - cut[0])]
    return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()), *chars, pa.array(outputs, pa.binary()).cast(pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: each text as it is trained on.

    n is the text's number of code points. The cuts come from the SHA-256 of `seed:doc_id`, so reruns agree and equal ids
    have equal draws. Nulls are empty texts; empty texts, texts that hold a mark and every tenth draw stay as they are
    (form plain, no piece lengths). A null doc_id draws like an empty one; repeated rows give repeated rows; other columns
    are left behind whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.cumsum(np.diff(utf8_buffer(b.column(1))[1]))
            lo = 0
            while lo < b.num_rows:
                before = size[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(size, before + SLICE, "right")))
                yield _transform(b.slice(lo, hi - lo), seed)
                lo = hi

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, OUT)


def restore(output, form):
    """Column: the text, from what fill_in_middle made of it; marks stand nowhere but between the pieces."""
    part = F.split(output, "<[PSM]>", -1)
    piece = lambda i: F.get(part, F.lit(i))
    return F.when(form == "psm", F.concat(piece(1), piece(3), piece(2))).when(form == "spm", F.concat(piece(2), piece(3), piece(1))).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """The output of fill_in_middle with the hashes of its output and of the text restored from that."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    output, form = F.col("output"), F.col("form")
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(output).alias("output_sha256"), sha(restore(output, form)).alias("restored_sha256"))
