"""Token ids in ORC: documents in ascending doc_id order, their ids as integer lists.

The files are ORC's own: run-length encoded integers in stripes, row indexes, and a Bloom filter on doc_id, so
reads go stripe by stripe in parallel and look-ups by doc_id skip stripes and row groups by their metadata.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_path, sized_broadcast, utf8_buffer

STRIPE = 16 << 20
ORC = {"compression": "lz4", "orc.rows.between.memory.checks": "500", "orc.row.index.stride": "1000", "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}
#: Bytes of text that are cut and encoded together, and bytes that a worker's known pieces may take.
_BLOCK, _CACHE = 2 << 20, 40 << 20
_ENTRY = 160  # bytes of a known piece besides its text
_SPACE, _LETTER, _DIGIT, _MARK = 1, 2, 3, 4  # other bytes are 0: nothing is cut beside them but before white space


def _classes() -> np.ndarray:
    """Classes of bytes. Apostrophes (contractions), control characters and all that isn't ASCII are left open."""
    t = np.zeros(256, np.uint8)
    for c in map(chr, range(33, 127)):
        t[ord(c)] = _LETTER if c.isalpha() else _DIGIT if c.isdigit() else 0 if c == "'" else _MARK
    t[[9, 10, 11, 12, 13, 32]] = _SPACE
    return t


_CLASS = _classes()
#: First bytes of two-byte characters that are letters all (but for two signs behind 0xC3).
_LATIN = np.zeros(256, bool)
_LATIN[[*range(0xC3, 0xCA), 0xD0, 0xD1]] = True
#: The last two bytes of what may be white space beyond ASCII; no cut follows it, as a run of white space is one match.
_LAST, _BEFORE = np.zeros(256, bool), np.zeros(256, bool)
_LAST[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True
_BEFORE[[0xC2, 0x9A, 0x80, 0x81]] = True


def piece_starts(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the texts may be cut so that pieces encode alone as they do within their text.

    A byte-level tokenizer's own split never joins what stands before a run of white space with the run, nor letters,
    digits and other marks with one another, contractions apart; a single line break before one of those stands alone.
    """
    k, first = _CLASS[flat], np.zeros(len(flat), bool)
    at = np.flatnonzero(_LATIN[flat])
    at = at[(at + 1 < len(flat)) & ((flat[at] != 0xC3) | ~np.isin(flat[np.minimum(at + 1, len(flat) - 1)], (0x97, 0xB7)))]
    k[at], k[at + 1] = _LETTER, _LETTER
    a, b = k[:-1], k[1:]
    run = (b == _SPACE) & (a != _SPACE)
    at = np.flatnonzero(run)
    last = flat[at]
    run[at[((last >= 0x1C) & (last <= 0x1F)) | (_LAST[last] & _BEFORE[flat[at - 1]])]] = False
    first[1:] = run | ((a > _SPACE) & (b > _SPACE) & (a != b))
    first[offsets[:-1][offsets[:-1] < len(flat)]] = True
    at = np.flatnonzero(flat[:-1] == 10)
    at = at[first[at] & (k[at + 1] > _SPACE)]
    first[at + 1] = True
    return np.flatnonzero(first)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places first[i], first[i] + 1, ... of every i, count[i] of them, in a row."""
    ends = np.cumsum(count)
    at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
    at += np.repeat((first - (ends - count)).astype(np.int32), count)
    return at


_BLANK = re.compile(r"[\x00-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class Encoder:
    """Ids of whole texts by the tokenizer's own library.

    The texts are cut into pieces that encode alone as they do in their text; each different piece is encoded by the
    library once and then known by its place in one array of ids, from which all texts' ids are gathered. A text with a
    special token's name, and all texts of a tokenizer that doesn't split byte by byte, are one piece each.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        split = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else {}
        self.cuts = self.tokenizer.normalizer is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        names = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(names.values()) + 1, bool)
        self.opens[[i for t, i in names.items() if t.startswith("\u0120")]] = True  # the byte-level mark of a space
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line = self.library(["\n"])[0][0] if self.cuts else -1
        self.known: dict[str, int] = {}
        self.ids, self.first, self.count, self.hits, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def library(self, texts: list[str]) -> list[np.ndarray]:
        run = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [np.array(e.ids, np.int32) for e in run(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Adds new pieces: many in one call, their ids told apart by the space that each begins with, or by line breaks."""
        spaced, bare, alone = [], [], []
        for x in pieces:
            if not self.cuts or len(x) > 200:
                alone.append(x)
            elif x.isascii():
                n = len(x.split())
                (spaced if x[0] == " " and n == 1 and x[1] > " " and x[-1] > " " else bare if n == 1 and x[0] > " " and x[-1] > " " else alone).append(x)
            else:
                n = len(_BLANK.split(x, 2))
                (spaced if x[0] == " " and n == 2 and x[1:2] != "" else bare if n == 1 else alone).append(x)
        order, data, count = [], [], []
        for group, sep in ((spaced, ""), (bare, "\n")):
            for lo in range(0, len(group), 2000):
                part = group[lo : lo + 2000]
                joined = sep.join(part)
                if any(x in joined for x in self.special):
                    alone += part
                    continue
                (got,) = self.library([joined])
                if sep:
                    at = np.flatnonzero(got == self.line) - np.arange(len(part) - 1) if (got == self.line).sum() == len(part) - 1 else None
                    got, at = (got[got != self.line], np.r_[0, at]) if at is not None else (got, np.zeros(0, np.int64))
                else:
                    at = np.flatnonzero(self.opens[got])
                if len(at) == len(part) and at[0] == 0:
                    order += part
                    data.append(got)
                    count.append(np.diff(np.r_[at, len(got)]))
                else:
                    alone += part
        for lo in range(0, len(alone), 2000):
            got = self.library(alone[lo : lo + 2000])
            data += got
            count.append(np.array([len(x) for x in got], np.int64))
        order += alone
        more = np.concatenate(count)
        begin = len(self.known)
        self.known.update(zip(order, range(begin, begin + len(order))))
        self.first = np.r_[self.first, len(self.ids) + np.cumsum(more) - more]
        self.count, self.hits = np.r_[self.count, more], np.r_[self.hits, np.zeros(len(more), np.int64)]
        self.ids = np.concatenate([self.ids, *data])
        self.size += sum(map(len, order)) + _ENTRY * len(order)

    def _shrink(self) -> None:
        """Keeps the pieces met oftenest, up to half the bound; older meetings count less and less."""
        names, budget = list(self.known), _CACHE // 2
        size = np.array([len(x) for x in names], np.int64) + _ENTRY
        order = np.argsort(-self.hits, kind="stable")
        order = np.sort(order[np.cumsum(size[order]) <= budget])
        ids = self.ids[_spread(self.first[order], self.count[order])]
        self.known = {names[i]: n for n, i in enumerate(order.tolist())}
        self.ids, self.count, self.hits, self.size = ids, self.count[order], self.hits[order] // 2, int(size[order].sum())
        self.first = np.cumsum(self.count) - self.count

    def encode_block(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (UTF-8 and int64 offsets) in a row, and where each text's begin and end."""
        n = len(flat)
        starts = piece_starts(flat, offsets) if self.cuts else np.unique(offsets[:-1][np.diff(offsets) > 0])
        raw = flat.tobytes()
        named = {int(np.searchsorted(offsets, m.start(), side="right")) - 1 for x in self.special for m in re.finditer(re.escape(x.encode()), raw)}
        if named:
            whole = np.array(sorted(named))
            starts = starts[~_inside(starts, offsets[whole], offsets[whole + 1])]
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        cut = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.r_[starts, n].astype(np.int64)), pa.py_buffer(raw))
        coded = cut.dictionary_encode()
        names, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        del cut, coded, raw
        slots = list(map(self.known.get, names))
        if fresh := [x for x, k in zip(names, slots) if k is None]:
            self._learn(fresh)
            slots = list(map(self.known.__getitem__, names))
        slot = np.array(slots, np.int64)
        self.hits[slot] += np.bincount(which, minlength=len(slot))
        slot = slot[which]
        count = self.count[slot]
        ids = self.ids[_spread(self.first[slot], count)]
        at = np.r_[0, np.cumsum(count)][np.searchsorted(starts, offsets)]
        if self.size > _CACHE:
            self._shrink()
        return ids, at

    def encode(self, text: str) -> bytes:
        flat = np.frombuffer(text.encode(), np.uint8)
        return self.encode_block(flat, np.array([0, len(flat)]))[0].astype("<u4").tobytes()


def _inside(at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of the places lie within (not at the begin of) one of the sorted stretches lo to hi."""
    k = np.searchsorted(lo, at, side="left") - 1
    return (k >= 0) & (at < hi[np.maximum(k, 0)])


@lru_cache(2)
def encoder_for(path: str) -> Encoder:
    """A worker's encoder, kept with its cache from task to task."""
    return Encoder(path)


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None, stripe_bytes: int = STRIPE) -> str:
    """Writes docs' ids, end_id after each document, and returns the folder: by default one in the shared folder.

    Columns: doc_id, part (the range of doc_ids, ascending), local_start (ids before it in its part), n_tokens, ids.
    Rows of one doc_id are ordered by a hash of their texts; a null doc_id comes first; null and empty texts have just
    the end_id; very long texts are encoded whole; other columns, whatever their names, are ignored; an empty table
    gives no rows. A tokenizer that doesn't split byte by byte encodes every text as a whole.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")

    def run(batches):
        encoder, part, start = encoder_for(tokenizer), TaskContext.get().partitionId(), 0
        for b in batches:
            flat, offsets = utf8_buffer(b.column(1))
            for lo, hi in _blocks(offsets):
                ids, at = encoder.encode_block(flat[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                n = hi - lo
                every = np.full(len(ids) + n, end_id, np.int32)
                at = at + np.arange(n + 1)
                mine = np.ones(len(every), bool)
                mine[at[1:] - 1] = False
                every[mine] = ids
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(every, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), pa.array(np.full(n, part), pa.int64()), pa.array(start + at[:-1], pa.int64()), pa.array(np.diff(at), pa.int64()), lists],
                    ["doc_id", "part", "local_start", "n_tokens", "ids"],
                )
                start += int(at[-1])

    found = dealt.mapInArrow(run, "doc_id long, part long, local_start long, n_tokens long, ids array<int>")
    found.write.options(**ORC, **{"orc.stripe.size": str(stripe_bytes)}).orc(path)
    return path


def _blocks(offsets: np.ndarray):
    """Row ranges of about _BLOCK bytes of text each."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _BLOCK, side="right")) - 1)
        yield lo, hi
        lo = hi


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, all from the files; nothing for no rows.

    Starts are running sums within a part plus the sums of the parts before it: one row per part is summed in order.
    """
    files = spark.read.schema("doc_id long, part long, local_start long, n_tokens long, ids array<int>").orc(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def run(batches):
        for b in batches:
            lists = b.column(3)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])

    rows = files.select("doc_id", "part", "local_start", "ids").mapInArrow(run, "doc_id long, part long, local_start long, n_tokens long, ids_crc32 long")
    found = rows.join(sized_broadcast(parts), F.col("part") == F.col("_part"))
    return found.select("doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The stored rows of some doc_ids; stripes and row groups without them are skipped by index and Bloom filter."""
    return spark.read.orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """docs written by write_tokens and read back by read_tokens, which say what becomes of nulls, ties and empty tables."""
    return read_tokens(docs.sparkSession, write_tokens(docs, tokenizer, end_id))
