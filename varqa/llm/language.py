"""Language identification by rank-order profiles of character n-grams (out-of-place distance)."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_crc, texts

#: Documents per language (about; chosen by a hash of doc_id) that a profile is learnt from, and ranks it keeps.
DOCS, RANKS, GRAMS = 1500, 400, 3
_BLOCK = 1 << 20


@cache
def _letters() -> np.ndarray:
    """For every code point, itself if it is a letter, else 0."""
    return np.array([c if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint64)


def gram_counts(text: str, most: int = GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of one to `most` characters of the lower-cased words, packed 21 bits a character, with counts.

    Each run of other characters is one boundary mark (0); long texts are counted in blocks and summed.
    """
    x = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    x = np.concatenate([np.zeros(1, np.uint64), x, np.zeros(1, np.uint64)])
    x = x[np.r_[True, (x[1:] > 0) | (x[:-1] > 0)]]
    parts = []
    for lo in range(0, len(x), _BLOCK):
        block, grams = x[lo : lo + _BLOCK + most - 1], []
        g = block
        for n in range(1, most + 1):
            if n > 1:
                g = (g[:-1] << np.uint64(21)) | block[n - 1 :]
            end = min(_BLOCK, len(g))
            own = g[:end]
            grams.append(own[(own > 0) & ((own & np.uint64(0x1FFFFF)) + (own >> np.uint64(21)) > 0)])
        parts.append(np.unique(np.concatenate(grams), return_counts=True))
    if len(parts) == 1:
        return parts[0]
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = RANKS) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by code."""
    if len(keys) > 4 * most:  # only those that can be among them are sorted
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))][:most]


class Profiles:
    def __init__(self, profiles: dict[str, np.ndarray], ranks: int = RANKS):
        self.langs, self.ranks = sorted(profiles), ranks
        self.grams = np.unique(np.concatenate([profiles[k] for k in self.langs])) if profiles else np.zeros(0, np.uint64)
        self.rank = np.full((len(self.grams), len(self.langs)), -1, np.int64)
        for i, k in enumerate(self.langs):
            self.rank[np.searchsorted(self.grams, profiles[k]), i] = np.arange(len(profiles[k]))

    def predict(self, text: str) -> tuple[str, float]:
        if not self.langs:
            return "und", 0.0
        keys, counts = gram_counts(text)
        if not len(keys):
            return "und", 0.0
        top = ranked(keys, counts, self.ranks)
        at = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        known = self.grams[at] == top
        rank = np.where(known[:, None], self.rank[at], -1)
        away = np.where(rank >= 0, np.abs(rank - np.arange(len(top))[:, None]), self.ranks).sum(0)
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.ranks * len(top)))


def learn_profiles(docs: DataFrame, per_language: int = DOCS, ranks: int = RANKS) -> Profiles:
    """Profiles from texts with a lang outside the held-out fold: all of a language's, or about per_language of them."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("lang is not null and text is not null and doc_id is not null").where(F.pmod(doc_crc(), F.lit(4)) != 2)
    count = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not count:
        return Profiles({})
    share = F.create_map(*[x for k, n in sorted(count.items()) for x in (F.lit(k), F.lit(min(1.0, per_language / n)))])
    part = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) < share[F.col("lang")] * 2.0**53)

    def tally(batches):
        for b in batches:
            got: dict[str, list] = {}
            for text, lang in zip(texts(b.column(0)), b.column(1).to_pylist()):
                got.setdefault(lang, []).append(gram_counts(text))
            for lang, each in got.items():
                keys, where = np.unique(np.concatenate([k for k, _ in each]), return_inverse=True)
                n = np.bincount(where, np.concatenate([c for _, c in each])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    sums = part.select("text", "lang").mapInArrow(tally, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found: dict[str, list] = {}
    for r in sums.toLocalIterator():
        found.setdefault(r.lang, []).append((r.gram, r.n))
    return Profiles({k: ranked(np.array([g for g, _ in v], np.int64).view(np.uint64), np.array([n for _, n in v]), ranks) for k, v in found.items()}, ranks)


def predict_language(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs.

    Null texts and texts without a letter are `und` with score 0, as is all where nothing could be learnt; ties go to
    the first language by code point; repeated rows agree; other columns are ignored; a null doc_id isn't held out.
    """

    def run(batches):
        for b in batches:
            got = [profiles.predict(t) for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(F.pmod(doc_crc(), F.lit(4)) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
