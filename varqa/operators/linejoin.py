"""Similarity join of line keys by the Ratcliff-Obershelp ratio, without comparing all pairs (JOIN03).

A ratio of t over lengths a and b means that at least t (a + b) / 2 characters match in blocks, and that no more blocks
than unmatched characters and one more hold them. So two keys share a number of q-grams (counted with repeats) that
grows with their lengths, and the rarest grams of both, as many as that bound leaves open and a few more, have some in
common. Only pairs that share as many such grams, have lengths that allow t and pass the bound from character counts are compared.

Keys whose length no key of the other side allows go first. Where a side is small (`HELD`), it stands as an index of its
grams in every task, through which the other side streams once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as line_keys
from ..functions.keys import similarity_udf
from .common import cut_lineage, sized_broadcast

#: Grams whose counts order the others (the commonest ones), and the least growth of the bound for which longer grams are used.
COUNTED, GROWTH = 50_000, 0.1
#: Common grams asked of a pair: for each one more than one, a gram more of both keys is looked at.
COMMON = 40
#: Keys and characters of a side up to which it is held in every task; cells of a block of counts.
HELD, HELD_CHARS, CELLS = 4_000, 1_000_000, 1_000_000
#: Rows for each held key up to which a side's different keys are counted; hashes of grams; lengths of a band, as a power of this.
REPEATED, SLOTS, BAND = 10, 1 << 20, 1.1
#: Characters of texts that are keyed at once; pairs whose characters are compared at once, in so many buckets.
CHARS, PAIRS, BUCKETS = 300_000, 10_000, 64
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def growth(q: int, t: float) -> float:
    """Common q-grams for each character of both keys, less a constant of q - 1."""
    return (2 * q - 1) * t / 2 - (q - 1)


def gram_size(t: float) -> int:
    return next(q for q in (4, 3, 2, 1) if q == 1 or growth(q, t) >= GROWTH)


def shared_grams(n: np.ndarray, q: int, t: float) -> np.ndarray:
    """q-grams that a key of length n has at least in common with any key that reaches the ratio t."""
    return np.ceil(growth(q, t) * 2 * n / (2 - t) - (q - 1) - 1e-9).astype(np.int64)


def shortest(q: int, t: float) -> int:
    """Length from which keys share a q-gram for certain."""
    n = 1
    while shared_grams(np.array([n]), q, t)[0] < 1:
        n += 1
    return n


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(keys: list[str], q: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all q-grams of the keys, and the key of each."""
    code = np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.array([len(k) for k in keys], np.int64)
    of = np.repeat(np.arange(len(keys)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(code))  # characters from here to the key's end
    h = np.zeros(len(code), np.uint64)
    for i in range(q):
        h = _mixed(h * np.uint64(31) + np.roll(code, -i) + np.uint64(q))
    return h[left >= q], of[left >= q]


def prefixes(keys: list[str], q: int, t: float, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key's rarest q-grams, so many that any key that reaches t has `least` of them in common (the lesser of both
    keys' numbers): tokens, their keys, and each one's `least`.

    The n-th equal gram of a key is a token of its own. `common` has the hashes (sorted) and counts of common grams.
    """
    h, of = grams(keys, q)
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (of[1:] != of[:-1]))) if len(h) else np.zeros(0, bool)
    turn = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
    token = _mixed(h + _mixed(turn.astype(np.uint64)))
    count = np.zeros(len(h), np.int64)
    if len(common[0]) and len(h):
        at = np.minimum(np.searchsorted(common[0], h), len(common[0]) - 1)
        count = np.where(common[0][at] == h, common[1][at], 0) // (turn + 1)
    order = np.lexsort((token, count, of))
    token, of = token[order], of[order]
    size = np.array([len(k) for k in keys], np.int64)
    held = np.maximum(size - q + 1, 0)
    place = np.arange(len(of)) - (np.cumsum(held) - held)[of]
    shared = np.maximum(shared_grams(size, q, t), 1)
    least = np.minimum(shared, COMMON)
    keep = place < (held - shared + least)[of]
    return token[keep], of[keep], least[of[keep]]


def _tokens(df: DataFrame, key: str, t: float, common: tuple[np.ndarray, np.ndarray], names: tuple[str, str, str]) -> DataFrame:
    """script, id (a hash of the key), length, number of common grams and token of the distinct keys' prefixes."""
    q = gram_size(t)
    least = shortest(q, t) if q > 1 else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(2).to_pylist()
            size = np.array([len(k) for k in keys], np.int64)
            parts = [prefixes(keys, q, t, common)] if keys else []
            if q > 1 and keys:  # short keys, and those that can be like one, meet by characters
                few = np.flatnonzero(size * t / (2 - t) < least)
                token, of, asked = prefixes([keys[i] for i in few], 1, t, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                parts = [tuple(x[size[parts[0][1]] >= least] for x in parts[0]), (token, few[of], asked)]
            for token, of, asked in parts:
                if len(of):
                    yield pa.record_batch([b.column(0).take(pa.array(of)), b.column(1).take(pa.array(of)), pa.array(size[of]), pa.array(asked), pa.array(token.view(np.int64))], ["script", *names, "token"])

    return df.select("script", F.xxhash64(key), key).mapInArrow(run, f"script string, {names[0]} long, {names[1]} long, {names[2]} long, token long")


def _common_grams(df: DataFrame, key: str, q: int) -> tuple[np.ndarray, np.ndarray]:
    """The commonest grams of a side and their counts, sorted by hash: at most COUNTED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, n = np.unique(grams(b.column(0).to_pylist(), q)[0], return_counts=True)
            yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    found = df.select(key).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(COUNTED).toArrow()
    h, n = found["h"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def letter_counts(key: Column) -> Column:
    each = [F.length(key) - F.length(F.replace(key, F.lit(c), F.lit(""))) for c in _LETTERS]
    return F.array(*each, F.length(key) - reduce(lambda x, y: x + y, each))


def counts_bound(a: Column, b: Column, total: Column) -> Column:
    """Upper bound of the ratio from two keys' character counts and the sum of their lengths; compiled, no lambda."""
    both = reduce(lambda x, y: x + y, [F.least(F.get(a, F.lit(i)), F.get(b, F.lit(i))) for i in range(len(_LETTERS) + 1)])
    return 2.0 * both / total


def _any_common_character(left: DataFrame, right: DataFrame) -> DataFrame:
    """script, lk, rk: all pairs with a character in common, met on the first of those; that is what a ratio over 0 means."""
    distinct = lambda k: F.array_sort(F.array_distinct(F.split(k, "")))
    a = left.withColumn("lc", distinct("lk")).withColumn("c", F.explode("lc"))
    b = right.withColumn("rc", distinct("rk")).withColumn("c", F.explode("rc"))
    return a.join(sized_broadcast(b, 200_000), ["script", "c"]).where(F.col("c") == F.get(F.array_intersect("lc", "rc"), F.lit(0))).select("script", "lk", "rk")


def allowed_lengths(keys: DataFrame, key: str, least: float) -> Callable[[str, str], Column]:
    """A condition on (script, key): some key (script, key) could reach `least` with it, by the lengths of the shortest and the longest."""
    spans = keys.groupBy("script").agg(F.min(F.length(key)).alias("lo"), F.max(F.length(key)).alias("hi")).collect()

    def allowed(script: str, other: str) -> Column:
        n, here = F.length(other), F.lit(False)
        for r in spans:
            lo, hi = (r.lo * least / (2 - least), r.hi * (2 - least) / least) if least > 0 else (1, 2**31 - 1)
            here = here | ((F.col(script) == r.script) & n.between(int(np.ceil(lo - 1e-9)), int(min(hi + 1e-9, 2**31 - 1))))
        return here

    return allowed


def _codes(keys: list[str]) -> np.ndarray:
    return np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), "<u4")


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def _buckets(code: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each key, how many of its characters are in each of BUCKETS buckets."""
    of = np.repeat(np.arange(len(size)), size)
    return np.bincount(of * BUCKETS + code % BUCKETS, minlength=len(size) * BUCKETS).reshape(len(size), BUCKETS)


class _Held:
    """The q-grams of a script's held keys: which keys have each.

    Grams are told apart by SLOTS slots of a hash only: a slot that two share makes a pair look more alike, never less. Keys
    of about one length meet only the held ones whose lengths allow t, through an index of these.
    """

    def __init__(self, keys: list[str], q: int, t: float):
        self.keys, self.q, self.t = sorted(keys, key=lambda k: (len(k), k)), q, t
        self.size = np.array([len(k) for k in self.keys], np.int64)
        self.shared = shared_grams(self.size, q, t)
        self.letters = _buckets(_codes(self.keys), self.size)
        slot, of = self._slots(_codes(self.keys), self.size)
        pair = np.unique(slot.astype(np.int64) * len(keys) + of)
        held, slot_of = np.unique(pair // max(len(keys), 1), return_inverse=True)
        self.n, self.slot = len(held), np.full(SLOTS, len(held), np.int32)  # the n-th is of no held key
        self.slot[held] = np.arange(len(held))
        self.pair_slot, self.pair_key, self.bands = slot_of, pair % max(len(keys), 1), {}

    def _slots(self, code: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each q-gram and the key it is of."""
        gram, c = np.zeros(len(code), np.uint64), code.astype(np.uint64)
        for i in range(self.q):
            gram[: max(len(c) - i, 0)] = gram[: max(len(c) - i, 0)] * np.uint64(1 << 16 | 1) + c[i:]
        of = np.repeat(np.arange(len(size)), size)
        whole = np.repeat(np.cumsum(size) - self.q, size) >= np.arange(len(code))
        return (gram[whole] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int32), of[whole]

    def _band(self, n: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        """For keys of n's band of lengths: the held keys between two places, where each slot's begin, how many, and all of them."""
        if n not in self.bands:
            lo, hi = BAND**n * self.t / (2 - self.t) * (1 - 1e-9), BAND ** (n + 1) * (2 - self.t) / self.t * (1 + 1e-9)
            first, last = int(np.searchsorted(self.size, lo)), int(np.searchsorted(self.size, hi, "right"))
            here = (self.pair_key >= first) & (self.pair_key < last)
            count = np.bincount(self.pair_slot[here], minlength=self.n + 1)
            self.bands[n] = first, last, _starts(count), count, self.pair_key[here] - first
        return self.bands[n]

    def alike(self, code: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (of keys, of held ones) of the pairs whose lengths, grams and characters allow t; the keys as code points, one after the other.

        A key's grams that the held key has too, repeats counted, are at least as many as both have in common.
        """
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        start, size = _starts(size)[order], size[order]
        band, ends = np.floor(np.log(size) / np.log(BAND)).astype(np.int64), np.cumsum(size)
        lo = 0
        while lo < len(size):
            first, last, at, count, held = self._band(int(band[lo]))
            # Keys of a band whose counts take CELLS at most, whatever their grams are; one key at least.
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CELLS // max(last - first, 1), "right"))
            hi = min(max(hi, lo + 1), int(np.searchsorted(band, band[lo], "right")))
            if last > first:
                n = size[lo:hi]
                mine = code[np.repeat(start[lo:hi] - _starts(n), n) + np.arange(n.sum())]
                slot, of = self._slots(mine, n)
                slot = self.slot[slot]
                times, width = count[slot], last - first
                cell = np.repeat(of * width, times) + held[np.repeat(at[slot] - _starts(times), times) + np.arange(times.sum())]
                c = np.bincount(cell, minlength=len(n) * width).reshape(len(n), width)
                a, b = n[:, None], self.size[None, first:last]
                ok = (c >= np.maximum(shared_grams(n, self.q, self.t)[:, None], self.shared[None, first:last])) & (2.0 * np.minimum(a, b) >= self.t * (a + b) - 1e-9)
                i, j = np.nonzero(ok)
                for p in range(0, len(i), PAIRS):
                    yield self._by_characters(mine, n, order[lo:hi], i[p : p + PAIRS], first + j[p : p + PAIRS])
            lo = hi

    def _by_characters(self, code: np.ndarray, size: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that have as many characters in common as t asks; those that share a bucket count as one, never as fewer."""
        some, at = np.unique(i, return_inverse=True)
        n = size[some]
        here = code[np.repeat(_starts(size)[some] - _starts(n), n) + np.arange(n.sum())]
        both = np.minimum(_buckets(here, n)[at], self.letters[j]).sum(axis=1)
        ok = 2.0 * both >= self.t * (size[i] + self.size[j]) - 1e-9
        return place[i[ok]], j[ok]


def _held_keys(df: DataFrame, key: str) -> dict[str, list[str]] | None:
    """script -> its different keys, if the side has few, else None; sides of very many rows aren't looked through for them."""
    df = df.select("script", key).where(f"{key} <> ''")
    if len(df.select(F.lit(1)).take(REPEATED * HELD + 1)) > REPEATED * HELD:
        return None
    df = df.distinct()
    if len(df.select(F.lit(1)).take(HELD + 1)) > HELD:
        return None
    found: dict[str, list[str]] = {}
    for r in df.orderBy("script", key).toLocalIterator():
        found.setdefault(r[0], []).append(r[1])
    return found if sum(len(k) for v in found.values() for k in v) <= HELD_CHARS else None


def held_keys(df: DataFrame, key: str, least: float) -> dict[str, list[str]] | None:
    """What `keys_like` takes of a side (script, key): its different keys, or None where it has too many or `least` is too low for grams."""
    return _held_keys(df, key) if least > 0 and gram_size(least) > 1 else None


def _met_held(df: DataFrame, key: str, held: dict[str, list[str]], other: str, t: float) -> DataFrame:
    """script, lk, rk: pairs of df's keys with the held ones that lengths and grams allow, each once."""
    q = gram_size(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {s: _Held(keys, q, t) for s, keys in held.items()}
        for b in batches:
            scripts = np.array(b.column(0).to_pylist(), object)
            for s, x in index.items():
                mine = b.column(1).take(pa.array(np.flatnonzero(scripts == s), pa.int64())).to_pylist()
                for i, j in x.alike(_codes(mine), np.array([len(k) for k in mine], np.int64)):
                    if len(i):
                        yield pa.record_batch([pa.array([s] * len(i), pa.string()), pa.array([mine[k] for k in i], pa.string()), pa.array([x.keys[k] for k in j], pa.string())], ["script", key, other])

    return df.mapInArrow(run, f"script string, {key} string, {other} string").distinct().select("script", "lk", "rk")


def keys_like(df: DataFrame, key: str, parts: list[tuple[str, str, str, str, bool]], held: dict[str, list[str]], least: float) -> DataFrame:
    """key, part, script, k: the keys of df's texts whose lengths and grams let them reach `least` with a held key of their script.

    parts: part, script, column, key function by its name in `LETTERS`, and whether each line has a key of its own or the text has one.
    The others can't be in any pair of `similar_keys` with the held ones; they are never strings, nor written.
    """
    q = gram_size(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {s: _Held(keys, q, least) for s, keys in held.items()}
        for b in batches:
            for i, (part, script, _, name, lines) in enumerate(parts):
                if script not in index:
                    continue
                chars = np.cumsum(pc.utf8_length(b.column(i + 1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                lo = 0
                while lo < b.num_rows:
                    hi = max(lo + 1, int(np.searchsorted(chars, (chars[lo - 1] if lo else 0) + CHARS, "right")))
                    code, size, of = line_keys.LETTERS[name].keys(b.column(i + 1).slice(lo, hi - lo).to_pylist(), lines)
                    found = np.unique(np.concatenate([np.zeros(0, np.int64), *(at for at, _ in index[script].alike(code, size))]))
                    if len(found):
                        ends = np.cumsum(size)
                        k = [code[ends[j] - size[j] : ends[j]].tobytes().decode("utf-32-le", "surrogatepass") for j in found]
                        yield pa.record_batch([b.column(0).take(pa.array(of[found] + lo)), pa.array([part] * len(k), pa.string()), pa.array([script] * len(k), pa.string()), pa.array(k, pa.string())], [key, "part", "script", "k"])
                    lo = hi

    texts = df.select(key, *[F.col(column).alias(f"t{i}") for i, (_, _, column, _, _) in enumerate(parts)])
    return texts.mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, part string, script string, k string")


def similar_keys(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """script, lk, rk, score: all pairs of non-empty keys of one script with a ratio of at least `least` (over 0 if that is 0).

    left (script, lk), right (script, rk); equal rows count once. The ratio is that of difflib with its defaults.
    """
    left, right = left.where("lk <> ''"), right.where("rk <> ''")
    if least > 0 and gram_size(least) > 1:
        for small, key, large, own in ((right, "rk", left, "lk"), (left, "lk", right, "rk")):
            held = _held_keys(small, key)
            if held is not None:
                large = large.where(allowed_lengths(small, key, least)("script", own)) if held else large.where("false")
                # Written, as Spark would push the comparison below `distinct` and make it for each repeated pair.
                return _scored(cut_lineage(_met_held(large.select("script", own), own, held, key, least)), least)
        left = left.where(allowed_lengths(right, "rk", least)("script", "lk"))
        right = right.where(allowed_lengths(left, "lk", least)("script", "rk"))
    left, right = (cut_lineage(x.distinct()) for x in (left, right))
    if least <= 0:
        met = _any_common_character(left, right)
    else:
        common = _common_grams(right, "rk", gram_size(least))
        a, b = _tokens(left, "lk", least, common, ("l", "n", "x")), _tokens(right, "rk", least, common, ("r", "m", "y"))
        fits = F.lit(2.0) * F.least("n", "m") >= least * (F.col("n") + F.col("m")) - 1e-9
        met = a.join(sized_broadcast(b, 400_000), ["script", "token"]).where(fits)
        counted = met.groupBy("script", "l", "r").agg(F.count("*").alias("c"), F.min(F.least("x", "y")).alias("asked"))
        pairs = counted.where("c >= asked").select("script", "l", "r")
        met = pairs.join(sized_broadcast(right.withColumn("r", F.xxhash64("rk")), 50_000), ["script", "r"]).join(left.withColumn("l", F.xxhash64("lk")), ["script", "l"])
        met = _letters_allow(met, least)
    return _scored(met, least)


def _letters_allow(met: DataFrame, least: float) -> DataFrame:
    met = met.withColumn("lc", letter_counts(F.col("lk"))).withColumn("rc", letter_counts(F.col("rk")))
    return met.where(counts_bound(F.col("lc"), F.col("rc"), F.length("lk") + F.length("rk")) >= least - 1e-9)


def _scored(met: DataFrame, least: float) -> DataFrame:
    score = F.when(F.col("lk") == F.col("rk"), F.lit(1.0)).otherwise(similarity_udf("lk", "rk"))
    scored = met.select("script", "lk", "rk", score.alias("score"))
    return scored.where(F.col("score") >= least) if least > 0 else scored.where("score > 0")
