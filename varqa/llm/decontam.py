"""Benchmark decontamination by q-gram lemma filtering.

Every benchmark item is cut into overlapping pieces. A text region within k edits of a piece of m bytes shares at
least m + 1 - q - k*q of its q-grams, all of them on k + 1 neighbouring diagonals (text position minus piece
position). Shared q-grams are counted in overlapping diagonal bands; regions that reach the bound are verified by
banded alignment.

A verbatim passage may hold no nearly whole piece. So the runs of WORDS words from every word of an item are looked up
too, and items too short for pieces as a whole: all runs of as many words of the texts are hashed by prefix sums, and
runs of an equal hash are compared byte by byte.

An edited passage of few words holds neither. So windows of WORDS words of the items are looked for with few edits: of
pieces of SEED_WORDS words, one at every SEED_STEP words, the lemma's bound is that of three edits anywhere or one stretch
that they would take; a region that reaches it is verified by banded alignment of the windows that hold the piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, filter_batches, id_array, materialize, utf8_buffer

Q, PIECE, STRIDE, EDITS, BAND = 10, 120, 60, 0.08, 16
#: Words of an item that a text must hold verbatim to count; each Chinese character or kana is a word.
WORDS = 13
#: Words and least bytes of a seed, words from one to the next, and edits of a window: so many anywhere, or more of them
#: between its first and its last word.
SEED_WORDS, SEED_BYTES, SEED_STEP, ANYWHERE, INSIDE = 10, 56, 3, 3, 8
#: Bytes of an index that one pass over the documents compares them with, and what an index takes for a byte of items.
INDEX_BYTES, _PER_BYTE = 128 << 20, 110
#: Shared q-grams that are counted at a time.
_PAIRS = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_SLICE = 1 << 19
_TEXTS = 2 << 20
_BITS = 22


def _tables() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    for c in range(256):
        if c >= 128 or chr(c).isalnum():
            t[c] = ord(chr(c).lower()) if c < 128 else c
    return t


_CLASS = _tables()


def normalize(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with each run of other characters as one space; their places; the texts' offsets in them."""
    x = _CLASS[flat]
    if len(x) > 1:
        after = (flat[1:] >= 0x80) & (flat[1:] <= 0x9E) & (flat[1:] != 0x97) & (flat[:-1] == 0xC3)
        x[1:][after] += 32  # Latin-1 capitals in UTF-8
    keep = np.ones(len(x), bool)
    if len(x) > 1:
        keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    at = np.flatnonzero(keep)
    return x[keep], at, np.searchsorted(at, offsets)


def qgrams(x: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each q-gram, built by doubling."""
    if len(x) < q:
        return np.zeros(0, np.uint64)
    h, have, out, done = x.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if q & have:
            if out is None:
                out, done = h, have
            else:
                n = len(x) - done - have + 1
                out, done = out[:n] * np.uint64(pow(_BASE, have, 2**64)) + h[done : done + n], done + have
        if done == q:
            return out[: len(x) - q + 1]
        h = h[: len(h) - have] * np.uint64(pow(_BASE, have, 2**64)) + h[have:]
        have *= 2


def _norm_one(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    x = normalize(raw, np.array([0, len(raw)]))[0].tobytes().strip(b" ")
    return np.frombuffer(x, np.uint8)


def words(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each word of normalised texts."""
    first = np.ones(len(x), bool)
    first[1:] = x[:-1] == 32
    first[starts[starts < len(x)]] = True
    alone = np.flatnonzero((x >= 0xE3) & (x <= 0xE9))  # a character of these lead bytes is a word of its own
    first[alone] = True
    first[alone[alone + 3 < len(x)] + 3] = True
    first &= x != 32
    s = np.flatnonzero(first)
    e = np.r_[s[1:], len(x)]
    e = e - (x[e - 1] == 32) if len(s) else s
    return s, e, np.searchsorted(starts, s, side="right") - 1


def prefix_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which run_hash has the hash of any stretch, and the powers that it takes."""
    powers = np.full((2, len(x) + 1), _BASE, np.uint64)
    powers[1] = _UNBASE
    powers[:, 0] = 1
    np.multiply.accumulate(powers, axis=1, out=powers)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * powers[0, : len(x)], out=sums[1:])
    return sums, powers[1]


def run_hash(sums: np.ndarray, powers: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return (sums[e] - sums[s]) * powers[s]


def equal_stretches(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the stretches of a and b of these starts and sizes (not 0) hold the same bytes."""
    out = np.zeros(len(size), bool)
    for lo in range(0, len(size), 1 << 13):
        n, k = size[lo : lo + (1 << 13)], slice(lo, lo + (1 << 13))
        cut = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(cut, n)
        out[k] = np.logical_and.reduceat(a[np.repeat(at_a[k], n) + step] == b[np.repeat(at_b[k], n) + step], cut)
    return out


class Runs:
    """The runs of so many words of some items, by hash."""

    def __init__(self, size: int, items: list[tuple[int, np.ndarray]]):
        self.size, self.x = size, np.concatenate([x for _, x in items])
        starts = np.cumsum([0, *(len(x) for _, x in items)])
        s, e, k = words(self.x, starts)
        first = np.flatnonzero(k[size - 1 :] == k[: len(k) - size + 1])
        s, e = s[first], e[first + size - 1]
        h = run_hash(*prefix_sums(self.x), s, e)
        order = np.argsort(h, kind="stable")
        self.start, self.length, self.item = s[order], (e - s)[order], np.array([i for i, _ in items], np.int64)[k[first]][order]
        self.hash, first = np.unique(h[order], return_index=True)
        self.first = np.r_[first, len(h)]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hash >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, x, s, e, doc, sums, powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """text, item, start and end of every run of the words (s, e, doc) of x that an item holds too."""
        first = np.flatnonzero(doc[self.size - 1 :] == doc[: max(len(doc) - self.size + 1, 0)])
        lo, hi = s[first], e[first + self.size - 1]
        h = run_hash(sums, powers, lo, hi)
        maybe = np.flatnonzero(self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        k = np.searchsorted(self.hash, h[maybe])
        same = self.hash[np.minimum(k, len(self.hash) - 1)] == h[maybe]
        maybe, k = maybe[same], k[same]
        count = self.first[k + 1] - self.first[k]
        at = np.repeat(self.first[k], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        maybe = np.repeat(maybe, count)
        lo, hi = lo[maybe], hi[maybe]
        same = np.flatnonzero(hi - lo == self.length[at])
        same = same[equal_stretches(x, lo[same], self.x, self.start[at[same]], (hi - lo)[same])]
        return doc[first[maybe[same]]], self.item[at[same]], lo[same], hi[same]


class Pieces:
    """The q-gram index of some benchmark items, small enough to be sent to every task."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, self.text, hashes, where, at = [], [], [], [], []
        self.of_item: dict[int, int] = {}
        runs: dict[int, list] = {}
        for item, text in items:
            x = _norm_one(text or "")
            n = len(words(x, np.array([0]))[0])
            if len(x) < 3 * Q:  # too little for edits: only as a whole
                self.of_item[item] = self.of_item.get(item, 0) + 1
                if n:
                    runs.setdefault(n, []).append((item, x))
                continue
            if n >= WORDS:
                runs.setdefault(WORDS, []).append((item, x))
            starts = [0] if len(x) <= PIECE else [*range(0, len(x) - PIECE, STRIDE), len(x) - PIECE]
            self.of_item[item] = self.of_item.get(item, 0) + len(starts)
            for s in starts:
                p = x[s : s + PIECE]
                h = qgrams(p)
                hashes.append(h)
                where.append(np.full(len(h), len(self.item), np.int32))
                at.append(np.arange(len(h), dtype=np.int16))
                self.item.append(item)
                self.text.append(p)
        self.runs = [Runs(n, found) for n, found in sorted(runs.items())]
        self.whole = np.array(sorted({i for r in self.runs for i in r.item.tolist()} - set(self.item)), np.int64)
        self.m = np.array([len(p) for p in self.text], np.int64)
        self.k = np.minimum((self.m * EDITS).astype(np.int64), BAND)
        self.least = np.maximum(self.m + 1 - Q - self.k * Q, 1)
        self._index(hashes, where, at)
        self.seeds = Seeds(items)
        # Each q-gram's place among the seeds' ones, or -1.
        k = np.minimum(np.searchsorted(self.seeds.hash, self.hash), max(len(self.seeds.hash) - 1, 0))
        self.seed_of = np.where(self.seeds.hash[k] == self.hash, k, -1) if len(self.seeds.hash) else np.full(len(self.hash), -1)

    def _index(self, hashes: list, where: list, at: list) -> None:
        """The q-grams' hashes in order, with the piece and the place in it of each."""
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        h = h[order]
        self.where = np.concatenate(where)[order] if hashes else np.zeros(0, np.int32)
        self.at = np.concatenate(at)[order] if hashes else np.zeros(0, np.int16)
        self.hash, first = np.unique(h, return_index=True)
        self.first = np.r_[first, len(h)]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hash >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def verify(self, p: int, x: np.ndarray, lo: int, hi: int, start: int, end: int) -> tuple[int, int, int]:
        """Edits of piece p with its best stretch of x, and that stretch, near where the piece would stand (lo to hi)
        in a text from start to end; edits over the piece's own, -1, -1 if there is none."""
        most, m = int(self.k[p]), int(self.m[p])
        lo, hi = max(lo - most, start), min(hi + most, end)
        j = x[lo:hi].tobytes().find(self.text[p].tobytes())
        edits, stop = (0, j + m) if j >= 0 else banded_edits(self.text[p], x[lo:hi], most)
        return (edits, lo + max(stop - m, 0), lo + stop) if stop >= 0 else (edits, -1, -1)


class Seeds(Pieces):
    """The index of the items' seeds, with the windows of WORDS words that hold each."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, self.windows, hashes, where, at, m = [], [], [], [], [], []
        for item, text in items:
            x = _norm_one(text or "")
            s, e, _ = words(x, np.array([0]))
            for a in range(0, len(s) - WORDS + SEED_STEP, SEED_STEP):
                a = min(a, max(len(s) - SEED_WORDS, 0))
                b = max(a + SEED_WORDS, int(np.searchsorted(e, s[a] + SEED_BYTES)) + 1)
                held = [i for i in range(max(b - WORDS, 0), a + 1) if i + WORDS <= len(s)] if b - a <= WORDS else []
                if not held:
                    continue
                h = qgrams(x[s[a] : e[b - 1]])
                if not len(h):
                    continue
                hashes.append(h)
                where.append(np.full(len(h), len(self.item), np.int32))
                at.append(np.arange(len(h), dtype=np.int16))
                m.append(e[b - 1] - s[a])
                self.item.append(item)
                # Each window with the bytes before its seed and the lengths of its first and last words.
                self.windows.append([(x[s[i] : e[i + WORDS - 1]], int(s[a] - s[i]), int(e[i] - s[i]), int(e[i + WORDS - 1] - s[i + WORDS - 1])) for i in held])
        self.m = np.array(m, np.int64)
        self.k = np.full(len(m), INSIDE, np.int64)
        self.least = np.maximum(self.m + 1 - Q - ANYWHERE * Q, 1)
        self._index(hashes, where, at)

    def verify(self, p: int, x: np.ndarray, lo: int, hi: int, start: int, end: int) -> tuple[int, int, int]:
        for w, before, head, tail in self.windows[p]:
            a = max(lo - before - INSIDE, start)
            region = x[a : min(hi - int(self.m[p]) + len(w) - before + INSIDE, end)]
            edits, stop = banded_edits(w, region, INSIDE)
            if stop < 0:
                continue
            ends = region[max(stop - tail, 0) : stop].tobytes() == w[-tail:].tobytes() and region[max(stop - len(w) - INSIDE, 0) : stop - len(w) + INSIDE + head].tobytes().find(w[:head].tobytes()) >= 0
            if edits <= ANYWHERE or ends:
                return edits, a + max(stop - len(w), 0), a + stop
        return INSIDE + 1, -1, -1


def banded_edits(piece: np.ndarray, region: np.ndarray, k: int) -> tuple[int, int]:
    """Least edits that turn piece into some stretch of region, and that stretch's end; over k: (k + 1, -1).

    Cell (i, j) is computed only for j - i from -k to len(region) - len(piece) + k: no other can lie within k edits.
    """
    m, n, far = len(piece), len(region), k + 1
    width = n - m + 2 * k + 1
    if width < 1:
        return far, -1
    band = np.arange(width)
    padded = np.full(m + width + 1, 256, np.int64)
    padded[k + 1 : k + 1 + n] = region[: m + width - k]
    row = np.where((band >= k) & (band - k <= n), 0, far)  # a start anywhere is free
    for i in range(1, m + 1):
        new = row + (padded[i : i + width] != piece[i - 1])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new[(band + i < k) | (band + i - k > n)] = far
        row = np.minimum(np.minimum.accumulate(new - band) + band, far)
        if row.min() > k:
            return far, -1
    best = int(row.argmin())
    return (int(row[best]), best + m - k) if row[best] <= k else (far, -1)


def _slices(flat: np.ndarray, offsets: np.ndarray):
    """The texts in slices of some size: number of the first, bytes, offsets."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _TEXTS, side="right")) - 1)
        yield lo, flat[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def find_runs(flat: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> list[tuple[int, int, int, int]]:
    """(text, item, start byte, end byte) of all verbatim runs of an item in a text, one row for both."""
    out = []
    for lo, part, cuts in _slices(flat, offsets) if pieces.runs else ():
        x, at, starts = normalize(part, cuts)
        s, e, doc = words(x, starts)
        sums, powers = prefix_sums(x)
        found = [np.concatenate(c) for c in zip(*(r.find(x, s, e, doc, sums, powers) for r in pieces.runs))]
        order = np.lexsort((found[1], found[0]))
        d, item, a, b = (c[order] for c in found)
        if len(d):
            cut = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (item[1:] != item[:-1])])
            a, b, d, item = at[np.minimum.reduceat(a, cut)], at[np.maximum.reduceat(b, cut) - 1] + 1, d[cut], item[cut]
            out += zip((d + lo).tolist(), item.tolist(), (a - cuts[d]).tolist(), (b - cuts[d]).tolist())
    return out


def find(flat: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> list[tuple[int, int, int, int, int, int]]:
    """(text, piece, start byte, end byte, edits, shared q-grams) for every verified region, some texts at a time."""
    return search(flat, offsets, pieces, None)[0]


def search(flat: np.ndarray, offsets: np.ndarray, pieces: Pieces, known: set | None, whole: bool = False) -> tuple[list, list]:
    """(regions of pieces, windows found by seeds), both as `find` gives them; no windows without `known`.

    `known` has the pairs of text and item (with `whole`, the texts) that need no windows any more; regions add to it.
    """
    regions, windows = [], []
    for lo, part, cuts in _slices(flat, offsets) if len(pieces.hash) else ():
        x, at, starts = normalize(part, cuts)
        pos, k, doc = _met(x, starts, pieces)
        regions += _verified(x, at, starts, cuts, pos, k, doc, pieces, lo, ())
        if known is None or not len(pieces.seeds.hash):
            continue
        known |= {d if whole else (d, pieces.item[p]) for d, p, *_ in regions}
        k, seeds = pieces.seed_of[k], pieces.seeds
        mine = k >= 0
        if whole:
            mine &= ~np.isin(doc, np.array([d - lo for d in known], np.int64))
        pos, k, doc = pos[mine], k[mine], doc[mine]
        # Fewer q-grams around than any seed asks for can't be part of one.
        reach = int(seeds.m.max()) + INSIDE
        near = np.searchsorted(pos, pos + reach, "right") - np.searchsorted(pos, pos - reach, "left") >= int(seeds.least.min())
        windows += _verified(x, at, starts, cuts, pos[near], k[near], doc[near], seeds, lo, known)
    return regions, windows


def _band_counts(pos, k, doc, starts, pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, piece, band and shared q-grams of every diagonal band in which q-grams meet.

    A q-gram that many pieces hold meets them all; so some _PAIRS meetings are laid out at a time and only counts are kept.
    """
    count = pieces.first[k + 1] - pieces.first[k]
    bands = int((np.diff(starts).max() if len(starts) > 1 else 0) + PIECE) // BAND + 2
    total = np.cumsum(count)
    kept = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    lo = 0
    while lo < len(pos):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + _PAIRS, side="right")))
        n = count[lo:hi]
        at = np.repeat(pieces.first[k[lo:hi]], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        d, piece = np.repeat(doc[lo:hi], n), pieces.where[at].astype(np.int64)
        band = (np.repeat(pos[lo:hi], n) - pieces.at[at] - starts[d] + PIECE) // BAND
        key = (d * len(pieces.m) + piece) * bands
        found, n = np.unique(np.r_[key + band, key + np.maximum(band - 1, 0)], return_counts=True)
        if len(kept[0]):
            found, back = np.unique(np.r_[kept[0], found], return_inverse=True)
            n = np.bincount(back, np.r_[kept[1], n]).astype(np.int64)
        kept = found, n
        lo = hi
    key, band = np.divmod(kept[0], bands)
    doc_at, piece = np.divmod(key, len(pieces.m))
    return doc_at, piece, band, kept[1]


def _met(x: np.ndarray, starts: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, number in the index and text of each q-gram of the texts that a piece has too."""
    hits, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, max(len(x) - Q + 1, 0), _SLICE):
        h = qgrams(x[lo : lo + _SLICE + Q - 1])
        maybe = np.flatnonzero(pieces.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(maybe):
            continue
        k = np.searchsorted(pieces.hash, h[maybe])
        same = pieces.hash[np.minimum(k, len(pieces.hash) - 1)] == h[maybe]
        hits.append(maybe[same] + lo)
        which.append(k[same])
    pos, k = np.concatenate(hits), np.concatenate(which)
    doc = np.searchsorted(starts, pos, side="right") - 1
    inside = pos + Q <= starts[doc + 1]
    return pos[inside], k[inside], doc[inside]


def _verified(x, at, starts, offsets, pos, k, doc, pieces: Pieces, number: int, known) -> list[tuple[int, int, int, int, int, int]]:
    """Regions of the meetings that reach the bound and are within a piece's edits; texts count from `number`."""
    if not len(pos):
        return []
    doc_at, piece_at, band_at, counts = _band_counts(pos, k, doc, starts, pieces)
    enough = counts >= pieces.least[piece_at]
    doc_at, piece_at, band_at, counts = doc_at[enough], piece_at[enough], band_at[enough], counts[enough]
    out, done = [], {}
    for i in np.argsort(-counts, kind="stable").tolist():
        d, p, b, c = int(doc_at[i]), int(piece_at[i]), int(band_at[i]), int(counts[i])
        if any(b + e in done.get((d, p), ()) for e in (-1, 0, 1)):
            continue  # the neighbouring band holds the same region
        if known and (d + number in known or (d + number, pieces.item[p]) in known):
            continue
        lo = int(starts[d]) + b * BAND - PIECE
        edits, first, end = pieces.verify(p, x, lo, lo + 2 * BAND + int(pieces.m[p]), int(starts[d]), int(starts[d + 1]))
        if end >= 0:
            done.setdefault((d, p), set()).add(b)
            out.append((d + number, p, int(at[first]) - int(offsets[d]), int(at[end - 1]) + 1 - int(offsets[d]), edits, c))
    return out


def _blocks(benchmark: DataFrame):
    """Indexes of the benchmark's items, of about INDEX_BYTES at most each (one for a usual benchmark). Rows of an item
    (and all items of a null id) are in one index, so that a document reports an item once."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * _PER_BYTE // INDEX_BYTES))
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) if n > 1 else items
        yield Pieces(sorted((NULL_ID if r.item_id is None else r.item_id, r.text or "") for r in part.toLocalIterator()))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item of which it holds a passage:
    doc_id, item_id, start, end (code points of the whole stretch), pieces, of_pieces, edits.

    A passage is a piece within its edits (counted in pieces and edits), a verbatim run of WORDS words, or a window of as
    many words with few edits (three anywhere, or eight between its first and last word); items of fewer
    than 30 bytes count as one piece, verbatim and of whole words; items without a word match nothing. Null and empty
    texts hold none; repeated rows report again; very long texts are searched whole; other columns are ignored; empty
    tables give an empty result. Rows of a null doc_id report with a null doc_id, items of a null item_id with a null
    item_id (all such items as one).
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = "doc_id long, item_id long, start long, end long, pieces long, of_pieces long, edits long"
    out = None
    for pieces in _blocks(benchmark):

        def run(batches, pieces=pieces):
            whole = set(pieces.whole.tolist())
            for b in batches:
                flat, offsets = utf8_buffer(b.column(1))
                found: dict = {}
                verbatim = find_runs(flat, offsets, pieces)
                regions, windows = search(flat, offsets, pieces, {(d, item) for d, item, _, _ in verbatim})
                for d, p, s, e, k, _ in regions:
                    x = found.setdefault((d, pieces.item[p]), [s, e, set(), 0])
                    x[0], x[1] = min(x[0], s), max(x[1], e)
                    x[3] += 0 if p in x[2] else k
                    x[2].add(p)
                for d, item, s, e in verbatim:
                    x = found.setdefault((d, item), [s, e, set(), 0])
                    x[0], x[1] = min(x[0], s), max(x[1], e)
                    if item in whole:
                        x[2].add(-1)
                for d, p, s, e, _, _ in windows:
                    x = found.setdefault((d, pieces.seeds.item[p]), [s, e, set(), 0])
                    x[0], x[1] = min(x[0], s), max(x[1], e)
                doc_ids, rows = b.column(0).to_pylist(), []
                for (d, item), (s, e, ps, k) in sorted(found.items()):
                    raw = flat[offsets[d] : offsets[d] + e]
                    chars = np.cumsum((raw & 0xC0) != 0x80)
                    rows.append((doc_ids[d], item, int(chars[s]) - 1, int(chars[e - 1]), len(ps), pieces.of_item[item], k))
                if rows:
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                    columns[1] = id_array(np.array([r[1] for r in rows], np.int64))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start", "end", "pieces", "of_pieces", "edits"])

        part = source.mapInArrow(run, kinds)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a benchmark passage; all columns as they were, nothing shuffled.

    Null and empty texts hold none and stay, whatever their doc_id; an empty benchmark, or items that are null or
    without a word, reject nothing; items of a null item_id count like any other; repeated rows go or stay together.
    """
    at = docs.columns.index("text")
    out = docs
    for number, pieces in enumerate(_blocks(benchmark)):

        def run(batches, pieces=pieces):
            for b in batches:
                flat, offsets = utf8_buffer(b.column(at))
                bad = {x[0] for x in find_runs(flat, offsets, pieces)}
                bad |= {x[0] for found in search(flat, offsets, pieces, bad, whole=True) for x in found}
                if bad:
                    b = b.filter(pa.array([i not in bad for i in range(b.num_rows)]))
                yield b

        if number:  # one index in a task at a time
            out = materialize(out, "decontaminated")
        out = filter_batches(out, run)
    return out
