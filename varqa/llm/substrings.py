"""Substring dedup: words of windows that also start in an earlier document are removed.

An automaton of the whole corpus fits in no memory, so it is sharded by content. In every window of `length` words
one stretch of `gram` words has the least hash; that anchor is the same wherever the window occurs, so equal
windows meet in the shard of their anchor. Two exchanges, both of packed arrays from and to batches of documents,
so that no common passage puts more than one entry per batch into a shard:

1. hashes of anchors: which of them occur in more than one document;
2. the windows around such anchors: a shard builds a suffix automaton over its reference stretches, in ascending
   order of documents, and streams every stretch through it for matching statistics; where the statistic reaches
   `length`, the state of that suffix knows the first document.

An anchor that occurs oftener than HOT times (a phrase in ever other contexts, a large group of copies) would make one
great automaton. Its windows are dealt out one by one instead, by the hash of all their words, so they spread over
all shards; the automaton of equal windows is a path and its answer their first document.

Batches then remove the spans that earlier documents cover.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_for, id_array, ids, utf8_buffer

LENGTH, GRAM = 13, 6
BATCH_BYTES = 8 << 20
#: Occurrences beyond which an anchor's windows are dealt out one by one.
HOT = 512
#: Batches that a task holds one after the other, and that share a shard.
_BATCHES_A_TASK = 16
_ALL, _ONE = 255, 254  # for a window's number in an answer: all of a stretch; a window dealt out alone
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 1 << 18
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.r_[np.uint64(1), np.full(_STEP, _BASE, np.uint64)])
    _BACK = np.cumprod(np.r_[np.uint64(1), np.full(_STEP, _INVERSE, np.uint64)])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def split_words(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the buffer, and the number of the first word of each text."""
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[flat]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(flat))]
    begins[edge] = word[edge]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[edge - 1] = word[edge - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def word_hashes(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from running sums of powers over stretches of the buffer."""
    out = np.zeros(len(start), np.uint64)
    long = end - start > _STEP // 2
    i = 0
    while i < len(start):
        if long[i]:
            out[i] = np.frombuffer(hashlib.blake2b(flat[start[i] : end[i]].tobytes(), digest_size=8).digest(), np.uint64)[0]
            i += 1
            continue
        j = int(np.searchsorted(end, start[i] + _STEP, side="right"))
        stop = np.flatnonzero(long[i:j])
        j = max(i + 1, i + int(stop[0]) if len(stop) else j)
        lo = int(start[i])
        x = _BYTE[flat[lo : end[j - 1]]] * _POWER[: end[j - 1] - lo]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = _mix((total[e] - total[s]) * _BACK[s] + (e - s).astype(np.uint64))
        i = j
    return out


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + h[k : k + len(out)]
    return _mix(out)


class Anchored:
    """The words of some documents and the anchor of each of their windows."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, length: int, gram: int):
        self.start, self.end, self.first = split_words(flat, offsets)
        self.hash = word_hashes(flat, self.start, self.end)
        per, span = np.diff(self.first), length - gram + 1
        n = np.maximum(per - length + 1, 0)
        self.doc = np.repeat(np.arange(len(per)), n)  # of each window
        self.at = np.arange(n.sum()) + np.repeat(self.first[:-1] - np.r_[0, np.cumsum(n)[:-1]], n)  # its first word
        if not len(self.at):
            self.anchor, self.key = self.at, np.zeros(0, np.uint64)
            return
        g = _grams(self.hash, gram)
        size = len(g) - span + 1
        least, where = g[:size].copy(), np.zeros(size, np.int64)
        for k in range(1, span):
            lower = g[k : k + size] < least
            least[lower] = g[k : k + size][lower]
            where[lower] = k
        self.key = least[self.at]  # hash of the anchor
        self.anchor = self.at + where[self.at]  # its first word


def _packed(parts: list[tuple[str, np.ndarray]]) -> bytes:
    """Columns one after the other; document ids (i8) as byte planes, whose zeros compress."""
    return b"".join(np.ascontiguousarray(a, t).view(np.uint8).reshape(-1, 8).T.tobytes() if t == "i8" else np.ascontiguousarray(a, t).tobytes() for t, a in parts)


def _unpacked(data: bytes, kinds: str) -> list[np.ndarray]:
    """The columns of a packed block; kinds by numpy name, all of one length."""
    types = [np.dtype(k) for k in kinds.split()]
    n, at, out = len(data) // sum(t.itemsize for t in types), 0, []
    for t in types:
        if t == np.int64:
            out.append(np.frombuffer(data, np.uint8, 8 * n, at).reshape(8, n).T.copy().view(np.int64).ravel())
        else:
            out.append(np.frombuffer(data, t, n, at))
        at += n * t.itemsize
    return out


class SuffixAutomaton:
    """Of several word sequences; every state knows the least document of its occurrences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len, self.doc = [-1], [0], [2**63 - 1]

    def add(self, words, doc: int) -> None:
        nxt, link, length = self.next, self.link, self.len
        last = 0
        for w in words:
            p = last
            if w in nxt[p]:
                q = nxt[p][w]
                if length[q] == length[p] + 1:
                    last = q
                else:
                    last = self._clone(p, q, w)
            else:
                cur = len(nxt)
                nxt.append({})
                length.append(length[p] + 1)
                link.append(0)
                self.doc.append(2**63 - 1)
                while p != -1 and w not in nxt[p]:
                    nxt[p][w] = cur
                    p = link[p]
                if p != -1:
                    q = nxt[p][w]
                    link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
                last = cur
            if doc < self.doc[last]:
                self.doc[last] = doc

    def _clone(self, p: int, q: int, w: int) -> int:
        nxt, link = self.next, self.link
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        self.len.append(self.len[p] + 1)
        link.append(link[q])
        self.doc.append(2**63 - 1)
        link[q] = c
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def settle(self) -> None:
        """Hands each state's least document on to its suffixes."""
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.len[s]):
            if self.doc[s] < self.doc[self.link[s]]:
                self.doc[self.link[s]] = self.doc[s]

    def first_documents(self, words, length: int) -> list[int]:
        """Streams words: where the matching statistic reaches length, the first document of that window, else -1."""
        out, state, matched = [], 0, 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.len[state]
            if w in self.next[state]:
                state, matched = self.next[state][w], matched + 1
            if i + 1 >= length:
                s = state
                while s and self.len[self.link[s]] >= length:
                    s = self.link[s]
                out.append(self.doc[s] if matched >= length else -1)
        return out


def _shared(data: list[tuple[int, bytes]], hot: int):
    """Of (batch, packed anchors): for each batch those that are in more than one document, and which of them are hot."""
    h = [_unpacked(d, "u8 u1") for _, d in data]
    key, many = np.concatenate([x[0] for x in h]), np.concatenate([x[1] for x in h])
    batch = np.repeat([b for b, _ in data], [len(x[0]) for x in h])
    order = np.argsort(key, kind="stable")
    key, many, batch = key[order], many[order], batch[order]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[cut, len(key)])
    keep = np.repeat((size > 1) | (np.maximum.reduceat(many, cut) > 127), size)
    often = np.repeat(np.add.reduceat((many & 127).astype(np.int64), cut) > hot, size)[keep]
    key, batch = key[keep], batch[keep]
    order = np.argsort(batch, kind="stable")
    key, batch, often = key[order], batch[order], often[order]
    for part in np.split(np.arange(len(key)), np.flatnonzero(batch[1:] != batch[:-1]) + 1):
        if len(part):
            yield int(batch[part[0]]), _packed([("u8", key[part]), ("u1", often[part])])


def _regions(a: Anchored, shared: np.ndarray, length: int):
    """Windows whose anchor is shared, one stretch for each occurrence of an anchor.

    Returns per stretch: document, anchor's hash, first word, number of windows, hash of all its words; windows of
    one anchor occurrence follow one another.
    """
    hit = np.flatnonzero(shared)
    if not len(hit):
        return None
    new = np.r_[True, (a.anchor[hit][1:] != a.anchor[hit][:-1]) | (a.doc[hit][1:] != a.doc[hit][:-1]) | (hit[1:] != hit[:-1] + 1)]
    cut = np.flatnonzero(new)
    count = np.diff(np.r_[cut, len(hit)])
    first = hit[cut]
    at, n = a.at[first], count + length - 1
    total = np.zeros(len(cut), np.uint64)
    for k in range(int(n.max())):
        go = k < n
        total[go] = total[go] * np.uint64(_BASE) + a.hash[at[go] + k]
    return a.doc[first], a.key[first], at, count, _mix(total + n.astype(np.uint64) + (a.anchor[first] - at).astype(np.uint64))


def _first_documents(data: list[tuple[int, bytes]], length: int, width: int):
    """Of (batch, packed stretches): for each batch (stretch hash, window, first document) where that is an earlier one."""
    h = [_unpack_stretches(d, length, width) for _, d in data]
    key, full, n, low, high, words = (np.concatenate([x[i] for x in h]) for i in range(6))
    batch = np.repeat([b for b, _ in data], [len(x[0]) for x in h])
    order = np.lexsort((low, full, key))
    key, full, n, low, high, words, batch = (x[order] for x in (key, full, n, low, high, words, batch))
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    kind = np.r_[True, (full[1:] != full[:-1]) | (key[1:] != key[:-1])]
    kinds = np.add.reduceat(kind.astype(np.int64), cut)
    size = np.diff(np.r_[cut, len(key)])
    least = np.repeat(np.minimum.reduceat(low, cut), size)
    out_batch, out_full, out_window, out_doc = [], [], [], []
    plain = np.repeat(kinds == 1, size) & (least < high)  # one stretch only: it is the whole automaton
    out_batch.append(batch[plain])
    out_full.append(full[plain])
    out_window.append(np.where(n[plain] == 0, _ONE, _ALL).astype(np.uint8))
    out_doc.append(least[plain])
    more_batch, more_full, more_window, more_doc = [], [], [], []
    for g in np.flatnonzero(kinds > 1):
        lo, hi = cut[g], cut[g] + size[g]
        heads = lo + np.flatnonzero(kind[lo:hi])  # ordered by low within a kind: the head has the least document
        automaton = SuffixAutomaton()
        lists = {int(i): words[i, : n[i] + length - 1].tolist() for i in heads}
        for i in sorted(lists, key=lambda i: low[i]):
            automaton.add(lists[i], int(low[i]))
        automaton.settle()
        for i, stop in zip(heads, np.r_[heads[1:], hi]):
            for k, doc in enumerate(automaton.first_documents(lists[int(i)], length)):
                for r in range(i, stop):
                    if doc < high[r]:
                        more_batch.append(batch[r])
                        more_full.append(full[r])
                        more_window.append(k)
                        more_doc.append(doc)
    batch = np.r_[out_batch[0], np.array(more_batch, np.int64)]
    full = np.r_[out_full[0], np.array(more_full, np.uint64)]
    window = np.r_[out_window[0], np.array(more_window, np.uint8)]
    doc = np.r_[out_doc[0], np.array(more_doc, np.int64)]
    order = np.argsort(batch, kind="stable")
    for part in np.split(order, np.flatnonzero(batch[order][1:] != batch[order][:-1]) + 1):
        if len(part):
            yield int(batch[part[0]]), _packed([("u8", full[part]), ("u1", window[part]), ("i8", doc[part])])


_BLOB = "bucket long, batch long, data binary"


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "batch": pa.array([r[1] for r in rows], pa.int64()), "data": pa.array([r[2] for r in rows], pa.binary())})


def _parts(values: np.ndarray) -> list[np.ndarray]:
    """The places of each value that occurs."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(values[order][1:] != values[order][:-1]) + 1
    return [p for p in np.split(order, cuts) if len(p)]


_HEAD = "u8 u8 u1 i8 i8"


def _pack_stretches(head: list[np.ndarray], words: np.ndarray, length: int) -> bytes:
    """Columns (anchor, stretch, windows, least document, greatest document), then the words of all, unpadded.

    A window dealt out alone has 0 windows and no words: its hash stands for it.
    """
    used = np.arange(words.shape[1])[None, :] < np.where(head[2] > 0, head[2].astype(np.int64) + length - 1, 0)[:, None]
    return _packed([("i8", np.array([len(words)])), *zip(_HEAD.split(), head), ("u4", words[used])])


def _unpack_stretches(data: bytes, length: int, width: int) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "i8", 1)[0])
    size = 8 + n * sum(np.dtype(t).itemsize for t in _HEAD.split())
    head = _unpacked(data[8:size], _HEAD)
    words = np.zeros((n, width), np.uint32)
    words[np.arange(width)[None, :] < np.where(head[2] > 0, head[2].astype(np.int64) + length - 1, 0)[:, None]] = np.frombuffer(data, "u4", -1, size)
    return [*head, words]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES, keep_text: bool = False, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept, the text left, with keep_text) for every row of docs.

    Removed is each word of a window of `length` words that also starts in a document with a smaller doc_id; windows
    within one document, or in rows of the same doc_id, don't count against each other. Null and blank texts have
    no words; rows with a null doc_id count as before all others; other columns are ignored; an empty table gives an
    empty result.
    """
    width = 2 * length - gram
    batches = batches_for(docs, "text", batch_bytes)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-batches // _BATCHES_A_TASK))
    buckets = tasks
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(batches)).alias("batch")).repartition(tasks, "batch")

    def anchors(part: pa.Table) -> pa.Table:
        batch = part.column("batch")[0].as_py()
        a = Anchored(*utf8_buffer(part.column("text")), length, gram)
        own = ids(part.column("doc_id"))[a.doc]
        new = np.r_[True, a.anchor[1:] != a.anchor[:-1]] if len(a.at) else np.zeros(0, bool)
        key, own = a.key[new], own[new]
        order = np.lexsort((own, key))
        key, own = key[order], own[order]
        if not len(key):
            return _table([])
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        last = np.r_[cut[1:], len(key)] - 1
        k = key[cut]
        many = (own[cut] != own[last]) * 128 + np.minimum(last - cut + 1, 127)  # whether in two documents, and how often
        return _table([(int(k[p[0]] % np.uint64(buckets)), batch, _packed([("u8", k[p]), ("u1", many[p])])) for p in _parts(k % np.uint64(buckets))])

    def which(part: pa.Table) -> pa.Table:
        return _table([(0, b, d) for b, d in _shared(list(zip(part.column("batch").to_pylist(), part.column("data").to_pylist())), hot)])

    def stretches(part: pa.Table, reply: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        if not part.num_rows or not reply.num_rows:
            return _table(rows)
        batch = part.column("batch")[0].as_py()
        got = [_unpacked(d, "u8 u1") for d in reply.column("data").to_pylist()]
        shared, often = (np.concatenate([g[i] for g in got]) for i in (0, 1))
        own = ids(part.column("doc_id"))
        a = Anchored(*utf8_buffer(part.column("text")), length, gram)
        alone = np.flatnonzero(np.isin(a.key, shared[often > 0]))
        if len(alone):
            full, mine = _grams(a.hash, length)[a.at[alone]], own[a.doc[alone]]
            order = np.lexsort((mine, full))
            cut = np.flatnonzero(np.r_[True, full[order][1:] != full[order][:-1]])
            head, tail = order[cut], order[np.r_[cut[1:], len(order)] - 1]
            columns = [full[head], full[head], np.zeros(len(head), np.uint8), mine[head], mine[tail]]
            for p in _parts(full[head] % np.uint64(buckets)):
                rows.append((int(full[head[p[0]]] % np.uint64(buckets)), batch, _pack_stretches([c[p] for c in columns], np.zeros((len(p), width), np.uint32), length)))
        found = _regions(a, np.isin(a.key, shared[often == 0]), length)
        if found is None:
            return _table(rows)
        doc, key, at, n, full = found
        order = np.lexsort((own[doc], full))
        cut = np.flatnonzero(np.r_[True, full[order][1:] != full[order][:-1]])
        head, tail = order[cut], order[np.r_[cut[1:], len(order)] - 1]
        words = np.zeros((len(head), width), np.uint32)
        short = (a.hash >> np.uint64(32)).astype(np.uint32)
        for k in range(width):
            go = k < n[head] + length - 1
            words[go, k] = short[at[head][go] + k]
        columns = [key[head], full[head], n[head].astype(np.uint8), own[doc[head]], own[doc[tail]]]
        for p in _parts(columns[0] % np.uint64(buckets)):
            rows.append((int(columns[0][p[0]] % np.uint64(buckets)), batch, _pack_stretches([c[p] for c in columns], words[p], length)))
        return _table(rows)

    def firsts(part: pa.Table) -> pa.Table:
        return _table([(0, b, d) for b, d in _first_documents(list(zip(part.column("batch").to_pylist(), part.column("data").to_pylist())), length, width)])

    def cleaned(part: pa.Table, reply: pa.Table) -> pa.Table:
        flat, offsets = utf8_buffer(part.column("text"))
        own = ids(part.column("doc_id"))
        got = [_unpacked(d, "u8 u1 i8") for d in reply.column("data").to_pylist()]
        a = Anchored(flat, offsets, length, gram)
        gone = np.zeros(len(a.start) + 1, np.int64)
        found = _regions(a, np.ones(len(a.key), bool), length) if got else None
        if found is not None:
            known, window, earliest = (np.concatenate([g[i] for g in got]) for i in range(3))
            alone = window == _ONE
            if alone.any():
                order = np.argsort(known[alone], kind="stable")
                one, before = known[alone][order], earliest[alone][order]
                full = _grams(a.hash, length)[a.at]
                k = np.minimum(np.searchsorted(one, full), len(one) - 1)
                hit = np.flatnonzero((one[k] == full) & (before[k] < own[a.doc]))
                np.add.at(gone, a.at[hit], 1)
                np.add.at(gone, a.at[hit] + length, -1)
                known, window, earliest = known[~alone], window[~alone], earliest[~alone]
            order = np.argsort(known, kind="stable")
            known, window, earliest = known[order], window[order], earliest[order]
            doc, _, at, n, full = found
            lo, hi = np.searchsorted(known, full, "left"), np.searchsorted(known, full, "right")
            count = hi - lo
            rows = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            of = np.repeat(np.arange(len(at)), count)
            early = earliest[rows] < own[doc[of]]
            rows, of = rows[early], of[early]
            whole = window[rows] == _ALL
            begin = at[of] + np.where(whole, 0, window[rows])
            np.add.at(gone, begin, 1)
            np.add.at(gone, begin + np.where(whole, n[of].astype(np.int64), 1) + length - 1, -1)
        stay = np.cumsum(gone)[:-1] == 0
        lost = np.diff(np.r_[0, np.cumsum(~stay)][a.first])
        raw, out = flat.tobytes(), []
        for i in range(len(own)):
            words = raw[int(offsets[i]) : int(offsets[i + 1])].split()
            if lost[i]:
                words = list(compress(words, stay[a.first[i] : a.first[i + 1]].tolist()))
            kept = b" ".join(words)
            out.append((int(a.first[i + 1] - a.first[i]), int(lost[i]), hashlib.sha256(kept).hexdigest(), kept.decode() if keep_text else None))
        c = list(zip(*out)) if out else [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table({"doc_id": id_array(own), **{k: pa.array(x, t) for k, x, t in zip(("n_words", "n_removed", "kept_sha256", "kept"), c, kinds)}})

    # One exchange of the texts serves all three passes over them.
    by_batch = text.groupBy("batch")
    shared = by_batch.applyInArrow(anchors, _BLOB).repartition(tasks, "bucket").groupBy("bucket").applyInArrow(which, _BLOB)
    sent = by_batch.cogroup(shared.groupBy("batch")).applyInArrow(stretches, _BLOB)
    answers = sent.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(firsts, _BLOB)
    done = by_batch.cogroup(answers.groupBy("batch")).applyInArrow(cleaned, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return done if keep_text else done.drop("kept")
