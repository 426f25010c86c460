"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint is given the vector phi(i) = i mod (2^(r+1) - 1) + 1 over GF(2); table v keeps the bits
whose phi(i) has odd inner product with v. At most r differing bits span at most r of r + 1 dimensions, so some
v is orthogonal to all of them and both fingerprints agree in that table: no pair within the radius is missed.
"""

from __future__ import annotations

from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, whole_rows
from .components import connected_components, tree_edges

BITS = 64


def _fingerprint(text: bytes, width: int, seed: int) -> int:
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    n = len(words)
    if not n:
        return 0
    if n <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    ends = [x - 1 for x in starts[width:]]
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), n - width + 1
    for k in range(0, total, 1 << 15):  # a very long text is counted in blocks
        h = np.array(list(map(digest, [joined[s:e] for s, e in zip(starts[k : k + (1 << 15)], ends[k : k + (1 << 15)])], repeat(seed))), np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, h (a hash of the text), fp (the 64 bits as a signed long) of every whole text; a null or blank text has fingerprint 0."""

    def run(batches):
        for b in batches:
            raw = b.column(2).cast(pa.binary()).to_pylist()
            fp = np.array([_fingerprint(x or b"", width, seed) for x in raw], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["doc_id", "h", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text").mapInArrow(run, "doc_id long, h long, fp long")


def masks(radius: int) -> list[int]:
    """The covering tables' bit masks, as signed longs."""
    top = 2 ** (radius + 1)
    out = []
    for v in range(1, top):
        m = sum(1 << i for i in range(BITS) if ((i % (top - 1) + 1) & v).bit_count() % 2)
        out.append(m - (1 << BITS) if m >> (BITS - 1) else m)
    return out


def _near(fp: np.ndarray, one: np.uint64, radius: int) -> np.ndarray:
    return np.bitwise_count(fp ^ one) <= radius


def local_components(fp: np.ndarray, radius: int) -> np.ndarray:
    """A label for each of the distinct fingerprints of one bucket, linked within the radius.

    Small buckets are searched breadth first, each step one vector comparison against those not yet reached.
    Larger ones are split by radius + 1 blocks of bits, one of which any linked pair has equal, and joined again.
    """
    n, label = len(fp), np.full(len(fp), -1, np.int64)
    if n <= 2048:
        rest, at = np.arange(n), 0
        while len(rest):
            todo, rest = [rest[0]], rest[1:]
            label[todo[0]] = at
            while todo and len(rest):
                hit = _near(fp[rest], fp[todo.pop()], radius)
                if hit.any():
                    got = rest[hit]
                    label[got] = at
                    todo.extend(got.tolist())
                    rest = rest[~hit]
            at += 1
        return label
    parent = np.arange(n)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    varying = np.flatnonzero(np.unpackbits((np.bitwise_or.reduce(fp) ^ np.bitwise_and.reduce(fp)).reshape(1).view(np.uint8), bitorder="little"))
    for block in np.array_split(varying, radius + 1):
        mask = np.uint64(sum(1 << int(i) for i in block))
        value = fp & mask
        order = np.argsort(value, kind="stable")
        cuts = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1]])
        for group in np.split(order, cuts[1:]):
            if len(group) < 2:
                continue
            if len(group) == n:  # the block tells nothing apart: breadth first, in blocks of vector comparisons
                sub = _breadth(fp, radius)
            else:
                sub = local_components(fp[group], radius)
            first: dict[int, int] = {}
            for i, k in zip(group.tolist(), sub.tolist()):
                a, b = root(first.setdefault(k, i)), root(i)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(n)])


def _breadth(fp: np.ndarray, radius: int) -> np.ndarray:
    label, rest, at = np.full(len(fp), -1, np.int64), np.arange(len(fp)), 0
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        label[todo[0]] = at
        while todo and len(rest):
            hit = _near(fp[rest], fp[todo.pop()], radius)
            label[rest[hit]] = at
            todo.extend(rest[hit].tolist())
            rest = rest[~hit]
        at += 1
    return label


def covering_edges(fps: DataFrame, radius: int) -> DataFrame:
    """src, dst: a spanning forest of each bucket's links between different fingerprints (fp); never all pairs."""
    tables = fps.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(v).cast("short").alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for v, m in enumerate(masks(radius))])).alias("t")
    ).select("t.v", "t.key", "fp")
    dealt = tables.repartition("v", "key").sortWithinPartitions("v", "key")

    def linked(fp):
        node = fp.view(np.int64)
        if len(fp) == 2:
            return ([int(node.max())], [int(node.min())]) if (int(fp[0]) ^ int(fp[1])).bit_count() <= radius else ([], [])
        src, dst, label = [], [], local_components(fp, radius)
        for k in np.flatnonzero(np.bincount(label) > 1):
            a, b = tree_edges(np.sort(node[label == k]))
            src.extend(a)
            dst.extend(b)
        return src, dst

    def run(batches):
        open_key, open_parts = None, []  # the last bucket of a batch may go on in the next ones
        for b in batches:
            v, key, fp = b.column(0).to_numpy().astype(np.int64), b.column(1).to_numpy(), b.column(2).to_numpy().view(np.uint64)
            cuts = np.r_[0, np.flatnonzero((v[1:] != v[:-1]) | (key[1:] != key[:-1])) + 1, len(v)] if len(v) else [0]
            src, dst = [], []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo and hi < len(v):
                    if hi - lo > 1:
                        a, c = linked(fp[lo:hi])
                        src.extend(a)
                        dst.extend(c)
                    continue
                if (v[lo], key[lo]) != open_key:
                    if sum(map(len, open_parts)) > 1:
                        a, c = linked(np.concatenate(open_parts))
                        src.extend(a)
                        dst.extend(c)
                    open_key, open_parts = (v[lo], key[lo]), []
                open_parts.append(fp[lo:hi].copy())
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])
        if sum(map(len, open_parts)) > 1:
            src, dst = linked(np.concatenate(open_parts))
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    return dealt.mapInArrow(run, "src long, dst long").distinct()


def _classes(known: DataFrame, radius: int) -> DataFrame:
    """fp, least (its smallest doc_id), component (a number of its own) for every different fingerprint."""
    each = materialize(known.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    labels = connected_components(covering_edges(each, radius))
    return each.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("component"))


def simhash_components(docs: DataFrame, radius: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) for every row of docs.

    Null and blank texts have fingerprint zero and link like any other; repeated rows keep their own rows;
    an empty table gives an empty result; other columns are ignored. Rows with a null doc_id take part and
    come back with a null doc_id; where nothing else is in their component, component_id is null too.
    """
    known = materialize(fingerprints(docs, width, seed), "fingerprints")
    classes = materialize(_classes(known, radius), "components")
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return known.join(classes.join(smallest, "component").select("fp", "component_id"), "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, radius: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """docs with one row of each near-duplicate group: that of the smallest doc_id, of rows of one doc_id that of the
    least hash of text; columns as they were, whatever their names.

    Rows without a doc_id take part: one stays only where its group has no row with an id. Null and blank texts are
    near duplicates of one another; repeated rows are one group; an empty table stays empty.
    """
    known = materialize(fingerprints(docs, width, seed), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    best = known.join(_classes(known, radius).select("fp", "component"), "fp").groupBy("component").agg(F.min(order).alias("b"))
    # Plain keys, null or not, so that the join and the window after it share one exchange.
    key = lambda c: [F.coalesce(c, F.lit(0)).alias("id"), c.isNull().alias("none")]
    keep = best.select(*key(F.col("b.doc_id")), F.col("b.h").alias("h"))
    rows = docs.select(whole_rows(docs).alias("row"), *key(F.col("doc_id").cast("long")), F.xxhash64("text").alias("h"))
    kept = rows.join(keep, ["id", "none", "h"], "left_semi")
    same = F.hash(*[F.col("row")[c] for c, t in docs.dtypes if "map<" not in t])
    first = F.row_number().over(Window.partitionBy("id", "none", "h").orderBy(same))
    return kept.withColumn("n", first).where("n = 1").select("row.*")
