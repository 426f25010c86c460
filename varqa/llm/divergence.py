"""Divergence audit of sources: how far each source's words are from every other source's of its language, and which
words set it apart.

Counts of (language, source, term) are cut into tiles: a block of terms against two blocks of sources. A tile is a pair
of dense int64 matrices, made in one task by numpy, that broadcasts all pairs of its rows; the partial matrices of a
pair of sources are summed over the blocks of terms, the short heaps of a source's terms are merged by rank. A tile's
size is bounded by the two block sizes, whatever the size of a language, a source or a term's count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, utf8_buffer

#: Terms and sources (about, as both are dealt out by hash) on the sides of a tile, and terms compared in one numpy step.
TERMS, SOURCES, STEP = 256, 64, 64
#: Bytes of text that a task counts at once, and rows of counts from which it adds equal ones up and hands them on.
SLICE, HELD = 2 << 20, 400_000
# Parts of a share, what is added to each count, documents that keep a term, ranks of a group's terms.
SCALE_STEPS, SMOOTH, LEAST_DOCS, TOP = 3, 2, 10, 10  # shares count in 1000 ** SCALE_STEPS
# Bytes of terms, A-Z as a-z; all others (ASCII but no letter) as 0.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)


def terms_of(flat: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms (runs of ASCII letters and other scripts' characters, A-Z lower-cased) of texts, and each one's text.

    flat has the texts' bytes, at their offsets.
    """
    low = _FOLD[flat]
    inside = low != 0
    before = np.concatenate(([False], inside[:-1]))
    before[at[:-1][at[:-1] < len(low)]] = False  # a text's first byte goes on from no other
    first = inside & ~before
    data, n = low[inside], int(first.sum())
    offsets = np.append(np.flatnonzero(first[inside]), len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)]), np.searchsorted(at, np.flatnonzero(first), "right") - 1


def _added(t: pa.Table, keys: list[str]) -> pa.Table:
    found = t.group_by(keys, use_threads=False).aggregate([("count", "sum"), ("docs", "sum")])
    return found.rename_columns([c.removesuffix("_sum") for c in found.column_names]).select(["group", "term", "count", "docs"])


def _count(flat: np.ndarray, at: np.ndarray, group: np.ndarray) -> pa.Table:
    """group, term, count, docs of some texts."""
    words, doc = terms_of(flat, at)
    coded = words.dictionary_encode()
    k = max(len(coded.dictionary), 1)
    pair, n = np.unique(doc * k + coded.indices.to_numpy(), return_counts=True)
    key = group[pair // k] * k + pair % k
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    counts = np.add.reduceat(n, first) if len(first) else n
    return pa.table({"group": key[first] // k, "term": coded.dictionary.take(pa.array(key[first] % k)), "count": counts.astype(np.int64), "docs": np.diff(np.append(first, len(key)))})


def _count_long(flat: np.ndarray, group: np.ndarray) -> pa.Table:
    """The same for one long text, counted in parts that end between terms."""
    parts, lo = [], 0
    while lo < len(flat):
        hi = min(lo + SLICE, len(flat))
        while hi < len(flat) and (gap := np.flatnonzero(_FOLD[flat[hi : hi + SLICE]] == 0)[:1]).size == 0:
            hi = min(hi + SLICE, len(flat))
        hi += int(gap[0]) if hi < len(flat) else 0
        parts.append(_count(flat[lo:hi], np.array([0, hi - lo]), group))
        lo = hi
    whole = _added(pa.concat_tables(parts), ["group", "term"])
    return whole.set_column(3, "docs", pa.array(np.ones(len(whole), np.int64)))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs: occurrences and documents of each term, the same one in several rows."""

    def emit(held: list[pa.Table], names: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        t = _added(pa.concat_tables(held), ["group", "term"])
        lang, source = (pa.array([x[i] for x in names], pa.string()) for i in (0, 1))
        for b in t.to_batches(max_chunksize=50_000):
            yield pa.record_batch([lang.take(b.column(0)), source.take(b.column(0)), b.column(1).cast(pa.string()), b.column(2), b.column(3)], ["lang", "source", "term", "count", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, groups = [], 0, {}
        for b in batches:
            flat, at = utf8_buffer(b.column(2))
            group = np.array([groups.setdefault(x, len(groups)) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], np.int64)
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE, "right")) - 1)
                if at[hi] - at[lo] > SLICE:
                    held.append(_count_long(flat[at[lo] : at[hi]], group[lo:hi]))
                else:
                    held.append(_count(flat[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], group[lo:hi]))
                rows, lo = rows + len(held[-1]), hi
                if rows > HELD:
                    held = [_added(pa.concat_tables(held), ["group", "term"])]
                    rows = len(held[0])
                    if rows > HELD // 2:
                        yield from emit(held, list(groups))
                        held, rows, groups = [], 0, {x: i for i, x in enumerate(groups)}
        if held:
            yield from emit(held, list(groups))

    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return plain.mapInArrow(run, "lang string, source string, term string, count long, docs long")


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total), exact in int64 by long division, for totals below 9 * 10^15."""
    quotient, rest = np.divmod(np.asarray(count, np.int64) + SMOOTH, total)
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        quotient, rest = quotient * 1000 + rest // total, rest % total
    return quotient + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); at most about 10^18 before the division."""
    return (p - q) ** 2 // (p + q)


def pair_matrix(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums over terms of the divergence of each row of p (sources, terms) from each row of q."""
    out = np.zeros((len(p), len(q)), np.int64)
    for lo in range(0, p.shape[1], STEP):
        out += divergence(p[:, None, lo : lo + STEP], q[None, :, lo : lo + STEP]).sum(axis=2)
    return out


def _tile(key: tuple, rows: pa.Table, sides: pa.Table) -> pa.Table:
    """One tile's partial pair sums, and on the diagonal its best terms of each source.

    sides has the sources of the tile's one or two blocks with their totals; rows the counts above zero.
    """
    gi, gj = key[2].as_py(), key[3].as_py()
    sides = sides.sort_by("source")
    v, n_lang, n_terms = (sides[c][0].as_py() for c in ("v", "n_lang", "n_terms"))
    sources, block = sides["source"].combine_chunks(), sides["gb"].to_numpy()
    coded = rows["term"].combine_chunks().dictionary_encode()
    column, names = coded.indices.to_numpy(), coded.dictionary
    row = pc.index_in(rows["source"], value_set=sources).to_numpy()
    dense = np.zeros((len(sources), len(names) + 1), np.int64)  # the last column: terms of the block that nobody here has
    dense[row, column] = rows["count"].to_numpy()
    p = shares(dense, np.maximum(sides["n"].to_numpy() + 2 * v, 1)[:, None])
    a, b = np.flatnonzero(block == gi), np.flatnonzero(block == gj)
    sums = pair_matrix(p[a, :-1], p[b, :-1]) + (n_terms - len(names)) * divergence(p[a, None, -1], p[None, b, -1])
    left, right = np.repeat(a, len(b)), np.tile(b, len(a))
    other = left != right
    left, right, sums = left[other], right[other], sums.ravel()[other]
    if gi != gj:
        left, right, sums = np.concatenate((left, right)), np.concatenate((right, left)), np.tile(sums, 2)
    out = [(sources.take(pa.array(left)), ["pair"] * len(left), sources.take(pa.array(right)), sums)]
    if gi == gj:
        own, whole = p[row, column], shares(rows["lang_count"].to_numpy(), max(n_lang + 2 * v, 1))
        value, more = divergence(own, whole), np.flatnonzero(own > whole)
        heaps: dict[int, list] = {}
        for i, s, f, t in zip(more.tolist(), row[more].tolist(), value[more].tolist(), names.take(pa.array(column[more])).to_pylist()):
            heaps.setdefault(s, []).append((-f, t, i))
        best = [x[2] for found in heaps.values() for x in heapq.nsmallest(TOP, found)]
        out.append((sources.take(pa.array(row[best])), ["term"] * len(best), names.take(pa.array(column[best])), value[best]))
    tables = [pa.table({"lang": pa.array([key[0].as_py()] * len(f), pa.string()), "source": s, "part": pa.array(part, pa.string()), "item": item, "value": pa.array(f, pa.int64())}) for s, part, item, f in out]
    return pa.concat_tables(tables)


def audit_sources(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: divergences of sources (part pair) and the terms that set each apart (term).

    Null texts, languages and sources count as ''. A language keeps the terms in at least ten of its documents (rows:
    repeated ones count each). A group that has no terms, or a language that keeps none, still has its pairs (then of
    value 0 in the latter); a language of one source has no pairs; an empty table gives no rows. Ties rank by the item's
    UTF-8. Other columns are left behind, whatever their names.
    """
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    # A term's rows, one for each source, give its language's sums and, on one of them, the term itself.
    term = Window.partitionBy("lang", "term").orderBy("source")
    every = term.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = counts.select("lang", "source", "term", "count", F.sum("count").over(every).alias("lang_count"), F.sum("docs").over(every).alias("n_docs"), (F.row_number().over(term) == 1).alias("first"))
    rows = materialize(met.where(F.col("n_docs") >= LEAST_DOCS).drop("n_docs"), "kept")
    # One row for each group: its words, and its language's words, terms and numbers of blocks.
    occur = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    n = rows.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    terms = rows.where("first").select("lang", "term", "lang_count")
    per_lang = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("n_lang"))
    n_sources = occur.groupBy("lang").agg(F.count("*").alias("n_sources"))
    langs = n_sources.join(per_lang, "lang", "left").na.fill(0, ["v", "n_lang"])
    blocks = lambda c, size: F.greatest(F.ceil(F.col(c) / size), F.lit(1))
    langs = materialize(langs.withColumn("n_tb", blocks("v", TERMS)).withColumn("n_gb", blocks("n_sources", SOURCES)), "langs")
    deal = lambda c, into: F.pmod(F.xxhash64(c), F.col(into))
    sizes = terms.join(langs, "lang").groupBy("lang", deal("term", "n_tb").alias("tb")).agg(F.count("*").alias("n_terms"))
    tiles = langs.select("lang", "v", "n_lang", "n_gb", "n_tb", F.explode(F.sequence(F.lit(0), F.col("n_tb") - 1)).alias("tb"))
    tiles = tiles.join(sizes, ["lang", "tb"], "left").na.fill(0, ["n_terms"])
    groups = occur.join(n, ["lang", "source"], "left").na.fill(0, ["n"]).join(langs.select("lang", "n_gb"), "lang")
    groups = groups.withColumn("gb", deal("source", "n_gb")).drop("n_gb")

    def paired(df: DataFrame) -> DataFrame:
        """Each row once for each pair of blocks of sources that its own block is in."""
        other = F.explode(F.sequence(F.lit(0), F.col("n_gb") - 1)).alias("_other")
        return df.select("*", other).withColumn("gi", F.least("gb", "_other")).withColumn("gj", F.greatest("gb", "_other")).drop("_other", "n_gb")

    sides = paired(groups.join(tiles, "lang")).select("lang", "tb", "gi", "gj", "gb", "source", "n", "v", "n_lang", "n_terms")
    dealt = rows.drop("first").join(langs.select("lang", "n_gb", "n_tb"), "lang").withColumn("gb", deal("source", "n_gb")).withColumn("tb", deal("term", "n_tb")).drop("n_tb")
    tile = ["lang", "tb", "gi", "gj"]
    found = paired(dealt).groupBy(*tile).cogroup(sides.groupBy(*tile)).applyInArrow(_tile, "lang string, source string, part string, item string, value long")
    parts = materialize(found, "tiles")
    item = ["lang", "source", "part", "item"]
    pairs = parts.where("part = 'pair'").groupBy(*item).agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    best = parts.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
