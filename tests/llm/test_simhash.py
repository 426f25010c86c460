import itertools
import random

import numpy as np
import pytest
import xxhash

from varqa.llm.simhash import covering_edges, local_components, masks, near_dedup, simhash_components


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, radius=4):
    fp = {d: brute_fp(t) for d, t in rows}
    comp = {d: d for d in fp}

    def root(d):
        while comp[d] != d:
            d = comp[d]
        return d

    for a, b in itertools.combinations(sorted(fp), 2):
        if (fp[a] ^ fp[b]).bit_count() <= radius:
            x, y = root(a), root(b)
            comp[max(x, y)] = min(x, y)
    return {(d, f"{fp[d]:016x}", root(d)) for d in fp}


def test_every_pair_within_the_radius_meets_in_some_table():
    rng = random.Random(1)
    tables = [m & (2**64 - 1) for m in masks(4)]
    assert len(tables) == 31
    for _ in range(2000):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(1, 4)):
            y ^= 1 << b
        assert any(x & m == y & m for m in tables)


def test_large_bucket_is_split_exactly():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fp = np.unique(np.concatenate([base[rng.integers(0, 40, 5000)] ^ (np.uint64(1) << rng.integers(0, 64, 5000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 5000).astype(np.uint64)), base]))
    got = local_components(fp, 4)
    want = {}
    dist = np.bitwise_count(fp[:, None] ^ base[None, :]).argmin(1)  # members are 2 bits from a base: one component for each
    for g, w in zip(got.tolist(), dist.tolist()):
        assert want.setdefault(w, g) == g
    assert len(set(want.values())) == 40


def test_components_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {tuple(r) for r in simhash_components(docs).collect()} == brute(rows)


def test_nulls_ties_and_other_columns(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "A b c", "z"), (4, "a B c", "z"), (4, "a B c", "z"), (None, "a b c", "q"), (7, "w " * 50000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in simhash_components(docs).collect())
    assert got == [(False, 1, 1), (False, 2, 1), (False, 3, 3), (False, 4, 3), (False, 4, 3), (False, 7, 7), (True, 0, 3)]
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [1, 3, 7]  # the row without an id is near 3


def test_empty_table(spark):
    assert simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_without_ids_and_clashing_names(spark):
    rows = [(None, "a b c d e", 7, 77), (None, "a b c d e", 8, 88), (None, "quite other words than those", 9, 99), (5, "one more text of this kind", 1, 11), (5, "one more text of this kind", 2, 12), (5, "words that no other row has", 3, 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _first int, `h` int").selectExpr("*", "1 as `a.b`", "_first as row", "h as n")
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == 4 and all(r.h % 11 == 0 or r.h in (11, 12, 13) for r in got) and all(r.row == r._first and r.n == r.h for r in got)
    assert sorted(r.text for r in got) == sorted({t for _, t, *_ in rows})
    assert near_dedup(docs.limit(0)).count() == 0


def test_a_bucket_over_many_arrow_batches(spark):
    fps = sorted({0x0123456789ABCDEF ^ 1 << a ^ 1 << b for a, b in itertools.combinations(range(0, 60, 3), 2)})
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        edges = [(r.src, r.dst) for r in covering_edges(table, 4).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    reached, todo = {fps[0]}, [fps[0]]
    while todo:
        x = todo.pop()
        new = {b for a, b in edges if a == x} | {a for a, b in edges if b == x}
        todo += new - reached
        reached |= new
    assert reached == set(fps) and all((a ^ b).bit_count() <= 64 for a, b in edges)
