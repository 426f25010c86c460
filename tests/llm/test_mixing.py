import re
from collections import Counter, defaultdict

import pytest

from varqa.llm.mixing import mix, mix_copies, pivot


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        t = {s: most * sizes[s] if s in full else rest * w[s] / free for s in names}
        over = {s for s in names if s not in full and t[s] > most * sizes[s]}
        if not over:
            return t
        full |= over


def test_duels_keep_words_and_expectations():
    size, p = [50, 40, 40, 30, 20, 10, 5, 3, 2, 1], [0.3, 0.7, 0.5, 0.5, 0.25, 0.9, 0.1, 0.5, 0.5, 0.5]
    sums = [0.0] * len(p)
    for r in range(4000):
        out = pivot([r * 100 + i for i in range(len(p))], size, p, False)
        assert sum(0 < x < 1 for x in out) <= 1
        assert sum(a * b for a, b in zip(size, out)) == pytest.approx(sum(a * b for a, b in zip(size, p)))
        sums = [a + b for a, b in zip(sums, out)]
    assert all(abs(s / 4000 - x) < 0.04 for s, x in zip(sums, p))


def test_targets_and_takes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mix_copies(docs).collect()
    sizes, taken = Counter(), Counter()
    text = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id][0])) and r.taken in (0, r.size, 2 * r.size)
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert len(got) == 1000 and all(abs(taken[s] - want[s]) < 0.05 * want[s] + 30 for s in want)
    again = mix_copies(docs.repartition(5)).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in again}


def test_nulls_ties_and_other_columns(spark):
    rows = [(1, "a b c", None, 1), (1, "a b c", None, 2), (2, None, "s", 3), (3, "", "s", 4), (None, "x y", "t", 5), (None, "x y", "t", 5), (5, "w " * 20000, "t", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mix_copies(docs).collect()
    assert len(got) == 7 and all(r.taken <= 2 * r.size for r in got)
    assert {r.target for r in got if r.source == "s"} == {0.0}
    out = mix(docs)
    assert out.columns == docs.columns
    n = defaultdict(int)
    for r in out.collect():
        n[r.doc_id] += len((r.text or "").split())
    want = defaultdict(int)
    for r in got:
        want[r.doc_id] += r.taken
    assert {k: v for k, v in n.items() if v} == {k: v for k, v in want.items() if v}
    assert mix_copies(docs.limit(0)).count() == 0


def test_columns_of_any_name_come_back_as_they_were(spark):
    rows = [(1, "a b c", "s", 77, 5), (1, "a b c", "s", 88, 6), (2, "d e", "s", 99, 7), (None, "f g h", None, 11, 8), (None, "f g h", None, 12, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _n int, _copies int").selectExpr("*", "_n as row", "_n as h", "_n as `a.b`", "_n as _id", "_n as _copy")
    out = mix(docs, share=2.0).collect()
    assert mix(docs).columns == docs.columns
    assert sorted((r._n, r._copies, r.row, r.h, r._id, r._copy) for r in out) == sorted((n, c, n, n, n, n) for *_, n, c in rows for _ in range(2))
    assert mix(docs.limit(0)).count() == 0
