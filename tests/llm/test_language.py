import re
import zlib
from collections import Counter

import numpy as np

from varqa.llm.language import Profiles, gram_counts, learn_profiles, predict_language, ranked


def brute_grams(text):
    s = re.sub(r"[\W\d_]+", "\0", "\0" + text.lower() + "\0")
    c = Counter(s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1))
    return {g: n for g, n in c.items() if g.strip("\0")}


def test_counts_match_brute_force():
    for t in ("", "a", "Ab ba!! ab", "été, straße 99 x_y", "the cat sat on the mat\n" * 50):
        keys, counts = gram_counts(t)
        unpack = lambda k: "".join(chr(k >> s & 0x1FFFFF) for s in (42, 21, 0))
        got = Counter()
        for k, n in zip(keys.tolist(), counts.tolist()):
            got[unpack(k).strip("\0")] += n
        want = Counter()
        for g, n in brute_grams(t).items():
            want[g.strip("\0")] += n
        assert set(got) == set(want)


def test_out_of_place_distance():
    p = Profiles({"x": np.array([5, 7, 9], np.uint64), "y": np.array([9, 5], np.uint64)}, 3)
    assert p.langs == ["x", "y"] and p.rank.tolist() == [[0, 1], [1, -1], [2, 0]]
    assert ranked(np.array([3, 1, 2], np.uint64), np.array([5, 5, 9]), 2).tolist() == [2, 1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in predict_language(docs, learn_profiles(docs)).collect()}
    held = [(got[r.doc_id].lang_pred, r.lang) for r in docs.collect() if got[r.doc_id].held_out]
    assert len(held) > 150 and np.mean([a == b for a, b in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 for d, r in got.items())


def test_nulls_ties_and_other_columns(spark):
    rows = [(i, "the cat and the dog " * 3 if i % 2 else "der hund und die katze " * 3, "en" if i % 2 else "de", 0.5) for i in range(60)]
    rows += [(100, None, None, 1.0), (101, "123 !!", "en", 1.0), (None, "the dog", None, 1.0), (102, "der die und " * 60000, None, 1.0), (102, "der die und " * 60000, None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    m = learn_profiles(docs)
    got = predict_language(docs, m).collect()
    by = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == 65 and by[100] == by[101] == "und" and by[None] == "en" and by[102] == "de"
    assert {r.lang_pred for r in predict_language(docs, learn_profiles(docs.limit(0))).collect()} == {"und"}
    assert predict_language(docs.limit(0), m).count() == 0


def packed(text):
    """Counts by packed n-gram, from plain strings: a boundary is 0, so a leading one doesn't show."""
    s, out = re.sub(r"[\W\d_]+", "\0", "\0" + text.lower() + "\0"), Counter()
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            key = 0
            for c in s[i : i + n]:
                key = key << 21 | ord(c)
            out[key] += key > 0
    return +out


def test_counts_by_gram_match_brute_force():
    for t in ("", "a", "Ab ba!! ab", "été, straße 99 x_y", "the cat sat on the mat\n" * 50):
        keys, counts = gram_counts(t)
        assert dict(zip(keys.tolist(), counts.tolist())) == dict(packed(t)), t


def test_query_matches_brute_force(spark, sf_dir):
    """Profiles, out-of-place distances and predictions of every document, all from plain counters."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    total = {}
    for d, t, lang in rows:
        if lang is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            total.setdefault(lang, Counter()).update(packed(t))
    order = lambda c: [k for k, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:400]]
    ranks = {lang: {g: i for i, g in enumerate(order(c))} for lang, c in total.items()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict_language(docs, learn_profiles(docs)).collect()}
    for d, t, _ in rows:
        mine = order(packed(t))
        away = {lang: sum(abs(r[g] - i) if g in r else 400 for i, g in enumerate(mine)) for lang, r in ranks.items()}
        best = min(sorted(away), key=lambda x: away[x])
        assert got[d] == ((best, 1 - away[best] / (400 * len(mine))) if mine else ("und", 0.0)), d
