import random

import pytest

from varqa.functions.keys import similarity
from varqa.operators.linejoin import COMMON, gram_size, prefixes, shared_grams, similar_keys


def words(r, n, letters):
    return ["".join(r.choice(letters) for _ in range(r.choice((1, 2, 3, 4, 5, 7, 11, 18, 30)))) for _ in range(n)]


def edited(r, key, letters):
    for _ in range(r.randint(0, max(1, len(key) // 3))):
        i = r.randrange(len(key) + 1)
        key = key[:i] + r.choice(letters) * r.randint(0, 1) + key[i + r.randint(0, 1) :]
    return key


@pytest.mark.parametrize("least", [0.0, 0.3, 0.55, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0])
def test_equals_all_pairs(spark, least):
    r = random.Random(int(least * 100))
    pairs = []
    for script, letters in (("r", "abcdefgh"), ("u", "ابتثج文"), ("x", "ab")):
        mine = words(r, 60, letters)
        theirs = words(r, 30, letters) + [edited(r, k, letters) for k in mine]
        pairs.append((script, mine + mine[:3], theirs))
    left = spark.createDataFrame([(s, k) for s, a, _ in pairs for k in [*a, ""]], "script string, lk string")
    right = spark.createDataFrame([(s, k) for s, _, b in pairs for k in [*b, ""]], "script string, rk string")
    want = {(s, x, y): similarity(x, y) for s, a, b in pairs for x in a for y in b if x and y}
    want = {k: v for k, v in want.items() if v >= least and v > 0}
    got = similar_keys(left, right, least).collect()
    assert len(got) == len(want) and {(g.script, g.lk, g.rk): g.score for g in got} == want


def test_long_keys(spark):
    r = random.Random(5)
    a = ["".join(r.choice("abcdefghij") for _ in range(n)) for n in (150, 199, 200, 260, 700)]
    b = [edited(r, k[: len(k) * 9 // 10], "abcdefghij") for k in a] + a
    df = lambda x, c: spark.createDataFrame([("r", k) for k in x], f"script string, {c} string")
    for least in (0.55, 0.8, 0.9):
        want = {(x, y) for x in a for y in b if similarity(x, y) >= least}
        assert {(g.lk, g.rk) for g in similar_keys(df(a, "lk"), df(b, "rk"), least).collect()} == want


def test_prefixes_are_short_and_tables_may_be_empty(spark):
    import numpy as np

    key, none = "the quick brown fox jumps over it".replace(" ", ""), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert gram_size(0.9) == 4 and gram_size(0.85) == 3 and gram_size(0.8) == 2 and gram_size(0.6) == 1
    for t in (0.6, 0.8, 0.9):
        q = gram_size(t)
        token, of, least = prefixes([key, "a", ""], q, t, none)
        shared = shared_grams(np.array([len(key)]), q, t)[0]
        assert least[0] == min(shared, COMMON) and (of == 0).sum() == len(key) - q + 1 - shared + least[0] <= len(key)
    empty = spark.createDataFrame([], "script string, lk string")
    right = spark.createDataFrame([("r", "abc")], "script string, rk string")
    assert similar_keys(empty, right, 0.8).count() == 0 and similar_keys(right.withColumnRenamed("rk", "lk"), empty.withColumnRenamed("lk", "rk"), 0.8).count() == 0


def test_a_small_side_is_held_and_large_sides_are_joined(spark, monkeypatch):
    """Both ways give the pairs of all; through a small side no more than the pairs found is shuffled."""
    from varqa.operators import linejoin as L

    r = random.Random(8)
    mine = words(r, 40, "abcdefgh") + ["x" * 40, "abcabcabcabcabcabcabc"]
    theirs = words(r, 20, "abcdefgh") + [edited(r, k, "abcdefgh") for k in mine] + ["y" * 400]
    df = lambda x, c: spark.createDataFrame([("r", k) for k in x], f"script string, {c} string")
    want = {(x, y) for x in mine for y in theirs if x and y and similarity(x, y) >= 0.9}
    assert L._held_keys(df(mine, "lk"), "lk") == {"r": sorted(set(mine))}
    for held in (L.HELD, 50, 0):
        monkeypatch.setattr(L, "HELD", held)
        got = similar_keys(df(mine, "lk"), df(theirs, "rk"), 0.9).collect()
        assert {(g.lk, g.rk) for g in got} == want and len(got) == len(want)


def test_repeated_keys_of_a_small_side_count_once(spark, monkeypatch):
    from varqa.operators import linejoin as L

    monkeypatch.setattr(L, "HELD", 5)
    df = spark.createDataFrame([("r", k) for k in ["abcdefgh", "bcdefghi", "", "cdefghij"] * 6], "script string, lk string")
    assert L.held_keys(df, "lk", 0.9) == {"r": ["abcdefgh", "bcdefghi", "cdefghij"]}
    assert L.held_keys(df, "lk", 0.0) is None and L.held_keys(df.unionByName(spark.range(9).selectExpr("'r' script", "repeat('x', id) lk")), "lk", 0.9) is None


@pytest.mark.parametrize("least", [0.75, 0.8, 0.85, 0.9, 1.0])
@pytest.mark.parametrize("small", [False, True])
def test_keys_like_lose_no_pair(spark, monkeypatch, least, small):
    from varqa.functions.keys import arabic_key, latin_key
    from varqa.operators import linejoin as L

    if small:  # every key is a slice and a block of its own, and hashes meet
        for name, n in (("CHARS", 1), ("CELLS", 1), ("PAIRS", 1), ("SLOTS", 16), ("BUCKETS", 3)):
            monkeypatch.setattr(L, name, n)
    r = random.Random(int(least * 100))
    held = {"r": sorted({k for k in map(latin_key, words(r, 60, "abcdefgh")) if k}), "u": sorted({k for k in map(arabic_key, words(r, 40, "ابتثجح")) if k})}
    near = {s: [edited(r, r.choice(k), "xyz" if s == "r" else "زس") for _ in range(60)] for s, k in held.items()}
    text = lambda s, letters: "\n".join(r.choice([*near[s], "", " ", *words(r, 3, letters)]) for _ in range(4))
    rows = [(i, r.choice([None, "", text("r", "mnopqrst")]), r.choice([None, text("u", "شصضطظع")])) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, a string, b string").coalesce(2)
    parts = [("title", "r", "a", "latin_key", False), ("lines", "r", "a", "latin_key", True), ("lines", "u", "b", "arabic_key", True)]
    mine = [(i, part, s, key(x)) for i, a, b in rows for part, s, t, key in (("title", "r", [a or ""], latin_key), ("lines", "r", (a or "").split("\n"), latin_key), ("lines", "u", (b or "").split("\n"), arabic_key)) for x in t]
    mine = [x for x in mine if x[3]]
    want = [x for x in mine if any(similarity(h, x[3]) >= least or similarity(x[3], h) >= least for h in held[x[2]])]
    got = [tuple(x) for x in L.keys_like(df, "id", parts, held, least).collect()]
    left = list(mine)
    for x in got:
        left.remove(x)  # each is a key of a text, and comes once for each time it stands there
    assert want and not any(x in left for x in want)
