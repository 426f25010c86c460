import hashlib
import random

from varqa.llm.substrings import SuffixAutomaton, remove_repeats


def brute(rows, length=13):
    first, out = {}, []
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            first[k] = min(first.get(k, (True, 10**18)), (d is not None, d or 0))
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < (d is not None, d or 0):
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in remove_repeats(docs, **options).collect()), key=str) == brute(rows)


def test_automaton_finds_the_first_document():
    rng = random.Random(4)
    for _ in range(60):
        seqs = [(d, [rng.randrange(3) for _ in range(rng.randint(3, 25))]) for d in rng.sample(range(100), 4)]
        a = SuffixAutomaton()
        for d, s in sorted(seqs):
            a.add(s, d)
        a.settle()
        for _, s in seqs:
            want = [min(d for d, t in seqs if any(t[j : j + 3] == s[i : i + 3] for j in range(len(t) - 2))) for i in range(len(s) - 2)]
            assert a.first_documents(s, 3) == want


def test_documents_match_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(spark, rows)
    check(spark, rows, batch_bytes=20_000)
    check(spark, rows, batch_bytes=20_000, hot=3)


def test_few_words_in_many_orders(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice(["a", "b", "c d"]) for _ in range(60)) for _ in range(6)]
    rows = []
    for d in range(60):
        t = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice("abcx")
        i = rng.randrange(20)
        rows.append((d, " ".join(t[i : i + rng.randint(5, 60)])))
    check(spark, rows, batch_bytes=500)
    check(spark, rows, batch_bytes=500, hot=0)
    check(spark, rows, batch_bytes=500, hot=20)


def test_nulls_ties_and_white_space(spark):
    long = " ".join(f"w{i % 97}é" for i in range(3000))
    rows = [(5, long), (5, long), (7, "\x0b" + long + " x"), (None, long[:200]), (8, None), (9, ""), (10, " \t\n"), (11, "x" * 400_000 + " " + long)]
    check(spark, rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as batch", "2 as data")
    kept = {r.doc_id: r.kept for r in remove_repeats(docs, keep_text=True).collect()}
    assert kept[11].startswith("xxx") and kept[8] == ""
    assert remove_repeats(docs.limit(0)).count() == 0
