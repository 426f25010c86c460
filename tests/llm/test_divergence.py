import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from varqa.llm import divergence as D
from varqa.llm.divergence import audit_sources, shares, terms_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows):
    """The contract, read plainly, over (text, lang, source)."""
    words = [(lang or "", source or "", [w.translate(LOWER) for w in TERM.findall(text or "")]) for text, lang, source in rows]
    out = []
    for lang in {w[0] for w in words}:
        docs, counts = Counter(), defaultdict(Counter)
        for _, s, w in (x for x in words if x[0] == lang):
            docs.update(set(w))
            counts[s].update(w)
        kept = sorted(t for t, n in docs.items() if n >= 10)

        def p(c, n=None):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        of = {s: p(c) for s, c in counts.items()}
        whole = p(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in of:
            pairs = [(-sum(f(of[s][t], of[o][t]) for t in kept), o.encode(), o) for o in of if o != s]
            terms = [(-f(of[s][t], whole[t]), t.encode(), t) for t in kept if counts[s][t] and of[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def audited(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    return sorted(tuple(r) for r in audit_sources(docs).collect())


def corpus(seed, n, n_sources, n_terms):
    r = np.random.default_rng(seed)
    terms = [f"{'éab文z'[i % 5]}{'xyz'[i % 3] * (i // 5 % 7)}{chr(97 + i % 26)}" for i in range(n_terms)]
    return [(" ".join(r.choice(terms, r.integers(0, 40))), ["en", "de", None][r.integers(3)], [None, *(f"s{i}" for i in range(n_sources))][r.integers(n_sources + 1)]) for _ in range(n)]


def test_terms():
    texts = ["", "a", " ", "Don't STOP-me ÀÉ x9y \x7f\x00Z 文字、か", "ends", "Starts İ K  b", "a\x1cb\x85c", ""]
    raw = [t.encode() for t in texts]
    words, doc = terms_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert list(zip(doc.tolist(), (w.decode() for w in words.to_pylist()))) == [(i, w.translate(LOWER)) for i, t in enumerate(texts) for w in TERM.findall(t)]


def test_shares_are_exact_beyond_64_bits():
    r = np.random.default_rng(1)
    total = r.integers(1, 9 * 10**15, 2000)
    count = (r.random(2000) * total).astype(np.int64)
    assert shares(count, total).tolist() == [1 + 10**9 * (c + 2) // t for c, t in zip(count.tolist(), total.tolist())]


@pytest.mark.parametrize("blocks", [(256, 64), (7, 2), (1, 1)])
def test_equals_brute_force_for_any_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(D, "TERMS", blocks[0])
    monkeypatch.setattr(D, "SOURCES", blocks[1])
    rows = corpus(3, 300, 4, 40)
    assert audited(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = corpus(5, 150, 3, 30) + [(None, "en", "silent"), ("", None, None), (None, "xx", "a"), ("rare words here", "xx", "b"), ("one", "yy", "only")]
    rows += [("Same same text", "tie", s) for s in ("a", "b", "é", "z") for _ in range(12)] + [("long wörds " * 100_000, "en", "s0")] * 2
    got = audited(spark, rows)
    assert got == brute(rows)
    assert ("xx", "a", "pair", "b", 0, 1) in got and not [r for r in got if r[0] == "yy"]
    assert [r[3] for r in got if r[:3] == ("tie", "b", "pair")] == ["a", "z", "é"]


def test_other_columns_and_empty_tables(spark):
    rows = corpus(9, 60, 2, 8)
    wide = spark.createDataFrame([(*r, 1, "x", None) for r in rows], "text string, lang string, source string, value long, term string, gb int")
    assert sorted(tuple(r) for r in audit_sources(wide).collect()) == brute(rows)
    assert audit_sources(wide.limit(0)).collect() == []


@pytest.mark.parametrize(("held", "slice_bytes"), [(5, 40), (60, 7), (10**6, 1)])
def test_slices_and_flushes_do_not_matter(spark, monkeypatch, held, slice_bytes):
    monkeypatch.setattr(D, "HELD", held)
    monkeypatch.setattr(D, "SLICE", slice_bytes)
    rows = corpus(11, 120, 3, 25)
    batch = pa.record_batch([pa.array([r[i] or "" for r in rows]) for i in (1, 2, 0)], ["lang", "source", "text"])

    class Docs:  # the function that the workers run, without workers
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    got, want = Counter(), Counter()
    for b in D.term_counts(Docs())(iter([batch.slice(0, 50), batch.slice(50)])):
        for r in b.to_pylist():
            got[r["lang"], r["source"], r["term"]] += np.array([r["count"], r["docs"]])
    for t, lang, s in rows:
        for w, n in Counter(x.translate(LOWER) for x in TERM.findall(t)).items():
            want[lang or "", s or "", w] += np.array([n, 1])
    assert {k: x.tolist() for k, x in got.items()} == {k: x.tolist() for k, x in want.items()}
