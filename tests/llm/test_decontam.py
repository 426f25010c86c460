import random

import numpy as np
import pytest

from varqa.llm.decontam import EDITS, Pieces, _norm_one, banded_edits, decontaminate, find, find_runs, leaks, qgrams


def semi_global(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_qgram_hashes_are_equal_just_for_equal_grams():
    x = np.frombuffer(b"abcabcabcdabcabcabcd" * 3, np.uint8)
    h = qgrams(x)
    grams = [x[i : i + 10].tobytes() for i in range(len(x) - 9)]
    assert len(h) == len(grams) and all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(len(h)) for j in range(len(h)))


def test_banded_alignment_matches_the_full_table():
    rng = random.Random(5)
    for _ in range(200):
        p = bytes(rng.choice(b"abc") for _ in range(rng.randint(20, 60)))
        t = bytearray(p)
        for _ in range(rng.randint(0, 6)):
            i = rng.randrange(len(t))
            match rng.randrange(3):
                case 0:
                    t[i] = rng.choice(b"abc")
                case 1:
                    del t[i]
                case _:
                    t.insert(i, rng.choice(b"abc"))
        t = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 8))) + bytes(t) + b"cba"
        want = semi_global(p, t)
        got, end = banded_edits(np.frombuffer(p, np.uint8), np.frombuffer(t, np.uint8), 6)
        assert got == min(want, 7) and (end >= 0) == (want <= 6)


def test_finds_all_regions_that_brute_force_finds(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: _norm_one(r.text).tobytes() for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, p in items.items() if p in _norm_one(r.text).tobytes()}
    got = leaks(docs, bench).collect()
    assert want and {(r.doc_id, r.item_id) for r in got if r.pieces == r.of_pieces and r.edits == 0} == want
    text, item = {r.doc_id: r.text for r in docs.collect()}, {r.item_id: r.text for r in bench.collect()}
    for r in got:
        if r.edits == 0 and r.pieces == r.of_pieces:
            assert _norm_one(text[r.doc_id][r.start : r.end]).tobytes() == items[r.item_id] and item
    flagged = {r.doc_id for r in got}
    assert {r.doc_id for r in decontaminate(docs, bench).collect()} == set(text) - flagged


def test_edited_copies_are_found_and_others_are_not():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    item = " ".join(word() for _ in range(40))
    pieces = Pieces([(1, item)])
    for edits in (0, 3, 6):
        t = list(item)
        for _ in range(edits):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        text = (" ".join(word() for _ in range(30)) + " " + "".join(t).upper() + "\n" + " ".join(word() for _ in range(30))).encode()
        assert find(np.frombuffer(text, np.uint8), np.array([0, len(text)]), pieces), edits
    text = " ".join(word() for _ in range(5000)).encode()
    assert not find(np.frombuffer(text, np.uint8), np.array([0, len(text)]), pieces)
    assert int(120 * EDITS) == 9


def test_nulls_empty_tables_and_other_columns(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again and again"), (2, None), (None, "x" * 99), (None, "ask me no more"), (3, "short")], "item_id long, text string")
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "THE QUICK  brown fox, jumps over the lazy dog again and again", "c"), (4, "é" * 100000 + " the quick brown fox jumps over the lazy dog again and again", "d"), (4, "clean", "d"), (6, "y " + "x" * 99, "e"), (7, "Ask me no more!", "f")], "doc_id long, text string, item_id string")
    got = {(r.doc_id, r.item_id, r.start) for r in leaks(docs, bench).collect()}
    assert got == {(None, 1, 0), (4, 1, 100001), (6, None, 0), (7, None, 0)}
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == 3
    assert leaks(docs.limit(0), bench).count() == 0 and leaks(docs, bench.limit(0)).count() == 0


def test_verbatim_passages_of_13_words_are_found_at_every_offset():
    rng = random.Random(3)
    for letters, gap in (("abcdefghijklmnop", " "), ("абвгдежзиклмноп", " "), ("的一是不了人我在有他这中大来上", "")):
        word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8) if gap else 1))
        w = [word() for _ in range(60)]
        pieces = Pieces([(7, gap.join(w)), (8, gap.join(word() for _ in range(60)))])
        for size in (12, 13, 14, 20, 29):
            passages = [gap.join(w[i : i + size]) for i in range(len(w) - size + 1)]
            raw = [f"zz{i}, {p}. yy".encode() for i, p in enumerate(passages)]
            flat, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
            got = {(d, item, raw[d][s:e].decode()) for d, item, s, e in find_runs(flat, offsets, pieces)}
            assert got == ({(d, 7, p) for d, p in enumerate(passages)} if size >= 13 else set())
            if gap:  # the first word is another
                cut = np.frombuffer(b"".join(r.replace(b", ", b", q") for r in raw), np.uint8), offsets + np.arange(len(offsets))
                assert {d for d, *_ in find_runs(*cut, pieces)} == (set(range(len(raw))) if size > 13 else set())


def test_short_items_and_short_passages_leak(spark):
    item = "one of these words two of these words three of them four of all these words five of nothing else"
    bench = spark.createDataFrame([(1, item), (2, "Is it so?"), (3, " . "), (4, "ja")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a - WORDS two of these words three of them four of all these words, b"), (2, "and is it so"), (3, "this it so"), (4, "is it sour jam . "), (5, "words two of these words three")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.start, r.end, r.pieces, r.of_pieces, r.edits) for r in leaks(docs, bench).collect()}
    assert got == {(1, 1, 4, 66, 0, 1, 0), (2, 2, 4, 12, 1, 1, 0)}
    assert {r.doc_id for r in decontaminate(docs, bench).collect()} == {3, 4, 5}


def test_edited_passages_planted_in_documents_match_brute_force(spark, sf_dir):
    rng = random.Random(9)
    docs = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars between 300 and 700").orderBy("doc_id").collect()][:12]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect()][:4]
    pieces, made = Pieces(list(enumerate(items))), []
    for i, text in enumerate(docs):
        p, edits = bytearray(pieces.text[i % len(pieces.text)].tobytes()), i
        for _ in range(edits):
            at = rng.randrange(len(p))
            match rng.randrange(3):
                case 0:
                    p[at : at + 1] = b"q"
                case 1:
                    del p[at]
                case _:
                    p.insert(at, ord("q"))
        made.append((text[:150] + " " + p.decode("utf-8", "ignore") + " " + text[150:300]).encode())
    want = {(d, j) for d, t in enumerate(made) for j in range(len(pieces.text)) if semi_global(pieces.text[j].tobytes(), _norm_one(t.decode()).tobytes()) <= pieces.k[j]}
    got = {(d, j) for d, j, *_ in find(np.frombuffer(b"".join(made), np.uint8), np.cumsum([0, *map(len, made)]), pieces)}
    assert got == want and len({d for d, _ in want}) >= 8


def test_a_beginning_that_all_items_share_is_counted_in_bounded_parts(monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    head = "answer the following question with one letter only please "
    items = [(i, head + " ".join(word() for _ in range(25))) for i in range(300)]
    pieces = Pieces(items)
    texts = [(head + "and no more " * 5).encode(), items[7][1].encode(), (head * 20 + items[250][1]).encode()]
    flat, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = find(flat, offsets, pieces)
    monkeypatch.setattr("varqa.llm.decontam._PAIRS", 1000)
    assert find(flat, offsets, pieces) == whole
    assert {(d, pieces.item[p]) for d, p, *_ in whole} == {(1, 7), (2, 250)}


def _edited(r, passage, words, chars):
    """The passage with so many words replaced by others and so many characters by others."""
    w = passage.split(" ")
    for i in r.sample(range(len(w)), words):
        w[i] = "".join(r.choice("qxzjk") for _ in range(r.randint(3, 8)))
    t = list(" ".join(w))
    for i in r.sample([i for i, c in enumerate(t) if c != " "], chars):
        t[i] = "q" if t[i] != "q" else "z"
    return "".join(t)


@pytest.mark.parametrize(("n", "words", "chars", "least"), [(13, 0, 0, 1.0), (13, 0, 1, 0.95), (20, 0, 3, 0.95), (20, 1, 0, 0.95), (20, 2, 0, 0.9), (25, 2, 0, 0.95), (25, 0, 3, 0.95)])
def test_recall_of_edited_passages(spark, n, words, chars, least):
    """Passages cut from the given items at any word, edited, between words of other documents."""


    r = random.Random(n * 100 + words * 10 + chars)
    d = "/root/testdata/sf0.1"
    items = [x for x in spark.read.parquet(f"{d}/benchmark.parquet").collect() if len(x.text.split()) > n + 2]
    filler = [w for x in spark.read.parquet(f"{d}/documents.parquet").limit(50).collect() for w in x.text.split()]
    rows, want = [], []
    for i in range(120):
        item = r.choice(items)
        w = item.text.split()
        a = r.randrange(len(w) - n + 1)
        text = " ".join([*r.choices(filler, k=30), _edited(r, " ".join(w[a : a + n]), words, chars), *r.choices(filler, k=30)])
        rows.append((i, text))
        want.append((i, item.item_id))
    docs = spark.createDataFrame([*rows, *((1000 + i, " ".join(r.choices(filler, k=80))) for i in range(60))], "doc_id long, text string")
    found = {(x.doc_id, x.item_id) for x in leaks(docs, spark.read.parquet(f"{d}/benchmark.parquet")).collect()}
    assert sum(x in found for x in want) / len(want) >= least
    assert not [x for x in found if x[0] >= 1000]
    assert {x.doc_id for x in decontaminate(docs, spark.read.parquet(f"{d}/benchmark.parquet")).collect()} == set(range(120)) - {x[0] for x in found} | {1000 + i for i in range(60)}


def test_blocks_do_not_change_rows(spark, monkeypatch):
    from varqa.llm import decontam

    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen"), (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"), (None, "short and sweet"), (None, "other words here"), (3, "x")] + [(10 + i, f"item number {i} stands by itself in here and is not like the others of them all") for i in range(9)], "item_id long, text string")
    docs = spark.createDataFrame([(i, r.text + " . " + s.text) for i, (r, s) in enumerate((r, s) for r in bench.collect() for s in bench.collect())] + [(None, None)], "doc_id long, text string")
    want = sorted(map(str, leaks(docs, bench).collect())), sorted(map(str, decontaminate(docs, bench).collect()))
    monkeypatch.setattr(decontam, "INDEX_BYTES", 20_000)
    assert len(list(decontam._blocks(bench))) > 3
    assert want == (sorted(map(str, leaks(docs, bench).collect())), sorted(map(str, decontaminate(docs, bench).collect())))
