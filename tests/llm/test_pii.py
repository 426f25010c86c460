import hashlib
import random
import re

import numpy as np
import pytest

from varqa.llm.pii import KINDS, WINDOW, BiLstmCrf, _labelled, _piece, base_spans, detect_pii, find_pii, luhn, reconcile, stretches, teacher, train_pii, trained, windows

BRUTE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, p in BRUTE.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind != "ip" or all(int(x) <= 255 for x in m[0].split("."))) and (kind != "card" or 13 <= len(d) <= 19 and luhn(d)) and (kind != "phone" or 9 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_patterns_match_plain_regexes():
    rng = random.Random(3)
    for _ in range(3000):
        t = "".join(rng.choice("ab@@..-+%_ ()0123456789é\n") for _ in range(rng.randint(0, 80)))
        assert base_spans(t) == brute(t), t
    assert base_spans("x 4111 1111 1111 1111, +1 (743) 555-3824 a@b.c@d.e 1.2.3.4.5.6.7.8") == brute("x 4111 1111 1111 1111, +1 (743) 555-3824 a@b.c@d.e 1.2.3.4.5.6.7.8")


def test_gradient_is_right():
    net = BiLstmCrf()
    x, y = _labelled(3, 1)
    x, y = x[:, :10], y[:, :10]
    _, grad = net.step(x, y)
    for k in ("o", "t", "w", "b", "e", "s"):
        i = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        old, h = net.p[k][i], np.float32(1e-2)
        net.p[k][i] = old + h
        up, _ = net.step(x, y)
        net.p[k][i] = old - h
        down, _ = net.step(x, y)
        net.p[k][i] = old
        assert abs((up - down) / (2 * h) - grad[k][i]) < 0.05 * abs(grad[k][i]) + 1e-3, k


def test_held_out_sentences():
    x, y = _labelled(300, 99)
    got = trained().decode(x)
    assert np.mean(got == y) > 0.95
    inside = y > 0
    assert np.mean((got > 0)[inside]) > 0.85 and np.mean((got == 0)[~inside]) > 0.95


def test_model_adds_forms_that_the_patterns_miss():
    ((base, every),) = find_pii(["please call the office (743) 555-3824 today or 212-555-0188 at night"], trained())
    assert not base and {"phone"} == {k for k, _, _ in every}


def test_windows_cover_all_triggers_and_reconcile():
    t = "a" * 100 + "1" * 500 + "b" * 100 + "@"
    cover = set()
    for s, e in windows(t):
        assert e - s <= WINDOW
        cover |= set(range(s, e))
    assert all(i in cover for i, c in enumerate(t) if c in "1@")
    tags = np.zeros(96, np.int64)
    tags[40:60], tags[40] = 2, 1
    other = np.zeros(96, np.int64)
    other[:12], other[0] = 2, 1
    assert reconcile([(0, 96, tags), (48, 144, other)]) == [("email", 40, 60)]


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = detect_pii(docs).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = sorted(brute(text[r.doc_id]), key=lambda x: (KINDS.index(x[0]), x[1]))
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in KINDS]
        assert not set(said.split(",")) - set(r.spans.split(","))


def test_nulls_ties_long_texts_and_other_columns(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "a@b.co " * 20000, 5), (3, "1.2.3.4", 5), (None, "é +49 123 456 789", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_ip int")
    got = {(r.doc_id, r.n_email, r.n_ip, r.n_phone) for r in detect_pii(docs).collect()}
    assert got == {(1, 0, 0, 0), (2, 0, 0, 0), (3, 20000, 0, 0), (3, 0, 1, 0), (None, 0, 0, 1)}
    assert detect_pii(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def held_out(spark):
    """A network trained on four fifths of the documents, and the texts of the rest."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return train_pii(docs.where("doc_id % 5 <> 0")), [r.text for r in docs.where("doc_id % 5 = 0").orderBy("doc_id").collect()]


def test_forms_planted_in_held_out_texts(held_out):
    net, texts = held_out
    rng, words, made, gold = random.Random(5), " ".join(texts).split(), [], []
    for _ in range(500):
        piece, spans = _piece(rng)
        k = rng.randint(0, len(words) - 40)
        before = " ".join(words[k : k + 12]) + " "
        made.append(before + piece + " " + " ".join(words[k + 12 : k + 24]))
        gold.append([(a, s + len(before), e + len(before)) for a, s, e in spans] + [x for x in teacher(before) if x[2] < len(before)])
    got = [every for _, every in find_pii(made, net)]
    right = sum(x in every for want, every in zip(gold, got) for x in want)
    assert right / sum(map(len, gold)) > 0.9
    assert right / sum(map(len, got)) > 0.9


def test_secrets_of_held_out_documents_are_added(held_out):
    net, texts = held_out
    named = found = added = 0
    for text, (base, every) in zip(texts, find_pii(texts, net)):
        want = {x for x in teacher(text) if x[0] == "secret"}
        named, found, added = named + len(want), found + len(want & set(every)), added + len(every) - len(base)
    assert named and found / named > 0.9 and found / added > 0.9


def test_a_number_that_runs_into_another_is_found(held_out):
    ((base, every),) = find_pii(["un. Des +1 (826) 555-4081 190.137.22.204 du la"], held_out[0])
    assert [k for k, _, _ in base] == ["ip"] and ("phone", 8, 25) in every


def test_windows_reach_over_whole_runs_and_keep_labels():
    t = "see " + "a" * 60 + "@" + "b" * 60 + ".example.com now"
    (s, e) = windows(t)[0][0], windows(t)[-1][1]
    assert s == 0 and e == len(t)
    assert stretches("x +1 (555) 123-4567 y") == [("x +1 (555) 123-4567 y", [("phone", 2, 19)])]


def test_an_empty_table_trains_on_generated_windows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert train_pii(none).p["e"].shape[0] == 130 and detect_pii(none).collect() == []
