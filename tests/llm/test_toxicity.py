import math
import re
import zlib

import numpy as np

from varqa.llm.toxicity import LabelModel, choose_voters, fit_linear, reject_toxic, score_toxicity, train_toxicity, vote_matrix


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in score_toxicity(docs, train_toxicity(docs, labels)).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in got.items())
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.9


def test_label_model_finds_accuracies_and_correlations_without_gold_labels():
    rng, n = np.random.default_rng(0), 8000
    y = (rng.random(n) < 0.3).astype(int)
    vote = lambda hit, miss: np.where(y == 1, rng.random(n) < hit, rng.random(n) < miss).astype(float)
    known = [(0.7, 0.08), (0.6, 0.05), (0.8, 0.1), (0.5, 0.05), (0.65, 0.06)]
    own = [vote(*r) for r in known]
    follower = np.where(rng.random(n) < 0.9, own[1], vote(0.5, 0.05))  # mostly says what the second voter says
    m = LabelModel(np.stack([own[0], own[0], own[0], *own[1:], follower], 1), 0.3, rounds=60, abstain=False, anchor=0)
    for j, (hit, miss) in zip((0, 3, 4, 5, 6), known):
        assert abs(m.rate[1][j] - hit) < 0.12 and abs(m.rate[0][j] - miss) < 0.05, j
    assert min(m.correlation[0, 1], m.correlation[1, 2]) > 0.95 and m.correlation[3, 7] > 0.7
    assert max(abs(m.correlation[0, j]) for j in (3, 4, 5, 6)) < 0.25
    assert m.parent[7] == 3 or m.parent[3] == 7  # the follower hangs on the voter that it follows
    q = m.posterior(np.stack([own[0], own[0], own[0], *own[1:], follower], 1))
    assert np.mean((q > 0.5) == y) > 0.9


def test_label_model_counts_copies_once():
    rng, n = np.random.default_rng(1), 6000
    y = (rng.random(n) < 0.3).astype(int)
    vote = lambda: np.where(y == 1, rng.random(n) < 0.7, rng.random(n) < 0.1).astype(float)
    a, rest = vote(), [vote() for _ in range(4)]
    one, three = (LabelModel(np.stack(v, 1), 0.3, rounds=60, abstain=False, anchor=0) for v in ([a, *rest], [a, a, a, *rest]))
    logit = lambda p: np.log(p / (1 - p))
    p, q = one.posterior(np.array([[1.0, 0, 0, 0, 0]])), three.posterior(np.array([[1.0, 1, 1, 0, 0, 0, 0]]))
    assert abs(logit(q)[0] - logit(p)[0]) < 0.5
    assert fit_linear(a[:, None], one.posterior(np.stack([a, *rest], 1)))[0] > 0


def test_query_matches_brute_force_scores(spark, sf_dir):
    """Every voter's words counted by a plain search of the whole text, then the linear model by its formula."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not model.voters:
        model = train_toxicity(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    got = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    assert model.voters and len(got) == docs.count()
    for r in docs.collect():
        hits = []
        for v in model.voters:
            n = 0
            for token in r.text.lower().split():
                mine = re.findall(r"[^\W\d_]+", token)
                n += any(w == v[:-1] if v.endswith("$") else w.startswith(v) for w in mine)
            hits.append(n)
        words, total = len(r.text.split()), sum(hits)
        z = sum(w * math.log1p(n) for w, n in zip(model.weights, hits))
        more = (math.log1p(total), math.log1p(100 * total / max(words, 20)), math.log1p(sum(n > 0 for n in hits)))
        z += sum(w * x for w, x in zip(model.weights[len(hits) :], more)) + model.weights[-1]
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-max(min(z, 30), -30)))) < 1e-9, r.doc_id


def test_voters_are_the_stems():
    rows = [("vequ", 150, 1), ("veq", 150, 40), ("vequai", 60, 0), ("the", 100, 1000), ("idiot", 90, 0), ("idiot$", 88, 0)]
    assert choose_voters(rows, 200, 1500) == ["vequ", "idiot"]


def test_nulls_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(i, ("you idiot " if i % 3 == 0 else "a kind word ") * 5 + f"w{i}", i) for i in range(200)] + [(None, "you idiot " * 5, 0), (500, None, 1), (501, "", 2)], "doc_id long, text string, score long")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(501, None), (None, 1)], "doc_id long, toxic int")
    m = train_toxicity(docs, labels)
    got = score_toxicity(docs, m)
    assert got.count() == 203 and got.columns == ["doc_id", "held_out", "score", "predicted"]
    kept = reject_toxic(docs, m)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in range(200) if i % 3} | {500, 501}
    flat = train_toxicity(docs, labels.limit(0))
    assert {r.predicted for r in score_toxicity(docs, flat).collect()} == {0}
    assert score_toxicity(docs.limit(0), m).count() == 0


def test_shipped_setting_on_held_out_rows(spark):
    """The label model as it is trained (silence as a vote, anchored first posteriors, no gold start)."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in score_toxicity(docs, train_toxicity(docs, labels)).collect()}
    held = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    x, y = np.array([s for s, _ in held]), np.array([t for _, t in held])
    rank = np.argsort(np.argsort(x))
    n = (y == 1).sum()
    auc = (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (y == 0).sum())
    assert auc >= 0.967 and np.mean(x[y == 1] >= 0.5) >= 0.92 and np.mean(x[y == 0] >= 0.5) <= 0.015


def test_a_lone_voter_of_a_small_group_is_not_explained_away():
    """Toxic rows are mostly of a group with ten voters; two small groups have one voter each, clean rows are silent."""
    rng, n = np.random.default_rng(2), 6000
    y = rng.random(n) < 0.1
    group = rng.choice(3, n, p=(0.6, 0.2, 0.2))
    own = [y & (group == 0) & (rng.random(n) < 0.6) for _ in range(10)] + [y & (group == g) for g in (1, 2)]
    counts = np.stack(own, 1) * rng.choice([1, 3, 9], (n, 12))
    votes = vote_matrix(counts, np.full(n, 300))[:, :36]  # those of counts alone
    q = LabelModel(votes, y.mean()).posterior(votes)
    assert all(np.mean(q[y & (group == g)] >= 0.5) > 0.95 for g in range(3)) and np.mean(q[~y] >= 0.5) < 0.01


def test_votes_of_counts_and_shares():
    got = vote_matrix(np.array([[0, 0], [1, 0], [3, 4]]), np.array([50, 1000, 100]))
    assert [np.flatnonzero(r).tolist() for r in got] == [[], [0], [2, 5, 10]]  # 0.1 in a hundred is no vote, 7 the last
