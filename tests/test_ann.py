import numpy as np
import pytest

from varqa.operators import ann
from varqa.operators.ann import build_index, open_index, search_index
from varqa.operators.vectors import nearest


def recall(got, want):
    hits = {(r.query_id, r.vec_id) for r in got} & {(r.query_id, r.vec_id) for r in want}
    return len(hits) / len(want)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    path = str(tmp_path_factory.mktemp("index") / "i")
    build_index(e, path, "m1")
    return e, path


def test_recall_at_five(spark, index):
    e, path = index
    q = e.where("vec_id % 20 = 0").selectExpr("vec_id as query_id", "embedding")
    want, got = nearest(q, e, 5).collect(), search_index(q, path, "m1", 5).collect()
    assert recall(got, want) >= 0.9
    exact = {(r.query_id, r.vec_id): r.score for r in want}
    assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-9 for r in got if (r.query_id, r.vec_id) in exact)
    full = search_index(q, path, "m1", 5, probes=10_000).collect()
    assert recall(full, want) >= 0.98 and len(full) == len(want)


def test_every_row_is_stored_and_the_model_is_checked(spark, index):
    e, path = index
    stored = spark.read.parquet(f"{path}/vectors")
    assert stored.select("vec_id").exceptAll(e.select("vec_id")).count() == 0 and stored.count() == e.count()
    lists = spark.read.parquet(f"{path}/lists").collect()
    assert sum(r.n for r in lists) == e.count() and 30 < len(lists) < 60
    with pytest.raises(ValueError, match="made by m1"):
        search_index(e.selectExpr("vec_id as query_id", "embedding"), path, "m2", 5)
    q, probes = open_index(spark, path, "m1")
    assert q.books.shape == (8, 256, 8) and 1 < probes < len(lists)


def test_small_groups_give_the_same(spark, index, monkeypatch):
    e, path = index
    q = e.where("vec_id % 100 = 0").selectExpr("vec_id as query_id", "embedding")
    want = sorted(map(tuple, search_index(q, path, "m1", 3, probes=10_000).collect()))
    monkeypatch.setattr(ann, "ROWS", 17)
    monkeypatch.setattr(ann, "QUERIES_HELD", 3)
    got = sorted(map(tuple, search_index(q, path, "m1", 3, probes=10_000).collect()))
    exact = sorted(map(tuple, nearest(q, e, 3).select("query_id", "vec_id", "score", "rank").collect()))
    assert np.mean([a == b for a, b in zip(got, exact)]) >= np.mean([a == b for a, b in zip(want, exact)]) > 0.95


def test_copies_nulls_and_few_rows(spark, tmp_path):
    r = np.random.default_rng(2)
    v = [(i, r.normal(size=16).tolist()) for i in range(30)] + [(100 + i, [1.0] * 16) for i in range(300)] + [(900, None), (901, [0.0] * 16)]
    path = str(tmp_path / "i")
    build_index(spark.createDataFrame(v, "vec_id long, embedding array<double>"), path, "m")
    q = spark.createDataFrame([(1, [1.0] * 16), (2, None), (3, v[7][1])], "query_id long, embedding array<double>")
    got = search_index(q, path, "m", 4, probes=99).collect()
    one = sorted((x.rank, x.vec_id, x.score) for x in got if x.query_id == 1)
    assert one == [(1, 100, 1.0), (2, 101, 1.0), (3, 102, 1.0), (4, 103, 1.0)]
    assert {x.query_id for x in got} == {1, 3} and (7, 1.0) in {(x.vec_id, x.score) for x in got if x.rank == 1}
    with pytest.raises(ValueError):
        build_index(spark.createDataFrame([(1, [1.0] * 9)], "vec_id long, embedding array<double>"), str(tmp_path / "j"), "m")


def test_query_recall(spark, sf_dir):
    from varqa.plans import registry

    q = registry.queries()
    assert recall(q["vec04_index_search"](spark, sf_dir).collect(), q["vec02_nearest"](spark, sf_dir).collect()) >= 0.9


def test_exact_search_in_groups_of_bounded_size(spark, monkeypatch):
    """No group holds more rows or queries than about the bounds, copies tie by id, and the rows are those of all pairs."""
    from varqa.operators import vectors

    r = np.random.default_rng(3)
    v = r.normal(size=(900, 16)).astype(np.float32)
    v[200:700] = v[0]  # a large group of copies
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    q = df.where("vec_id % 3 = 0").withColumnRenamed("vec_id", "query_id")
    seen = spark.sparkContext.accumulator(0)  # groups of more rows or queries than allowed
    monkeypatch.setattr(vectors, "ROWS", 128)
    monkeypatch.setattr(vectors, "BLOCK", 64)
    monkeypatch.setattr(vectors, "TILE", 50)
    monkeypatch.setattr(vectors, "STEP", 7)
    best = vectors._best

    def watched(a, ids, b, k):
        seen.add(int(len(a) > 128 or len(b) > 256))
        return best(a, ids, b, k)

    monkeypatch.setattr(vectors, "_best", watched)
    got = {}
    for row in nearest(q, df, 5).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    u = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    s = np.round(u @ u.T, 4)
    assert seen.value == 0 and len(got) == 300
    for i, hits in got.items():
        order = np.lexsort((np.arange(900), -s[i]))[:5]
        assert sorted(hits) == [(n + 1, int(j), float(s[i, j])) for n, j in enumerate(order)]
    assert nearest(q.limit(0), df, 5).count() == 0 and nearest(q, df.limit(0), 5).count() == 0
