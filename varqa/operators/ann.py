"""Retrieval from a stored index: inverted lists of product-quantised residuals, re-ranked exactly (VEC02, VEC04).

An index is a folder of Parquet tables: `vectors` (partitioned by list: id, code, vector), `lists` (centroid and number of
rows of each), `codebooks` and `about` (one row: the embedding model's name, dimension and parameters). Centroids and
codebooks are learnt from a bounded sample; every row is assigned and stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, shared_path, table

#: Vectors that centroids and codebooks are learnt from, lists at most, parts of a vector and codes of each.
SAMPLE, MOST_LISTS, PARTS, CODES = 20_000, 4_096, 8, 256
#: Vectors and queries that meet in one task, queries scored at once, approximate hits compared exactly for each one asked for.
ROWS, QUERIES_HELD, STEP, REFINE = 50_000, 2_000, 128, 20
#: Vectors of the sample whose own neighbours tell how many lists a query has to look into.
TRIED = 256


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half, out = (centres**2).sum(1) / 2, np.empty(len(x), np.int64)
    for lo in range(0, len(x), 4096):
        out[lo : lo + 4096] = np.argmax(x[lo : lo + 4096] @ centres.T - half, axis=1)
    return out


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """k centres of the rows of x; a centre that loses all its rows takes the row farthest from its own."""
    r = np.random.default_rng(seed)
    centres = x[r.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _closest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        far = np.argsort(-((x - centres[own]) ** 2).sum(1), kind="stable")
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        empty = np.flatnonzero(n == 0)
        centres[empty] = x[far[: len(empty)]]
    return centres


def _first(scores: np.ndarray, m: int) -> np.ndarray:
    """Places of the m highest scores; of equal ones the first."""
    least = np.partition(scores, len(scores) - m)[len(scores) - m]
    above = np.flatnonzero(scores > least)
    return np.concatenate((above, np.flatnonzero(scores == least)[: m - len(above)]))


class Quantiser:
    """Centroids of the lists, and for each part of a vector the codebook of its residuals."""

    def __init__(self, centres: np.ndarray, books: np.ndarray):
        self.centres, self.books = centres, books

    @classmethod
    def learn(cls, x: np.ndarray, lists: int) -> Quantiser:
        x = _unit(x)
        centres = k_means(x, min(lists, len(x)))
        rest = x - centres[_closest(x, centres)]
        width = x.shape[1] // PARTS
        return cls(centres, np.stack([k_means(rest[:, i * width : (i + 1) * width], min(CODES, len(x)), seed=i) for i in range(PARTS)]))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and codes of unit vectors."""
        own = _closest(x, self.centres)
        rest, width = x - self.centres[own], self.books.shape[2]
        return own, np.stack([_closest(rest[:, i * width : (i + 1) * width], self.books[i]) for i in range(PARTS)], axis=1).astype(np.uint8)

    def probes(self, x: np.ndarray, k: int, recall: float) -> int:
        """Closest lists that hold `recall` of the k nearest other rows of the first rows of x."""
        x = _unit(x)
        ask, own = x[:TRIED], _closest(x, self.centres)
        near = ask @ x.T
        near[np.arange(len(ask)), np.arange(len(ask))] = -2
        best = np.argsort(-near, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
        turn = np.argsort(np.argsort(-(ask @ self.centres.T), axis=1, kind="stable"), axis=1)
        needed = np.sort(np.take_along_axis(turn, own[best], 1).ravel()) + 1
        return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if len(needed) else 1

    def scores(self, q: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Approximate cosines of unit queries with the coded rows of one list."""
        width = self.books.shape[2]
        out = np.broadcast_to((q @ self.centres[which])[:, None], (len(q), len(codes))).copy()
        for i in range(PARTS):
            out += (q[:, i * width : (i + 1) * width] @ self.books[i].T)[:, codes[:, i]]
        return out


def build_index(vectors: DataFrame, path: str, model: str, lists: int | None = None, k: int = 5, recall: float = 0.95) -> None:
    """Writes an index of vectors (vec_id, embedding) that `model` made; rows without a vector are left out.

    There are about as many lists as the square root of the rows, unless given. How many of them a query
    looks into is measured on the sample: so many that `recall` of the k nearest lie in them. The dimension is that of the sample's
    vectors, a multiple of 8; a vector of another one fails the build. A list of many rows is dealt over several tasks.
    """
    spark = vectors.sparkSession
    rows = vectors.where("embedding is not null").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    n = rows.count()
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    sizes = {len(v) for v in picked["embedding"].to_pylist()}
    if len(sizes) != 1 or (dim := sizes.pop()) % PARTS:
        raise ValueError(f"an index needs vectors of one dimension, a multiple of {PARTS}")
    sample = _matrix(picked["embedding"].combine_chunks())
    q = Quantiser.learn(sample, lists or max(1, min(MOST_LISTS, round(n**0.5))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, codes = q.encode(_unit(_matrix(b.column(1))))
                yield pa.record_batch([pa.array(own.astype(np.int32)), b.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), b.column(1)], ["list", "vec_id", "code", "embedding"])

    checked = rows.withColumn("embedding", F.when(F.size("embedding") == dim, F.col("embedding")).otherwise(F.raise_error(F.lit(f"not a vector of dimension {dim}")).cast("array<double>")))
    coded = checked.mapInArrow(assign, "list int, vec_id long, code binary, embedding array<double>")
    coded.repartition("list", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n // (len(q.centres) * ROWS))))).write.partitionBy("list").parquet(f"{path}/vectors")
    held = spark.read.parquet(f"{path}/vectors").groupBy("list").count()
    centres = spark.createDataFrame([Row(list=i, centre=c.tolist()) for i, c in enumerate(q.centres)], "list int, centre array<double>")
    centres.join(held, "list", "left").na.fill(0, ["count"]).withColumnRenamed("count", "n").coalesce(1).write.parquet(f"{path}/lists")
    spark.createDataFrame([Row(part=i, book=b.tolist()) for i, b in enumerate(q.books)], "part int, book array<array<double>>").coalesce(1).write.parquet(f"{path}/codebooks")
    spark.createDataFrame([(model, dim, n, len(q.centres), q.probes(sample, k, recall))], "model string, dim int, n long, lists int, probes int").coalesce(1).write.parquet(f"{path}/about")


def index_report(vectors: DataFrame, path: str, model: str) -> DataFrame:
    """build_index, and what it says of itself: model, dim, n, lists, probes."""
    build_index(vectors, path, model)
    return vectors.sparkSession.read.parquet(f"{path}/about")


def open_index(spark: SparkSession, path: str, model: str) -> tuple[Quantiser, int]:
    """The index' quantiser and its measured number of probes (bounded: 4,096 centroids, 8 codebooks); an index that another model made is refused."""
    about = spark.read.parquet(f"{path}/about").first()
    if about.model != model:
        raise ValueError(f"the index was made by {about.model}, the queries by {model}")
    centres = np.array([r.centre for r in spark.read.parquet(f"{path}/lists").orderBy("list").collect()])
    return Quantiser(centres, np.array([r.book for r in spark.read.parquet(f"{path}/codebooks").orderBy("part").collect()])), about.probes


def search_index(queries: DataFrame, path: str, model: str, k: int, probes: int | None = None) -> DataFrame:
    """query_id, vec_id, score, rank: the k best of the `probes` lists closest to each query (the index' own number if
    not given), ties by vec_id.

    queries (query_id, embedding) are vectors of the index' model. A query meets a list's rows in groups of bounded size
    on both sides: rows and queries of one list are dealt by their ids. In a group codes give approximate scores, the
    best of which are compared exactly. Scores are cosines to 4 places. Queries without a vector have no hits.
    """
    spark = queries.sparkSession
    q, measured = open_index(spark, path, model)
    probes = probes or measured
    dim, lists = q.centres.shape[1], len(q.centres)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _unit(_matrix(b.column(1)))
                best = np.argsort(-(x @ q.centres.T), axis=1, kind="stable")[:, :probes]
                of = np.repeat(np.arange(len(x)), best.shape[1])
                yield pa.record_batch([b.column(0).take(pa.array(of)), pa.array(best.ravel().astype(np.int32)), b.column(1).take(pa.array(of))], ["query_id", "list", "embedding"])

    asked = queries.where(F.size("embedding") == dim).select(F.col("query_id").cast("long"), F.col("embedding").cast("array<double>"))
    asked = cut_lineage(asked.mapInArrow(choose, "query_id long, list int, embedding array<double>"))
    # How many groups each list's rows and queries are dealt into: one row for each list.
    deals = asked.groupBy("list").agg(F.count("*").alias("m")).join(spark.read.parquet(f"{path}/lists").select("list", "n"), "list")
    deals = F.broadcast(deals.select("list", F.ceil(F.greatest("n", F.lit(1)) / ROWS).cast("int").alias("a"), F.ceil(F.col("m") / QUERIES_HELD).cast("int").alias("b")))
    every = lambda into: F.explode(F.sequence(F.lit(0), F.col(into) - 1))
    mine = lambda key, into: F.pmod(F.xxhash64(key), F.col(into)).cast("int")
    left = spark.read.parquet(f"{path}/vectors").join(deals, "list").select("list", mine("vec_id", "a").alias("a"), every("b").alias("b"), "vec_id", "code", "embedding")
    right = asked.join(deals, "list").select("list", every("a").alias("a"), mine("query_id", "b").alias("b"), "query_id", "embedding")

    def meet(key: tuple, rows: pa.Table, ask: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        ids = rows["vec_id"].to_numpy()
        codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(ids), PARTS)
        v, x = _unit(_matrix(rows["embedding"].combine_chunks())) if len(ids) else np.zeros((0, dim)), _unit(_matrix(ask["embedding"].combine_chunks())) if len(ask) else np.zeros((0, dim))
        who, out = ask["query_id"].to_numpy(), []
        for lo in range(0, len(x) if len(ids) else 0, STEP):
            near = q.scores(x[lo : lo + STEP], key[0].as_py(), codes)
            m = min(k * REFINE, near.shape[1])
            best = np.stack([_first(line, m) for line in near])
            exact = np.round(np.einsum("qmd,qd->qm", v[best], x[lo : lo + STEP]), 4)
            order = np.lexsort((ids[best], -exact), axis=1)[:, :k]
            out.append((np.repeat(who[lo : lo + STEP], order.shape[1]), ids[np.take_along_axis(best, order, 1)].ravel(), np.take_along_axis(exact, order, 1).ravel()))
        cols = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, t) for i, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))

    keys = ["list", "a", "b"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def vec04_index_search(spark, d):
    """Every vector indexed; those whose id is divisible by 20 look up their five nearest."""
    e, path = table(spark, d, "embeddings"), shared_path(spark, "index")
    build_index(e, path, model="embeddings-64")
    asked = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return search_index(asked, path, "embeddings-64", 5).select("query_id", "vec_id", "score", F.col("rank").cast("long").alias("rank"))


QUERIES = {f.__name__: f for f in (vec04_index_search,)}
ORACLE: dict[str, str] = {}
