"""Vector retrieval: exact k nearest by cosine in groups of bounded size, score floors, grounded answers (VEC01-05, JOIN20, FLT10)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Index rows and queries that meet in one task at most (about), and those whose scores stand at once.
ROWS, BLOCK, TILE, STEP = 16_384, 16_384, 2048, 256


def _unit(column: pa.ChunkedArray) -> np.ndarray:
    """A list column as rows of doubles of length 1."""
    flat = pa.concat_arrays(c.flatten() for c in column.chunks).to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def _best(q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores to 4 places and ids of each query's k nearest rows of v; ids ascend, so that of equal scores the first places win."""
    m = min(k, len(v))
    score, at = np.full((len(q), m), -np.inf), np.zeros((len(q), m), np.int64)
    for lo in range(0, len(q), STEP):
        for first in range(0, len(v), TILE):
            s = np.round(q[lo : lo + STEP] @ v[first : first + TILE].T, 4)
            least = score[lo : lo + STEP, -1:]
            for i in np.flatnonzero((s > least).any(axis=1)):  # later places don't win against equal scores
                new = np.flatnonzero(s[i] > least[i])
                if len(new) > m:
                    edge = np.partition(s[i, new], len(new) - m)[len(new) - m]
                    above, same = new[s[i, new] > edge], new[s[i, new] == edge]
                    new = np.concatenate((above, same[: m - len(above)]))
                both, where = np.concatenate((score[lo + i], s[i, new])), np.concatenate((at[lo + i], new + first))
                order = np.lexsort((where, -both))[:m]
                score[lo + i], at[lo + i] = both[order], where[order]
    return score, ids[at]


def nearest(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score, rank: the k nearest by cosine, score rounded to 4 places, ties by vec_id.

    Every query (query_id, embedding) meets every row of the index (vec_id, embedding), in groups of bounded size on both
    sides: rows and queries are dealt by their ids, each part of the index meets each block of queries in one task, and in
    it a tile of scores stands at a time. A group keeps its k best per query, so only those meet in the final ranking.
    """
    parts, blocks = max(1, -(-index.count() // ROWS)), max(1, -(-queries.count() // BLOCK))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select(dealt("vec_id", parts).alias("part"), every(blocks).alias("block"), F.col("vec_id").cast("long"), "embedding")
    right = queries.select(every(parts).alias("part"), dealt("query_id", blocks).alias("block"), F.col("query_id").cast("long"), "embedding")

    def meet(rows: pa.Table, ask: pa.Table) -> pa.Table:
        who, score, near = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        if len(rows) and len(ask):
            rows = rows.sort_by("vec_id")
            s, ids = _best(_unit(ask["embedding"]), rows["vec_id"].to_numpy(), _unit(rows["embedding"]), k)
            who, score, near = np.repeat(ask["query_id"].to_numpy(), s.shape[1]), s.ravel(), ids.ravel()
        return pa.table({"query_id": who, "vec_id": near, "score": score})

    keys = ["part", "block"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def embed(texts: DataFrame, encode, batch: int = 32, dim: int = 64) -> DataFrame:
    """vec_id, embedding of texts (vec_id, text): encode(list of texts) in batches, L2-normalised."""

    def run(frames):
        for f in frames:
            for lo in range(0, len(f), batch):
                part = f.iloc[lo : lo + batch]
                v = np.asarray(encode(part["text"].tolist()), np.float32)
                v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                yield pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), "embedding": list(v)})

    return texts.select("vec_id", "text").mapInPandas(run, "vec_id long, embedding array<float>")


def with_floor(hits: DataFrame, floor: float) -> DataFrame:
    """Hits with `declined` where the best score of their query is under the floor."""
    return hits.withColumn("declined", F.max("score").over(Window.partitionBy("query_id")) < floor)


def compose_prompt(hits: DataFrame, records: DataFrame, question: str) -> DataFrame:
    """query_id, prompt: numbered records in rank order, then the question."""
    x = hits.join(records.select("vec_id", "text"), "vec_id")
    line = F.format_string("[%d] (kb:%d) %s", "rank", "vec_id", "text")
    p = x.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("p"))
    return p.select("query_id", F.concat(F.array_join("p.line", "\n"), F.lit(f"\n\nQuestion: {question}")).alias("prompt"))


def _twentieth(spark, d):
    e = table(spark, d, "embeddings")
    return e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), e


def vec02_nearest(spark, d):
    q, e = _twentieth(spark, d)
    return nearest(q, e, 5).select("query_id", "vec_id", "score", F.col("rank").cast("long").alias("rank"))


def vec03_floor(spark, d):
    """VEC03: queries whose best other vector is under the floor decline."""
    q, e = _twentieth(spark, d)
    hits = nearest(q, e, 6).where("query_id <> vec_id")
    return with_floor(hits, 0.35).groupBy("query_id").agg(F.max("score").alias("best"), F.bool_or("declined").alias("declined"))


QUERIES = {f.__name__: f for f in (vec02_nearest, vec03_floor)}

_TOP = "SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 4) AS score FROM embeddings q CROSS JOIN embeddings e WHERE q.vec_id % 20 = 0"
ORACLE = {
    "vec02_nearest": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM ({_TOP})) WHERE rank <= 5",
    "vec03_floor": f"SELECT query_id, max(score) AS best, max(score) < 0.35 AS declined FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM ({_TOP})) WHERE r <= 6 AND query_id <> vec_id GROUP BY 1",
}
