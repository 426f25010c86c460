"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected copies are its source's target over its source's size. The whole part is taken; fractions are
rounded in duels: two documents of a source pass words between them, at random and without changing either's
expectation, until one fraction is 0 or 1. Words are conserved in every duel, so a source's total stays at its
target up to the one fraction that is left at the end. Duels run in leaves of bounded size, largest documents first;
what is left of the leaves meets in a tree, FAN leaves at a time.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sized_broadcast, whole_rows

LEAF, FAN = 512, 32
WORD = r"[^\x20\x09-\x0D]+"
_MASK = 2**64 - 1


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, docs, target from rows of (source, size), one row per source.

    Sources by code point, null last, get the weights in turn and share `share` times all sizes; a target stops at
    `most` times its source's size and the excess goes to the others by weight: the level at which that ends is
    found by running sums over the sources in the order in which they stop.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_name, by_level = Window.orderBy(F.asc_nulls_last("source")), Window.orderBy("level", F.asc_nulls_last("source"))
    before, onward = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = totals.withColumn("n", F.row_number().over(by_name))
    t = t.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int")))
    t = t.withColumn("stop", most * F.col("source_size")).withColumn("level", F.col("stop") / F.col("weight"))
    t = t.withColumn("budget", share * F.sum("source_size").over(every))
    t = t.withColumn("here", (F.col("budget") - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    t = t.withColumn("full", F.col("here") > F.col("level"))
    level = (F.col("budget") - F.sum(F.when(F.col("full"), F.col("stop")).otherwise(0.0)).over(every)) / F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    return t.withColumn("level", level).select("source", "source_size", "docs", F.when(F.col("full"), F.col("stop")).otherwise(F.col("level") * F.col("weight")).cast("double").alias("target"))


def _uniform(a: int, b: int) -> float:
    """A number in [0, 1) that only the two ids decide."""
    x = (a * 0x9E3779B97F4A7C15 ^ (b * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9)) & _MASK
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor & _MASK
    return ((x ^ x >> 31) >> 11) / 2**53


def pivot(key: list[int], size: list[float], p: list[float], last: bool) -> list[float]:
    """Fractions after duels in the given order: all 0 or 1 but at most one; with last, that one too is rounded."""
    p, held = list(p), -1
    for i in range(len(p)):
        if not 0 < p[i] < 1:
            continue
        if not size[i]:
            p[i] = 0.0
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        up = min((1 - p[a]) * size[a], p[b] * size[b])
        down = min(p[a] * size[a], (1 - p[b]) * size[b])
        move = up if _uniform(key[a], key[b]) * (up + down) < down else -down
        p[a] += move / size[a]
        p[b] -= move / size[b]
        held = -1
        for x in (a, b):
            if p[x] < 1e-9:
                p[x] = 0.0
            elif p[x] > 1 - 1e-9:
                p[x] = 1.0
            else:
                held = x
    if last and held >= 0:
        p[held] = 1.0 if _uniform(key[held], 7) < p[held] else 0.0
    return p


def _duel_with(last: bool):
    def duel(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["size", "key"], ascending=[False, True], kind="stable")
        part["p"] = pivot(part["key"].tolist(), part["size"].tolist(), part["p"].tolist(), last)
        return part

    return duel


def mix_copies(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, source, h, n, size, source_size, target, copies, taken for every row of docs.

    size is the number of words (a null text has none), taken = copies * size. Null sources form a source of their
    own; repeated rows are documents of their own (h is a hash of the text, n numbers the rows of one doc_id, text and
    source); documents without words, and so sources without words, get no copy; very long texts count whole; an empty
    table gives an empty result. Other columns are ignored. Reruns agree: chance is a hash of ids.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("h"))
    sized = materialize(sized.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "h", "source").orderBy("size"))), "sizes")
    targets = materialize(source_targets(sized, weights, share, most), "targets")
    leaves = F.ceil(F.col("docs") / LEAF).cast("long")
    rows = sized.join(sized_broadcast(targets.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s")))
    expected = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.select(
        "doc_id", "source", "h", "n", "size", "source_size", "target", F.floor(expected).alias("base"), (expected - F.floor(expected)).alias("p"),
        F.xxhash64("doc_id", "n", "size").alias("key"), F.pmod(F.xxhash64("doc_id", "n", F.lit(1)), leaves).alias("leaf"),
    )
    most_leaves = targets.agg(F.max(leaves)).first()[0] or 1
    done = None
    while True:
        last = most_leaves == 1

        level = materialize(rows.groupBy("source", "leaf").applyInPandas(_duel_with(last), rows.schema), "duels")
        settled = level if last else level.where("p = 0 or p = 1")
        done = settled if done is None else done.unionByName(settled)
        if last:
            break
        rows = level.where("p > 0 and p < 1").withColumn("leaf", F.floor(F.col("leaf") / FAN).cast("long"))
        most_leaves = -(-most_leaves // FAN)
    copies = (F.col("base") + F.col("p")).cast("long")
    return done.select("doc_id", "source", "h", "n", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """docs with each row as many times as the mix takes it; columns as they were, whatever their names.

    Null doc_ids, texts and sources, empty texts, repeated rows and empty tables: as mix_copies says. Only rows that are
    repeated in doc_id, text and source are numbered; all others meet their copies by a plain join.
    """
    found = materialize(mix_copies(docs, weights, share, most), "copies")
    keys = ["doc_id", "source", "h"]
    taken = found.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("n").alias("_n"), F.col("copies").cast("int").alias("_copies"))
    many = found.where("n = 2").select(*[F.col(k).alias(f"_{k}") for k in keys])  # each repeated row once
    rows = docs.select(whole_rows(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64("text").alias("h"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("h") == F.col("_h"))
    if many.take(1):
        repeated = sized_broadcast(many)
        order = F.hash(*[F.col("row")[c] for c, t in docs.dtypes if "map<" not in t])
        again = rows.join(repeated, same, "left_semi").withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
        rows = rows.join(repeated, same, "left_anti").withColumn("n", F.lit(1)).unionByName(again)
    else:
        rows = rows.withColumn("n", F.lit(1))
    met = rows.join(taken.where("_copies > 0"), same & (F.col("n") == F.col("_n")))
    return met.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")
