"""Work clusters: connected components over match edges (GRF01-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, table

EXACT, RELATED = 1.0, 0.85


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of each component; nodes (node), edges (a, b); edges to unknown nodes count for nothing.

    Every round, each node goes over to the node around it (or itself) that a hash of the round puts first, and the
    edges are drawn between those, so that a node stands for all that went to it. The order is random, so a constant share of the nodes goes in each round, whatever
    the graph and its ids are (randomised contraction): rounds grow with the logarithm of the largest component.
    """
    nodes = cut_lineage(nodes.select("node").distinct())
    pairs = cut_lineage(edges.select(F.col("a").alias("x"), F.col("b").alias("y")))
    pairs = cut_lineage(pairs.join(nodes.select(F.col("node").alias("x")), "x", "left_semi"))
    pairs = cut_lineage(pairs.join(nodes.select(F.col("node").alias("y")), "y", "left_semi").where("x <> y"))
    both = cut_lineage(pairs.select("x", "y").unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    gone: list[DataFrame] = []
    while not both.isEmpty():
        turn = F.lit(len(gone))
        near = both.groupBy("x").agg(F.min(F.struct(F.xxhash64(turn, "y").alias("h"), F.col("y").alias("to"))).alias("m"))
        to = cut_lineage(near.select("x", F.least("m", F.struct(F.xxhash64(turn, "x").alias("h"), F.col("x").alias("to")))["to"].alias("to")))
        gone.append(to)
        ends = both.join(to.withColumnRenamed("to", "a"), "x").join(to.select(F.col("x").alias("y"), F.col("to").alias("b")), "y")
        both = cut_lineage(ends.where("a <> b").select(F.col("a").alias("x"), F.col("b").alias("y")).distinct())
    if not gone:
        return nodes.select("node", F.col("node").alias("label"))
    root = gone.pop()
    while gone:  # where each round's nodes have gone in the end, from the last round back
        root = cut_lineage(gone.pop().select("x", F.col("to").alias("via")).join(root.select(F.col("x").alias("via"), "to"), "via", "left").select("x", F.coalesce("to", "via").alias("to")))
    full = cut_lineage(nodes.join(root.withColumnRenamed("x", "node"), "node", "left").select("node", F.coalesce("to", "node").alias("root")))
    least = full.groupBy("root").agg(F.min("node").alias("least"))
    return full.join(least, "root", "left").select("node", F.coalesce("least", "node").alias("label"))


def build_clusters(entries: DataFrame, items: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per cluster: canonical id, members with roles, confidence and related candidates.

    entries (node), items (node); matches (item, entry, score). Matches of score 1 to known nodes merge; the anchor is
    the smallest entry, or else the smallest member; scores from RELATED up to other clusters are related.
    """
    nodes = entries.select("node", F.lit("entry").alias("member_type")).unionByName(items.select("node", F.lit("item").alias("member_type")))
    known = matches.join(nodes.select(F.col("node").alias("item")), "item", "left_semi").join(nodes.select(F.col("node").alias("entry")), "entry", "left_semi")
    label = components(nodes.select("node"), known.where(F.col("score") == EXACT).select(F.col("item").alias("a"), F.col("entry").alias("b")))
    member = nodes.join(label, "node")
    anchor = member.groupBy("label").agg(F.coalesce(F.min(F.when(F.col("member_type") == "entry", F.col("node"))), F.min("node")).alias("work"), F.count("*").alias("n"))
    full = member.join(anchor, "label")
    nested = full.groupBy("label", "work", "n").agg(F.array_sort(F.collect_list(F.struct(F.col("node").alias("member_id"), "member_type", F.when(F.col("node") == F.col("work"), "anchor").otherwise("witness").alias("role")))).alias("members"))
    of = member.select("node", F.col("label").alias("cluster"))
    rel = known.where((F.col("score") >= RELATED) & (F.col("score") < EXACT)).join(of.select(F.col("node").alias("item"), F.col("cluster").alias("label")), "item").join(of.select(F.col("node").alias("entry"), F.col("cluster").alias("other")), "entry").where("label <> other")
    rel = rel.groupBy("label").agg(F.array_sort(F.collect_set(F.struct(F.col("entry").alias("member_id"), "score"))).alias("related"))
    return nested.join(rel, "label", "left").select("work", "members", F.when(F.col("n") > 1, "auto_exact_match").otherwise("unreviewed").alias("confidence"), F.coalesce("related", F.array().cast("array<struct<member_id:bigint,score:double>>")).alias("related"))


def cluster_map(clusters: DataFrame) -> DataFrame:
    return clusters.select(F.explode("members.member_id").alias("member_id"), "work")


def _edges(spark, d):
    """Documents with equal texts, each tied to the previous one, and every fifth document to its neighbour."""
    docs = cut_lineage(table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h")))
    same = docs.withColumn("p", F.lag("doc_id").over(Window.partitionBy("h").orderBy("doc_id"))).where("p is not null").select(F.col("doc_id").alias("a"), F.col("p").alias("b"))
    near = docs.where("doc_id % 5 = 0").select(F.col("doc_id").alias("a"), (F.col("doc_id") + 1).alias("b")).join(docs.select(F.col("doc_id").alias("b")), "b", "left_semi").select("a", "b")
    return docs.select(F.col("doc_id").alias("node")), same.unionByName(near)


def grf01_components(spark, d):
    return components(*_edges(spark, d))


def grf02_clusters(spark, d):
    """Even documents are entries, odd ones items; equal texts match exactly, neighbours nearly."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    even, odd = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    first = even.groupBy("h").agg(F.min("doc_id").alias("entry"))
    exact = odd.join(first, "h").select(F.col("doc_id").alias("item"), "entry", F.lit(1.0).alias("score"))
    near = odd.where("doc_id % 7 = 0").select(F.col("doc_id").alias("item"), (F.col("doc_id") - 1).alias("entry"), F.lit(0.9).alias("score"))
    c = build_clusters(even.select(F.col("doc_id").alias("node")), odd.select(F.col("doc_id").alias("node")), exact.unionByName(near))
    return c.select("work", F.size("members").cast("long").alias("n"), "confidence", F.size("related").cast("long").alias("n_related"))


QUERIES = {f.__name__: f for f in (grf01_components, grf02_clusters)}

ORACLE = {
    "grf01_components": """WITH RECURSIVE e AS (SELECT a, b FROM (SELECT doc_id AS a, lag(doc_id) OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS b FROM documents) WHERE b IS NOT NULL
  UNION ALL SELECT doc_id, doc_id + 1 FROM documents WHERE doc_id % 5 = 0 AND doc_id + 1 IN (SELECT doc_id FROM documents)),
  s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, s.b FROM r JOIN s ON r.other = s.a)
SELECT node, min(other) AS label FROM r GROUP BY 1""",
    "grf02_clusters": """WITH x AS (SELECT doc_id, sha256(text) AS h FROM documents), f AS (SELECT h, min(doc_id) AS entry FROM x WHERE doc_id % 2 = 0 GROUP BY 1),
  m AS (SELECT x.doc_id AS item, entry FROM x JOIN f USING (h) WHERE doc_id % 2 = 1), w AS (SELECT x.doc_id, coalesce(m.entry, x.doc_id) AS work FROM x LEFT JOIN m ON m.item = x.doc_id),
  r AS (SELECT wi.work, count(DISTINCT i.doc_id - 1) AS n_related FROM x i JOIN w wi ON wi.doc_id = i.doc_id JOIN w we ON we.doc_id = i.doc_id - 1 WHERE i.doc_id % 2 = 1 AND i.doc_id % 7 = 0 AND wi.work <> we.work GROUP BY 1)
SELECT w.work, count(*) AS n, CASE WHEN count(*) > 1 THEN 'auto_exact_match' ELSE 'unreviewed' END AS confidence, coalesce(any_value(n_related), 0) AS n_related FROM w LEFT JOIN r ON r.work = w.work GROUP BY 1""",
}
