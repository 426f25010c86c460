"""Integrity joins, overrides, ordered lookups, aggregates, windows and set operations (JOIN, AGG, WIN, SRT, LIM, SET)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .common import ordered_list, sized_broadcast, sql_words, table, with_positions


def paired_join(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(joined rows, violations): a one-to-one join that reports keys missing on either side and repeated keys."""
    counts = left.groupBy(key).agg(F.count("*").alias("n_left")).join(right.groupBy(key).agg(F.count("*").alias("n_right")), key, "full_outer").fillna(0, ["n_left", "n_right"])
    problem = F.when(F.col("n_left") == 0, "missing left").when(F.col("n_right") == 0, "missing right").when((F.col("n_left") > 1) | (F.col("n_right") > 1), "repeated")
    return left.join(right, key), counts.select(key, problem.alias("problem")).where("problem is not null")


def classification_violations(matches: DataFrame, classes: DataFrame, statuses: list[str]) -> DataFrame:
    """match_id, problem: unknown or unmatched ids, repeated classifications, unknown statuses, candidates outside the match."""
    repeated = classes.groupBy("match_id").agg(F.count("*").alias("n")).where("n > 1").select("match_id", F.lit("repeated").alias("problem"))
    missing = matches.join(classes, "match_id", "left_anti").select("match_id", F.lit("unclassified").alias("problem"))
    unknown = classes.join(matches, "match_id", "left_anti").select("match_id", F.lit("unknown match").alias("problem"))
    status = classes.where(~F.col("status").isin(statuses)).select("match_id", F.lit("unknown status").alias("problem"))
    outside = classes.join(matches, "match_id").where("status <> 'unmatched' and not array_contains(candidates, chosen)").select("match_id", F.lit("not a candidate").alias("problem"))
    return missing.unionByName(unknown).unionByName(repeated).unionByName(status).unionByName(outside)


def last_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(seq)))).where("_r = 1").drop("_r")


def first_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc(seq)))).where("_r = 1").drop("_r")


def override(layers: DataFrame, corrections: DataFrame, keys: list[str], value: str) -> DataFrame:
    """layers with value replaced where a correction matches; corrections without a layer follow as rows of their own."""
    c = corrections.select(*keys, F.col(value).alias("_new"))
    changed = layers.join(c, keys, "left").withColumn("corrected", F.col("_new").isNotNull()).withColumn(value, F.coalesce("_new", value)).drop("_new")
    extra = corrections.join(layers, keys, "left_anti").select(*keys, value).withColumn("corrected", F.lit(True))
    return changed.unionByName(extra, allowMissingColumns=True)


def ordered_lookup(df: DataFrame, key: str, ids: str, dimension: DataFrame, dim_key: str, dim_value: str, keep_unknown: bool = False) -> DataFrame:
    """ids replaced by values of the dimension, in their order; unknown ids are dropped or stand for themselves."""
    x = df.select(key, F.posexplode(ids).alias("pos", "_id")).join(dimension.select(F.col(dim_key).alias("_id"), F.col(dim_value).alias("_v")), "_id", "left" if keep_unknown else "inner")
    value = F.coalesce("_v", F.col("_id").cast("string")) if keep_unknown else F.col("_v")
    return x.groupBy(key).agg(ordered_list(value, F.col("pos")).alias("values"))


def merge_first_seen(df: DataFrame, keys: list[str], seq: Column, scalars: list[str], lists: list[str]) -> DataFrame:
    """One row per key: scalars as first seen, list columns as ordered distinct values."""
    return df.groupBy(*keys).agg(*[F.min_by(c, seq).alias(c) for c in scalars], *[F.array_distinct(ordered_list(F.col(c), seq)).alias(c) for c in lists])


def gap_audit(df: DataFrame, column: str, expected: int | None = None) -> DataFrame:
    """kind, value: numbers from 1 to expected (by default the greatest there) that are missing, and numbers that occur more than once."""
    if expected is None:
        expected = df.agg(F.max(F.col(column).cast("long"))).first()[0] or 0
    whole = df.sparkSession.range(1, expected + 1).select(F.col("id").alias(column))
    missing = whole.join(df.select(F.col(column).cast("long")).distinct(), column, "left_anti").select(F.lit("missing").alias("kind"), F.col(column).alias("value"))
    twice = df.groupBy(F.col(column).cast("long").alias("value")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate").alias("kind"), "value")
    return missing.unionByName(twice)


def quota(df: DataFrame, family: str, order: str, per_family: int, total: int) -> DataFrame:
    """At most per_family rows of each family and total rows of all, in order."""
    mine = df.withColumn("_r", F.row_number().over(Window.partitionBy(family).orderBy(order))).where(F.col("_r") <= per_family).drop("_r")
    return mine.orderBy(order).limit(total)


# --- queries ---------------------------------------------------------------------------------------------------


def join06_paired(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return paired_join(c.select(F.col("c_custkey").alias("k")), o.select(F.col("o_custkey").alias("k")), "k")[1].groupBy("problem").agg(F.count("*").alias("n"))


def join08_classification(spark, d):
    """Labels as classifications of documents: candidates are the two neighbouring ids."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    m = docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("match_id"), F.array(F.col("doc_id"), F.col("doc_id") + 1).alias("candidates"))
    c = labels.select(F.col("doc_id").alias("match_id"), F.when(F.col("quality") == 1, "variant").when(F.col("toxic") == 1, "bad").otherwise("unmatched").alias("status"), (F.col("doc_id") + F.pmod("doc_id", F.lit(6))).alias("chosen"))
    return classification_violations(m, c, ["exact_witness", "variant", "excerpt", "possible", "unmatched"])


def join12_override(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    layers = docs.select("doc_id", "lang", F.col("source").alias("value"))
    c = labels.select((F.col("doc_id") * 2).alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("fixed "), F.col("quality").cast("string")).alias("value"))
    return override(layers, c, ["doc_id", "lang"], "value")


def join13_ordered_lookup(spark, d):
    """JOIN13, JOIN17: three neighbouring document ids per label, their sources in that order, unknown ids as themselves."""
    ids = table(spark, d, "labels").select("doc_id", F.array(F.col("doc_id") + 1, F.col("doc_id") - 1, F.col("doc_id") * 3).alias("ids"))
    x = ordered_lookup(ids, "doc_id", "ids", table(spark, d, "documents"), "doc_id", "source", keep_unknown=True)
    return x.select("doc_id", F.array_join("values", "|").alias("sources"))


def join10_work_members(spark, d):
    """JOIN09, JOIN10, FLT12: works are sources; every document with the first and the number of its work and language."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    works = docs.groupBy("source", "lang").agg(F.min("doc_id").alias("first"), F.countDistinct("doc_id").alias("n")).where("n >= 2")
    return docs.join(sized_broadcast(works), ["source", "lang"], "left").select("doc_id", F.coalesce("first", F.lit(-1)).alias("anchor"), F.coalesce("n", F.lit(0)).alias("n_members"))


def join10_members(spark, d):
    """JOIN10: the sorted members of each work (source and language) as rows: each document's position among them."""
    docs = with_positions(table(spark, d, "documents").select("source", "lang", "doc_id"), "n", "source", "lang", "doc_id")
    first = docs.groupBy("source", "lang").agg(F.min("n").alias("first"), F.count("*").alias("n_members"))
    first = first.select(F.col("source").alias("s"), F.col("lang").alias("l"), "first", "n_members")
    x = docs.join(sized_broadcast(first), F.col("source").eqNullSafe(F.col("s")) & F.col("lang").eqNullSafe(F.col("l")))
    return x.select("source", "lang", "doc_id", (F.col("n") - F.col("first") + 1).alias("position"), "n_members")


def join14_view_pairs(spark, d):
    """Ordered pairs of turns of one conversation, at most four per conversation."""
    c = table(spark, d, "conversations").select("conv_id", "turn")
    c = c.withColumn("k", F.dense_rank().over(Window.partitionBy("conv_id").orderBy("turn"))).where("k <= 5").drop("k")  # no later turn is in the first four pairs
    p = c.join(c.withColumnRenamed("turn", "other"), "conv_id").where("turn <> other")
    r = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "other"))
    return p.withColumn("r", r).where("r <= 4").select("conv_id", "turn", "other")


def join15_resume(spark, d):
    """What is still to do: documents without a label."""
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_anti").select("doc_id", "source")


def join16_citations(spark, d):
    """Cited ids that are not among the retrieved ones."""
    c = table(spark, d, "conversations").groupBy("conv_id").agg(ordered_list(F.concat(F.lit("[kb:"), F.pmod(F.length("text"), F.lit(9)).cast("string"), F.lit("]")), F.col("turn")).alias("said"))
    cited = T.citations(F.array_join("said", " "))
    found = F.array(*[F.lit(f"kb:{i}") for i in range(6)])
    return c.select("conv_id", F.array_join(F.array_sort(F.array_distinct(F.array_except(cited, found))), ",").alias("invented"))


def join18_views(spark, d):
    """JOIN18, JOIN19, PRJ10: pages by id, 0 to the last, with the view that should exist; a missing one is a status, in catalog order."""
    p = table(spark, d, "pages")
    last = p.agg(F.max("page_id")).first()[0]
    catalog = spark.range(0, 0 if last is None else last + 1).select(F.col("id").alias("page_id"))
    x = catalog.join(p, "page_id", "left")
    return x.select(F.col("page_id").cast("long").alias("page_id"), F.when(F.col("html").isNull(), "error").when(F.length("html") < 3000, "unavailable").otherwise("ok").alias("status"))


def agg01_counts(spark, d):
    """Counts by language and quality, zero-filled over all combinations."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    langs = docs.select("lang").distinct()
    grid = langs.select("lang", F.explode(F.array(F.lit(0), F.lit(1))).alias("quality"))
    n = docs.join(labels, "doc_id").groupBy("lang", "quality").agg(F.count("*").alias("n"))
    return grid.join(n, ["lang", "quality"], "left").select("lang", "quality", F.coalesce("n", F.lit(0)).alias("n"))


def agg02_pivot(spark, d):
    s = F.when(F.pmod("doc_id", F.lit(10)) == 0, "eval").otherwise("train")
    x = table(spark, d, "documents").withColumn("split", s).groupBy("source").pivot("split", ["train", "eval"]).count()
    return x.select("source", F.coalesce("train", F.lit(0)).alias("train"), F.coalesce("eval", F.lit(0)).alias("eval"))


def agg03_merge(spark, d):
    """AGG03, AGG04: sources merged: first language seen, ordered distinct languages, joined ids of the first lines."""
    x = merge_first_seen(table(spark, d, "documents").withColumn("langs", F.col("lang")), ["source"], F.col("doc_id"), ["lang"], ["langs"])
    return x.select("source", "lang", F.array_join("langs", ",").alias("langs"))


def agg05_audit(spark, d):
    """AGG05, AGG08, AGG09, AGG16: one row of conditional counts over documents."""
    x = table(spark, d, "documents")
    return x.agg(F.count("*").alias("records"), F.countDistinct("doc_id").alias("ids"), F.countDistinct(F.sha2("text", 256)).alias("texts"), F.count_if(F.col("lang") == "fr").alias("french"), F.count_if(F.length("text") < 100).alias("short"), F.max(F.length("text")).cast("long").alias("longest"), F.sum("n_chars").alias("chars"))


def agg06_gaps(spark, d):
    """AGG06: labelled documents up to the last one, line numbers up to 9."""
    return gap_audit(table(spark, d, "labels"), "doc_id").unionByName(gap_audit(table(spark, d, "lineitem"), "l_linenumber", 9))


def agg07_means(spark, d):
    """AGG07, AGG13, AGG14: means of counts as exact sums and sizes, rejection rate with its warning."""
    x = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").groupBy("lang").agg(F.sum("toxic").alias("rejected"), F.count("*").alias("n"))
    return x.select("lang", F.round(F.coalesce(F.col("rejected") / F.col("n"), F.lit(0.0)), 3).alias("rate"), F.when(F.col("rejected") / F.col("n") > 0.12, "high").otherwise("fine").alias("warning"))


def agg12_argmin(spark, d):
    """AGG12, WIN09: per event type the event of least value (first one wins) and the trend of its last value."""
    e = table(spark, d, "events")
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    t = e.withColumn("before", F.lag("value").over(w)).groupBy("event_type").agg(F.min_by("event_id", F.struct("value", "event_id")).alias("best"), F.max_by(F.when(F.col("value") < F.col("before"), "down").when(F.col("value") > F.col("before"), "up").otherwise("flat"), F.struct("ts", "event_id")).alias("trend"))
    return t


def win01_ranks(spark, d):
    """WIN01, WIN02: rank within source by length, three longest."""
    w = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    return table(spark, d, "documents").select("source", "doc_id", F.row_number().over(w).cast("long").alias("rank")).where("rank <= 3")


def win03_quota(spark, d):
    """WIN03, WIN04, LIM01: at most five documents per source and 25 in all, by id."""
    return quota(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 5, 25)


def win05_last_wins(spark, d):
    """WIN05, WIN06: the last and the first turn of every conversation and role."""
    c = table(spark, d, "conversations")
    last = last_wins(c, ["conv_id", "role"], "turn").select("conv_id", "role", F.col("turn").alias("last"))
    return last.join(first_wins(c, ["conv_id", "role"], "turn").select("conv_id", "role", F.col("turn").alias("first")), ["conv_id", "role"])


def win08_duplicate_chain(spark, d):
    """GATE04, WIN08: questions with the same words, each naming the previous holder."""
    q = table(spark, d, "documents").select("doc_id", F.sha2(F.array_join(T.words(F.col("text")), " "), 256).alias("k"))
    w = Window.partitionBy("k").orderBy("doc_id")
    return q.select("doc_id", F.lag("doc_id").over(w).alias("duplicate_of")).where("duplicate_of is not null")


def win10_every_nth(spark, d):
    """WIN10, SPL01: every tenth source is held out with all its documents; the others by global position."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    works = docs.select("source").distinct().withColumn("held", F.pmod(F.row_number().over(Window.orderBy("source")) - 1, F.lit(10)) == 0)
    return docs.join(sized_broadcast(works), "source").select("doc_id", F.when(F.col("held"), "eval").otherwise("train").alias("split"))


def win12_templates(spark, d):
    w = Window.partitionBy("lang").orderBy("doc_id")
    return table(spark, d, "documents").select("doc_id", T.pick(["a", "b", "c"], F.row_number().over(w) - 1).alias("template"))


def set01_operations(spark, d):
    """SET01-SET04: union, difference, intersection and distinct of document and label ids."""
    a, b = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id")
    part = lambda df, name: df.select("doc_id", F.lit(name).alias("op"))
    return part(a.union(b), "union").unionByName(part(a.exceptAll(b), "difference")).unionByName(part(a.intersect(b), "intersection")).unionByName(part(a.union(b).distinct(), "distinct"))


def srt01_sorted(spark, d):
    """SRT01, SRT02: positions in a sort by number descending, then string."""
    w = Window.partitionBy("n_regionkey").orderBy(F.desc("n_nationkey"), "n_name")
    return table(spark, d, "nation").select("n_regionkey", "n_name", F.row_number().over(w).cast("long").alias("pos"))


def cube_orders(spark, d):
    """Grouping sets over orders: beyond the reference's own operators, native here."""
    o = table(spark, d, "orders")
    return o.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("gid"))


def star_join(spark, d):
    """A star join whose date range reaches the scan: quantities by nation for one year."""
    li, o, c, n = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    x = li.join(o.where("o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1996-01-01'"), F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(sized_broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    return x.groupBy("n_name").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))


QUERIES = {f.__name__: f for f in (join06_paired, join08_classification, join12_override, join13_ordered_lookup, join10_work_members, join10_members, join14_view_pairs, join15_resume, join16_citations, join18_views, agg01_counts, agg02_pivot, agg03_merge, agg05_audit, agg06_gaps, agg07_means, agg12_argmin, win01_ranks, win03_quota, win05_last_wins, win08_duplicate_chain, win10_every_nth, win12_templates, set01_operations, srt01_sorted, cube_orders, star_join)}

ORACLE = {
    "join10_members": "SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS position, count(*) OVER (PARTITION BY source, lang) AS n_members FROM documents",
    "join06_paired": "WITH l AS (SELECT c_custkey AS k, count(*) AS a FROM customer GROUP BY 1), r AS (SELECT o_custkey AS k, count(*) AS b FROM orders GROUP BY 1), x AS (SELECT coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM l FULL JOIN r USING (k)) SELECT CASE WHEN a = 0 THEN 'missing left' WHEN b = 0 THEN 'missing right' ELSE 'repeated' END AS problem, count(*) AS n FROM x WHERE a <> 1 OR b <> 1 GROUP BY 1",
    "join08_classification": """WITH m AS (SELECT doc_id AS match_id FROM documents WHERE doc_id % 2 = 0), c AS (SELECT doc_id AS match_id, CASE WHEN quality = 1 THEN 'variant' WHEN toxic = 1 THEN 'bad' ELSE 'unmatched' END AS status, doc_id + doc_id % 6 AS chosen FROM labels)
SELECT match_id, 'unclassified' AS problem FROM m ANTI JOIN c USING (match_id) UNION ALL SELECT match_id, 'unknown match' FROM c ANTI JOIN m USING (match_id)
UNION ALL SELECT match_id, 'unknown status' FROM c WHERE status = 'bad' UNION ALL SELECT match_id, 'not a candidate' FROM c JOIN m USING (match_id) WHERE status <> 'unmatched' AND chosen NOT IN (match_id, match_id + 1)""",
    "join12_override": """WITH c AS (SELECT doc_id * 2 AS doc_id, 'en' AS lang, 'fixed ' || quality AS value FROM labels)
SELECT d.doc_id, d.lang, coalesce(c.value, d.source) AS value, c.value IS NOT NULL AS corrected FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id AND c.lang = d.lang
UNION ALL SELECT doc_id, lang, value, true FROM c WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = c.doc_id AND d.lang = c.lang)""",
    "join13_ordered_lookup": "WITH x AS (SELECT doc_id, unnest([1, 2, 3]) AS pos, unnest([doc_id + 1, doc_id - 1, doc_id * 3]) AS i FROM labels) SELECT x.doc_id, string_agg(coalesce(d.source, i::VARCHAR), '|' ORDER BY pos) AS sources FROM x LEFT JOIN documents d ON d.doc_id = i GROUP BY 1",
    "join10_work_members": "WITH w AS (SELECT source, lang, min(doc_id) AS a, count(DISTINCT doc_id) AS n FROM documents GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 2) SELECT doc_id, coalesce(a, -1)::BIGINT AS anchor, coalesce(n, 0)::BIGINT AS n_members FROM documents LEFT JOIN w USING (source, lang)",
    "join14_view_pairs": "SELECT conv_id, turn, other FROM (SELECT a.conv_id, a.turn, b.turn AS other, row_number() OVER (PARTITION BY a.conv_id ORDER BY a.turn, b.turn) AS r FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn <> b.turn) WHERE r <= 4",
    "join15_resume": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "join16_citations": "SELECT conv_id, coalesce(string_agg(DISTINCT k, ',' ORDER BY k) FILTER (k >= 'kb:6'), '') AS invented FROM (SELECT conv_id, 'kb:' || (length(text) % 9) AS k FROM conversations) GROUP BY 1",
    "join18_views": "SELECT i::BIGINT AS page_id, CASE WHEN html IS NULL THEN 'error' WHEN length(html) < 3000 THEN 'unavailable' ELSE 'ok' END AS status FROM range((SELECT max(page_id) + 1 FROM pages)) t(i) LEFT JOIN pages ON page_id = i",
    "agg01_counts": "SELECT g.lang, q.quality, count(x.doc_id) AS n FROM (SELECT DISTINCT lang FROM documents) g CROSS JOIN (SELECT unnest([0, 1])::INT AS quality) q LEFT JOIN (SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)) x ON x.lang = g.lang AND x.quality = q.quality GROUP BY 1, 2",
    "agg02_pivot": "SELECT source, count(*) FILTER (doc_id % 10 <> 0) AS train, count(*) FILTER (doc_id % 10 = 0) AS eval FROM documents GROUP BY 1",
    "agg03_merge": "WITH x AS (SELECT source, lang, min(doc_id) AS f FROM documents GROUP BY 1, 2) SELECT source, arg_min(lang, f) AS lang, string_agg(lang, ',' ORDER BY f) AS langs FROM x GROUP BY 1",
    "agg05_audit": "SELECT count(*) AS records, count(DISTINCT doc_id) AS ids, count(DISTINCT sha256(text)) AS texts, count(*) FILTER (lang = 'fr') AS french, count(*) FILTER (length(text) < 100) AS short, max(length(text))::BIGINT AS longest, sum(n_chars)::BIGINT AS chars FROM documents",
    "agg06_gaps": "SELECT 'missing' AS kind, i::BIGINT AS value FROM range(1, (SELECT max(doc_id) + 1 FROM labels)) t(i) WHERE i NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'duplicate', doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1 UNION ALL SELECT 'missing', i FROM range(1, 10) t(i) WHERE i NOT IN (SELECT l_linenumber FROM lineitem) UNION ALL SELECT 'duplicate', l_linenumber FROM lineitem GROUP BY l_linenumber HAVING count(*) > 1",
    "agg07_means": "SELECT lang, round(sum(toxic) / count(*)::DOUBLE, 3) AS rate, CASE WHEN sum(toxic) / count(*)::DOUBLE > 0.12 THEN 'high' ELSE 'fine' END AS warning FROM labels JOIN documents USING (doc_id) GROUP BY 1",
    "agg12_argmin": "WITH x AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS b, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS v FROM events) SELECT event_type, max(event_id) FILTER (v = 1) AS best, max(CASE WHEN value < b THEN 'down' WHEN value > b THEN 'up' ELSE 'flat' END) FILTER (r = 1) AS trend FROM x GROUP BY 1",
    "win01_ranks": "SELECT * FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 3",
    "win03_quota": "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 5 ORDER BY doc_id LIMIT 25",
    "win05_last_wins": "SELECT conv_id, role, max(turn) AS last, min(turn) AS first FROM conversations GROUP BY 1, 2",
    "win08_duplicate_chain": f"SELECT doc_id, p AS duplicate_of FROM (SELECT doc_id, lag(doc_id) OVER (PARTITION BY sha256(array_to_string({sql_words('text')}, ' ')) ORDER BY doc_id) AS p FROM documents) WHERE p IS NOT NULL",
    "win10_every_nth": "SELECT doc_id, CASE WHEN (r - 1) % 10 = 0 THEN 'eval' ELSE 'train' END AS split FROM (SELECT doc_id, dense_rank() OVER (ORDER BY source) AS r FROM documents)",
    "win12_templates": "SELECT doc_id, (['a', 'b', 'c'])[(row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) % 3 + 1] AS template FROM documents",
    "set01_operations": "SELECT doc_id, 'union' AS op FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'difference' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'intersection' FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'distinct' FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels)",
    "srt01_sorted": "SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC, n_name) AS pos FROM nation",
    "cube_orders": "SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping_id(o_orderstatus, o_orderpriority)::BIGINT AS gid FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "star_join": "SELECT n_name, count(*) AS n, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE year(o_orderdate) = 1995 GROUP BY 1",
}
