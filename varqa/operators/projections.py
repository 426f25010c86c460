"""Filters, projections and review helpers over nested records (FLT, PRJ, GATE02-03, UDF06)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .common import ordered_list, sql_words, table
from .matching import leak_pairs
from .relational import last_wins, ordered_lookup, override


def public_layers(layers: Column) -> Column:
    """Only the layers that may be published: `publishable` is true (a null isn't) (FLT03)."""
    return F.filter(layers, lambda x: x["publishable"].eqNullSafe(True))


def positive_signals(signals: Column) -> Column:
    """The sparse form of a map of signals (FLT13)."""
    return F.map_filter(signals, lambda _, v: v > 0)


def score_band(score: Column, bands: list[tuple[str, float, float]]) -> Column:
    """Name of the band [low, high) that a score lies in (FLT08)."""
    out = F.lit(None).cast("string")
    for name, low, high in reversed(bands):
        out = F.when((score >= low) & (score < high), name).otherwise(out)
    return out


def usable_reviews(reviews: DataFrame) -> DataFrame:
    """poem_id, kind, text, reviewer, id: corrections with a reviewer and real text; the last one per poem and kind (FLT07, WIN05).

    reviews: id, seq, poem_id, reviewer, corrected_translation, corrected_tashreeh.
    """
    kinds = F.array(F.struct(F.lit("literary_translation").alias("kind"), F.col("corrected_translation").alias("text")), F.struct(F.lit("tashreeh").alias("kind"), F.col("corrected_tashreeh").alias("text")))
    x = reviews.select("id", "seq", "poem_id", "reviewer", F.explode(kinds).alias("c")).select("id", "seq", "poem_id", "reviewer", "c.*")
    full = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) > 0
    x = x.where(full(F.col("poem_id")) & full(F.col("reviewer")) & full(F.col("text")) & ~T.is_bracket_slot(F.col("text")) & ~T.is_bracket_slot(F.col("reviewer")))
    return last_wins(x, ["poem_id", "kind"], "seq").drop("seq")


def corrected_layers(layers: DataFrame, reviews: DataFrame) -> DataFrame:
    """layers (poem_id, kind, text, …) with reviewed texts in place of their own, and reviews without a layer added (JOIN12)."""
    return override(layers, usable_reviews(reviews).select("poem_id", "kind", "text"), ["poem_id", "kind"], "text")


def entry_record(entries: DataFrame, reference_attribution: str = r"(?i)reference translation by") -> DataFrame:
    """Entries (id, front_matter map<string, array<string>>, sections map<string, string>) as poem records (PRJ01, PRJ02).

    Reference and literal slots give a layer only where they have text; a literal slot that names a third party is a
    reference: copyrighted and not trainable. An AI draft is attributed to its model.
    """
    field = lambda k: F.coalesce(F.get(F.coalesce(F.try_element_at("front_matter", F.lit(k)), F.array().cast("array<string>")), F.lit(0)), F.lit(""))
    many = lambda k: F.coalesce(F.try_element_at("front_matter", F.lit(k)), F.array().cast("array<string>"))
    part = lambda k: F.coalesce(F.try_element_at("sections", F.lit(k)), F.lit(""))

    def layer(kind: Column, text: Column, rights: Column, trainable: Column):
        by_ai = text.rlike(r"(?i)ai-drafted")
        return F.struct(kind.alias("kind"), text.alias("text"), rights.alias("rights"), trainable.alias("trainable"), F.when(by_ai, "ai").otherwise("human").alias("created_by"))

    own, free = F.lit("project-original"), F.lit(True)
    literal, third = part("literal_gloss"), part("literal_gloss").rlike(reference_attribution)
    slots = F.array(
        F.when(F.length(part("reference_translation")) > 0, layer(F.lit("reference_translation"), part("reference_translation"), F.lit("copyrighted"), F.lit(False))),
        F.when(F.length(literal) > 0, layer(F.when(third, "reference_translation").otherwise("literal_gloss"), literal, F.when(third, "copyrighted").otherwise("project-original"), ~third)),
        layer(F.lit("ai_translation"), part("ai_translation"), own, free),
        F.when(F.length(part("literary_translation")) > 0, layer(F.lit("literary_translation"), part("literary_translation"), own, free)),
    )
    lines = T.nonempty_lines(part("original"))
    return entries.select(
        "id", field("poet_id").alias("poet_id"), field("title").alias("title"), many("sources").alias("source_ids"), field("rights_status").alias("rights_status"),
        F.struct(part("original").alias("text"), T.dominant_script(part("original")).alias("script"), T.primary_language(field("language")).alias("language")).alias("original"),
        F.struct(part("transliteration").alias("text")).alias("transliteration"),
        F.transform(lines, lambda x, i: F.struct(F.concat("id", F.lit("_l"), (i + 1).cast("string")).alias("segment_id"), x.alias("text"))).alias("segmentation"),
        F.filter(slots, lambda s: s.isNotNull()).alias("translations"),
        F.array(layer(F.lit("tashreeh"), part("tashreeh"), own, free)).alias("tashreeh"),
    )


def review_queue(matches: DataFrame, bands: list[tuple[str, float, float]]) -> DataFrame:
    """match_id, entry, score, band, status of each match's first candidate (PRJ14, AGG01).

    matches: match_id, candidates array<struct<entry, score>>, status, reviewed.
    """
    top = F.get("candidates", F.lit(0))
    return matches.select("match_id", top["entry"].alias("entry"), top["score"].alias("score"), score_band(top["score"], bands).alias("band"), F.coalesce("reviewed", "status").alias("status"))


def prompt_packs(poems: DataFrame, terms: DataFrame, template: str) -> DataFrame:
    """id, prompt: the template with the poem's text and its terms' meanings in their order (UDF06, JOIN13, PRJ17)."""
    meanings = ordered_lookup(poems, "id", "term_ids", terms, "id", "meaning").select("id", F.array_join("values", "\n- ").alias("m"))
    x = poems.join(meanings, "id", "left")
    return x.select("id", F.concat(F.replace(F.lit(template), F.lit("{text}"), F.col("text")), F.coalesce(F.concat(F.lit("\n- "), "m"), F.lit(""))).alias("prompt"))


# --- queries ---------------------------------------------------------------------------------------------------

BANDS = [("exact", 1.0, 1.01), ("strong", 0.5, 1.0), ("weak", 0.0, 0.5)]


def flt03_layers(spark, d):
    """FLT02-FLT06, FLT13: nested layers filtered by tri-state flags, sparse signals."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    layer = lambda name, flag: F.struct(F.lit(name).alias("kind"), flag.alias("publishable"))
    a = F.array(layer("a", F.col("quality") == 1), layer("b", F.col("toxic") == 1), layer("c", F.lit(None).cast("boolean")))
    s = F.create_map(F.lit("chars"), F.col("n_chars") - 1000, F.lit("quality"), F.coalesce("quality", F.lit(0)).cast("long"))
    return x.select("doc_id", F.array_join(F.transform(public_layers(a), lambda v: v["kind"]), "").alias("kinds"), F.array_join(F.array_sort(F.map_keys(positive_signals(s))), ",").alias("signals"))


def flt07_reviews(spark, d):
    """FLT07, WIN05, AGG11, JOIN12: labels as reviews of documents, each document's and its neighbour's (the later id wins);
    corrections counted by kind."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    labels = labels.withColumn("of", F.explode(F.array(F.col("doc_id"), F.col("doc_id") + 1)))
    r = labels.select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("seq"), F.col("of").cast("string").alias("poem_id"), F.when(F.col("quality") == 1, "r1").otherwise("[name]").alias("reviewer"), F.concat(F.lit("t"), "doc_id").alias("corrected_translation"), F.when(F.col("toxic") == 1, F.concat(F.lit("x"), "doc_id")).otherwise("[todo]").alias("corrected_tashreeh"))
    layers = docs.select(F.col("doc_id").cast("string").alias("poem_id"), F.lit("literary_translation").alias("kind"), F.col("source").alias("text"))
    return corrected_layers(layers, r).groupBy("kind", "corrected").agg(F.count("*").alias("n"), F.min("text").alias("first"))


def flt08_bands(spark, d):
    """FLT08, PRJ14: documents as matches, banded by their share of the longest text of their source."""
    x = table(spark, d, "documents")
    top = x.groupBy("source").agg(F.max("n_chars").alias("top"))
    m = x.join(top, "source").select(F.col("doc_id").alias("match_id"), F.array(F.struct(F.col("source").alias("entry"), F.round(F.col("n_chars") / F.col("top"), 4).alias("score"))).alias("candidates"), F.lit("needs_review").alias("status"), F.when(F.pmod("doc_id", F.lit(4)) == 0, "variant").alias("reviewed"))
    return review_queue(m, BANDS)


def prj01_records(spark, d):
    """PRJ01, PRJ02: documents as entries with front matter and sections; their records' layers."""
    x = table(spark, d, "documents")
    one = lambda c: F.array(c)
    e = x.select(
        F.col("doc_id").cast("string").alias("id"),
        F.create_map(F.lit("title"), one(F.col("source")), F.lit("language"), one(F.concat("lang", F.lit("/x"))), F.lit("sources"), F.array(F.lit("s1"), F.col("source"))).alias("front_matter"),
        F.create_map(F.lit("original"), F.col("text"), F.lit("literal_gloss"), F.when(F.pmod("doc_id", F.lit(3)) == 0, "Reference translation by X").when(F.pmod("doc_id", F.lit(3)) == 1, "AI-drafted gloss").otherwise("")).alias("sections"),
    )
    r = entry_record(e)
    return r.select("id", "title", F.col("original.language").alias("language"), F.size("segmentation").cast("long").alias("n_segments"), F.array_join(F.transform("translations", lambda t: F.concat(t["kind"], F.lit(":"), t["created_by"], F.lit(":"), t["trainable"].cast("string"))), ",").alias("layers"))


def gate03_example_leak(spark, d):
    """GATE02, GATE03: leaks of benchmark texts into whole conversations, all messages joined."""
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(ordered_list(F.col("text"), F.col("turn")), " ").alias("text"))
    docs = table(spark, d, "documents").select((-1 - F.col("doc_id")).alias("conv_id"), "text")
    return leak_pairs(c.unionByName(docs), "conv_id", table(spark, d, "benchmark"), "item_id").groupBy("item_id").agg(F.count("*").alias("n"))


def udf06_prompts(spark, d):
    docs, bench = table(spark, d, "documents"), table(spark, d, "benchmark")
    p = docs.select("doc_id", F.col("doc_id").alias("id"), F.col("source").alias("text"), F.array(F.pmod("doc_id", F.lit(60)), F.pmod("doc_id", F.lit(7))).alias("term_ids"))
    packs = prompt_packs(p, bench.select(F.col("item_id").alias("id"), F.col("text").alias("meaning")), "Explain: {text}")
    return packs.select(F.col("id").alias("doc_id"), F.sha2("prompt", 256).alias("prompt_sha256"))


QUERIES = {f.__name__: f for f in (flt03_layers, flt07_reviews, flt08_bands, prj01_records, gate03_example_leak, udf06_prompts)}


def _grams(source: str, key: str) -> str:
    return f"SELECT {key}, unnest(list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' ')))) AS gram FROM (SELECT {key}, {sql_words('text')} AS w FROM ({source})) WHERE len(w) >= 8"


ORACLE = {
    "flt03_layers": "SELECT doc_id, CASE WHEN quality = 1 THEN 'a' ELSE '' END || CASE WHEN toxic = 1 THEN 'b' ELSE '' END AS kinds, array_to_string(list_filter([CASE WHEN n_chars > 1000 THEN 'chars' END, CASE WHEN quality > 0 THEN 'quality' END], lambda x: x IS NOT NULL), ',') AS signals FROM documents LEFT JOIN labels USING (doc_id)",
    "flt07_reviews": """WITH o AS (SELECT doc_id, quality, toxic, doc_id AS of FROM labels UNION ALL SELECT doc_id, quality, toxic, doc_id + 1 FROM labels),
  r AS (SELECT of::VARCHAR AS poem_id, 'literary_translation' AS kind, 't' || doc_id AS text, doc_id FROM o WHERE quality = 1 UNION ALL SELECT of::VARCHAR, 'tashreeh', 'x' || doc_id, doc_id FROM o WHERE quality = 1 AND toxic = 1),
  l AS (SELECT poem_id, kind, arg_max(text, doc_id) AS text FROM r GROUP BY 1, 2), d AS (SELECT doc_id::VARCHAR AS poem_id, 'literary_translation' AS kind, source FROM documents),
  x AS (SELECT coalesce(d.kind, l.kind) AS kind, l.text IS NOT NULL AS corrected, coalesce(l.text, d.source) AS text FROM d FULL JOIN l ON d.poem_id = l.poem_id AND d.kind = l.kind)
SELECT kind, corrected, count(*) AS n, min(text) AS first FROM x GROUP BY 1, 2""",
    "flt08_bands": "WITH x AS (SELECT doc_id, source, round(n_chars::DOUBLE / max(n_chars) OVER (PARTITION BY source), 4) AS score FROM documents) SELECT doc_id AS match_id, source AS entry, score, CASE WHEN score >= 1 THEN 'exact' WHEN score >= 0.5 THEN 'strong' ELSE 'weak' END AS band, CASE WHEN doc_id % 4 = 0 THEN 'variant' ELSE 'needs_review' END AS status FROM x",
    "prj01_records": "SELECT doc_id::VARCHAR AS id, source AS title, lang AS language, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))::BIGINT AS n_segments, CASE doc_id % 3 WHEN 0 THEN 'reference_translation:human:false,' WHEN 1 THEN 'literal_gloss:ai:true,' ELSE '' END || 'ai_translation:human:true' AS layers FROM documents",
    "gate03_example_leak": f"WITH a AS ({_grams(chr(10).join(['SELECT conv_id, string_agg(text, chr(32) ORDER BY turn) AS text FROM conversations GROUP BY 1', 'UNION ALL SELECT -1 - doc_id, text FROM documents']), 'conv_id')}), b AS ({_grams('SELECT item_id, text FROM benchmark', 'item_id')}) SELECT item_id, count(DISTINCT conv_id) AS n FROM a JOIN b USING (gram) GROUP BY 1",
    "udf06_prompts": "SELECT d.doc_id, sha256('Explain: ' || source || coalesce(chr(10) || '- ' || array_to_string(list_filter([a.text, b.text], lambda x: x IS NOT NULL), chr(10) || '- '), '')) AS prompt_sha256 FROM documents d LEFT JOIN benchmark a ON a.item_id = d.doc_id % 60 LEFT JOIN benchmark b ON b.item_id = d.doc_id % 7",
}
