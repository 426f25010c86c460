"""Record builders, layers, the knowledge base, generated examples, page parsing and segmentation (PRJ, GEN, SRC, FLT)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.readers import catalog, html_elements, segments
from ..sources.sinks import search_documents
from .common import table, with_positions

KB = "id string, kind string, text string, poem_ids array<string>, canonical_work_id string, source_ids array<string>, rights string, trainable boolean, uncertainty boolean, provenance_note string"


def layers(poems: DataFrame, include_reference: bool = False) -> DataFrame:
    """Unnests poems into layer rows: original, transliteration, translations, explanations; empty texts and what
    may not be trained on are left out (PRJ03, FLT04, FLT05).

    poems: id, original, transliteration, rights (strings), translations array<struct<kind, text, rights, trainable>>, tashreeh array<struct<text, rights, trainable>>.
    """
    one = lambda kind, text, rights, trainable: F.struct(F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), text.alias("text"), rights.alias("rights"), trainable.alias("trainable"))
    yes = F.lit(True)
    every = F.concat(
        F.array(one("original", F.col("original"), F.col("rights"), yes), one("transliteration", F.col("transliteration"), F.col("rights"), yes)),
        F.transform("translations", lambda t: one(t["kind"], t["text"], t["rights"], t["trainable"])),
        F.transform("tashreeh", lambda t: one("tashreeh", t["text"], t["rights"], t["trainable"])),
    )
    x = poems.select(F.col("id").alias("poem_id"), "original", F.posexplode(every).alias("pos", "l")).select("poem_id", "pos", "original", "l.*")
    x = x.where(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0)
    keep = F.col("trainable").eqNullSafe(True) | (F.lit(include_reference) & (F.col("kind") == "reference_translation"))
    return x.where(keep).select("poem_id", "pos", "kind", "text", "rights", (T.is_uncertain(F.col("text")) | T.is_uncertain(F.col("original"))).alias("uncertainty"))


def kb_rows(df: DataFrame, kb_id: Column, kind: str, text: Column, poem_ids: Column, rights: Column, trainable: Column, uncertain: Column, note: str) -> DataFrame:
    """Knowledge-base rows of one producer; rows without text are left out (PRJ04)."""
    first = F.coalesce(F.get(poem_ids, F.lit(0)), F.lit(""))
    x = df.select(F.concat(F.lit("kb:"), kb_id).alias("id"), F.lit(kind).alias("kind"), text.alias("text"), poem_ids.alias("poem_ids"), first.alias("canonical_work_id"), F.array().cast("array<string>").alias("source_ids"), rights.alias("rights"), trainable.alias("trainable"), uncertain.alias("uncertainty"), F.lit(note).alias("provenance_note"))
    return x.where(F.length(F.trim("text")) > 0)


def examples(rows: DataFrame, *made: tuple[Column | int, Column | str, Column, Column]) -> DataFrame:
    """part, id, family, question, answer, uncertain: an example for each row (id, uncertain) and each of (part, family,
    question, answer) with both texts, in one pass over the rows (GEN)."""
    column = lambda c: c if isinstance(c, Column) else F.lit(c)
    each = [F.struct(*[column(c).alias(n) for c, n in zip(m, ("part", "family", "question", "answer"))]) for m in made]
    x = rows.select("id", "uncertain", F.explode(F.array(*each)).alias("e")).select("e.*", "id", "uncertain")
    return x.where((F.length(F.trim("question")) > 0) & (F.length(F.trim("answer")) > 0))


def with_messages(rows: DataFrame, system: str) -> DataFrame:
    """Examples with their three chat messages; made after numbering, as they repeat question and answer."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return rows.withColumn("messages", F.array(message("system", F.lit(system)), message("user", F.col("question")), message("assistant", F.col("answer"))))


def numbered(parts: list[DataFrame], *order: str) -> DataFrame:
    """The union of examples with global ids ex_{family}_{position} in the order of `part` and the columns: only rows that were kept count.

    Positions are counted over ranges of (part, order), so no task sorts all.
    """
    x = with_positions(reduce(DataFrame.unionByName, parts), "_n", "part", *order)
    return x.withColumn("seq", F.col("_n") + 1).withColumn("id", F.format_string("ex_%s_%06d", "family", "seq")).drop("part", "_n")


# Fixed value: what an answer from uncertain records ends with.
HEDGE_NOTE = "Note: parts of the underlying record carry uncertain readings flagged for review."
SYSTEM = "You are a scholarly assistant. Answer from the corpus and keep its doubts."


def build_examples(poems: DataFrame, records: DataFrame) -> DataFrame:
    """The template families over poems (id, title, original, translation, transliteration, note, uncertain) and
    knowledge-base records (kb_id, kind, text, titles): GEN02-GEN10 and the honesty family."""
    note = HEDGE_NOTE
    h = lambda c: F.when(F.trim(c) != "", T.hedged(c, F.col("uncertain"), note)).otherwise("")
    poems = poems.withColumn("first", T.first_line(F.col("original")))
    say = lambda text, c: F.concat(F.lit(text), c)
    of_poems = examples(
        poems,
        (0, "translation", say("Translate:\n", F.col("original")), h(F.col("translation"))),
        (1, "transliteration", say("Transliterate:\n", F.col("original")), h(F.col("transliteration"))),
        (2, "transliteration", F.when(F.trim("transliteration") != "", say("Give the original of:\n", F.col("transliteration"))), h(F.col("original"))),
        (3, "tashreeh", say("Explain:\n", F.col("original")), h(F.col("note"))),
        (4, "identification", say("Which work begins: ", F.col("first")), h(F.col("title"))),
        (5, "identification", say("How does this work begin: ", F.col("title")), h(F.col("first"))),
        (11, "honesty", say("What does the corpus say of the year 2050 in ", F.col("title")), F.lit("The corpus does not contain an answer to that.")),
    )
    text, titles = F.col("text"), F.array_join("titles", "; ")
    kinds = {
        "term": (6, "term", say("What does this term mean: ", T.before_stop(text)), text),
        "theme": (7, "theme", say("Which works share the theme ", T.before_stop(text)), titles),
        "biographical_claim": (8, "biography", say("What is said of: ", T.body_after_dates(text)), text),
        "event": (9, "biography", say("When: ", T.body_after_dates(text)), text),
        "cluster_relation": (10, "variant_awareness", say("Is this one work: ", titles), text),
    }
    its = [reduce(lambda done, k: F.when(F.col("kind") == k, kinds[k][i] if isinstance(kinds[k][i], Column) else F.lit(kinds[k][i])).otherwise(done), kinds, F.lit(None)) for i in range(4)]
    of_records = examples(records.select(F.col("kb_id").alias("id"), (F.col("kind") == "biographical_claim").alias("uncertain"), "kind", "text", "titles"), (*its[:3], h(its[3])))
    x = numbered([of_poems, of_records], "id")
    return with_messages(x, SYSTEM).select("seq", "id", "family", "question", "answer", "messages", "uncertain")


# --- queries ---------------------------------------------------------------------------------------------------


def _poems(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    t = F.struct(F.lit("literary").alias("kind"), F.when(F.col("quality") == 1, F.concat(F.lit("T "), F.col("source"))).otherwise("").alias("text"), F.lit("project-original").alias("rights"), (F.col("toxic") == 0).alias("trainable"))
    n = F.struct(F.concat(F.lit("about "), F.col("lang")).alias("text"), F.lit("project-original").alias("rights"), (F.col("quality") == 1).alias("trainable"))
    return docs.join(labels, "doc_id").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("original"), F.lit("").alias("transliteration"), F.lit("public-domain").alias("rights"), F.array(t).alias("translations"), F.array(n).alias("tashreeh"))


def prj03_layers(spark, d):
    return layers(_poems(spark, d)).select("poem_id", "kind", F.length("text").cast("long").alias("n"))


def prj04_knowledge_base(spark, d):
    """PRJ04, PRJ05, SET01, AGG01: three producers in one table, counted by kind and flags."""
    docs, bench, pages = table(spark, d, "documents"), table(spark, d, "benchmark"), table(spark, d, "pages")
    no, yes, free = F.lit(False), F.lit(True), F.lit("public-domain")
    ids = lambda c: F.array(c.cast("string"))
    kb = kb_rows(docs, F.concat(F.lit("doc:"), "doc_id"), "original", F.col("text"), ids(F.col("doc_id")), free, F.col("lang") == "en", T.is_uncertain(F.col("text")), "document")
    kb = kb.unionByName(kb_rows(bench, F.concat(F.lit("item:"), "item_id"), "reference", F.col("text"), ids(F.col("item_id")), F.lit("copyrighted"), no, no, "benchmark"))
    kb = kb.unionByName(kb_rows(pages, F.concat(F.lit("page:"), "page_id"), "source", F.col("url"), F.array().cast("array<string>"), free, yes, no, "page"))
    return kb.groupBy("kind", "trainable").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.count_if(F.col("canonical_work_id") == "").alias("without_work"))


def gen_examples(spark, d):
    """GEN02-GEN10, GEN13, FLT05: all template families over documents and labels; counts by family."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    x = docs.join(labels, "doc_id", "left")
    poems = x.select(F.col("doc_id").cast("string").alias("id"), F.concat("source", F.lit(" "), "doc_id").alias("title"), F.col("text").alias("original"), F.when(F.col("quality") == 1, F.col("lang")).otherwise("").alias("translation"), F.lit("").alias("transliteration"), F.when(F.col("toxic") == 1, "noted").otherwise("").alias("note"), (F.coalesce(F.col("toxic"), F.lit(0)) == 1).alias("uncertain"))
    kb = docs.select(F.col("doc_id").cast("string").alias("kb_id"), F.element_at(F.array(*map(F.lit, ("term", "theme", "biographical_claim", "event", "cluster_relation"))), (F.pmod("doc_id", F.lit(5)) + 1).cast("int")).alias("kind"), F.concat("source", F.lit(" (x): "), "lang", F.lit(". More.")).alias("text"), F.array("source", "lang").alias("titles"))
    e = build_examples(poems, kb)
    return e.groupBy("family").agg(F.count("*").alias("n"), F.min("seq").alias("first"), F.max("seq").alias("last"), F.count_if(F.col("uncertain") & T.hedges(F.col("answer"))).alias("hedged"))


def snk03_search(spark, d):
    docs, bench = table(spark, d, "documents"), table(spark, d, "benchmark")
    poems = docs.select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("source").alias("title"), F.lit("p1").alias("poet_id"), "text", F.array("lang").alias("themes"), F.when(F.col("n_chars") > 500, True).alias("public"))
    terms = bench.select(F.concat(F.lit("i"), "item_id").alias("id"), F.concat(F.lit("head "), "item_id").alias("headword"), F.col("text").alias("meaning"))
    return search_documents(poems, terms).select("id", "type", "title", F.sha2("text", 256).alias("text_sha256"))


def src11_pages(spark, d):
    """SRC11, SRC15: pages parsed to elements, then to one catalog row each."""
    return catalog(html_elements(table(spark, d, "pages"))).select("page_id", "n_links", F.col("title").isNull().alias("untitled"))


def src22_segments(spark, d):
    """SRC22, WIN07, AGG06: documents as pages of a book per source, every third one opened by a numbered heading."""
    x = table(spark, d, "documents").select("source", F.col("doc_id").cast("int").alias("page"), F.concat(F.when(F.pmod("doc_id", F.lit(3)) == 0, F.concat(F.pmod("doc_id", F.lit(900)).cast("string"), F.lit(". Title\n"))).otherwise(""), F.coalesce("text", F.lit(""))).alias("text"))
    return segments(x, key="source").select("source", "ordinal", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"), "text")


QUERIES = {f.__name__: f for f in (prj03_layers, prj04_knowledge_base, gen_examples, snk03_search, src11_pages, src22_segments)}

_UNCERTAIN = r"(?i)\[uncertain|\[torn|uncertain line|reading uncertain|high-uncertainty|\(\?\)"
ORACLE = {
    "prj03_layers": "SELECT doc_id::VARCHAR AS poem_id, kind, length(t)::BIGINT AS n FROM (SELECT doc_id, 'original' AS kind, text AS t FROM documents JOIN labels USING (doc_id) UNION ALL SELECT doc_id, 'literary', 'T ' || source FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0 UNION ALL SELECT doc_id, 'tashreeh', 'about ' || lang FROM documents JOIN labels USING (doc_id) WHERE quality = 1) WHERE length(trim(t)) > 0",
    "prj04_knowledge_base": "SELECT kind, trainable, count(*) AS n, count(DISTINCT id) AS ids, count(*) FILTER (w = '') AS without_work FROM (SELECT 'd' || doc_id AS id, 'original' AS kind, lang = 'en' AS trainable, doc_id::VARCHAR AS w, text FROM documents UNION ALL SELECT 'i' || item_id, 'reference', false, item_id::VARCHAR, text FROM benchmark UNION ALL SELECT 'p' || page_id, 'source', true, '', url FROM pages) WHERE length(trim(text)) > 0 GROUP BY 1, 2",
    "gen_examples": """WITH x AS (SELECT d.doc_id, d.doc_id::VARCHAR AS id, text, coalesce(quality = 1, false) AS tr, coalesce(toxic, 0) = 1 AS unc FROM documents d LEFT JOIN labels USING (doc_id)),
  e AS (SELECT 0 AS p, 'translation' AS family, id, unc FROM x WHERE tr AND length(trim(text)) > 0 UNION ALL SELECT 3, 'tashreeh', id, unc FROM x WHERE unc UNION ALL SELECT 4, 'identification', id, unc FROM x UNION ALL SELECT 5, 'identification', id, unc FROM x WHERE length(trim(replace(text, chr(10), ' '))) > 0
    UNION ALL SELECT 6 + doc_id % 5, (['term', 'theme', 'biography', 'biography', 'variant_awareness'])[doc_id % 5 + 1], id, doc_id % 5 = 2 FROM x UNION ALL SELECT 11, 'honesty', id, unc FROM x),
  n AS (SELECT *, row_number() OVER (ORDER BY p, id) AS seq FROM e)
SELECT family, count(*) AS n, min(seq) AS first, max(seq) AS last, count(*) FILTER (unc AND family <> 'honesty') AS hedged FROM n GROUP BY 1""",
    "snk03_search": "SELECT 'd' || doc_id AS id, 'poem' AS type, source AS title, sha256(source || ' ' || text || ' ' || lang) AS text_sha256 FROM documents WHERE n_chars > 500 UNION ALL SELECT 'i' || item_id, 'term', 'head ' || item_id, sha256('head ' || item_id || ' ' || text) FROM benchmark",
    "src22_segments": r"""WITH p AS (SELECT source, doc_id AS page, string_split(CASE WHEN doc_id % 3 = 0 THEN (doc_id % 900) || '. Title' || chr(10) ELSE '' END || coalesce(text, ''), chr(10)) AS l FROM documents),
  x AS (SELECT source, page, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM p), h AS (SELECT *, regexp_matches(s, '^\s*\d{1,3}\.\s*.*\S\s*$') AS head FROM x),
  y AS (SELECT *, sum(head::INT) OVER (PARTITION BY source ORDER BY page, i) AS g FROM h)
SELECT source, max(CASE WHEN head THEN regexp_extract(s, '^\s*(\d{1,3})\.\s*(.*\S)\s*$', 1)::INT END) AS ordinal, min(page) AS page_start, max(page) FILTER (trim(s) <> '') AS page_end,
  regexp_replace(regexp_replace(coalesce(string_agg(s, chr(10) ORDER BY page, i) FILTER (NOT head), ''), '^(?:[ \t]*\n)+', ''), '(?:\n[ \t]*)+$', '') AS text FROM y WHERE g > 0 GROUP BY source, g""",
}
