"""Validation of a whole project and its dashboard: all counts of a table in one scan of it (GATE07, GATE09, AGG09, AGG10).

A rule is a condition on a row, with a level; rows that break it are violations. The same rules can be counted while a
table is being written, by observed metrics, so that a gate costs no scan of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as T
from .common import table

# Fields that a work's record must have, rights under which it may be published, kinds of translations.
REQUIRED = ("id", "poet_id", "title", "work_type", "source_ids", "rights_status", "original", "transliteration", "translations", "tashreeh", "review", "publication")
SAFE = ("public-domain", "permission-cleared", "project-original")
LITERAL = ("literal_gloss", "reference_translation")

Rule = tuple[str, str, Column]


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def record_rules(text: Column | None = None) -> list[Rule]:
    """(level, rule, condition) of any table with ids: a record without one, and unfilled slots in its text."""
    rules: list[Rule] = [("error", "no id", _blank(F.col("id")))]
    return rules + ([("warning", "placeholder", F.coalesce(T.has_placeholder(text), F.lit(False)))] if text is not None else [])


def poem_rules(columns: list[str]) -> list[Rule]:
    """The rules of a work's record (original, transliteration: struct<text>; translations: array<struct<kind, text,
    trainable>>; publication: struct<include_on_website>). A field is missing where the column is, or where it is null."""
    no = F.lit(False)
    c = lambda name, kind: F.col(name) if name in columns else F.lit(None).cast(kind)
    translations = F.coalesce(c("translations", "array<struct<kind: string, text: string, trainable: boolean>>"), F.array())
    kinds = F.transform(translations, lambda t: t["kind"])
    original, transliteration = c("original", "struct<text: string>")["text"], c("transliteration", "struct<text: string>")["text"]
    few = F.size(translations) < 2
    reference = F.exists(translations, lambda t: t["kind"].eqNullSafe("reference_translation") & ~t["trainable"].eqNullSafe(False))
    said = F.concat_ws("\n", original, transliteration, F.transform(translations, lambda t: t["text"]))
    published = F.coalesce(c("publication", "struct<include_on_website: boolean>")["include_on_website"], no)
    style = T.lint_counts(F.coalesce(transliteration, F.lit("")))
    filled = ~F.coalesce(T.has_placeholder(transliteration), no)
    rules: list[Rule] = [("error", f"no {f}", F.lit(True) if f not in columns else F.col(f).isNull()) for f in REQUIRED]
    rules += [
        ("warning", "no original text", _blank(original)),
        ("warning", "no transliteration text", _blank(transliteration)),
        ("warning", "fewer than two translations", few),
        ("warning", "no literal translation", ~few & ~F.arrays_overlap(kinds, F.array(*map(F.lit, LITERAL))).eqNullSafe(True)),
        ("warning", "no literary translation", ~few & ~F.array_contains(kinds, "literary_translation").eqNullSafe(True)),
        ("error", "trainable reference translation", ~few & reference),
        ("warning", "placeholder", F.coalesce(T.has_placeholder(said), no)),
        ("error", "published without rights", published & ~F.coalesce(F.col("rights_status").isin(*SAFE) if "rights_status" in columns else no, no)),
        *[("warning", f"style: {name}", filled & (style[name] > 0)) for name in ("doubled", "nasal", "ain")],
    ]
    return rules


def violations(df: DataFrame, rules: list[Rule], name: str) -> DataFrame:
    """table, level, record_id, rule: a row for each rule that a record breaks, and for each id that several have.

    All rules are checked in one pass; only ids are shuffled.
    """
    broken = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"))) for level, rule, cond in rules]))
    rows = df.select(F.col("id").cast("string").alias("record_id"), F.explode(broken).alias("r")).select("r.level", "record_id", "r.rule")
    twice = df.where(~_blank(F.col("id"))).groupBy(F.col("id").cast("string").alias("record_id")).agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.unionByName(twice.select(F.lit("error").alias("level"), "record_id", F.lit("repeated id").alias("rule")))
    return rows.select(F.lit(name).alias("table"), "level", "record_id", "rule")


def validate_project(tables: dict[str, tuple[DataFrame, list[Rule]]]) -> DataFrame:
    """The violations of all tables of a project (GATE09)."""
    return reduce(DataFrame.unionByName, [violations(df, rules, name) for name, (df, rules) in tables.items()])


def write_observed(df: DataFrame, path: str, rules: list[Rule], metrics: dict[str, Column] | None = None) -> dict[str, int]:
    """Writes df as Parquet and gives, from the same pass, `rows`, `errors`, `warnings`, rows that break each rule, and
    the metrics (aggregates)."""
    seen = Observation()
    counts = [F.count_if(cond).alias(f"{level}: {rule}") for level, rule, cond in rules]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts, *[m.alias(n) for n, m in (metrics or {}).items()]).write.parquet(path)
    got = {k: int(v or 0) for k, v in seen.get.items()}
    return got | {f"{level}s": sum(n for k, n in got.items() if k.startswith(f"{level}: ")) for level in ("error", "warning")}


def dashboard(counts: dict[str, tuple[DataFrame, dict[str, Column]]], found: DataFrame | None = None) -> DataFrame:
    """metric, n: for each table one scan that works out all of its metrics (aggregates); with violations `found` also
    validation_errors and validation_warnings (AGG09, AGG10)."""
    parts = []
    for df, metrics in counts.values():
        one = df.agg(*[m.cast("long").alias(n) for n, m in metrics.items()])
        parts.append(one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.coalesce(F.col(n), F.lit(0)).alias("n")) for n in metrics])).alias("x")).select("x.*"))
    if found is not None:
        parts.append(dashboard({"": (found, {f"validation_{level}s": F.count_if(F.col("level") == level) for level in ("error", "warning")})}))
    return reduce(DataFrame.unionByName, parts)


# --- queries ---------------------------------------------------------------------------------------------------


def _project(spark, d) -> dict[str, tuple[DataFrame, list[Rule]]]:
    """The given tables as a project's: documents as works' records (labels say what they have), the others as records."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    text = lambda c: F.struct(c.alias("text"))
    one = lambda kind, said, trainable: F.struct(F.lit(kind).alias("kind"), said.alias("text"), trainable.alias("trainable"))
    good, marked = F.coalesce(F.col("quality") == 1, F.lit(False)), F.col("toxic") == 1
    translations = F.concat(F.when(good, F.array(one("literary_translation", F.col("source"), F.lit(True)))).otherwise(F.array()), F.when(F.col("quality").isNotNull(), F.array(one("reference_translation", F.col("lang"), marked))).otherwise(F.array()))
    works = x.select(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("poet_id"), F.col("source").alias("title"), F.when(F.col("n_chars") > 200, "prose").alias("work_type"), F.array("source").alias("source_ids"),
        F.when(marked, "copyrighted").otherwise("public-domain").alias("rights_status"), text(F.col("text")).alias("original"), text(F.when(F.pmod("doc_id", F.lit(3)) > 0, F.col("text"))).alias("transliteration"),
        translations.alias("translations"), F.array("lang").alias("tashreeh"), F.col("quality").alias("review"), F.struct(good.alias("include_on_website")).alias("publication"),
    )
    by = lambda name, key, text=None: (table(spark, d, name).withColumn("id", F.col(key)), record_rules(text))
    return {"works": (works, poem_rules(works.columns)), "benchmark": by("benchmark", "item_id", F.col("text")), "pages": by("pages", "page_id", F.col("html")), "conversations": by("conversations", "conv_id", F.col("text")), "embeddings": by("embeddings", "vec_id")}


def gate09_project(spark, d):
    return validate_project(_project(spark, d))


def agg09_status(spark, d):
    """26 counts, each table read once for its own; the last two are the levels of gate09's rows."""
    t, n, some = lambda name: table(spark, d, name), F.count(F.lit(1)), F.count_if
    c, distinct = F.col, F.countDistinct
    counts = {
        "documents": (t("documents"), {"works": n, "languages": distinct("lang"), "sources": distinct("source"), "empty_works": some(F.coalesce(c("text"), F.lit("")) == ""), "long_works": some(c("n_chars") > 10000), "characters": F.sum("n_chars")}),
        "labels": (t("labels"), {"reviews": n, "accepted": some(c("quality") == 1), "flagged": some(c("toxic") == 1)}),
        "benchmark": (t("benchmark"), {"reference_items": n}),
        "pages": (t("pages"), {"source_items": n, "secure_source_items": some(c("url").startswith("https://"))}),
        "conversations": (t("conversations"), {"messages": n, "examples": distinct("conv_id"), "answers": some(c("role") == "assistant"), "questions": some(c("role") == "user"), "system_messages": some(c("role") == "system")}),
        "embeddings": (t("embeddings"), {"index_records": n, "index_labels": distinct("label")}),
        "events": (t("events"), {"events": n, "people": distinct("user_id"), "errors": some(c("event_type") == "error"), "purchases": some(c("event_type") == "purchase"), "event_types": distinct("event_type")}),
    }
    return dashboard(counts, gate09_project(spark, d))


QUERIES = {f.__name__: f for f in (gate09_project, agg09_status)}

_SLOT = r"regexp_matches({0}, '(?i)\[(?:explain|add|describe|fill in|insert|write|paste|todo)\b[^\]]*\]|yes/no/unknown|public-domain/permission-cleared')"
_GATE = rf"""
  x AS (SELECT doc_id::VARCHAR AS id, source, lang, text, n_chars, quality, toxic, coalesce(quality = 1, false) AS good, CASE WHEN doc_id % 3 > 0 THEN text END AS tr FROM documents LEFT JOIN labels USING (doc_id)),
  r AS (SELECT 'works' AS "table", 'error' AS level, id AS record_id, 'no work_type' AS rule FROM x WHERE NOT coalesce(n_chars > 200, false)
    UNION ALL SELECT 'works', 'error', id, 'no review' FROM x WHERE quality IS NULL
    UNION ALL SELECT 'works', 'warning', id, 'no original text' FROM x WHERE trim(coalesce(text, '')) = ''
    UNION ALL SELECT 'works', 'warning', id, 'no transliteration text' FROM x WHERE trim(coalesce(tr, '')) = ''
    UNION ALL SELECT 'works', 'warning', id, 'fewer than two translations' FROM x WHERE NOT good
    UNION ALL SELECT 'works', 'error', id, 'trainable reference translation' FROM x WHERE good AND coalesce(toxic, 1) = 1
    UNION ALL SELECT 'works', 'error', id, 'published without rights' FROM x WHERE good AND coalesce(toxic, 0) = 1
    UNION ALL SELECT 'works', 'warning', id, 'style: doubled' FROM x WHERE regexp_matches(tr, '(?i)aa|ee|oo')
    UNION ALL SELECT 'works', 'warning', id, 'style: nasal' FROM x WHERE regexp_matches(tr, '[ṅṁṉ]')
    UNION ALL SELECT 'works', 'warning', id, 'placeholder' FROM x WHERE {_SLOT.format("concat_ws(chr(10), text, tr, CASE WHEN good THEN source END, CASE WHEN quality IS NOT NULL THEN lang END)")}
    UNION ALL SELECT 'benchmark', 'warning', item_id::VARCHAR, 'placeholder' FROM benchmark WHERE {_SLOT.format('text')}
    UNION ALL SELECT 'pages', 'warning', page_id::VARCHAR, 'placeholder' FROM pages WHERE {_SLOT.format('html')}
    UNION ALL SELECT 'conversations', 'warning', conv_id::VARCHAR, 'placeholder' FROM conversations WHERE {_SLOT.format('text')}
    UNION ALL SELECT 'embeddings', 'error', vec_id::VARCHAR, 'repeated id' FROM embeddings GROUP BY vec_id HAVING count(*) > 1
    UNION ALL SELECT 'benchmark', 'error', item_id::VARCHAR, 'repeated id' FROM benchmark GROUP BY item_id HAVING count(*) > 1
    UNION ALL SELECT 'pages', 'error', page_id::VARCHAR, 'repeated id' FROM pages GROUP BY page_id HAVING count(*) > 1
    UNION ALL SELECT 'conversations', 'error', conv_id::VARCHAR, 'repeated id' FROM conversations GROUP BY conv_id HAVING count(*) > 1)"""
_COUNTS = {
    "documents": "count(*) AS works, count(DISTINCT lang) AS languages, count(DISTINCT source) AS sources, count(*) FILTER (coalesce(text, '') = '') AS empty_works, count(*) FILTER (n_chars > 10000) AS long_works, sum(n_chars)::BIGINT AS characters",
    "labels": "count(*) AS reviews, count(*) FILTER (quality = 1) AS accepted, count(*) FILTER (toxic = 1) AS flagged",
    "benchmark": "count(*) AS reference_items",
    "pages": "count(*) AS source_items, count(*) FILTER (url LIKE 'https://%') AS secure_source_items",
    "conversations": "count(*) AS messages, count(DISTINCT conv_id) AS examples, count(*) FILTER (role = 'assistant') AS answers, count(*) FILTER (role = 'user') AS questions, count(*) FILTER (role = 'system') AS system_messages",
    "embeddings": "count(*) AS index_records, count(DISTINCT label) AS index_labels",
    "events": "count(*) AS events, count(DISTINCT user_id) AS people, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS purchases, count(DISTINCT event_type) AS event_types",
}
ORACLE = {
    "gate09_project": f'WITH {_GATE} SELECT * FROM r',
    "agg09_status": f"WITH {_GATE}, {', '.join(f'c_{t} AS (SELECT {c} FROM {t})' for t, c in _COUNTS.items())} "
    + " UNION ALL ".join(f"SELECT metric, n FROM (UNPIVOT c_{t} ON COLUMNS(*) INTO NAME metric VALUE n)" for t in _COUNTS)
    + " UNION ALL SELECT 'validation_' || l || 's', (SELECT count(*) FROM r WHERE level = l) FROM (VALUES ('error'), ('warning')) v(l)",
}
