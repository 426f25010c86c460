"""Scalar functions over whole tables (FN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys
from ..functions import text as T
from .common import sql_lines, sql_words, table


def fn05_words(spark, d):
    w = T.words(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(w)).cast("long").alias("n_distinct"), F.sha2(F.array_join(w, " "), 256).alias("words_sha256"))


def fn06_ngrams(spark, d):
    w = T.words(F.col("text"))
    return table(spark, d, "documents").select("doc_id", w.alias("w")).select("doc_id", F.size(T.ngram_set(F.col("w"), 8)).cast("long").alias("n_grams"))


def fn04_lines(spark, d):
    x = T.nonempty_lines(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(x).cast("long").alias("n_lines"), F.sha2(F.array_join(x, "\n"), 256).alias("lines_sha256"), T.first_line(F.col("text")).alias("first_line"))


def fn16_script(spark, d):
    docs = table(spark, d, "documents")
    return docs.groupBy("lang", T.dominant_script(F.col("text")).alias("script")).agg(F.count("*").alias("n"))


def fn07_markers(spark, d):
    """FN07, FN32, FN03, FN41 over answers in conversations, with the marker phrases mixed in by turn."""
    said = F.concat(F.col("text"), F.element_at(F.array(*map(F.lit, (" [uncertain]", " The corpus DOES NOT contain it.", " This is Disputed.", " [todo: fill]", ""))), (F.pmod("conv_id", F.lit(5)) + 1).cast("int")))
    c = table(spark, d, "conversations").select("conv_id", "turn", said.alias("t"))
    return c.select("conv_id", "turn", T.is_uncertain(F.col("t")).alias("uncertain"), T.declines(F.col("t")).alias("declines"), T.hedges(F.col("t")).alias("hedges"), T.has_placeholder(F.col("t")).alias("placeholder"), T.is_bracket_slot(F.regexp_extract("t", r"(\[[^\]]*\])$", 1)).alias("slot"))


def fn_cleanup(spark, d):
    """FN02, FN20, FN26-FN30 on conversation turns wrapped in what each function takes off."""
    c = table(spark, d, "conversations")
    t = F.col("text")
    return c.select(
        "conv_id", "turn",
        T.strip_think(F.concat(F.lit("<think>a\nb</think> "), t)).alias("no_think"),
        T.strip_special_tokens(F.concat(t, F.lit("<|im_end|>"))).alias("no_special"),
        F.array_join(T.citations(F.concat(t, F.format_string(" [kb:c%d] and [kb:t%d]", "conv_id", "turn"))), ",").alias("cited"),
        T.grade(F.concat(F.lit("Grade: "), F.pmod("conv_id", F.lit(6)).cast("string"))).alias("grade"),
        T.strip_quotes(F.concat(F.lit('"'), t, F.lit('"'))).alias("unquoted"),
        T.strip_notes(F.concat(t, F.lit("\n_a note_\n_another_\n"))).alias("no_notes"),
        T.trim_blank_edges(F.concat(F.lit("\n  \n"), t, F.lit("\n\n"))).alias("trimmed"),
    )


def fn24_urls(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", T.slug_of_url(u).alias("slug"), T.with_query(u, "lang", F.lit("ur")).alias("view_url"), F.sha2("html", 256).alias("html_sha256"))


def fn31_token_f1(spark, d):
    """Each assistant turn against the user's turn before it."""
    c = table(spark, d, "conversations")
    ask = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("q"))
    a = c.where("role = 'assistant'").join(ask, ["conv_id", "turn"])
    return a.select("conv_id", "turn", F.round(T.token_f1(F.col("text"), F.col("q")), 4).alias("f1"))


def fn_labels(spark, d):
    """FN21, FN22, FN33, FN37-FN40: text composed from fields and taken apart again."""
    docs = table(spark, d, "documents")
    made = docs.select("doc_id", F.concat(F.lit("Event ("), F.col("lang"), F.lit("): "), F.col("source"), F.lit(" happened. More.")).alias("body"), F.concat(F.lit("theme_divine_"), F.col("source")).alias("theme"), F.concat(F.col("lang"), F.lit(" , x/ y")).alias("languages"), "source")
    return made.select(
        "doc_id", T.body_after_dates(F.col("body")).alias("after"), T.before_stop(F.col("body"), r"Event ").alias("before"), T.label_of_id(F.col("theme"), "theme_").alias("label"), T.primary_language(F.col("languages")).alias("language"),
        T.hedged(F.col("source"), F.pmod("doc_id", F.lit(3)) == 0, "Note: uncertain.").alias("hedged"), T.pick(["What is {}?", "Explain {}.", "Define {}."], F.col("doc_id")).alias("template"),
        F.concat_ws(" ", F.coalesce("source", F.lit("")), F.array_join(F.transform(F.split("theme", "_"), F.upper), " ")).alias("search_text"),
    )


def fn14_style(spark, d):
    """FN14, FN15: native vowel lengths and lint counts over whole texts."""
    x = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    n = T.lint_counts(F.col("t"))
    return x.select("doc_id", F.sha2(T.vowel_lengths(F.col("t")), 256).alias("styled_sha256"), n["doubled"].cast("long").alias("doubled"), n["nasal"].cast("long").alias("nasal"))


def fn43_next_id(spark, d):
    n = F.regexp_extract(F.concat(F.lit("doc_"), F.lpad(F.col("doc_id").cast("string"), 7, "0")), r"^doc_(\d+)$", 1).cast("long")
    return table(spark, d, "documents").agg(F.concat(F.lit("doc_"), F.lpad((F.coalesce(F.max(n), F.lit(0)) + 1).cast("string"), 7, "0")).alias("next_id"))


def fn09_keys(spark, d):
    """FN01, FN08-FN10, FN13: keys of every non-blank line, numbered from 1; a document without one has an empty line 1."""
    x = table(spark, d, "documents").select("doc_id", F.posexplode_outer(T.nonempty_lines(F.col("text"))).alias("pos", "t"))
    x = x.select("doc_id", (F.coalesce("pos", F.lit(0)) + 1).cast("long").alias("line"), F.coalesce(F.regexp_replace("t", r"(?U)^\s+", ""), F.lit("")).alias("t"))
    return x.select("doc_id", "line", keys.slugify_udf("t").alias("slug"), keys.latin_key_udf("t").alias("latin_key"), keys.strip_marks_udf("t").alias("plain"), keys.arabic_key_udf("t").alias("arabic_key"), keys.devanagari_key_udf("t").alias("devanagari_key"))


def fn17_views(spark, d):
    """FN17, FN19, FN42: documents as nested lines of tokens; text and alignment read back from the nesting."""
    w = F.transform(T.nonempty_lines(F.col("text")), lambda x, i: F.struct(F.lit("s1").alias("stanza_id"), F.concat(F.lit("l"), i.cast("string")).alias("line_id"), F.transform(F.split(x, " "), lambda t, j: F.struct(F.concat(F.lit("m"), F.pmod(j, F.lit(3)).cast("string")).alias("mapping_id"), t.alias("text"))).alias("tokens")))
    x = table(spark, d, "documents").select("doc_id", w.alias("lines"))
    s = T.alignment_signature(F.col("lines"))
    return x.select("doc_id", F.sha2(T.view_text(F.col("lines")), 256).alias("view_sha256"), F.size(s).cast("long").alias("n_lines"), F.aggregate(s, F.lit(0), lambda a, v: a + F.size(v["mappings"])).cast("long").alias("n_mappings"))


QUERIES = {f.__name__: f for f in (fn05_words, fn06_ngrams, fn04_lines, fn16_script, fn07_markers, fn_cleanup, fn24_urls, fn31_token_f1, fn_labels, fn14_style, fn43_next_id, fn09_keys, fn17_views)}

_UNCERTAIN = r"(?i)\[uncertain|\[torn|uncertain line|reading uncertain|high-uncertainty|\(\?\)"
_DECLINE = r"(?i)does not (currently )?contain|not in the (archive|corpus)|no (record|material|information)|outside the scope|cannot (confirm|supply)|does not attribute"
_HEDGE = r"(?i)disput|uncertain|conventional|later sources|not definitive|debated|cannot be stated|traditions disagree|confidence"

ORACLE = {
    "fn05_words": f"SELECT doc_id, len(w)::BIGINT AS n_words, len(list_distinct(w))::BIGINT AS n_distinct, sha256(array_to_string(w, ' ')) AS words_sha256 FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents)",
    "fn06_ngrams": f"WITH x AS (SELECT doc_id, {sql_words('text')} AS w FROM documents) SELECT doc_id, CASE WHEN len(w) < 8 THEN 0 ELSE len(list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' ')))) END::BIGINT AS n_grams FROM x",
    "fn04_lines": f"SELECT doc_id, len(x)::BIGINT AS n_lines, sha256(array_to_string(x, chr(10))) AS lines_sha256, coalesce(ltrim(x[1]), '') AS first_line FROM (SELECT doc_id, {sql_lines('text')} AS x FROM documents)",
    "fn16_script": r"WITH x AS (SELECT lang, len(regexp_extract_all(text, '[\x{0600}-\x{06FF}]')) AS a, len(regexp_extract_all(text, '[\x{0900}-\x{097F}]')) AS v, len(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{024F}\x{1E00}-\x{1EFF}]')) AS l FROM documents) SELECT lang, CASE WHEN greatest(a, v, l) = 0 THEN 'other' WHEN a = greatest(a, v, l) THEN 'arabic' WHEN v = greatest(a, v, l) THEN 'devanagari' ELSE 'latin' END AS script, count(*) AS n FROM x GROUP BY 1, 2",
    "fn07_markers": rf"WITH x AS (SELECT conv_id, turn, text || ([' [uncertain]', ' The corpus DOES NOT contain it.', ' This is Disputed.', ' [todo: fill]', ''])[conv_id % 5 + 1] AS t FROM conversations) SELECT conv_id, turn, regexp_matches(t, '{_UNCERTAIN}') AS uncertain, regexp_matches(t, '{_DECLINE}') AS declines, regexp_matches(t, '{_HEDGE}') AS hedges, regexp_matches(t, '(?i)\[(?:explain|add|describe|fill in|insert|write|paste|todo)\b[^\]]*\]|yes/no/unknown|public-domain/permission-cleared') AS placeholder, regexp_matches(t, '\[[^\]]*\]$') AS slot FROM x",
    "fn_cleanup": r"""SELECT conv_id, turn, trim(text) AS no_think, trim(text) AS no_special,
  array_to_string(list_concat(regexp_extract_all(text, '\[(kb:[^\]\s]+)\]', 1), ['kb:c' || conv_id, 'kb:t' || turn]), ',') AS cited,
  CASE WHEN conv_id % 6 <= 3 THEN (conv_id % 6)::INT ELSE 0 END AS grade, text AS unquoted,
  regexp_replace(text || chr(10) || '_a note_' || chr(10) || '_another_' || chr(10), '((\n|^)_[^_\n]+_\s*)+$', '') AS no_notes,
  regexp_replace(regexp_replace(text, '^(?:[ \t]*\n)+', ''), '(?:\n[ \t]*)+$', '') AS trimmed FROM conversations""",
    "fn24_urls": r"SELECT page_id, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/*$', 1) AS slug, regexp_replace(url, '[?#].*$', '') || '?lang=ur' AS view_url, sha256(html) AS html_sha256 FROM pages",
    "fn31_token_f1": f"""WITH a AS (SELECT r.conv_id, r.turn, list_distinct({sql_words('r.text')}) AS x, list_distinct({sql_words('q.text')}) AS y
  FROM conversations r JOIN conversations q ON q.conv_id = r.conv_id AND q.turn + 1 = r.turn AND q.role = 'user' WHERE r.role = 'assistant')
SELECT conv_id, turn, round(CASE WHEN len(list_intersect(x, y)) > 0 THEN 2.0::DOUBLE * len(list_intersect(x, y)) / (len(x) + len(y)) ELSE 0.0::DOUBLE END, 4) AS f1 FROM a""",
    "fn_labels": """SELECT doc_id, source || ' happened' AS after, '(' || lang || '): ' || source || ' happened' AS before, 'Divine ' || source AS label, lang AS language,
  CASE WHEN doc_id % 3 = 0 THEN source || chr(10) || chr(10) || 'Note: uncertain.' ELSE source END AS hedged,
  (['What is {}?', 'Explain {}.', 'Define {}.'])[doc_id % 3 + 1] AS template, source || ' THEME DIVINE ' || upper(source) AS search_text FROM documents""",
    "fn14_style": f"""WITH x AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, sha256(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(t, 'aa', 'ā'), 'Aa', 'Ā'), 'AA', 'Ā'), 'ee', 'ī'), 'Ee', 'Ī'), 'EE', 'Ī'), 'oo', 'ū'), 'Oo', 'Ū'), 'OO', 'Ū'), 'ṅ', 'n̄'), 'ṁ', 'n̄'), 'ṉ', 'n̄')) AS styled_sha256,
  len(regexp_extract_all(t, '(?i)aa|ee|oo'))::BIGINT AS doubled, len(regexp_extract_all(t, '[ṅṁṉ]'))::BIGINT AS nasal FROM x""",
    "fn43_next_id": "SELECT 'doc_' || lpad((max(doc_id) + 1)::VARCHAR, 7, '0') AS next_id FROM documents",
    "fn17_views": f"""WITH x AS (SELECT doc_id, list_transform({sql_lines('text')}, lambda l: string_split(l, ' ')) AS t FROM documents)
SELECT doc_id, sha256(array_to_string(list_filter(list_transform(t, lambda l: array_to_string(list_filter(list_transform(l, lambda w: trim(w)), lambda w: w <> ''), ' ')), lambda l: l <> ''), chr(10))) AS view_sha256,
  len(t)::BIGINT AS n_lines, coalesce(list_sum(list_transform(t, lambda l: least(len(l), 3))), 0)::BIGINT AS n_mappings FROM x""",
}
