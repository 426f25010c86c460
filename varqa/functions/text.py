"""Text functions as native columns: everything here stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that mark uncertain readings, declines, hedges and unfilled template slots.
UNCERTAIN = r"(?iu)\[uncertain|\[torn|uncertain line|reading uncertain|high-uncertainty|\(\?\)"
DECLINE = r"(?iu)does not (currently )?contain|not in the (archive|corpus)|no (record|material|information)|outside the scope|cannot (confirm|supply)|does not attribute"
HEDGE = r"(?iu)disput|uncertain|conventional|later sources|not definitive|debated|cannot be stated|traditions disagree|confidence"
PLACEHOLDERS = (
    r"\[first line or working title\]",
    r"\[paste or type[^\]]*\]",
    r"\[type latin transliteration[^\]]*\]",
    r"\[reference translation, e\.g\.[^\]]*\]",
    r"\[ai-drafted english translation[^\]]*\]",
    r"\[your own literary translation\.?\]",
    r"\[explanation of metaphor[^\]]*\]",
    r"\[human-reviewed answer[^\]]*\]",
    r"\[clearly labeled ai translation[^\]]*\]",
    r"\[literal gloss here\]",
    r"\[project literary translation here\]",
    r"\[model name\]",
    r"\[prompt version\]",
    r"\[(?:explain|add|describe|fill in|insert|write|paste|todo)\b[^\]]*\]",
    r"yes/no/unknown",
    r"public-domain/permission-cleared",
)
THINK = r"(?s)<think>.*?</think>"
SPECIAL_TOKENS = r"<\|(?:im_end|im_start|endoftext)\|>"
CITATION = r"\[(kb:[^\]\s]+)\]"
MECHANICAL_FAMILIES = ("identification", "transliteration")
# Doubled vowels and old nasal marks with what the transliteration style writes for them.
STYLE_PAIRS = (("aa", "ā"), ("Aa", "Ā"), ("AA", "Ā"), ("ee", "ī"), ("Ee", "Ī"), ("EE", "Ī"), ("oo", "ū"), ("Oo", "Ū"), ("OO", "Ū"), ("ṅ", "n̄"), ("ṁ", "n̄"), ("ṉ", "n̄"))

#: Everything Python's splitlines() ends a line at.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores (combining marks separate, as Python's \\w does)."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s]", " "), r"(?U)\s+"), lambda w: w != "")


def ngram_set(word_list: Column, n: int) -> Column:
    """Distinct n-word runs, joined by spaces; none where there are fewer words."""
    size = F.size(word_list)
    grams = F.transform(F.sequence(F.lit(0), size - n), lambda i: F.array_join(F.slice(word_list, i + 1, n), " "))
    return F.when(size >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def nonempty_lines(text: Column) -> Column:
    """Lines with something other than white space, right-stripped."""
    strip = lambda x: F.when(F.right(x, F.lit(1)).rlike(r"(?U)\s"), F.regexp_replace(x, r"(?U)\s+$", "")).otherwise(x)
    return F.transform(F.filter(lines(text), lambda x: x.rlike(r"(?U)\S")), strip)


def first_line(text: Column) -> Column:
    """The first non-blank line, trimmed; '' where there is none."""
    return F.coalesce(F.get(F.transform(nonempty_lines(text), lambda x: F.regexp_replace(x, r"(?U)^\s+", "")), F.lit(0)), F.lit(""))


def strip_quotes(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r"(?s)^(['\"])(.*)\1$", "$2")


def is_uncertain(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(UNCERTAIN)


def declines(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(DECLINE)


def hedges(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(HEDGE)


def has_placeholder(*columns: Column) -> Column:
    """True if any of the text columns still holds an unfilled template slot."""
    pattern = "(?iu)" + "|".join(PLACEHOLDERS)
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(c, F.lit("")).rlike(pattern)
    return found


def is_bracket_slot(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit(""))).rlike(r"^\[[^\]]*\]$")


def dominant_script(text: Column) -> Column:
    """arabic, devanagari or latin by counted letters, ties in that order; other where none."""
    counts = {"arabic": r"[\x{0600}-\x{06FF}]", "devanagari": r"[\x{0900}-\x{097F}]", "latin": r"[A-Za-z\x{00C0}-\x{024F}\x{1E00}-\x{1EFF}]"}
    n = {k: F.regexp_count(text, F.lit(v)) for k, v in counts.items()}
    top = F.greatest(*n.values())
    return F.when(top == 0, "other").when(n["arabic"] == top, "arabic").when(n["devanagari"] == top, "devanagari").otherwise("latin")


def strip_notes(text: Column) -> Column:
    """Without trailing lines that are one italic note each."""
    return F.regexp_replace(text, r"((\n|^)_[^_\n]+_\s*)+$", "")


def hedged(answer: Column, uncertain: Column, note: str) -> Column:
    return F.when(uncertain, F.concat(answer, F.lit("\n\n" + note))).otherwise(answer)


def pick(templates: list[str], i: Column) -> Column:
    """Templates in turn, by position."""
    return F.element_at(F.array(*map(F.lit, templates)), (F.pmod(i, F.lit(len(templates))) + 1).cast("int"))


def trim_blank_edges(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^(?:[ \t]*\n)+", ""), r"(?:\n[ \t]*)+$", "")


def strip_think(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, THINK, ""))


def strip_special_tokens(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPECIAL_TOKENS, ""))


def citations(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CITATION), 1)


def grade(reply: Column) -> Column:
    """The first digit from 0 to 3, else 0."""
    return F.coalesce(F.nullif(F.regexp_extract(reply, "[0-3]", 0), F.lit("")).cast("int"), F.lit(0))


def token_f1(answer: Column, reference: Column) -> Column:
    """F1 of the two sets of words; 0 where either is empty."""
    a, b = F.array_distinct(words(answer)), F.array_distinct(words(reference))
    both = F.size(F.array_intersect(a, b))
    return F.when(both > 0, 2.0 * both / (F.size(a) + F.size(b))).otherwise(0.0)


def slug_of_url(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"([^/]*)/*$", 1)


def with_query(url: Column, key: str, value: Column) -> Column:
    """The URL's path with key=value as its only query."""
    return F.concat(F.regexp_replace(url, r"[?#].*$", ""), F.lit(f"?{key}="), value)


def label_of_id(identifier: Column, prefix: str) -> Column:
    """theme_divine_love -> Divine love: first letter only."""
    s = F.replace(F.regexp_replace(identifier, "^" + prefix, ""), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substr(s, F.lit(2))))


def primary_language(languages: Column) -> Column:
    return F.nullif(F.trim(F.get(F.split(F.get(F.split(languages, "/"), F.lit(0)), ","), F.lit(0))), F.lit(""))


def body_after_dates(text: Column) -> Column:
    """What follows the first '): ', up to the first full stop."""
    tail = F.regexp_replace(text, r"(?s)^.*?\): ", "")
    return F.substring_index(tail, ".", 1)


def before_stop(text: Column, prefix: str = "") -> Column:
    return F.substring_index(F.regexp_replace(text, "^" + prefix, ""), ".", 1)


def vowel_lengths(text: Column) -> Column:
    """Doubled Latin vowels as macrons and one nasal mark: the native part of the transliteration style."""
    for source, target in STYLE_PAIRS:
        text = F.replace(text, F.lit(source), F.lit(target))
    return text


def lint_counts(text: Column) -> Column:
    """How often rejected transliteration marks occur: doubled vowels, old nasals, apostrophe for ain."""
    return F.struct(
        F.regexp_count(text, F.lit(r"(?i)aa|ee|oo")).alias("doubled"),
        F.regexp_count(text, F.lit("[ṅṁṉ]")).alias("nasal"),
        F.regexp_count(text, F.lit(r"'(?=[Aa]in\b)")).alias("ain"),
    )


def alignment_signature(lines_column: Column) -> Column:
    """For lines of struct<stanza_id, line_id, tokens: array<struct<mapping_id, text>>>: ids with sorted distinct mappings."""
    return F.transform(lines_column, lambda x: F.struct(x["stanza_id"].alias("stanza_id"), x["line_id"].alias("line_id"), F.array_sort(F.array_distinct(F.transform(x["tokens"], lambda t: t["mapping_id"]))).alias("mappings")))


def view_text(lines_column: Column) -> Column:
    """Tokens joined by spaces and lines by newlines; empty tokens and lines dropped."""
    said = F.transform(lines_column, lambda x: F.array_join(F.filter(F.transform(x["tokens"], lambda t: F.trim(t["text"])), lambda s: s != ""), " "))
    return F.array_join(F.filter(said, lambda s: s != ""), "\n")
