"""Matching texts between sources: n-gram leaks, exact lines, scored top-N candidates, evidence (JOIN01-05, JOIN07, JOIN11)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import text as T
from ..functions.keys import arabic_key_udf, devanagari_key_udf, latin_key_udf, similarity_udf
from ..functions.numbers import round_exact
from .common import cut_lineage, ordered_list, sized_broadcast, sql_lines, sql_words, table
from .linejoin import held_keys, keys_like, similar_keys

# The length of a leak, the thresholds of coverage and the cap of approximate scores.
LEAK_WORDS = 8
STRONG, LOOSE, LOOSE_APPROXIMATE, APPROXIMATE_CAP = 0.80, 0.60, 0.55, 0.98


def grams_of(df: DataFrame, key: str, text: str, n: int = LEAK_WORDS) -> DataFrame:
    """key, gram: the distinct n-word runs of each row's text."""
    w = df.select(key, T.words(F.col(text)).alias("_w"))
    return w.select(key, F.explode(T.ngram_set(F.col("_w"), n)).alias("gram"))


def leak_pairs(texts: DataFrame, key: str, protected: DataFrame, protected_key: str, n: int = LEAK_WORDS) -> DataFrame:
    """key, protected_key, n_grams for texts that share an n-word run with a protected text.

    The runs meet in an equi join on the run itself; the protected side is broadcast if it is small.
    """
    mine, theirs = grams_of(texts, key, "text", n), grams_of(protected, protected_key, "text", n)
    return mine.join(sized_broadcast(theirs, 200_000), "gram").groupBy(key, protected_key).agg(F.count("*").alias("n_grams"))


def short_text_leaks(texts: DataFrame, key: str, protected: DataFrame, protected_key: str, n: int = LEAK_WORDS) -> DataFrame:
    """Protected texts of fewer than n words, contained in the joined words of a text (as a substring).

    Candidates come from an equi join on one word of the protected text, its longest, among the text's words or
    their parts; containment is then confirmed on the strings.
    """
    short = protected.select(protected_key, T.words(F.col("text")).alias("w")).where((F.size("w") < n) & (F.size("w") > 0))
    short = short.select(protected_key, F.array_join("w", " ").alias("needle"), F.size("w").alias("_k"), F.get("w", F.lit(1)).alias("second"))
    hay = texts.select(key, T.words(F.col("text")).alias("hw"))
    # From three words on, the second word stands whole in any text that holds them: ids meet first, then the texts.
    met = hay.select(key, F.explode(F.array_distinct("hw")).alias("second")).join(sized_broadcast(short.where("_k >= 3")), "second").select(key, protected_key, "needle")
    joined = hay.select(key, F.array_join("hw", " ").alias("hay"))
    by_word = joined.join(met, key).where("contains(hay, needle)").select(key, protected_key)
    return by_word.unionByName(_holding(joined, key, short.where("_k < 3").select(protected_key, "needle"), protected_key)).distinct()


#: Needles that one automaton holds; more of them are looked for in several passes.
NEEDLES = 50_000


def _holding(texts: DataFrame, key: str, needles: DataFrame, needle_key: str) -> DataFrame:
    """key, needle_key for the needles (of a word or two: they can begin and end inside longer words) that stand anywhere
    in a text (key, hay): one reading of each text for all needles of a pass, by an automaton."""
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((texts, key), (needles, needle_key))}
    needles, found_type = cut_lineage(needles), to_arrow_type(needles.schema[needle_key].dataType)
    passes = max(1, -(-needles.count() // NEEDLES))
    out = None
    for i in range(passes):
        held: dict[str, list] = {}
        for r in needles.where(F.pmod(F.xxhash64("needle"), F.lit(passes)) == i).toLocalIterator():
            held.setdefault(r["needle"], []).append(r[needle_key])
        if not held:
            continue

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            automaton = ahocorasick.Automaton()
            for needle, ids in held.items():
                automaton.add_word(needle, (needle, ids))
            automaton.make_automaton()
            for b in batches:
                at, found = [], []
                for j, hay in enumerate(b.column(1).to_pylist()):
                    mine = {k for needle in {v[0] for _, v in automaton.iter(hay or "")} for k in held[needle]}
                    at += [j] * len(mine)
                    found += mine
                yield pa.record_batch([b.column(0).take(pa.array(at, pa.int64())), pa.array(found, found_type)], [key, needle_key])

        hits = texts.select(key, "hay").mapInArrow(run, f"{key} {kinds[key]}, {needle_key} {kinds[needle_key]}")
        out = hits if out is None else out.unionByName(hits)
    return out if out is not None else texts.select(key).join(needles.select(needle_key), F.lit(False)).select(key, needle_key)


def leaks(texts: DataFrame, key: str, protected: DataFrame, protected_key: str, n: int = LEAK_WORDS) -> DataFrame:
    """key, protected_key of texts that share an n-word run with a protected text, or hold a shorter one (GATE01, JOIN11)."""
    runs = leak_pairs(texts, key, protected, protected_key, n).select(key, protected_key)
    return runs.unionByName(short_text_leaks(texts, key, protected, protected_key, n)).distinct()


def exact_line_overlap(texts: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """key, other_key, n_lines: how many distinct normalised lines two texts have in common."""

    def keyed(df, k):
        x = df.select(k, F.explode(T.nonempty_lines(F.col("text"))).alias("line"))
        return x.select(k, F.array_join(T.words(F.col("line")), " ").alias("line_key")).where("line_key <> ''").distinct()

    return keyed(texts, key).join(sized_broadcast(keyed(other, other_key), 200_000), "line_key").groupBy(key, other_key).agg(F.count("*").alias("n_lines"))


def line_similarity(texts: DataFrame, key: str, other: DataFrame, other_key: str, least: float) -> DataFrame:
    """key, pos, other_key, other_pos, score: line pairs whose similarity reaches `least`, without loss.

    Distinct keys meet once, by their rarest grams (`similar_keys`); the pairs are then given back to their lines.
    """

    def keyed(df, k, pos, name):
        x = df.select(k, F.posexplode(T.nonempty_lines(F.col("text"))).alias(pos, "line"))
        return x.select(k, pos, F.lit("r").alias("script"), latin_key_udf("line").alias(name)).where(f"{name} <> ''")

    a, b = cut_lineage(keyed(texts, key, "pos", "lk")), cut_lineage(keyed(other, other_key, "other_pos", "rk"))
    alike = cut_lineage(similar_keys(a.select("script", "lk"), b.select("script", "rk"), least).drop("script"))
    return a.join(sized_broadcast(alike), "lk").join(sized_broadcast(b, 200_000), "rk").select(key, "pos", other_key, "other_pos", "score")


def combine_signals(roman: list[Column], urdu: list[Column], approximate: list[Column], exact_lines: Column) -> Column:
    """The match score: the best native signal; two strong scripts together a little more; approximate channels at
    most APPROXIMATE_CAP; any exact line 1. Rounded to 4 places."""
    top = lambda c: F.greatest(*c) if len(c) > 1 else c[0]
    r, u = top(roman), top(urdu)
    score = F.greatest(r, u)
    score = F.when((r >= 0.75) & (u >= 0.75), F.greatest(score, F.least(F.lit(1.0), (r + u) / 2 + 0.05))).otherwise(score)
    score = F.greatest(score, F.least(F.lit(APPROXIMATE_CAP), top(approximate)))
    return round_exact(F.when(exact_lines > 0, 1.0).otherwise(score), 4)


def score_items(items: DataFrame, entries: DataFrame, least: float = 0.0) -> DataFrame:
    """item_id, entry_id, score, signals (positive ones, to 4 places), exact_roman, exact_urdu (JOIN01).

    items: item_id, roman_title, roman_text, urdu_title, urdu_text, devanagari_title, devanagari_text; entries: entry_id,
    title, roman_text, urdu_text. Titles and lines are compared by their keys; Devanagari meets the Roman side by
    transliteration. A signal is the best similarity of its kind, whatever it is, or with `least`
    those that reach it (others count as none, in the rule for two strong scripts too); `best_matches` finds the top ones without all pairs.
    Nulls and blank lines have no key; repeated lines count once; empty tables give no rows.
    """
    def keyed(df, key, parts):
        out = None
        for part, script, column, make, lines in parts:
            text = F.explode(T.nonempty_lines(F.col(column))) if lines else F.col(column)
            x = df.select(key, F.lit(part).alias("part"), F.lit(script).alias("script"), text.alias("t")).select(key, "part", "script", make("t").alias("k")).where("k <> ''")
            out = x if out is None else out.unionByName(x)
        return out

    sides = ("roman", "r", latin_key_udf), ("urdu", "u", arabic_key_udf), ("devanagari", "r", devanagari_key_udf)
    mine = cut_lineage(keyed(items, "item_id", [(f"{name}_{kind}", script, f"{name}_{kind}", make, kind == "text") for name, script, make in sides for kind in ("title", "text")]).distinct())
    held = held_keys(mine.select("script", F.col("k").alias("lk")), "lk", least)
    if held is not None:  # one pass over the entries leaves the keys that can be like an item's
        theirs = keys_like(entries, "entry_id", [("title", "r", "title", "latin_key", False), ("lines", "r", "roman_text", "latin_key", True), ("lines", "u", "urdu_text", "arabic_key", True)], held, least)
    else:
        theirs = keyed(entries, "entry_id", [("title", "r", "title", latin_key_udf, False), ("lines", "r", "roman_text", latin_key_udf, True), ("lines", "u", "urdu_text", arabic_key_udf, True)])
    theirs = cut_lineage(theirs)
    alike = cut_lineage(similar_keys(mine.select("script", F.col("k").alias("lk")), theirs.select("script", F.col("k").alias("rk")), least))
    said = theirs.withColumnRenamed("k", "rk").withColumnRenamed("part", "theirs").join(sized_broadcast(alike, 200_000), ["script", "rk"]).distinct()
    met = said.join(mine.withColumnRenamed("k", "lk").withColumnRenamed("part", "mine"), ["script", "lk"])
    lines, says = F.col("theirs") == "lines", lambda part: F.col("mine") == part
    rules = {
        "roman_title_to_title": says("roman_title") & ~lines, "roman_title_to_any_line": says("roman_title"), "roman_any_line": says("roman_text") & lines,
        "urdu_title_to_any_line": says("urdu_title"), "urdu_any_line": says("urdu_text"),
        "devanagari_title_to_any_line": says("devanagari_title"), "devanagari_any_line": says("devanagari_text") & lines,
    }
    exact = lambda part: F.count_if(says(part) & lines & (F.col("lk") == F.col("rk")))
    x = met.groupBy("item_id", "entry_id").agg(*[F.coalesce(F.max(F.when(rule, F.col("score"))), F.lit(0.0)).alias(name) for name, rule in rules.items()], exact("roman_text").alias("exact_roman"), exact("urdu_text").alias("exact_urdu"))
    c = F.col
    score = combine_signals([c("roman_title_to_any_line"), c("roman_any_line")], [c("urdu_title_to_any_line"), c("urdu_any_line")], [c("devanagari_title_to_any_line"), c("devanagari_any_line")], c("exact_roman") + c("exact_urdu"))
    signals = F.map_filter(F.create_map(*[v for name in rules for v in (F.lit(name), round_exact(c(name), 4))]), lambda _, v: v > 0)
    return x.select("item_id", "entry_id", score.alias("score"), signals.alias("signals"), "exact_roman", "exact_urdu").where("score > 0")


#: Scores down to which candidates are looked for, one after the other, until an item has enough of them.
TIERS = (0.75, 0.5, 0.0)


def best_matches(items: DataFrame, entries: DataFrame, n: int) -> DataFrame:
    """item_id, entry_id, score, signals, exact_roman, exact_urdu, rank: each item's n best entries of all with a positive score.

    Signals below a tier can't lift an entry over it, so an item that has n entries from a tier on is done; only the
    others are compared again, with all entries, at the next tier, and at last at any score. Signals of an item's rows
    are those from its tier on.
    """
    if n < 1:
        raise ValueError("top_n must be at least 1")
    left, done = cut_lineage(items), None
    for tier in TIERS:
        scored = cut_lineage(score_items(left, entries, tier))
        have = scored.where(F.col("score") >= tier).groupBy("item_id").count().where(F.col("count") >= n).select("item_id")
        own = scored.join(have, "item_id", "left_semi").where(F.col("score") >= tier) if tier else scored
        done = own if done is None else done.unionByName(own)
        left = left.join(have, "item_id", "left_anti")
    return top_matches(done, "item_id", "entry_id", n)


def top_matches(scored: DataFrame, item: str, candidate: str, n: int) -> DataFrame:
    """The n best candidates of each item by (score descending, candidate), positive scores only."""
    if n < 1:
        raise ValueError("top_n must be at least 1")
    order = Window.partitionBy(item).orderBy(F.desc("score"), F.asc(candidate))
    return scored.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= n) & (F.col("score") > 0))


def nested_matches(ranked: DataFrame, item: str, candidate: str) -> DataFrame:
    """One row per item with its candidates in order."""
    one = F.struct(F.col(candidate), "score")
    return ranked.groupBy(item).agg(ordered_list(one, F.col("rank")).alias("candidates"))


def best_alignment(pairs: DataFrame, source: list[str], target_pos: str) -> DataFrame:
    """Per source line the best target line: highest score, then the first."""
    order = Window.partitionBy(*source).orderBy(F.desc("score"), F.asc(target_pos))
    return pairs.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def propose_status(channels: Column, strong_w: Column, strong_e: Column, loose_w: Column, loose_e: Column, exact: Column) -> Column:
    """Status from the coverage of witness and entry at the strong and the loose threshold."""
    return (
        F.when(~channels, "unmatched")
        .when((loose_w == 0) & (loose_e == 0) & (exact == 0), "unmatched")
        .when((strong_w >= 0.9) & (strong_e >= 0.9), "exact_witness")
        .when((loose_w >= 0.7) & (loose_e >= 0.7), "variant")
        .when(((loose_w >= 0.8) & (loose_e < 0.5)) | ((loose_e >= 0.8) & (loose_w < 0.5)), "excerpt")
        .otherwise("possible")
    )


def coverage(lines: DataFrame, aligned: DataFrame, keys: list[str], pos: str, strong: float = STRONG, loose: Column | float = LOOSE) -> DataFrame:
    """Share of each key's lines whose best score, rounded to 2 places, reaches either threshold, to 2 places; `n` lines.

    Lines without a partner have a score of 0; `loose` may be a column of the lines.
    """
    x = lines.join(aligned, [*keys, pos], "left").withColumn("s", F.coalesce(round_exact(F.col("score"), 2), F.lit(0.0)))
    share = lambda least: round_exact(F.avg((F.col("s") >= least).cast("int")), 2)
    return x.groupBy(*keys).agg(share(strong).alias("strong"), share(loose).alias("loose"), F.count("*").alias("n"))


def channel_lines(df: DataFrame, key: str, channels: dict[str, tuple[str, object]]) -> DataFrame:
    """key, channel, pos, raw, k: the non-blank lines of each channel's column with their keys (empty ones left out).

    channels: name -> (column, key function); Devanagari lines have the key of their transliteration.
    """
    out = None
    for channel, (column, make) in channels.items():
        x = df.select(key, F.lit(channel).alias("channel"), F.posexplode(T.nonempty_lines(F.col(column))).alias("pos", "raw"))
        x = x.select(key, "channel", "pos", F.trim("raw").alias("raw"), make("raw").alias("k")).where("k <> ''")
        out = x if out is None else out.unionByName(x)
    return out


WITNESS = {"roman": ("roman_text", latin_key_udf), "urdu": ("urdu_text", arabic_key_udf), "devanagari": ("devanagari_text", devanagari_key_udf)}
#: An entry's Roman lines also stand against the transliterated Devanagari ones.
ENTRY = {"roman": ("roman_text", latin_key_udf), "urdu": ("urdu_text", arabic_key_udf), "devanagari": ("roman_text", latin_key_udf)}


def line_evidence(matches: DataFrame, items: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(evidence, alignment) of matches (item_id, entry_id) for each channel that both sides have lines in.

    evidence: item_id, entry_id, channel, witness_lines, entry_lines, exact_lines (distinct keys in common),
    witness_strong, entry_strong, witness_loose, entry_loose (to 2 places; the loose threshold is lower for Devanagari).
    alignment: item_id, entry_id, channel, side, pos, raw, best (the other side's line; empty where nothing is alike),
    score. Each line goes to the other side's line of the highest score, of equal ones the first. A match's lines meet
    each other only, all of them, and keys that occur again are compared once. Unknown ids and empty texts have no channel.
    """
    wanted = matches.select("item_id", "entry_id").distinct()
    # Only the matches' texts are cut to lines and keyed: a key is a function in Python that no join is pushed below.
    of = lambda df, key: cut_lineage(df.join(sized_broadcast(wanted.select(key).distinct()), key, "left_semi"))
    w = wanted.join(channel_lines(of(items, "item_id"), "item_id", WITNESS), "item_id")
    e = wanted.join(channel_lines(of(entries, "entry_id"), "entry_id", ENTRY), "entry_id")
    pair = ["item_id", "entry_id", "channel"]
    w, e = cut_lineage(w.select(*pair, "pos", "raw", "k")), cut_lineage(e.select(*pair, "pos", "raw", "k"))
    both = w.select(*pair).distinct().intersect(e.select(*pair).distinct())
    w, e = w.join(both, pair), e.join(both, pair)
    other = e.select(*pair, F.col("pos").alias("epos"), F.col("raw").alias("eraw"), F.col("k").alias("ek"))
    met = w.select(*pair, F.col("pos").alias("wpos"), F.col("raw").alias("wraw"), F.col("k").alias("wk")).join(other, pair)
    # The ratio is not the same both ways: forward scores have the witness first, backward ones the entry.
    ratio = lambda a, b: F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(similarity_udf(a, b)).alias("score")
    forward = cut_lineage(met.select("wk", "ek").distinct().select("wk", "ek", ratio("wk", "ek")))
    backward = cut_lineage(met.select("wk", "ek").distinct().select("wk", "ek", ratio("ek", "wk")))
    sides = []
    for side, lines, pos, raw, scores, to, said in (("witness", w, "wpos", "wraw", forward, "epos", "eraw"), ("entry", e, "epos", "eraw", backward, "wpos", "wraw")):
        best = best_alignment(met.join(scores, ["wk", "ek"]).where("score > 0"), [*pair, pos], to).select(*pair, F.col(pos).alias("pos"), F.col(said).alias("best"), "score")
        soft = F.when(F.col("channel") == "devanagari", LOOSE_APPROXIMATE).otherwise(LOOSE)
        share = coverage(lines.select(*pair, "pos"), best.select(*pair, "pos", "score"), pair, "pos", loose=soft)
        sides.append((side, share, lines.join(best, [*pair, "pos"], "left").select(*pair, F.lit(side).alias("side"), "pos", "raw", F.coalesce("best", F.lit("")).alias("best"), round_exact(F.coalesce("score", F.lit(0.0)), 2).alias("score"))))
    named = [x.select(*pair, F.col("strong").alias(f"{side}_strong"), F.col("loose").alias(f"{side}_loose"), F.col("n").alias(f"{side}_lines")) for side, x, _ in sides]
    exact = w.select(*pair, "k").distinct().intersect(e.select(*pair, "k").distinct()).groupBy(*pair).agg(F.count("*").alias("exact_lines"))
    evidence = named[0].join(named[1], pair).join(exact, pair, "left").na.fill(0, ["exact_lines"])
    evidence = evidence.select(*pair, "witness_lines", "entry_lines", "exact_lines", "witness_strong", "entry_strong", "witness_loose", "entry_loose")
    return evidence, sides[0][2].unionByName(sides[1][2])


# The order of channels among equal ones.
CHANNELS = ("roman", "urdu", "devanagari")


def proposals(matches: DataFrame, items: DataFrame, evidence: DataFrame) -> DataFrame:
    """item_id, status, entry_id, channel, note for each item of matches (item_id, entry_id, rank).

    A candidate's best channel is that of most strong, then most loose coverage of both sides; the item goes with the
    candidate of most loose coverage, the first of equal ones. Items that aren't in `items` have the note `missing`, those
    without a candidate or a common channel `no comparable channel`; both are unmatched.
    """
    turn = F.array_position(F.array(*map(F.lit, CHANNELS)), F.col("channel"))
    strong, loose = F.col("witness_strong") + F.col("entry_strong"), F.col("witness_loose") + F.col("entry_loose")
    per_pair = Window.partitionBy("item_id", "entry_id").orderBy(strong.desc(), loose.desc(), turn)
    best = evidence.withColumn("_c", F.row_number().over(per_pair)).where("_c = 1").drop("_c")
    ranked = best.join(matches.select("item_id", "entry_id", "rank").distinct(), ["item_id", "entry_id"])
    chosen = ranked.withColumn("_r", F.row_number().over(Window.partitionBy("item_id").orderBy(loose.desc(), "rank", "entry_id"))).where("_r = 1")
    c = F.col
    known = items.select("item_id", F.lit(True).alias("known")).distinct()
    x = matches.select("item_id").distinct().join(known, "item_id", "left").join(chosen, "item_id", "left")
    status = propose_status(c("channel").isNotNull(), c("witness_strong"), c("entry_strong"), c("witness_loose"), c("entry_loose"), c("exact_lines"))
    note = F.when(c("known").isNull(), "missing").when(c("channel").isNull(), "no comparable channel")
    return x.select("item_id", status.alias("status"), "entry_id", "channel", note.alias("note"))


# --- queries ---------------------------------------------------------------------------------------------------


def gate01_ngram_leak(spark, d):
    return leak_pairs(table(spark, d, "documents"), "doc_id", table(spark, d, "benchmark"), "item_id")


def join11_short_leak(spark, d):
    """Second rule of the leak gate: the lines and sentences of each item, of however few words, are looked for in the texts."""
    parts = table(spark, d, "benchmark").select("item_id", F.explode(F.split("text", r"[.!?\n]+")).alias("text"))
    return short_text_leaks(table(spark, d, "documents"), "doc_id", parts, "item_id")


def join04_exact_lines(spark, d):
    return exact_line_overlap(table(spark, d, "documents"), "doc_id", table(spark, d, "benchmark"), "item_id")


def join01_source_matching(spark, d):
    """Benchmark items against documents by shared runs: Jaccard-like score, top 3 documents of each item."""
    docs, bench = table(spark, d, "documents"), table(spark, d, "benchmark")
    hits = _shared_runs(docs, bench)
    score = F.round(2.0 * F.col("n_grams") / (F.col("n_item") + F.col("n_doc")), 4)
    return top_matches(hits.select("item_id", "doc_id", score.alias("score")), "item_id", "doc_id", 3).select("item_id", "doc_id", "score", F.col("rank").cast("long").alias("rank"))


def _shared_runs(docs: DataFrame, bench: DataFrame, n: int = 4) -> DataFrame:
    mine, theirs = grams_of(docs, "doc_id", "text", n), grams_of(bench, "item_id", "text", n)
    n_doc, n_item = mine.groupBy("doc_id").agg(F.count("*").alias("n_doc")), theirs.groupBy("item_id").agg(F.count("*").alias("n_item"))
    hits = mine.join(sized_broadcast(theirs, 200_000), "gram").groupBy("item_id", "doc_id").agg(F.count("*").alias("n_grams"))
    return hits.join(n_doc, "doc_id").join(sized_broadcast(n_item), "item_id")


def join02_line_scores(spark, d):
    """Similarity join of document lines with benchmark lines at 0.9, then per item and document the best score and exact lines combined."""
    docs = table(spark, d, "documents")
    pairs = line_similarity(docs, "doc_id", table(spark, d, "benchmark"), "item_id", 0.9)
    per = pairs.groupBy("item_id", "doc_id").agg(F.max("score").alias("best"), F.sum((F.col("score") == 1.0).cast("int")).alias("exact"))
    zero = F.lit(0.0)
    return top_matches(per.withColumn("score", combine_signals([F.col("best")], [zero], [zero], F.col("exact"))), "item_id", "doc_id", 5).select("item_id", "doc_id", "score", "rank")


def join07_evidence(spark, d):
    """Coverage of items by their documents' lines (exact keys) and the status it proposes."""
    docs, bench = table(spark, d, "documents"), table(spark, d, "benchmark")

    def keyed(df, k):
        x = df.select(k, F.posexplode(T.nonempty_lines(F.col("text"))).alias("pos", "line"))
        return x.select(k, "pos", F.array_join(T.words(F.col("line")), " ").alias("lk")).where("lk <> ''")

    items = keyed(bench, "item_id")
    hit = items.join(keyed(docs, "doc_id").withColumnRenamed("pos", "dpos"), "lk")
    per = hit.groupBy("item_id", "doc_id").agg(F.countDistinct("pos").alias("covered"), F.countDistinct("dpos").alias("doc_covered"))
    n_item, n_doc = items.groupBy("item_id").agg(F.count("*").alias("n_item")), keyed(docs, "doc_id").groupBy("doc_id").agg(F.count("*").alias("n_doc"))
    x = per.join(n_item, "item_id").join(n_doc, "doc_id")
    w, e = F.col("covered") / F.col("n_item"), F.col("doc_covered") / F.col("n_doc")
    return x.select("item_id", "doc_id", "covered", "n_item", "n_doc", propose_status(F.lit(True), w, e, w, e, F.col("covered")).alias("status"))


# Letters that stand for the Latin ones in the views that the queries derive.
_URDU, _NAGARI = "ابچدےفگہیجکلمنوپقرستعتوخیز", "अबचदएफगहइजकलमनओपकरसतउववखयझ"


def _views(df: DataFrame, key: str) -> DataFrame:
    """Texts in three scripts, each letter by one of the other script, with the first line's first words as titles."""
    t = F.coalesce(F.col("text"), F.lit(""))
    other = lambda to: F.translate(F.lower(t), "abcdefghijklmnopqrstuvwxyz", to)
    title = lambda c: F.substring(F.coalesce(F.get(T.nonempty_lines(c), F.lit(0)), F.lit("")), 1, 40)
    return df.select(F.col(key), t.alias("roman_text"), other(_URDU).alias("urdu_text"), other(_NAGARI).alias("devanagari_text")).select("*", *[title(F.col(f"{s}_text")).alias(f"{s}_title") for s in ("roman", "urdu", "devanagari")])


def _item_views(bench: DataFrame) -> DataFrame:
    return _views(bench, "item_id")


def _entry_views(docs: DataFrame) -> DataFrame:
    return _views(docs.withColumnRenamed("doc_id", "entry_id"), "entry_id").withColumnRenamed("roman_title", "title")


def _signal_matches(spark, d) -> DataFrame:
    items, entries = _item_views(table(spark, d, "benchmark")), _entry_views(table(spark, d, "documents"))
    return top_matches(score_items(items, entries, least=0.9), "item_id", "entry_id", 3)


def join01_signals(spark, d):
    """Benchmark items against all documents by seven signals over three scripts, from a similarity of 0.9 on; top 3."""
    best = _signal_matches(spark, d)
    signals = F.array_join(F.array_sort(F.transform(F.map_entries("signals"), lambda e: F.concat_ws("=", e["key"], F.format_number(e["value"], 4)))), ",")
    return best.select("item_id", F.col("entry_id").alias("doc_id"), "score", F.col("rank").cast("long").alias("rank"), signals.alias("signals"), "exact_roman", "exact_urdu")


def join07_channels(spark, d):
    """Evidence of each match in each channel: coverage of both sides, exact lines, and the item's proposed status."""
    matches = cut_lineage(_signal_matches(spark, d).select("item_id", "entry_id", "rank"))
    # A semi join isn't pushed below the views, which cost more than the rest of the evidence: the matches' rows go first.
    of = lambda name, key, match: table(spark, d, name).join(sized_broadcast(matches.select(F.col(match).alias(key)).distinct()), key, "left_semi")
    items, entries = _item_views(of("benchmark", "item_id", "item_id")), _entry_views(of("documents", "doc_id", "entry_id"))
    evidence = cut_lineage(line_evidence(matches, items, entries)[0])
    status = proposals(matches, items, evidence).select("item_id", "status", F.col("entry_id").alias("chosen"))
    return evidence.join(status, "item_id").withColumnRenamed("entry_id", "doc_id")


QUERIES = {f.__name__: f for f in (gate01_ngram_leak, join11_short_leak, join04_exact_lines, join01_source_matching, join02_line_scores, join07_evidence, join01_signals, join07_channels)}


def _sql_grams(tbl: str, key: str, n: int) -> str:
    return f"SELECT {key}, unnest(list_distinct(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i+{n - 1}], ' ')))) AS gram FROM (SELECT {key}, {sql_words('text')} AS w FROM {tbl}) WHERE len(w) >= {n}"


def _sql_line_keys(tbl: str, key: str) -> str:
    return f"SELECT {key}, pos, array_to_string({sql_words('line')}, ' ') AS lk FROM (SELECT {key}, generate_subscripts(x, 1) AS pos, unnest(x) AS line FROM (SELECT {key}, {sql_lines('text')} AS x FROM {tbl}))"


ORACLE = {
    "gate01_ngram_leak": f"WITH a AS ({_sql_grams('documents', 'doc_id', 8)}), b AS ({_sql_grams('benchmark', 'item_id', 8)}) SELECT doc_id, item_id, count(*) AS n_grams FROM a JOIN b USING (gram) GROUP BY 1, 2",
    "join11_short_leak": f"WITH a AS (SELECT doc_id, array_to_string({sql_words('text')}, ' ') AS hay FROM documents), b AS (SELECT item_id, array_to_string(w, ' ') AS needle FROM (SELECT item_id, {sql_words('part')} AS w FROM (SELECT item_id, unnest(string_split_regex(text, '[.!?\\n]+')) AS part FROM benchmark)) WHERE len(w) BETWEEN 1 AND 7) SELECT DISTINCT doc_id, item_id FROM a JOIN b ON contains(hay, needle)",
    "join04_exact_lines": f"WITH a AS (SELECT DISTINCT doc_id, lk FROM ({_sql_line_keys('documents', 'doc_id')}) WHERE lk <> ''), b AS (SELECT DISTINCT item_id, lk FROM ({_sql_line_keys('benchmark', 'item_id')}) WHERE lk <> '') SELECT doc_id, item_id, count(*) AS n_lines FROM a JOIN b USING (lk) GROUP BY 1, 2",
    "join01_source_matching": f"""WITH a AS ({_sql_grams('documents', 'doc_id', 4)}), b AS ({_sql_grams('benchmark', 'item_id', 4)}),
  na AS (SELECT doc_id, count(*) AS n_doc FROM a GROUP BY 1), nb AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY 1),
  h AS (SELECT item_id, doc_id, round(2.0::DOUBLE * count(*) / (any_value(n_item) + any_value(n_doc)), 4) AS score FROM a JOIN b USING (gram) JOIN na USING (doc_id) JOIN nb USING (item_id) GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM h)
SELECT item_id, doc_id, score, rank FROM r WHERE rank <= 3 AND score > 0""",
    "join07_evidence": f"""WITH a AS (SELECT * FROM ({_sql_line_keys('documents', 'doc_id')}) WHERE lk <> ''), b AS (SELECT * FROM ({_sql_line_keys('benchmark', 'item_id')}) WHERE lk <> ''),
  h AS (SELECT item_id, doc_id, count(DISTINCT b.pos) AS covered, count(DISTINCT a.pos) AS dc FROM a JOIN b USING (lk) GROUP BY 1, 2),
  x AS (SELECT h.*, nb.n AS n_item, na.n AS n_doc, covered::DOUBLE / nb.n AS w, dc::DOUBLE / na.n AS e FROM h JOIN (SELECT item_id, count(*) AS n FROM b GROUP BY 1) nb USING (item_id) JOIN (SELECT doc_id, count(*) AS n FROM a GROUP BY 1) na USING (doc_id))
SELECT item_id, doc_id, covered, n_item, n_doc, CASE WHEN w >= 0.9 AND e >= 0.9 THEN 'exact_witness' WHEN w >= 0.7 AND e >= 0.7 THEN 'variant' WHEN (w >= 0.8 AND e < 0.5) OR (e >= 0.8 AND w < 0.5) THEN 'excerpt' ELSE 'possible' END AS status FROM x""",
}
