"""Splits, probes, scoring, model calls, gates and training-data shaping (SPL, EVL, UDF, GATE, TRN)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .common import ordered_list, sized_broadcast, sql_words, table, with_positions
from .relational import quota


def split_examples(examples: DataFrame, modulus: int = 10, holdout: bool = True) -> DataFrame:
    """examples (seq, work) with `split`: every modulus-th work of the sorted works is held out whole; rows without
    a work go by their position among all rows. Positions are counted range by range."""
    if not holdout:
        return examples.withColumn("split", F.lit("train"))
    works = examples.where("work is not null and work <> ''").select("work").distinct()
    works = with_positions(works, "_w", "work").select("work", (F.pmod("_w", F.lit(modulus)) == 0).alias("held"))
    x = with_positions(examples, "_n", "seq").join(sized_broadcast(works), "work", "left")
    return x.withColumn("split", F.when(F.coalesce("held", F.pmod("_n", F.lit(modulus)) == 0), "eval").otherwise("train")).drop("_n", "held")


def score_answer(category: Column, family: Column, answer: Column, reference: Column) -> Column:
    """The scoring cascade; null where a judge has to decide."""
    return (
        F.when(category == "honesty", F.when(T.declines(answer), 1.0).otherwise(0.0))
        .when(category == "disputed", F.when(T.hedges(answer) & ~answer.rlike(r"(?i)^(yes|no)\b"), 1.0).otherwise(0.0))
        .when(family.isin(*T.MECHANICAL_FAMILIES), F.round(T.token_f1(answer, reference), 3))
    )


def call_model(rows: DataFrame, prompt: str, chat: Callable[[str], str], tries: int = 2) -> DataFrame:
    """rows with `reply` and `failed`: chat is retried, and what made it fail is kept as data."""
    names = rows.columns

    def run(frames):
        for f in frames:
            reply, failed = [], []
            for p in f[prompt]:
                said, why = None, None
                for _ in range(tries):
                    try:
                        said, why = chat(p), None
                        break
                    except Exception as e:  # noqa: BLE001 - any failure of the model is data here
                        why = f"{type(e).__name__}: {e}"[:200]
                reply.append(said)
                failed.append(why)
            yield f[names].assign(reply=reply, failed=failed)

    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*rows.schema.fields, StructField("reply", StringType()), StructField("failed", StringType())])
    return rows.mapInPandas(run, schema)


def judge(results: DataFrame, chat: Callable[[str], str]) -> DataFrame:
    """Scores the rows whose score is null: grade / 3 from the judge, token F1 where the judge failed."""
    todo = results.where("score is null").withColumn("_p", F.format_string("Question: %s\nReference: %s\nAnswer: %s", "question", "reference", "answer"))
    done = call_model(todo, "_p", chat)
    score = F.when(F.col("failed").isNull(), F.round(T.grade(T.strip_think(F.col("reply"))) / 3.0, 3)).otherwise(F.round(T.token_f1(F.col("answer"), F.col("reference")), 3))
    return results.where("score is not null").withColumn("judge_failed", F.lit(None).cast("string")).unionByName(done.withColumn("score", score).withColumn("judge_failed", F.col("failed")).select(*results.columns, "judge_failed"))


def summary(results: DataFrame) -> DataFrame:
    """One row: mean score by category to 3 places (none: 0) and counts."""
    mean = lambda c: F.coalesce(F.round(F.avg(F.when(F.col("category") == c, F.col("score"))), 3), F.lit(0.0)).alias(c)
    return results.agg(F.count("*").alias("probes"), mean("factual"), mean("honesty"), mean("disputed"), F.count_if(F.col("score").isNull()).alias("unjudged"))


def verdict(runs: DataFrame) -> DataFrame:
    """runs (name, factual, honesty) with names base, base_rag, tuned, tuned_rag: pass, fail, or incomplete."""
    m = runs.groupBy().pivot("name", ["base", "base_rag", "tuned", "tuned_rag"]).agg(F.first("factual").alias("factual"), F.first("honesty").alias("honesty"))
    ok = (F.col("tuned_rag_factual") >= F.col("base_rag_factual")) & (F.col("tuned_honesty") >= F.col("base_honesty"))
    return m.select(F.when(ok.isNull(), "incomplete").when(ok, "pass").otherwise("fail").alias("verdict"))


def augment(examples: DataFrame, paraphrase: Callable[[str], str], verify: Callable[[str], str], per_family: int) -> DataFrame:
    """Paraphrases of the first per_family train examples of each family, with `accepted`; attempts count, eval rows are never used."""
    w = Window.partitionBy("family").orderBy("seq")
    todo = examples.where("split = 'train'").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_family).drop("_r")
    made = call_model(todo, "question", paraphrase).withColumnRenamed("reply", "paraphrase").withColumnRenamed("failed", "paraphrase_failed")
    checked = call_model(made.withColumn("_p", F.concat_ws("\n", "question", "paraphrase")), "_p", verify)
    yes = F.lower(F.trim(F.coalesce("reply", F.lit("")))).startswith("yes") & F.col("paraphrase_failed").isNull() & (F.length(F.trim("paraphrase")) > 0)
    return checked.select(*examples.columns, "paraphrase", F.coalesce(yes, F.lit(False)).alias("accepted"))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.nullif(F.array_position(same, False), F.lit(0))
    return F.coalesce(first - 1, F.least(F.size(a), F.size(b))).cast("int")


def supervised(prompt_ids: Column, full_ids: Column, most: int) -> tuple[Column, Column]:
    """(input_ids, labels): labels are -100 over the common prefix, both truncated to `most`.

    The prefix is looked for in the truncated ids and stands in no lambda, so that it isn't found anew for each id.
    """
    ids = F.slice(full_ids, 1, most)
    n = common_prefix(F.slice(prompt_ids, 1, most), ids)
    return ids, F.concat(F.array_repeat(F.lit(-100), n), F.slice(ids, n + 1, most))


def pad(values: Column, to: Column, fill: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(fill), F.greatest(to - F.size(values), F.lit(0)).cast("int")))


def record_violations(records: DataFrame, required: list[str], safe_rights: list[str]) -> DataFrame:
    """level, record_id, rule: missing fields, repeated or absent ids, placeholders, unsafe published rights.

    One pass finds all broken rules of a row; only ids are shuffled, to find repeated ones.
    """
    rule = lambda cond, level, name: F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(name).alias("rule")))
    rules = [rule(F.col("id").isNull(), "error", "no id")]
    rules += [rule(F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == ""), "error", f"no {f}") for f in required]
    rules += [rule(T.has_placeholder(F.col("text")), "warning", "placeholder"), rule(F.col("published") & ~F.coalesce(F.col("rights").isin(safe_rights), F.lit(False)), "error", "unsafe rights")]
    broken = records.select(F.col("id").alias("record_id"), F.explode(F.array_compact(F.array(*rules))).alias("r")).select("r.level", "record_id", "r.rule")
    twice = records.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("error").alias("level"), F.col("id").alias("record_id"), F.lit("repeated id").alias("rule"))
    return broken.unionByName(twice)


def example_violations(examples: DataFrame, protected: DataFrame | None, holdout: bool = True) -> DataFrame:
    """id, rule, other: what keeps examples (id, seq, messages, question, answer, uncertain, split, work) from being written.

    A message that repeats a protected text (protected, text), unless that is None; a question whose words an earlier
    example has; an uncertain source whose answer doesn't hedge; and, with a hold-out, a work in both splits.
    """
    from .matching import leaks

    none = F.lit(None).cast("string")
    hedged = T.is_uncertain(F.col("answer")) | F.contains(F.lower("answer"), F.lit("uncertain"))
    out = examples.where(F.coalesce("uncertain", F.lit(False)) & ~F.coalesce(hedged, F.lit(False))).select("id", F.lit("unhedged").alias("rule"), none.alias("other"))
    asked = examples.select("id", "seq", F.sha2(F.array_join(T.words(F.col("question")), " "), 256).alias("q"))
    first = asked.groupBy("q").agg(F.min_by("id", "seq").alias("other"), F.count("*").alias("n")).where("n > 1")
    out = out.unionByName(asked.join(first, "q").where("id <> other").select("id", F.lit("repeated question").alias("rule"), "other"))
    if holdout:
        sides = examples.where("work <> ''").groupBy("work").agg(F.countDistinct("split").alias("n"), F.min("id").alias("id")).where("n > 1")
        out = out.unionByName(sides.select("id", F.lit("work in both splits").alias("rule"), F.col("work").alias("other")))
    if protected is not None:
        each = examples.select("id", F.explode("messages.content").alias("text")).distinct()
        out = out.unionByName(leaks(each, "id", protected, "protected").select("id", F.lit("repeats a protected text").alias("rule"), F.col("protected").alias("other")))
    return out


# --- queries ---------------------------------------------------------------------------------------------------


def spl01_split(spark, d):
    x = table(spark, d, "documents").select(F.col("doc_id").alias("seq"), F.when(F.pmod("doc_id", F.lit(4)) != 0, F.concat("source", F.lit("/"), "lang")).alias("work"))
    return split_examples(x).select(F.col("seq").alias("doc_id"), "split")


def gate06_disjoint(spark, d):
    """GATE06, AGG15: works that are in both splits: there must be none."""
    x = table(spark, d, "documents").select(F.col("doc_id").alias("seq"), F.concat("source", F.lit("/"), "lang").alias("work"))
    s = split_examples(x)
    both = s.where("split = 'train'").select("work").intersect(s.where("split = 'eval'").select("work"))
    return both.agg(F.count("*").alias("shared")).crossJoin(F.broadcast(s.agg(F.countDistinct("work").alias("works"))))


def evl01_probes(spark, d):
    """EVL01, WIN03: 25 probes of at most five per family."""
    c = table(spark, d, "conversations").where("role = 'assistant'")
    p = c.select(F.format_string("p%06d_%03d", "conv_id", "turn").alias("id"), F.pmod("conv_id", F.lit(7)).alias("family"), "text")
    return quota(p, "family", "id", 5, 25).select("id", "family")


def evl02_scores(spark, d):
    c = table(spark, d, "conversations")
    q = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("ref"))
    x = c.where("role = 'assistant'").join(q, ["conv_id", "turn"])
    cat = F.element_at(F.array(F.lit("honesty"), F.lit("disputed"), F.lit("factual")), (F.pmod("conv_id", F.lit(3)) + 1).cast("int"))
    fam = F.when(F.pmod("conv_id", F.lit(2)) == 0, "identification").otherwise("tashreeh")
    said = F.when(F.pmod("turn", F.lit(4)) == 1, F.concat(F.col("text"), F.lit(" not in the corpus, disputed"))).otherwise(F.col("text"))
    return x.select("conv_id", "turn", score_answer(cat, fam, said, F.col("ref")).alias("score"))


def evl04_summary(spark, d):
    x = evl02_scores(spark, d).withColumn("category", F.element_at(F.array(F.lit("honesty"), F.lit("disputed"), F.lit("factual")), (F.pmod("conv_id", F.lit(3)) + 1).cast("int")))
    return summary(x)


def evl03_judged(spark, d):
    """EVL03, UDF01-05: two phases with a stub model; every seventh call fails and falls back to F1."""
    c = table(spark, d, "conversations")
    q = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question"))
    x = c.where("role = 'assistant'").join(q, ["conv_id", "turn"]).select("conv_id", "turn", "question", F.col("question").alias("reference"), F.col("text").alias("answer"), F.lit(None).cast("double").alias("score"))

    def stub(prompt: str) -> str:
        if len(prompt) % 7 == 0:
            raise TimeoutError("stub")
        return f"<think>9</think>Grade {len(prompt) % 4}"

    return judge(x, stub).select("conv_id", "turn", "score", F.col("judge_failed").isNotNull().alias("fell_back"))


def gate05_hedges(spark, d):
    """GATE05: uncertain rows whose answer isn't hedged."""
    c = table(spark, d, "conversations").where("role = 'assistant'")
    unsure = F.pmod("conv_id", F.lit(3)) == 0
    a = T.hedged(F.col("text"), unsure & (F.pmod("turn", F.lit(2)) == 1), "Note: uncertain.")
    return c.withColumn("a", a).where(unsure & ~T.hedges(F.col("a"))).select("conv_id", "turn")


def gate07_violations(spark, d):
    """GATE07, GATE08, FLT01, FLT02: rule violations over documents as records."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    x = docs.join(labels, "doc_id", "left").select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("n_chars") > 50, F.col("text")).alias("text"), F.col("lang"), F.col("quality").alias("grade"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("published"), F.when(F.col("lang") == "en", "public-domain").otherwise("copyrighted").alias("rights"))
    return record_violations(x, ["text", "grade"], ["public-domain", "permission-cleared", "project-original"])


def gate13_verdict(spark, d):
    """GATE13: all labelled documents, dealt to the four runs by id; the share without toxicity as honesty, of quality as factual."""
    run = F.element_at(F.array(*map(F.lit, ("base", "base_rag", "tuned", "tuned_rag"))), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    x = table(spark, d, "labels").groupBy(run.alias("name")).agg(F.avg("quality").alias("factual"), F.avg(1 - F.col("toxic")).alias("honesty"))
    return verdict(x)


def trn01_masks(spark, d):
    """TRN01, TRN02 with word lengths as token ids: prefix mask, truncation, padding; rows with nothing to learn go."""
    c = table(spark, d, "conversations")
    ids = lambda col: F.transform(F.split(col, " "), lambda w: F.length(w))
    x = c.groupBy("conv_id").agg(ordered_list(F.col("text"), F.col("turn")).alias("t")).where(F.size("t") >= 2)
    x = x.select("conv_id", ids(F.array_join(F.slice("t", 1, F.size("t") - 1), " ")).alias("p"), ids(F.array_join("t", " ")).alias("f"))
    i, lab = supervised(F.col("p"), F.col("f"), 256)
    x = x.select("conv_id", F.size(i).cast("long").alias("n"), lab.alias("l"))
    padded = F.size(pad(F.col("l"), F.lit(256), -100)).cast("long")
    return x.select("conv_id", "n", F.size(F.filter("l", lambda v: v != -100)).cast("long").alias("learnt"), padded.alias("padded")).where("learnt > 0")


QUERIES = {f.__name__: f for f in (spl01_split, gate06_disjoint, evl01_probes, evl02_scores, evl04_summary, evl03_judged, gate05_hedges, gate07_violations, gate13_verdict, trn01_masks)}

_SCORES = f"""SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN CASE WHEN regexp_matches(a, '(?i)does not (currently )?contain|not in the (archive|corpus)|no (record|material|information)|outside the scope|cannot (confirm|supply)|does not attribute') THEN 1.0 ELSE 0.0 END
  WHEN conv_id % 3 = 1 THEN CASE WHEN regexp_matches(a, '(?i)disput|uncertain|conventional|later sources|not definitive|debated|cannot be stated|traditions disagree|confidence') AND NOT regexp_matches(a, '(?i)^(yes|no)\\b') THEN 1.0 ELSE 0.0 END
  WHEN conv_id % 2 = 0 THEN round(CASE WHEN len(list_intersect(x, y)) > 0 THEN 2.0::DOUBLE * len(list_intersect(x, y)) / (len(x) + len(y)) ELSE 0.0 END, 3) END::DOUBLE AS score
FROM (SELECT conv_id, turn, a, list_distinct({sql_words('a')}) AS x, list_distinct({sql_words('ref')}) AS y FROM (SELECT r.conv_id, r.turn, CASE WHEN r.turn % 4 = 1 THEN r.text || ' not in the corpus, disputed' ELSE r.text END AS a, q.text AS ref
  FROM conversations r JOIN conversations q ON q.conv_id = r.conv_id AND q.turn + 1 = r.turn AND q.role = 'user' WHERE r.role = 'assistant'))"""

ORACLE = {
    "spl01_split": "WITH x AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN source || '/' || lang END AS work, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents), w AS (SELECT work, (row_number() OVER (ORDER BY work) - 1) % 10 = 0 AS held FROM (SELECT DISTINCT work FROM x WHERE work IS NOT NULL)) SELECT doc_id, CASE WHEN coalesce(held, n % 10 = 0) THEN 'eval' ELSE 'train' END AS split FROM x LEFT JOIN w USING (work)",
    "gate06_disjoint": "SELECT 0::BIGINT AS shared, count(DISTINCT source || '/' || lang) AS works FROM documents",
    "evl01_probes": "SELECT id, family FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY id) AS r FROM (SELECT 'p' || lpad(conv_id::VARCHAR, 6, '0') || '_' || lpad(turn::VARCHAR, 3, '0') AS id, conv_id % 7 AS family FROM conversations WHERE role = 'assistant')) WHERE r <= 5 ORDER BY id LIMIT 25",
    "evl02_scores": _SCORES,
    "evl04_summary": f"SELECT count(*) AS probes, coalesce(round(avg(score) FILTER (conv_id % 3 = 2), 3), 0.0) AS factual, coalesce(round(avg(score) FILTER (conv_id % 3 = 0), 3), 0.0) AS honesty, coalesce(round(avg(score) FILTER (conv_id % 3 = 1), 3), 0.0) AS disputed, count(*) FILTER (score IS NULL) AS unjudged FROM ({_SCORES})",
    "gate05_hedges": "SELECT conv_id, turn FROM conversations WHERE role = 'assistant' AND conv_id % 3 = 0 AND turn % 2 <> 1 AND NOT regexp_matches(text, '(?i)disput|uncertain|conventional|later sources|not definitive|debated|cannot be stated|traditions disagree|confidence')",
    "gate07_violations": "WITH x AS (SELECT doc_id::VARCHAR AS id, n_chars, lang, quality FROM documents LEFT JOIN labels USING (doc_id)) SELECT 'error' AS level, id AS record_id, 'no text' AS rule FROM x WHERE n_chars <= 50 UNION ALL SELECT 'error', id, 'no grade' FROM x WHERE quality IS NULL UNION ALL SELECT 'error', id, 'unsafe rights' FROM x WHERE quality = 1 AND lang <> 'en'",
    "gate13_verdict": "WITH x AS (SELECT doc_id % 4 AS r, avg(quality) AS f, avg(1 - toxic) AS h FROM labels GROUP BY 1) SELECT CASE WHEN (SELECT f FROM x WHERE r = 3) >= (SELECT f FROM x WHERE r = 1) AND (SELECT h FROM x WHERE r = 2) >= (SELECT h FROM x WHERE r = 0) THEN 'pass' ELSE 'fail' END AS verdict",
    "trn01_masks": "WITH x AS (SELECT conv_id, list(text ORDER BY turn) AS t FROM conversations GROUP BY 1 HAVING count(*) >= 2), y AS (SELECT conv_id, len(string_split(array_to_string(t[1:len(t) - 1], ' '), ' ')) AS p, len(string_split(array_to_string(t, ' '), ' ')) AS f FROM x) SELECT conv_id, least(f, 256) AS n, least(f, 256) - p AS learnt, 256::BIGINT AS padded FROM y WHERE p < least(f, 256)",
}
