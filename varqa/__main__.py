"""python -m varqa COMMAND --data FOLDER --out FOLDER: the engine's steps over tables in a folder.

Tables are Parquet folders or files NAME.parquet under --data; results are written as Parquet under --out, gated:
a step whose gate finds violations writes nothing, prints them and exits with 1.
"""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import keys, text
from .operators import ann, evaluation, graph, matching, projections, records, relational, vectors
from .sources import readers, sinks

# Section titles and the names they stand for.
ALIASES = {
    "original": "original", "script notes": "script_notes", "transliteration": "transliteration", "literal gloss": "literal_gloss", "literal translation": "literal_gloss",
    "reference translation": "reference_translation", "ai translation": "ai_translation", "literary translation": "literary_translation", "tashreeh": "tashreeh",
    "key terms": "key_terms", "themes": "themes", "source notes": "source_notes", "review notes": "review_notes",
}


def build_data(spark: SparkSession, a) -> DataFrame:
    """Markdown entries under --data as records; entries with unfilled slots only with --include-placeholders.

    An entry whose front matter is broken fails the step: nothing is written.
    """
    files = readers.markdown_paths(spark, a.data)

    def parsed(path, text):
        fields, rest, error = readers.front_matter(text)
        if error:
            raise ValueError(f"{path}: {error}")
        return fields, rest

    parse = F.udf(parsed, "struct<f: map<string, array<string>>, rest: string>", useArrow=True)
    x = files.select("path", parse("path", "value").alias("p")).select("path", F.col("p.f").alias("front_matter"), readers.sections(F.col("p.rest"), ALIASES).alias("sections"))
    x = x.withColumn("id", F.coalesce(F.get(F.try_element_at("front_matter", F.lit("id")), F.lit(0)), F.regexp_extract("path", r"([^/]+)\.md$", 1)))
    if not a.include_placeholders:
        from .functions import text as T

        x = x.where(~T.has_placeholder(F.array_join(F.map_values("sections"), "\n")))
    return projections.entry_record(x)


def table(spark: SparkSession, a, name: str) -> DataFrame:
    return spark.read.parquet(f"{a.data}/{name}.parquet")


COMMANDS = {
    "build-data": (build_data, "records"),
    "status": (lambda s, a: table(s, a, "records").agg(F.count("*").alias("records"), F.countDistinct("id").alias("ids")), "status"),
    "validate": (lambda s, a: evaluation.record_violations(table(s, a, "records"), a.required.split(","), ["public-domain", "permission-cleared", "project-original"]), "violations"),
    "extract-lexicon": (lambda s, a: relational.merge_first_seen(table(s, a, "key_terms"), ["headword"], F.col("seq"), ["meaning"], ["record_id"]), "terms"),
    "build-clusters": (lambda s, a: graph.build_clusters(table(s, a, "entries"), table(s, a, "items"), table(s, a, "matches")), "clusters"),
    "export-training-corpus": (lambda s, a: records.layers(table(s, a, "poems"), a.include_reference), "layers"),
    "generate-training-data": (lambda s, a: evaluation.split_examples(records.build_examples(table(s, a, "poems"), table(s, a, "knowledge_base")).withColumn("work", F.col("id")), holdout=not a.no_holdout), "examples"),
    "build-probes": (lambda s, a: relational.quota(table(s, a, "examples"), "family", "id", 5, 25), "probes"),
    "crosswalk-evidence": (lambda s, a: matching.line_evidence(table(s, a, "matches"), table(s, a, "items"), table(s, a, "entries"))[0], "evidence"),
    "propose-statuses": (lambda s, a: matching.proposals(table(s, a, "matches"), table(s, a, "items"), table(s, a, "evidence")), "proposals"),
    "normalize-translit": (lambda s, a: table(s, a, "records").select("id", keys._text_udf(keys.latin_style)("transliteration").alias("transliteration"), text.lint_counts(F.col("transliteration")).alias("found")), "styled"),
    "build-index": (lambda s, a: ann.index_report(table(s, a, "embeddings"), f"{a.out}/index", a.model), "index_report"),
    "match-source-manifest": (lambda s, a: matching.best_matches(table(s, a, "items"), table(s, a, "entries"), a.top) if a.least is None else matching.top_matches(matching.score_items(table(s, a, "items"), table(s, a, "entries"), a.least), "item_id", "entry_id", a.top), "matches"),
    "apply-reviews": (lambda s, a: projections.corrected_layers(table(s, a, "layers"), table(s, a, "reviews")), "layers"),
    "retrieve": (lambda s, a: vectors.with_floor(vectors.nearest(table(s, a, "queries"), table(s, a, "embeddings"), a.top), a.min_score), "hits"),
    "run-eval": (lambda s, a: evaluation.summary(table(s, a, "eval_results")), "summary"),
    "parse-pages": (lambda s, a: readers.catalog(readers.html_elements(table(s, a, "pages"))), "catalog"),
    "segment-pages": (lambda s, a: readers.segments(table(s, a, "page_texts")), "segments"),
    "manifest": (lambda s, a: sinks.bundle_manifest({n: table(s, a, n) for n in a.tables.split(",")}), "manifest"),
}


def gates(a, name: str, df: DataFrame, spark: SparkSession) -> DataFrame | None:
    """Violations that keep a step's result from being written."""
    if name == "export-training-corpus" and not a.include_reference:
        texts = df.select(F.concat_ws("/", "poem_id", "kind").alias("key"), "text")
        return matching.leaks(texts, "key", protected_texts(spark, a, table(spark, a, "poems")), "protected")
    if name == "generate-training-data":
        return evaluation.example_violations(df, None if a.include_reference else protected_texts(spark, a, None), holdout=not a.no_holdout)
    return None


def protected_texts(spark: SparkSession, a, poems: DataFrame | None) -> DataFrame:
    """protected, text: the poems' reference translations, the table `references` and --protected, of which one must be there."""
    found = []
    if poems is not None:
        found.append(poems.select(F.explode("translations").alias("t")).where("t.kind = 'reference_translation'").select("t.text"))
    if a.protected:
        found.append(spark.read.parquet(a.protected).select("text"))
    if (rest := readers.read_optional(spark, f"{a.data}/references.parquet", "text string", spark.read.parquet)).columns and not rest.isEmpty():
        found.append(rest.select("text"))
    if not found:
        raise SystemExit("no texts to protect: give --protected, a table `references` or --include-reference")
    texts = reduce(DataFrame.unionByName, found)
    return texts.where("text is not null").distinct().select(F.sha2("text", 256).alias("protected"), "text")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="varqa", description=__doc__)
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--data", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--include-placeholders", action="store_true")
    p.add_argument("--include-reference", action="store_true")
    p.add_argument("--no-holdout", action="store_true")
    p.add_argument("--required", default="text")
    p.add_argument("--protected", help="Parquet of texts that no output may repeat")
    p.add_argument("--model", default="unnamed", help="the embedding model of build-index")
    p.add_argument("--tables", default="records")
    p.add_argument("--top", type=int, default=5)
    p.add_argument("--min-score", type=float, default=0.35)
    p.add_argument("--least", type=float, help="similarity from which a signal of match-source-manifest counts; any if not given")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("varqa").getOrCreate()
    make, name = COMMANDS[a.command]
    df = make(spark, a)
    found = gates(a, a.command, df, spark)
    bad = sinks.gated_write(df, df.limit(0) if found is None else found, lambda x: x.write.mode("overwrite").parquet(f"{a.out}/{name}.parquet"))
    if a.command == "validate":  # the report is written, and errors in it are a failure
        bad = spark.read.parquet(f"{a.out}/{name}.parquet").where("level = 'error'").limit(100).collect()
    for row in bad:
        print("violation:", row, file=sys.stderr)
    return int(bool(bad))


if __name__ == "__main__":
    sys.exit(main())
