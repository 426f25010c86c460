"""The training-corpus pipeline: each stage works on all that the one before it kept.

Every stage takes null doc_ids, texts and sources, empty and very long texts, repeated rows, further columns of any name
and an empty table; its docstring says what becomes of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from varqa.llm.common import shared_path, table
from varqa.llm.decontam import decontaminate
from varqa.llm.mixing import mix
from varqa.llm.simhash import near_dedup
from varqa.llm.tokens import token_table
from varqa.llm.toxicity import reject_toxic, train_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled rows outside the held-out fold, doesn't find toxic.

    Null and empty texts score as texts without words; rows without a doc_id are judged by their texts; repeated rows go
    or stay together; labels that are null, or of one class only, teach nothing.
    """
    return reject_toxic(docs, train_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by fingerprints at most 4 bits apart.

    Null and blank texts are one group; a row without a doc_id stays only where its group has none with one.
    """
    return near_dedup(docs, radius=4, width=4, seed=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts hold none, null and wordless items match none."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: null sources are a source, documents without words go."""
    return mix(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as ORC and read back: doc_id, start, n_tokens, ids_crc32; null and empty texts have the end id only."""
    return token_table(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [("toxicity", toxicity), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("tokens", tokens)]

#: SQL expresses neither the classifier nor the tokenizer: tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again; the folder lasts as long as the session."""
    docs = table(spark, sf_dir, "documents")
    base = shared_path(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
    return docs
