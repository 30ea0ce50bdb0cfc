"""A corpus pipeline: toxic documents go, then copies, then near copies; the rest is mixed and packed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from lodestone.llm.common import table
from lodestone.tables import discard_since, shared_folder, tables_written

#: The mixture takes so many hundredths of the remaining tokens, each document once at most.
MIX_PERCENT, MIX_EPOCHS = 90, 1
#: Target weights of the mixture; names that are not listed weigh 1.
MIX_WEIGHTS = {"domain": {"=web": 5, "=books": 3, "=code": 2}, "lang": {"=en": 6, "=de": 2}, "source": {}}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: learns from the labels of the given documents, and rejects whatever it predicts to be toxic."""
    model = toxicity.train_grammar(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity(model)("text") < toxicity.THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of equal texts the longest stays, then the one with the smallest id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each component of near duplicates the document with the smallest id stays."""
    return jaccard_join.without_near_duplicates(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: budgets by domain, language and source; a prefix of each leaf's seeded order."""
    return mixing.mixed_documents(docs, MIX_PERCENT, MIX_EPOCHS, MIX_WEIGHTS).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the places of all token pieces in sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies), ("mixture", mix), ("packing", pack)]

#: SQL can't express the toxicity grammar; tests/llm/test_pipeline.py holds each stage and the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to the documents; each stage's result is written and read again by the next.

    The stages' tables stay in the shared folder, the last one as the result; what the operators wrote for themselves is
    removed as soon as their stage is written. Null and repeated ids, null and empty texts, very long texts and further
    columns are handled as each operator says. An empty documents table gives an empty result.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        mark = tables_written()
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        discard_since(spark, mark)
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs.select(F.col("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
