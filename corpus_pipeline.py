"""A corpus pipeline of five stages; each result is written and read again by the next.

A stage's scratch tables are dead once its result is written, so the next
stage deletes them.  Those of the last stage stay, as its result reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, jaccard_join, mixing, scratch, token_files, toxicity
from millrace.llm.queries import table, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model is fitted on the labelled documents."""
    scratch.sweep(spark, "pipeline")
    with scratch.scope("pipeline"):
        return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near copies."""
    scratch.sweep(spark, "pipeline")
    with scratch.scope("pipeline"):
        return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of any benchmark item."""
    scratch.sweep(spark, "pipeline")
    with scratch.scope("pipeline"):
        return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"), least_items=1)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, repeated as often as the mix of sources takes them."""
    scratch.sweep(spark, "pipeline")
    with scratch.scope("pipeline"):
        return mixing.mix(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: ``doc_id, start, n_tokens, ids_crc32``."""
    scratch.sweep(spark, "pipeline")
    with scratch.scope("pipeline output"):
        return token_files.token_files(docs, vocabulary(), end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing_to_target_weights", mix_sources),
    ("token_id_output", write_tokens),
]

#: The toxicity model is trained, so the rows cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = f"{scratch.shared_dir(spark)}/millrace-pipeline/{spark.sparkContext.applicationId}/{scratch.uuid.uuid4().hex[:12]}-{name}"
            result.write.parquet(path)
            docs = spark.read.parquet(path)
    return result
