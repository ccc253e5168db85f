"""The registered queries of this subpackage: ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, exact_dedup, jaccard_join, language, line_dedup, mixing, token_files, toxicity, urls
from .sql import SQL

Query = Callable[[SparkSession, str], DataFrame]

#: (action, host, path) of op1.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, urls.RULE_SCHEMA))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema))
    records = rows.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("turns"))
    back = chat.read_chat(chat.format_chat(chat.canonical_turns(records)))
    said = F.array_join(F.transform("turns_back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns_back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs, reject=0.0))  # und is for texts without letters only


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), vocabulary(), end_id=0, added=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_url_filter, op2_line_dedup, op3_mix_sources, op4_chat_format, op5_decontaminate, op6_ngram_jaccard, op7_language_id, op8_toxicity, op9_exact_dedup, op10_token_files, pipeline)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
