"""Corpus preparation: sources to records, rules, dedup, split, mix, statistics."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import templates as P
from ..functions import text as X
from ..operators import select as O
from ..operators.stages import written
from ..sources import files as S

FIELDS = ["id", "instruction", "input", "output", "source", "task", "text"]


@dataclass(frozen=True)
class Settings:
    """Thresholds and seeds; the defaults are the fixed ones."""

    seed: int = 42
    test: float = 0.02
    val: float = 0.02
    mix: int = 8000
    samples: int = 20
    script: str = X.CJK
    system: str = P.SYSTEM


def alpaca(spark: SparkSession, path: str) -> DataFrame:
    return S.json_lines(spark, path).select("instruction", "input", "output")


def dialogue(spark: SparkSession, path: str) -> DataFrame:
    return S.json_array(spark, path).select("instruction", "input", "output")


def allaspect(spark: SparkSession, path: str) -> DataFrame:
    rows = S.json_array(spark, path, "Question string, Response string")
    return rows.select(F.col("Question").alias("instruction"), F.lit("").alias("input"), F.col("Response").alias("output"))


def doyouknow(spark: SparkSession, path: str) -> DataFrame:
    rows = S.csv_table(spark, path)
    return rows.select(F.col("Prompt").alias("instruction"), F.lit("").alias("input"), X.either(F.col("FormattedResponse"), F.col("RawResponse")).alias("output"))


def harmful(spark: SparkSession, path: str) -> DataFrame:
    """Requests, each with the fixed refusal; a missing file is no rows."""

    def read(spark: SparkSession, path: str) -> DataFrame:
        rows = S.csv_table(spark, path)
        return rows.select(S.column_or_first(rows, "text").alias("instruction"), F.lit("").alias("input"), F.lit(P.REFUSAL).alias("output"))

    return S.optional(spark, path, read, S.ASKED)


# Fixed values, in order of precedence: source, task, reader, file; and the source of translations.
SOURCES = [
    ("yue-alpaca", "instruct", alpaca, "yue-alpaca/train.jsonl"),
    ("cantonese-dialogue", "dialogue", dialogue, "Cantonese-Dialogue/train.json"),
    ("allaspect-qa", "qa", allaspect, "Cantonese_AllAspectQA_11K/cantonese_allaspectqa_11k.json"),
    ("wiki-doyouknow", "qa", doyouknow, "cantonesewiki_doyouknow/cantonesewiki_doyouknow.csv"),
    ("yue-harmful", "refuse", harmful, "yue_harmful_behaviors.csv"),
]
TRANSLATIONS = "translate-sample"


def union(parts: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Raw rows of all sources with source, task and rank of the source."""
    out = None
    for rank, (source, task, df) in enumerate(parts):
        rows = df.select("instruction", "input", "output", F.lit(source).alias("source"), F.lit(task).alias("task"), F.lit(rank).alias("source_rank"))
        out = rows if out is None else out.unionByName(rows)
    return out


def normalised(raw: DataFrame, script: str = X.CJK) -> DataFrame:
    """``raw`` with its three fields normalised, ``reason`` and ``id``.

    Each field is normalised once, as long as no filter on the new columns
    stands right above: the planner would move it down and with it copies of
    the expressions.
    """
    done = {"instruction": X.norm_text(F.col("instruction")), "input": X.norm_input(F.col("input")), "output": X.norm_text(F.col("output"))}
    rows = raw.select(*(done[c].alias(c) if c in done else F.col(c) for c in raw.columns))
    return rows.select("*", X.drop_reason(F.col("instruction"), F.col("output"), script).alias("reason"), X.record_id(F.col("instruction"), F.col("input"), F.col("output")).alias("id"))


def with_status(rows: DataFrame, *order: str) -> DataFrame:
    """Add ``status`` to a written table of normalised rows: null if kept, else the reason, ``duplicate`` after the rules.

    Rows dropped by a rule take no part in the dedup.
    """
    marked = O.mark_duplicates(rows, "id", *order, among=F.col("reason").isNull())
    return marked.withColumn("status", F.coalesce("reason", F.when(F.col("duplicate"), "duplicate")))


def judged(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Normalised rows with id and ``status``; of equal rows that of the least source rank is kept."""
    return with_status(written(normalised(raw, settings.script), "normalised"), "source_rank")


def records(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The seven fields of a record for normalised rows."""
    text = P.chatml(F.col("instruction"), F.col("input"), F.col("output"), settings.system)
    return rows.withColumn("text", text).select(FIELDS)


def kept(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return records(rows.where("status is null"), settings)


def translations(raw: DataFrame, settings: Settings = Settings(), source: str = TRANSLATIONS) -> DataFrame:
    """An exact random sample of rows with instruction and output; no other rules."""
    rows = written(raw.select(X.norm_text(F.col("instruction")).alias("instruction"), X.norm_input(F.col("input")).alias("input"), X.norm_text(F.col("output")).alias("output")), "translations")
    rows = rows.where("instruction != '' and output != ''").select("*", F.lit(source).alias("source"), F.lit("translate").alias("task"), X.record_id(F.col("instruction"), F.col("input"), F.col("output")).alias("id"))
    return records(O.take_random(rows, settings.mix, "id", settings.seed), settings)


def mixed(train: DataFrame, more: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Train and translations in one random order."""
    return O.shuffled(train.select(FIELDS).unionByName(more.select(FIELDS)), "id", settings.seed)


def validation(qa: DataFrame, translate: DataFrame, most: int = 1000, seed: int = 42) -> DataFrame:
    """Both validation sets with the tag ``validation``: all of ``qa``, and ``most`` rows of ``translate`` at random."""
    sample = O.take_random(translate.select(FIELDS), most, "id", seed)
    return qa.select(F.lit("qa").alias("validation"), *FIELDS).unionByName(sample.select(F.lit("translate").alias("validation"), *FIELDS))


def prepare(spark: SparkSession, folder: str, out: str, settings: Settings = Settings(), translate: str | None = None) -> dict:
    """All of it: reads the sources in ``folder``, writes seven results to ``out``, returns the statistics."""
    rows = written(judged(union([(name, task, read(spark, f"{folder}/{file}")) for name, task, read, file in SOURCES]), settings), "judged")
    split = written(O.stratified_split(kept(rows, settings), "source", "id", settings.seed, settings.test, settings.val), "split")
    part = lambda name: split.where(F.col("split") == name).select(FIELDS)
    S.write_json(O.shuffled(split.select(FIELDS), "id", settings.seed), f"{out}/all")
    for name in ("train", "val", "test"):
        S.write_json(part(name), f"{out}/{name}")
    S.write_json(O.take_random(part("test"), settings.samples, "id", settings.seed), f"{out}/samples")
    extra = None
    if translate and settings.mix > 0 and S.exists(spark, translate):
        extra = written(translations(S.json_lines(spark, translate), settings), "translate")
    S.write_json(mixed(part("train"), extra if extra is not None else part("train").limit(0), settings), f"{out}/mix_train")
    document = statistics(rows, split, extra, settings)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/stats")
    return json.loads(document)


def statistics(rows: DataFrame, split: DataFrame, extra: DataFrame | None, settings: Settings = Settings()) -> str:
    """The statistics document, from a few aggregate rows."""
    sources: dict[str, dict[str, int]] = {name: {} for name, *_ in SOURCES}
    for r in O.reason_counts(rows).collect():  # one row per source and reason
        sources.setdefault(r["source"], {})[r["status"]] = r["n"]
    facets: dict[str, dict[str, int]] = {"source": {}, "task": {}, "split": {}}
    for r in O.count_sets(split, list(facets)).collect():
        facets[r["facet"]][r["value"]] = r["n"]
    n = extra.count() if extra is not None else 0
    parts = {name: facets["split"].get(name, 0) for name in ("train", "val", "test")}
    return json.dumps({
        "seed": settings.seed, "system_prompt": settings.system, "schema": FIELDS,
        "filters": {
            "min_instruction": X.ASK_LENGTH[0], "max_instruction": X.ASK_LENGTH[1], "min_output": X.REPLY_LENGTH[0], "max_output": X.REPLY_LENGTH[1],
            "require_cjk": settings.script == X.CJK, "dedup": "sha1(instruction+input+output)",
        },
        "sources": sources, "kept_by_source": facets["source"], "kept_by_task": facets["task"],
        "splits": parts | {"all": sum(parts.values()), "mix_train": parts["train"] + n, "translate_in_mix": n},
    }, ensure_ascii=False)


def rates(document: dict) -> dict[str, float]:
    """Shares that a statistics document implies: kept of raw rows in all and per source, translations in the mix."""
    share = lambda a, b: a / b if b else 0.0
    sources, splits = document["sources"], document["splits"]
    return {
        "kept": share(sum(s.get("kept", 0) for s in sources.values()), sum(s.get("raw", 0) for s in sources.values())),
        **{f"kept {name}": share(s.get("kept", 0), s.get("raw", 0)) for name, s in sources.items()},
        "translate_in_mix": share(splits["translate_in_mix"], splits["mix_train"]),
    }
