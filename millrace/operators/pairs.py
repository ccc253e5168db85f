"""Pairs of parallel texts and of conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bernoulli, choice, strip, translated

# Instructions by direction.
TO_MANDARIN = ["请将这段地道的粤语翻译成普通话。", "帮我把这段话翻译成普通话。", "用普通话怎么说这段粤语？", "翻译以下粤语内容："]
TO_CANTONESE = ["请将这段普通话翻译成地道的粤语。", "帮我把这段话转成粤语口语。", "用粤语怎么说这段话？", "将以下内容翻译为粤语："]
MIRROR_RATE = 0.33


def mirrored(df: DataFrame, a: str, b: str, key: str, seed: int = 42, rate: float = MIRROR_RATE, table: dict[str, str] | None = None) -> DataFrame:
    """One row from ``a`` to ``b`` and, for about ``rate`` of the pairs, one back; rows with an empty side go."""
    left, right = strip(F.col(a)), translated(strip(F.col(b)), table) if table else strip(F.col(b))
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(key).alias("pair_id"), left.alias("_a"), right.alias("_b")).where("_a != '' and _b != ''")
    there = F.struct(choice(seed, F.col("pair_id"), TO_MANDARIN).alias("instruction"), F.col("_a").alias("input"), F.col("_b").alias("output"))
    back = F.struct(choice(seed + 1, F.col("pair_id"), TO_CANTONESE).alias("instruction"), F.col("_b").alias("input"), F.col("_a").alias("output"))
    both = F.when(bernoulli(seed, F.col("pair_id"), rate), F.array(there, back)).otherwise(F.array(there))
    return rows.select("pair_id", F.explode(both).alias("p")).select("pair_id", "p.*")


def next_replies(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Each user turn that the next turn, an assistant's, answers: ``conv_id, turn, instruction, output``."""
    w = Window.partitionBy(conv).orderBy(turn)
    seen = turns.select(conv, turn, "role", "text", F.lead("role").over(w).alias("r"), F.lead("text").over(w).alias("t"))
    return seen.where("role = 'user' and r = 'assistant'").select(conv, turn, F.col("text").alias("instruction"), F.col("t").alias("output"))
