"""Normalisation, rules and dedup over an unbounded source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as X


def cleaned(stream: DataFrame, at: str = "ts", lateness: str = "1 hour", script: str = X.CJK) -> DataFrame:
    """Rows of ``instruction, input, output`` that pass the rules, once per id while the watermark remembers it."""
    rows = stream.select(at, X.norm_text(F.col("instruction")).alias("instruction"), X.norm_input(F.col("input")).alias("input"), X.norm_text(F.col("output")).alias("output"))
    rows = rows.where(X.drop_reason(F.col("instruction"), F.col("output"), script).isNull())
    rows = rows.withColumn("id", X.record_id(F.col("instruction"), F.col("input"), F.col("output")))
    return rows.withWatermark(at, lateness).dropDuplicatesWithinWatermark(["id"])


def appended(stream: DataFrame, path: str, checkpoint: str, each: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """A result log that grows by one batch at a time."""
    def add(batch: DataFrame, number: int) -> None:
        each(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")  # a batch that runs again replaces itself

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).start()
