"""Parallel corpora: pairs, dedup and positional split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.templates import REFUSAL_FORMAL
from ..functions.text import choice, order_key
from ..operators.pairs import TO_MANDARIN, mirrored
from ..operators.select import first_wins, mark_duplicates, pair_key, ratio_split, totals
from ..operators.stages import written
from ..sources.files import ASKED, READERS, csv_table, raw_lines, write_lines


def directed(spark: SparkSession, sources: list[tuple[str, str]], seed: int = 42, table: dict[str, str] | None = None) -> DataFrame:
    """Directed pairs of all (reader, path) sources."""
    out = None
    for reader, path in sources:
        rows = READERS[reader](spark, path)
        rows = rows.withColumn("pair_id", F.md5(F.concat_ws("\n", "yue", "zh")))
        rows = mirrored(rows, "yue", "zh", "pair_id", seed, table=table).select("instruction", "input", "output")
        out = rows if out is None else out.unionByName(rows)
    return out


def refusals(texts: DataFrame, column: str = "text", seed: int = 42) -> DataFrame:
    """Safety rows with the fixed answer."""
    return texts.select(choice(seed, F.col(column), TO_MANDARIN).alias("instruction"), F.col(column).alias("input"), F.lit(REFUSAL_FORMAL).alias("output"))


def deduplicated(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with input and output, the first of each pair in the order given."""
    full = rows.where("coalesce(input, '') != '' and coalesce(output, '') != ''")
    return first_wins(full.withColumn("pair_key", pair_key(F.col("input"), F.col("output"))), "pair_key", *order)


def malformed_or_kept(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines in file order with ``line`` as it was written and ``pair_key``; the key is null for lines that go.

    Lines that are no JSON, or lack an input or an output, go; of equal pairs
    the first in file order stays.
    """
    rows = written(raw_lines(spark, path), "lines")
    said = rows.select("*", F.from_json("line", ASKED).alias("j"))
    full = (F.coalesce(F.col("j.input"), F.lit("")) != "") & (F.coalesce(F.col("j.output"), F.lit("")) != "")
    keyed = written(said.select("line", "file", "block", "position", F.when(full, pair_key(F.col("j.input"), F.col("j.output"))).alias("key")), "keyed")
    marked = mark_duplicates(keyed, "key", "file", "block", "position", among=F.col("key").isNotNull())
    return marked.select("line", "file", "block", "position", F.when(~F.col("duplicate"), F.col("key")).alias("pair_key"))


def prepare(spark: SparkSession, sources: list[tuple[str, str]], safety: str | None, out: str, seed: int = 42, table: dict[str, str] | None = None) -> dict[str, int]:
    """The whole job: directed pairs and refusals in random order, dedup by line, totals, and the three parts as raw lines.

    Writes ``all``, ``kept`` and ``split`` (by part) to ``out`` and returns
    ``total, kept, removed``.
    """
    rows = directed(spark, sources, seed, table)
    if safety:
        rows = rows.unionByName(refusals(csv_table(spark, safety), seed=seed))
    lines = rows.select(F.to_json(F.struct("instruction", "input", "output"), {"ignoreNullFields": "false"}).alias("line"))
    write_lines(lines.orderBy(order_key(seed, F.col("line")), "line"), f"{out}/all")
    judged = written(malformed_or_kept(spark, f"{out}/all"), "judged")
    kept = judged.where(F.col("pair_key").isNotNull())
    write_lines(kept.orderBy("file", "block", "position"), f"{out}/kept")
    write_lines(split(kept, "pair_key", seed), f"{out}/split", by="split")
    return totals(judged, F.col("pair_key").isNotNull()).first().asDict()


def split(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return ratio_split(rows, key, seed, 0.98, 0.01)
