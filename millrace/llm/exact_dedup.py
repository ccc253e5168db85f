"""Exact dedup by two passes over hashes (native).

Pass 1 builds a saturating Bloom filter: two independent bit arrays in which
a bit stands only if at least two rows hit it, held as words of 64 bits.
Pass 2 tests every row.  A row whose two bits both stand may have an equal
one; only those rows are shuffled by digest and grouped.  The rest are alone
for certain and pass straight through.

Null text counts as empty.  A null id ranks below every other id.  Repeated
rows are copies like others; of rows with equal id and text exactly one stays.
Long texts are hashed whole.  An empty table gives an empty result.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, low_hex
from .scratch import small, stored


def _slot(bits: int, seed: int) -> Column:
    return F.xxhash64("digest", F.lit(seed)).bitwiseAND(F.lit(bits - 1))


def possibly_repeated(rows: DataFrame, bits_per_row: int = 16) -> DataFrame:
    """The rows of ``rows`` (with a binary ``digest``) marked ``maybe``: false if surely alone."""
    count = rows.count()
    bits = 1 << max(10, (count * bits_per_row).bit_length())
    slots = rows.select(F.explode(F.array(*(F.struct(F.lit(k).alias("k"), _slot(bits, k).alias("slot")) for k in (0, 1)))).alias("s")).select("s.k", "s.slot")
    words = (
        slots.groupBy("k", "slot").count().where("count > 1")
        .groupBy("k", F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mask"))
    )
    words = stored(words, "bloom")
    out = rows
    for k in (0, 1):
        half = words.where(F.col("k") == k).select(F.col("word").alias(f"word{k}"), F.col("mask").alias(f"mask{k}"))
        out = out.withColumn(f"slot{k}", _slot(bits, k)).withColumn(f"word{k}", F.shiftright(f"slot{k}", 6)).join(small(half), f"word{k}", "left")
    bit = [F.expr(f"(shiftrightunsigned(coalesce(mask{k}, 0L), cast(slot{k} & 63 as int)) & 1L) = 1L") for k in (0, 1)]
    return out.select(*rows.columns, (bit[0] & bit[1]).alias("maybe"))


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", bits_per_row: int = 16) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(key).alias("doc_id"),
            F.unhex(F.sha2(lower_ascii(F.coalesce(F.col(text), F.lit(""))), 256)).alias("digest"),
        ),
        "digests",
    )
    tested = possibly_repeated(rows, bits_per_row)
    alone = tested.where(~F.col("maybe"))
    suspects = stored(tested.where("maybe").drop("maybe"), "suspects")
    groups = suspects.groupBy("digest").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "uid")).alias("best"))
    groups = stored(groups.where("group_size > 1"), "groups")
    met = suspects.join(small(groups), "digest", "left")
    result = met.select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best.uid") == F.col("uid"), F.lit(True)).alias("kept"),
        low_hex(F.col("digest")).alias("text_sha256"),
    )
    straight = alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), low_hex(F.col("digest")).alias("text_sha256"))
    return straight.unionByName(result)
