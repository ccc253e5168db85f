"""Mixing sources to target weights.

Every row gets a hash-random key (MD5 of seed, id and text).  Within each
source the keys are cut into ranges of equal width; the word sums of the
ranges, prefix-summed per source, show in which range a source's budget ends,
and only that range is sorted and summed row by row.  The cut is then one key
per source: rows below it are taken once more than the rows above it, and the
row at the cut supplies what is missing to the exact budget (or, with
``whole``, is taken whole where that is nearer).  Budgets beyond a source's
size repeat whole epochs.

Null and empty texts have size 0 and are never taken.  Rows of a null source
form one source, last in order.  Rows equal in id, source and text share a
key; at the cut they share the missing words evenly.  Long texts count in full.
An empty table gives an empty result.  Other columns, whatever their names, are
left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, count_words
from .scratch import small, stored

#: Hex digits of the key that name a range: 4096 ranges per source.
RANGE_DIGITS = 3


def ranked(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 in the order of the distinct values of ``by``; no task sees all rows."""
    parts = stored(rows.repartitionByRange(F.col(by)).withColumn("pid", F.spark_partition_id()), "ranked")
    before = parts.groupBy("pid").count().select("pid", (F.sum("count").over(Window.orderBy("pid")) - F.col("count")).alias("base"))
    inner = parts.withColumn("rn", F.row_number().over(Window.partitionBy("pid").orderBy(by)))
    return inner.join(before, "pid").withColumn("rank", F.col("base") + F.col("rn") - 1).drop("pid", "base", "rn")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sources`` (grp, source_size) with ``target``; each round of resharing is one aggregate row."""
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    src = stored(
        ranked(sources, "grp").select(
            "grp", "source_size", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("w"), (F.col("source_size") * F.lit(float(most))).alias("cap")
        ),
        "sources",
    )
    first = src.agg(F.sum("source_size").alias("s"), F.sum("w").alias("w")).first()
    total, capped, weight = share * (first["s"] or 0), 0.0, first["w"] or 0.0
    while weight:
        above = F.col("cap") < F.col("w") * F.lit(total - capped) / F.lit(weight)
        got = src.agg(F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)).alias("c"), F.coalesce(F.sum(F.when(~above, F.col("w"))), F.lit(0.0)).alias("w")).first()
        if got["c"] == capped:
            break
        capped, weight = got["c"], got["w"]
    even = F.least(F.col("cap"), F.col("w") * F.lit(total - capped) / F.lit(weight)) if weight else F.col("cap")
    return src.select("grp", "source_size", even.alias("target"))


def keyed(docs: DataFrame, text: str, key: str, source: str, seed: str) -> list[Column]:
    """Columns of a row: grp (sorts as the source, null last), rkey, size."""
    body = F.coalesce(F.col(text), F.lit(""))
    return [
        F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source))).alias("grp"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), body)).alias("rkey"),
        count_words(F.col(text), SPACES).alias("size"),
    ]


def cuts(rows: DataFrame, weights: tuple[float, ...], share: float, most: float, whole: bool) -> DataFrame:
    """Per source: ``grp, source_size, target, epochs, cut_key, cut_words``."""
    span = F.substring("rkey", 1, RANGE_DIGITS)
    sums = stored(rows.groupBy("grp", span.alias("span")).agg(F.sum("size").alias("words")), "ranges")
    goal = targets(sums.groupBy("grp").agg(F.sum("words").alias("source_size")), weights, share, most)
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = stored(goal.withColumn("rest", F.greatest(F.lit(0), F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))), "goals")
    run = F.sum("words").over(Window.partitionBy("grp").orderBy("span"))
    ends = sums.withColumn("run", run).join(goal.where("rest > 0"), "grp").where("run >= rest and run - words < rest").select("grp", "span", "rest", (F.col("run") - F.col("words")).alias("before"))
    near = rows.withColumn("span", span).join(small(ends), ["grp", "span"]).groupBy("grp", "rkey", "rest", "before").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    run = F.col("before") + F.sum("words").over(Window.partitionBy("grp").orderBy("rkey"))
    at = near.withColumn("run", run).where("run >= rest and run - words < rest")
    missing = F.col("rest") - F.col("run") + F.col("words")
    given = F.when(missing * 2 >= F.col("words"), F.col("words")).otherwise(F.lit(0)) if whole else missing
    at = at.select("grp", F.col("rkey").alias("cut_key"), F.floor(given / F.col("rows")).cast("long").alias("cut_words"))
    return stored(goal.join(at, "grp", "left").select("grp", "source_size", "target", "epochs", "cut_key", "cut_words"), "cuts")


def taken_words() -> Column:
    """Words that the mix takes from a row joined with its source's cut."""
    more = F.when(F.col("rkey") < F.col("cut_key"), F.col("size")).when(F.col("rkey") == F.col("cut_key"), F.col("cut_words")).otherwise(F.lit(0))
    return (F.col("epochs") * F.col("size") + F.coalesce(more, F.lit(0))).cast("long")


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix", whole: bool = False, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    rows = stored(docs.select(F.col(key).alias("doc_id"), *keyed(docs, text, key, source, seed)), "keyed")
    plan = cuts(rows, weights, share, most, whole)
    return rows.join(small(plan), "grp").select("doc_id", "size", "source_size", "target", taken_words().alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix", text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The mixed rows themselves: each document of ``docs`` whole, as often as the mix takes it."""
    rows = stored(docs.select(*keyed(docs, text, key, source, seed)), "keyed")
    plan = cuts(rows, weights, share, most, whole=True)
    grp, rkey, size = keyed(docs, text, key, source, seed)
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), grp, rkey, size)  # no name can clash
    times = F.when(F.col("size") > 0, F.floor(taken_words() / F.col("size")).cast("int")).otherwise(F.lit(0))
    met = own.join(small(plan), "grp").withColumn("times", times).where("times > 0")
    return met.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")
