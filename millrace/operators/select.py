"""Dedup, splits, samples and statistics.

All randomness is a hash of seed and id, so results do not depend on
partitioning.  Positions in a random order are found from counts of hash
ranges: only the ranges that hold a cut are sorted, and the rows themselves
are compared with the cuts where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import order_key
from .stages import written

#: Hex digits of the order key that make a range.
_RANGE = 4


def first_wins(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """One row per key, the first in the order given; the planner keeps one row per key and task before the shuffle."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def mark_duplicates(df: DataFrame, key: str, *order: str, among: Column | None = None) -> DataFrame:
    """Add ``duplicate``: true for all but the first row of a key, by ``order``, of the rows that fulfil ``among``.

    ``df`` must be cheap to read twice, such as a written table.  The first
    rows come from an aggregate, which combines copies before the shuffle, and
    are joined back, so no task ranks all copies of a key.  Rows equal in
    ``order`` too are told apart by position in the table.
    """
    place = F.struct(*(F.col(c) for c in order), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    rows = df.select("*", place.alias("_place"), (F.lit(True) if among is None else among).alias("_among"))
    first = rows.where("_among").groupBy(F.col(key).alias("_key")).agg(F.min("_place").alias("_first"))
    met = rows.join(first, rows[key].eqNullSafe(first["_key"]), "left")
    return met.select(*df.columns, (F.col("_among") & (F.col("_place") != F.col("_first"))).alias("duplicate"))


def pair_key(given: Column, reply: Column) -> Column:
    """MD5 of two texts one after another."""
    return F.md5(F.concat(given, reply))


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.orderBy(order_key(seed, F.col(key)), key)


def take_random(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly ``n`` rows, or all if fewer; a heap per partition, no full sort."""
    return df.orderBy(order_key(seed, F.col(key)), key).limit(max(n, 0))


def split_sizes(n: Column, test: float, val: float) -> tuple[Column, Column]:
    """Sizes of test and validation for a stratum of ``n`` rows."""
    share = lambda r: F.greatest(F.lit(1), F.floor(n * F.lit(float(r))).cast("int"))
    few = F.greatest(F.lit(1), F.floor(n / 20).cast("int"))
    t, v = F.when(n >= 50, share(test)).otherwise(few), F.when(n >= 50, share(val)).otherwise(few)
    tight = t + v >= n
    return F.when(tight, F.least(t, F.lit(1))).otherwise(t), F.when(tight, F.least(v, F.when(n > 2, 1).otherwise(0))).otherwise(v)


def _cuts(rows: DataFrame, stratum: list[str], sizes: list[Column]) -> DataFrame:
    """Per stratum the places (``_h``, ``_k``) of the rows that stand at the given ranks, as ``_cut0``, ``_cut1`` ...

    ``rows`` holds the stratum, ``_h`` and ``_k``.  A rank below 1 gives null.
    """
    spans = rows.groupBy(*stratum, F.substring("_h", 1, _RANGE).alias("_span")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*stratum)  # one row per hash range
    spans = spans.withColumn("_before", F.sum("_c").over(w.orderBy("_span")) - F.col("_c")).withColumn("_n", F.sum("_c").over(w))
    ranks = F.array(*(s.cast("long") for s in sizes))
    wanted = spans.withColumn("_ranks", F.filter(ranks, lambda r: (r > F.col("_before")) & (r <= F.col("_before") + F.col("_c")))).where(F.size("_ranks") > 0)
    wanted = written(wanted.select(*(F.col(c).alias(f"_s{i}") for i, c in enumerate(stratum)), "_span", "_before", "_ranks", ranks.alias("_all")), "cuts")
    same = F.col("_span") == F.substring("_h", 1, _RANGE)
    for i, c in enumerate(stratum):
        same &= F.col(f"_s{i}").eqNullSafe(F.col(c))
    keys = [f"_s{i}" for i in range(len(stratum))]
    near = rows.join(wanted, same).select(*keys, "_span", "_before", "_ranks", "_all", "_h", "_k")
    near = near.withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy(*keys, "_span").orderBy("_h", "_k")))
    near = near.where(F.array_contains("_ranks", F.col("_rank").cast("long")))
    cut = lambda i: F.max(F.when(F.col("_rank") == F.element_at("_all", i + 1), F.struct("_h", "_k"))).alias(f"_cut{i}")
    return near.groupBy(*keys).agg(*(cut(i) for i in range(len(sizes))))


def stratified_split(df: DataFrame, stratum: str, key: str, seed: int, test: float = 0.02, val: float = 0.02) -> DataFrame:
    """Add ``split``: test first, then val, the rest train, by random rank inside each stratum.

    ``df`` is read three times and should be a table; keys are unique.  Two
    reads are of stratum and key alone; the last one compares each row with
    the two places where its stratum is cut, so no row is shuffled.
    """
    narrow = df.select(stratum, order_key(seed, F.col(key)).alias("_h"), F.col(key).alias("_k"))
    t, v = split_sizes(F.col("_n"), test, val)
    cuts = _cuts(narrow, [stratum], [t, t + v])
    place = F.struct(order_key(seed, F.col(key)).alias("_h"), F.col(key).alias("_k"))
    met = df.join(cuts, F.col(stratum).eqNullSafe(F.col("_s0")), "left")
    return met.withColumn("split", F.when(place <= F.col("_cut0"), "test").when(place <= F.col("_cut1"), "val").otherwise("train")).select(*df.columns, "split")


def ratio_split(df: DataFrame, key: str, seed: int, train: float = 0.98, val: float = 0.01) -> DataFrame:
    """Add ``split`` by random position among all rows: floor(train), floor(val), the rest test.

    As :func:`stratified_split`, of one stratum that holds all rows.
    """
    narrow = df.select(F.lit(0).alias("_all_rows"), order_key(seed, F.col(key)).alias("_h"), F.col(key).alias("_k"))
    a, b = F.floor(F.col("_n") * F.lit(float(train))), F.floor(F.col("_n") * F.lit(float(val)))
    cuts = _cuts(narrow, ["_all_rows"], [a, a + b])
    place = F.struct(order_key(seed, F.col(key)).alias("_h"), F.col(key).alias("_k"))
    met = df.join(cuts, F.col("_s0") == F.lit(0), "left")  # one row
    return met.withColumn("split", F.when(place <= F.col("_cut0"), "train").when(place <= F.col("_cut1"), "val").otherwise("test")).select(*df.columns, "split")


def quota_sample(df: DataFrame, quotas: DataFrame, keys: list[str], n: str, key: str, seed: int) -> DataFrame:
    """At most the quota of each group, at random; ``quotas`` holds one row per group.

    The greatest quota, a literal, lets the planner keep that many rows per
    group and task before the shuffle.
    """
    most = quotas.agg(F.coalesce(F.max(n), F.lit(0))).first()[0]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order_key(seed, F.col(key)), key))
    near = df.join(quotas, keys, "left_semi").withColumn("_nth", nth).where(F.col("_nth") <= int(most))
    return near.join(quotas, keys).where(F.col("_nth") <= F.col(n)).select(*df.columns)


def count_sets(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts by each column alone in one pass: ``facet, value, n``."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns)))
    return df.select(pairs.alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))


def reason_counts(df: DataFrame, source: str = "source", status: str = "status") -> DataFrame:
    """Rows per source and status, and ``raw`` for each source."""
    both = F.explode(F.array(F.lit("raw"), F.coalesce(status, F.lit("kept"))))
    return df.select(source, both.alias("status")).groupBy(source, "status").agg(F.count("*").alias("n"))


def reason_maps(counts: DataFrame, source: str = "source") -> DataFrame:
    """Counts of each source as one map, by reason in order."""
    return counts.groupBy(source).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n")))).alias("reasons"))


def totals(df: DataFrame, kept: Column) -> DataFrame:
    """One row: ``total, kept, removed``."""
    return df.agg(F.count("*").alias("total"), F.count_if(kept).alias("kept"), (F.count("*") - F.count_if(kept)).alias("removed"))


def status_rollup(df: DataFrame, group: str, states: tuple[str, ...] = ("success", "skipped", "failed")) -> DataFrame:
    """Counts of each state per group and in all, with ``any_failed``."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in states]
    return df.rollup(group).agg(F.grouping(group).alias("is_total"), F.count("*").alias("n"), *counts, F.coalesce(F.bool_or(F.col("status") == "failed"), F.lit(False)).alias("any_failed"))
