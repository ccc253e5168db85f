"""Benchmark decontamination by winnowing (native).

Every 8-word window is represented by the least of the hashes of its four
5-word grams, so any shared span of 8 words has a shared fingerprint at that
very window (k + w - 1 = 8).  A fingerprint is kept once for the run of windows
whose least gram it is.  Fingerprints of documents and benchmark are joined; a
hit is extended left and right over its run, whose windows are compared word by
word with the benchmark's.  Items shorter than a window are one window of their
own length and meet grams of that length.

Null or wordless texts have no words and no hits; null item ids are left out;
repeated items count once, repeated documents each.  Copies of a text share
one verdict, found by the MD5 of the text.  Long texts are compared whole.  An
empty table gives an empty result, an empty benchmark no hits.  Other columns,
whatever their names, are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_PLAIN_ANY_CASE, as_rows, count_words, plain_words
from .scratch import small, stored

#: Words of a window, of a gram, and grams of a window.
WINDOW, GRAM = 8, 5


def window_marks(df: DataFrame, words: str = "words") -> DataFrame:
    """Add ``marks``: per window of 8 words the least hash of its 5-word grams.  Needs k=5, w=4."""
    n = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))
    shift = lambda c, by: F.slice(c, by + 1, F.greatest(F.size(c) - by, F.lit(0)))
    pair = lambda a, b: F.xxhash64(a, b)
    least = lambda a, b: F.least(a, b)
    return (
        df.withColumn("h1", F.transform(words, lambda x: F.xxhash64(x)))
        .withColumn("h2", F.zip_with("h1", shift("h1", 1), pair))
        .withColumn("h4", F.zip_with("h2", shift("h2", 2), pair))
        .withColumn("h5", F.zip_with("h4", shift("h1", 4), pair))
        .withColumn("m2", F.zip_with("h5", shift("h5", 1), least))
        .withColumn("marks", F.slice(F.zip_with("m2", shift("m2", 2), least), F.lit(1), n))
        .drop("h1", "h2", "h4", "h5", "m2")
    )


def mark_runs(df: DataFrame, words: str = "words") -> DataFrame:
    """Add ``runs``: the fingerprints of a text, each with the first window of its run (``at``) and the one after it (``upto``)."""
    last = lambda i: F.get("marks", i - 1)
    df = window_marks(df, words)
    df = df.withColumn("starts", F.filter(F.transform("marks", lambda m, i: F.when((i == 0) | (m != last(i)), i)), lambda i: i.isNotNull()))
    following = F.concat(F.slice("starts", F.lit(2), F.greatest(F.size("starts") - 1, F.lit(0))), F.array(F.size("marks")))
    following = F.slice(following, F.lit(1), F.size("starts"))
    return df.withColumn("runs", F.zip_with("starts", following, lambda a, b: F.struct(F.get("marks", a).alias("mark"), a.alias("at"), b.alias("upto")))).drop("marks", "starts")


def _gram(words: Column, at: Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, at + 1, length), " ")


def _short_marks(words: str, length: int) -> Column:
    starts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(_gram(F.col(words), i, length)))


def find_hits(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per distinct text with hits: ``text_key`` (MD5), ``n_hit``, ``items`` (sorted array of strings)."""
    bench = items.where(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("item"), plain_words(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    bench = bench.withColumn("len", F.least(F.size("words"), F.lit(WINDOW)))
    long_ = window_marks(bench.where(F.col("len") == WINDOW)).select("item", "words", "len", F.posexplode_outer("marks").alias("at", "mark"))
    long_ = long_.select("item", "len", "mark", _gram(F.col("words"), F.col("at"), WINDOW).alias("gram")).where("mark is not null")
    short = bench.where(F.col("len") < WINDOW).select("item", "len", F.array_join("words", " ").alias("gram")).withColumn("mark", F.xxhash64("gram"))
    windows = stored(long_.unionByName(short, allowMissingColumns=True).select("item", "len", "mark", "gram").distinct(), "windows")
    marks = stored(windows.select("len", "mark").distinct(), "marks")
    short_lengths = [r["len"] for r in marks.where(F.col("len") < WINDOW).select("len").distinct().collect()]  # 1 to 7

    # Outer explodes: for inner ones the planner would add a filter on the whole chain of array expressions, inlined.
    body = docs.where(F.col(text).isNotNull()).select(F.md5(F.col(text)).alias("text_key"), plain_words(F.col(text)).alias("words"))
    met = mark_runs(body).select("text_key", F.lit(WINDOW).alias("len"), F.explode_outer("runs").alias("r")).select("text_key", "len", "r.*")
    for length in short_lengths:
        short_ = body.select("text_key", F.lit(length).alias("len"), F.posexplode_outer(_short_marks("words", length)).alias("at", "mark"))
        met = met.unionByName(short_.withColumn("upto", F.col("at") + 1))
    spots = met.join(small(marks), ["len", "mark"], "left_semi").groupBy("text_key").agg(F.collect_set(F.struct("len", "at", "upto")).alias("spots"))
    spots = stored(spots, "spots")

    near = docs.where(F.col(text).isNotNull()).select(F.md5(F.col(text)).alias("text_key"), F.col(text).alias("body")).join(small(spots), "text_key")
    run = lambda s: F.transform(F.sequence(s["at"], s["upto"] - 1), lambda at: F.struct(s["len"].alias("len"), at.alias("at"), _gram(F.col("words"), at, s["len"]).alias("gram")))
    cut = F.flatten(F.transform("spots", run))
    # Named twice, the words are not inlined into the lambda, which would split the text for every spot.
    near = near.withColumn("words", plain_words(F.col("body"))).select("text_key", F.explode_outer(F.when(F.size("words") > 0, cut)).alias("s"))
    near = near.select("text_key", "s.*").distinct()
    hits = stored(near.join(windows.select("item", "len", "gram").distinct(), ["len", "gram"]).select("text_key", "at", "len", "item"), "hits")
    words = hits.select("text_key", "at", "len").distinct().select("text_key", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("len") - 1)).alias("word")).distinct()
    words = words.groupBy("text_key").agg(F.count("*").alias("n_hit"))
    names = hits.select("text_key", "item").distinct().groupBy("text_key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return stored(words.join(names, "text_key"), "verdicts")


def decontaminate(docs: DataFrame, items: DataFrame, least_items: int = 2, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items, contaminated``."""
    found = small(find_hits(docs, items, text, item, item_text))
    rows = docs.select(F.col(key).alias("doc_id"), count_words(F.col(text), NOT_PLAIN_ANY_CASE).alias("n_words"), F.md5(F.col(text)).alias("text_key"))
    met = rows.join(found, "text_key", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return met.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"), (F.size(listed) >= least_items).alias("contaminated")
    )


def without_contaminated(docs: DataFrame, items: DataFrame, least_items: int = 2, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds windows of fewer than ``least_items`` items."""
    bad = stored(find_hits(docs, items, text).where(F.size("items") >= least_items).select(F.col("text_key").alias("bad_key")), "bad")
    return as_rows(docs).join(small(bad), F.md5(F.col("row")[text]) == F.col("bad_key"), "left_anti").select("row.*")
