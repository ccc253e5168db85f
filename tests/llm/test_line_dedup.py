"""Line dedup with hot words, large groups, long lines and joins by shuffle, against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import line_dedup, scratch
from millrace.llm.jaccard_join import Similarity


def words_of(line):
    return set(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line)))


def expected(docs, num=4, den=5):
    """``{(doc_id, line): gone}`` by comparing every line with every earlier one."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("m")).where("text is not null").distinct().collect()
    placed = {((r["doc_id"] is not None, r["doc_id"] or 0), r["m"], i): words_of(x) for r in rows for i, x in enumerate(r["text"].split("\n"))}
    order = sorted(placed)
    return {(p[0][1], p[2]) for k, p in enumerate(order) if placed[p] and any(placed[q] and den * len(placed[p] & placed[q]) >= num * len(placed[p] | placed[q]) for q in order[:k])}


def found(docs, sim=line_dedup.SIM):
    return {(r["doc_id"] or 0, a) for r in line_dedup.removed_lines(docs, sim).collect() for a in r["gone"]}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    rare = [f"r{i}" for i in range(300)]
    hot = [f"h{i}" for i in range(14)]  # many lines of common words alone
    lines = [" ".join(rng.sample(hot, rng.randrange(4, 12))) for _ in range(250)]
    lines += [" ".join(rng.sample(rare, 12)) for _ in range(60)]
    base = [f"f{i}" for i in range(20)]  # one family of near-equal lines
    for _ in range(120):
        line = list(base)
        for _ in range(rng.randrange(4)):
            line[rng.randrange(20)] = rng.choice(rare)
        lines.append(" ".join(line))
    lines += [" ".join(f"x{i}" for i in range(3000)), " ".join(f"x{i}" for i in range(200, 3000)), "once", "ONCE", "", "  ", "a b", "a c"]
    rng.shuffle(lines)
    texts = ["\n".join(lines[a : a + 7]) for a in range(0, len(lines), 7)] + [None, "", "\n\n"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("hot", [1 << 16, 40, 0])
def test_hot_words_are_split_by_a_second_word(docs, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    assert found(docs) == expected(docs)


def test_lower_similarity_with_hot_words(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", 20)
    assert found(docs, Similarity(1, 2, 1)) == expected(docs, 1, 2)
    small = docs.sparkSession.createDataFrame([(0, "a b"), (1, "a"), (2, "b c"), (3, "a b c"), (4, "d")] + [(k, f"a b q{k}") for k in range(5, 60)], "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "HOT", 0)
    assert found(small, Similarity(1, 3, 1)) == expected(small, 1, 3)


def test_rounds_until_all_are_met(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "FIRST_MET", 1)
    monkeypatch.setattr(line_dedup, "MORE_MET", 2)
    monkeypatch.setattr(line_dedup, "BUFFER_BYTES", 4000)
    assert found(docs) == expected(docs)


def test_joins_by_shuffle(docs, monkeypatch):
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", -1)
    assert found(docs) == expected(docs)


def test_clashing_names_and_empty_table(docs):
    wide = docs.select("doc_id", "text", *(F.lit(1).alias(c) for c in ("row", "_id", "_mark", "_gone", "mark", "at", "kind", "part", "key")))
    kept = line_dedup.dedup_lines(wide)
    assert kept.columns == wide.columns
    gone = expected(docs)
    want = {r["doc_id"]: None if r["text"] is None else "\n".join(x for i, x in enumerate(r["text"].split("\n")) if (r["doc_id"], i) not in gone) for r in docs.collect()}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == want
    assert line_dedup.dedup_lines(wide.limit(0)).count() == 0
