"""The lexicon matcher against a naive scan, and what the fitted lexicon finds in each language."""

import random

from millrace.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def naive(text, weights, beginnings, exceptions):
    """Every word of the folded text against every entry, in plain loops."""
    inside = lambda a, b: any(text.startswith(p, i) and (i == 0 or not text[i - 1].isalnum()) and (i + len(p) == len(text) or not text[i + len(p)].isalnum()) and i <= a and b <= i + len(p) for p in exceptions for i in range(len(text)))
    found = []
    for a in range(len(text)):
        if a and text[a - 1].isalnum():
            continue
        best = None
        for entries, ends in ((weights, True), (beginnings, False)):
            for e, w in entries.items():
                b = a + len(e)
                if e and text.startswith(e, a) and (b == len(text) or not text[b].isalnum()) == ends and (best is None or w > best[1]):
                    best = (b, w)
        if best and not inside(a, best[0]):
            found.append(best[1])
    return sum(found), len(found)


def test_matcher_against_a_naive_scan():
    rng = random.Random(3)
    weights = {"bad": 1.0, "bad cat": 0.5, "rot": 2.0, "a": 0.25}
    beginnings = {"bad": 0.75, "ro": 1.5}
    exceptions = ("bad luck", "not bad", "so not bad at all", "rot", "a bad a bad")
    matcher = toxicity.Matcher(weights, exceptions, beginnings)
    for _ in range(3000):
        text = " ".join(rng.choice(["bad", "badly", "cat", "luck", "not", "so", "at", "all", "rot", "rotten", "ro", "a", "xbad", "bad-cat"]) for _ in range(rng.randrange(12)))
        assert matcher.find(text) == naive(text, weights, beginnings, [e for e in exceptions if e not in weights]), text


def test_any_number_of_exception_phrases_covers_a_match():
    phrases = ["bad " + " ".join("x" * k for k in range(1, n)) for n in range(2, 12)]
    matcher = toxicity.Matcher({"bad": 1.0, "xx": 1.0}, phrases)
    assert matcher.find(phrases[-1]) == (0, 0) and matcher.find("bad y xx") == (2.0, 2)
    matcher = toxicity.Matcher({"z": 1.0}, [f"{'p ' * n}z" for n in range(1, 9)])
    assert matcher.find("p p p p p p p z") == (0, 0) and matcher.find("q z") == (1.0, 1)


def test_learns_beginnings_of_families_but_no_chance_entries():
    rng = random.Random(1)
    plain = lambda: [rng.choice("wasser brot haus wind regen feld baum stein".split()) for _ in range(30)]
    toxic = [" ".join([*plain(), *(f"garst{rng.choice('abcdefghik')}{rng.choice('lmnop')}" for _ in range(4))]) for _ in range(12)]
    clean = [" ".join(plain()) for _ in range(200)] + [" ".join([*plain(), "garst"]) for _ in range(20)]
    model = toxicity.learn(toxic + clean, [1] * len(toxic) + [0] * len(clean))
    assert list(model.beginnings) and all("garst".startswith(b[:5]) for b in model.beginnings)
    assert model.score("ein garstix garstoq garstuz") > 0.3 > max(map(model.score, clean))


def test_held_out_recall_by_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    got = queries.op8_toxicity(spark, SF).join(docs, "doc_id").join(truth, "doc_id").where("held_out")
    rows = {r["lang"]: r for r in got.groupBy("lang").agg({"*": "count"}).collect()}
    assert set(rows) >= {"de", "en", "es", "fr"}
    for r in got.groupBy("lang").pivot("toxic", [0, 1]).agg({"predicted": "avg"}).collect():
        assert r["1"] >= 0.85 and r["0"] <= 0.05, r
