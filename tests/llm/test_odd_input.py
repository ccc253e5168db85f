"""Every operator and stage: clashing names, empty tables, very large groups, and joins by shuffle."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, decontaminate, exact_dedup, jaccard_join, language, line_dedup, mixing, queries, scratch, token_files, toxicity, urls

CLASHES = ("row", "_id", "_mark", "bad_key", "prompt", "chat", "layout", "key", "mark", "n", "grp", "rkey", "size", "times", "uid", "digest", "host", "path", "word", "text_key", "words", "label", "h", "_nth", "with.dot")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def groups(texts):
    """Root of each text by links of similarity 0.8, compared pair by pair."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))], sets


@pytest.fixture(scope="module")
def wide(spark):
    """A hot source and group of copies of a third of the rows, near copies, nulls, a long text; columns of all internal names."""
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(500)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(12)]
    near = [" ".join(w if i != k else "other" for i, w in enumerate(base[0].split())) for k in range(20)]
    texts = [base[0]] * 40 + near + base + [None, "", " \n", "one", "long " * 30000 + "x", base[1].upper()]
    df = spark.createDataFrame([(i, t, "hot" if i < 60 else None if i % 5 == 0 else f"s{i % 3}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    return df.select("*", *(F.lit(7).alias(c) for c in CLASHES)).repartition(6)


@pytest.fixture(params=[None, -1], ids=["broadcast", "shuffle"])
def limit(request, monkeypatch):
    if request.param is not None:
        monkeypatch.setattr(scratch, "BROADCAST_BYTES", request.param)


def test_near_copies(wide, limit):
    rows = sorted(wide.select("doc_id", "text").collect())
    root, sets = groups([r["text"] for r in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_groups(wide).collect()}
    assert got == {r["doc_id"]: (len(sets[i]), root[i] if sets[i] else i) for i, r in enumerate(rows)}
    kept = jaccard_join.one_of_each(wide)
    assert kept.columns == wide.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [i for i in range(len(rows)) if root[i] == i or not sets[i]]


def test_exact_copies(wide, limit):
    rows = wide.select("doc_id", "text").collect()
    best = {}
    for r in rows:
        best[lower(r["text"])] = max(best.get(lower(r["text"]), -1), r["doc_id"])
    many = Counter(lower(r["text"]) for r in rows)
    want = {r["doc_id"]: (best[lower(r["text"])], many[lower(r["text"])]) for r in rows}
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(wide).collect()} == want


def test_passages(spark, wide, limit):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    texts = {r["doc_id"]: words(r["text"]) for r in wide.select("doc_id", "text").collect()}
    items = [(1, " ".join(texts[61][5:25])), (2, "long " * 9), (3, "one"), (4, " ".join(texts[62][3:11]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    parts = {}
    for k, t in items:
        w = words(t)
        size = min(8, len(w))
        for a in range(len(w) - size + 1):
            parts.setdefault(tuple(w[a : a + size]), set()).add(str(k))
    want = {}
    for d, w in texts.items():
        hit, found = set(), set()
        for size in {len(p) for p in parts}:
            for a in range(len(w) - size + 1):
                if tuple(w[a : a + size]) in parts:
                    hit.update(range(a, a + size))
                    found |= parts[tuple(w[a : a + size])]
        want[d] = (len(w), len(hit), sorted(found))
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.decontaminate(wide, bench).collect()} == want
    clean = decontaminate.without_contaminated(wide, bench, least_items=1)
    assert clean.columns == wide.columns and {r["doc_id"] for r in clean.select("doc_id").collect()} == {d for d, (_, _, found) in want.items() if not found}
    assert decontaminate.without_contaminated(wide, bench.limit(0), least_items=1).count() == wide.count()


def test_fingerprints_are_kept_once_a_run(spark):
    rows = spark.createDataFrame([([f"w{i * i % 97}" for i in range(200)],), (["a"] * 50,), (["a"] * 7,), ([],)], "words array<string>")
    for r in decontaminate.mark_runs(decontaminate.window_marks(rows).withColumnRenamed("marks", "every")).collect():
        assert [x["mark"] for x in r["runs"] for _ in range(x["at"], x["upto"])] == r["every"]
        assert all(a["mark"] != b["mark"] and a["upto"] == b["at"] for a, b in zip(r["runs"], r["runs"][1:]))


def test_mixing_and_urls(spark, wide, limit):
    got = mixing.mix_plan(wide).collect()
    assert len(got) == wide.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    mixed = mixing.mix(wide)
    assert mixed.columns == wide.columns and mixed.where("text is null").count() == 0
    rules = spark.createDataFrame(queries.URL_RULES, urls.RULE_SCHEMA)
    pages = wide.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://a.example.org/es/"), F.coalesce("text", F.lit(""))).alias("url"), "host", "rkey")
    assert urls.judge_urls(pages, rules).where("verdict = 'block' and rule = 'example.org/es/'").count() == wide.count()
    assert urls.judge_urls(pages.limit(0), rules).count() == 0 and urls.judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == wide.count()


def test_models_and_files(wide, limit):
    model = toxicity.learn(["you idiot", "a fine day"] * 10, [1, 0] * 10)
    assert toxicity.without_toxic(wide, model).columns == wide.columns
    assert toxicity.score_toxicity(wide, model).count() == wide.count()
    assert language.identify(wide, None).count() == wide.count()
    assert token_files.token_files(wide, queries.vocabulary()).count() == wide.count()
    assert line_dedup.line_report(wide).count() == wide.count()


def test_chat_beside_other_columns(spark):
    bodies = ['{"messages":[{"role":"user","content":"h"}],"prompt":"x"}', '{"prompt":"p","completion":"c"}', '{"instruction":"i","output":"o"}', '{"prompt":"p"}', "bad", None]
    rows = spark.createDataFrame([(b, 1, 2, 3, 4, 5) for b in bodies], "j string, prompt int, chat int, layout int, schema_mark int, _prompt int")
    opened = chat.parsed(rows, "j")
    seen = chat.canonical_turns(opened)
    assert [r["layout"] for r in seen.collect()] == ["messages", "prompt_completion", "instruction", None, None, None]
    assert seen.first()["__prompt"] == 1 and seen.first()["_prompt"] == 5 and seen.first()["schema_mark"] == 4
    back = chat.read_chat(chat.format_chat(seen.withColumn("safe", F.lit(1)).withColumn("pieces", F.lit(2))))
    assert back.first()["safe"] == 1 and back.first()["pieces"] == 2 and back.first()["turns_back"][0]["text"] == "h"
    flat = spark.createDataFrame([([("user", "long " * 50000), ("assistant", "a")], "unrelated")] * 2, "messages array<struct<role:string,content:string>>, prompt string")
    done = chat.read_chat(chat.format_chat(chat.canonical_turns(flat))).collect()
    assert len(done) == 2 and all(r["loss_text"] == "a" and r["turns_back"][0]["text"] == "long " * 50000 for r in done)
    assert chat.read_chat(chat.format_chat(chat.canonical_turns(flat.limit(0)))).count() == 0


def test_measured_sizes(spark):
    rows = spark.createDataFrame([("x" * 1000, [1] * 500, [("a" * 300, 1)])] * 10, "s string, a array<long>, t array<struct<u:string,v:int>>")
    assert 10 * (1000 + 4000 + 300) <= scratch.measured_bytes(rows) <= 2 * 10 * (1000 + 4000 + 300)
    assert scratch.measured_bytes(rows.limit(0)) == 0 and scratch.fits(rows, 10**6) and not scratch.fits(rows, 1000)


def test_scratch_tables_go(spark):
    table = scratch.stored(spark.range(5), "five")
    path = table.inputFiles()[0]
    scratch.discard(spark, table)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A corpus with toxic documents, near copies, passages, nulls, empty texts, repeated rows and clashing columns."""
    folder = tmp_path_factory.mktemp("planted")
    rng = random.Random(4)
    vocabulary = "wasser brot haus wind regen feld baum stein water bread house rain field tree stone agua pan casa viento maison vent pluie champ".split()
    plain = lambda n=40: " ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(n))
    rows, labels, kinds = [], [], {}

    def add(text, kind, label=None):
        rows.append((len(rows), text, f"s{len(rows) % 4}", 1, 2, "k"))
        kinds[len(rows) - 1] = kind
        if label is not None:
            labels.append((len(rows) - 1, label))

    for _ in range(200):
        add(plain(), "clean", 0)
    for beginning in ("garst", "vilo", "merdu", "stolt"):
        for _ in range(24):
            add(plain(30) + " " + " ".join(beginning + rng.choice("abcdefghik") + rng.choice("lmnop") for _ in range(6)), "toxic", 1)
    for _ in range(5):
        add("you stupid idiot, worthless scum and pathetic loser " + plain(20), "toxic")
    for k in range(6):
        words = rows[k][1].split()
        words[k % 4] = "changed"  # at most four of the shingles
        add(" ".join(words), "copy")
        add(rows[k][1], "copy")
    item = " ".join(plain(20).split())
    for _ in range(5):
        add(plain(20) + " " + item + " " + plain(10), "passage")
    for t in (None, "", "  ", "one"):
        add(t, "clean")
    schema = "doc_id long, text string, source string, _id int, bad_key int, row string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, plain(30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), kinds


def test_pipeline_stages_keep_and_drop_what_they_should(spark, planted):
    import corpus_pipeline

    folder, kinds = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left, columns = set(kinds), docs.columns
    for (name, stage), goes in zip(corpus_pipeline.STAGES[:3], ("toxic", "copy", "passage")):
        docs = scratch.stored(stage(spark, docs, folder), name)
        left -= {k for k in left if kinds[k] == goes}
        assert docs.columns == columns and {r["doc_id"] for r in docs.select("doc_id").collect()} == left, name
    mixed = scratch.stored(corpus_pipeline.STAGES[3][1](spark, docs, folder), "mixed")
    assert mixed.columns == columns and {r["doc_id"] for r in mixed.select("doc_id").distinct().collect()} <= left
    tokens = corpus_pipeline.STAGES[4][1](spark, mixed, folder)
    assert Counter(r["doc_id"] for r in tokens.collect()) == Counter(r["doc_id"] for r in mixed.select("doc_id").collect())


def test_pipeline_of_an_empty_table(spark, planted, tmp_path):
    import corpus_pipeline

    folder, _ = planted
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
