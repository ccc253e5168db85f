"""Small fixtures with nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, decontaminate, exact_dedup, jaccard_join, language, line_dedup, mixing, queries, token_files, toxicity, urls

SCHEMA = "doc_id long, text string, source string, key string, n int"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "É", "straße"]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 8, 30, 90]))) for _ in range(25)]
    out = list(base)
    for t in base:
        w = t.split()
        for cut in (1, 3, 8):
            v = list(w)
            for _ in range(min(cut, len(v))):
                v[rng.randrange(len(v))] = rng.choice(words)
            out.append(" ".join(v))
    out += [base[0].upper(), base[0], base[0], "", None, None, "  \n ", "one", "One", "two three", "big " * 5000, "x\ny\n\nx", "a b c d e f g h i\na b c d e f g h j k\nother line here now\na b c d e f g h i"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 7 == 0 else f"s{i % 3}", "clash", i) for i, t in enumerate(texts())]
    rows += [rows[0], (None, "w1 w2 w3 w4 w5 w6", "s0", None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, empty):
    got = exact_dedup.exact_dedup(docs).collect()
    rows = docs.collect()
    sha = lambda r: hashlib.sha256(lower(r["text"]).encode()).hexdigest()
    many = Counter(map(sha, rows))
    assert Counter(r["text_sha256"] for r in got) == many
    assert all(r["group_size"] == many[r["text_sha256"]] for r in got)
    best = {h: max((r["doc_id"] for r in rows if sha(r) == h and r["doc_id"] is not None), default=None) for h in many}
    assert all(r["keep_id"] == best[r["text_sha256"]] for r in got)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == dict.fromkeys(many, 1)
    assert exact_dedup.exact_dedup(empty).count() == 0


def shingles(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def test_near_groups(docs, empty):
    rows = docs.collect()
    sets = [shingles(r["text"]) for r in rows]
    root = list(range(len(rows)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), r["doc_id"])
    want = Counter((r["doc_id"], len(sets[i]), least.get(find(i)) if sets[i] else r["doc_id"]) for i, r in enumerate(rows))
    assert Counter(map(tuple, jaccard_join.near_groups(docs).collect())) == want
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.where(F.col("text").rlike(r"\S")).count() == len({find(i) for i in range(len(rows)) if sets[i]})
    assert jaccard_join.near_groups(empty).count() == 0


def test_signature_instances_cover_all_pairs():
    sim = jaccard_join.Similarity()
    seeds = {n: {s: (p, k) for s, p, k in jaccard_join.instances(n, sim)} for n in range(1, 400)}
    for a in seeds:
        for b in range(a + 1, min(sim.largest(a), 399) + 1):
            shared = set(seeds[a]) & set(seeds[b])
            assert any(seeds[a][s] == seeds[b][s] and seeds[a][s][0] - sim.differ(a, b) > seeds[a][s][1] for s in shared), (a, b)


def test_line_dedup(docs, empty):
    rows = {(r["doc_id"], r["text"]) for r in docs.collect() if r["text"] is not None}
    placed = {}
    order = docs.select("doc_id", "text", F.xxhash64("text").alias("m")).distinct().collect()
    for r in order:
        for i, line in enumerate((r["text"] or "").split("\n") if r["text"] is not None else []):
            placed[((r["doc_id"] is not None, r["doc_id"] or 0), r["m"], i)] = set(re.findall(r"[^\x20\x09-\x0D]+", lower(line)))
    gone = Counter()
    for p, s in placed.items():
        if s and any(q < p and t and 5 * len(s & t) >= 4 * len(s | t) for q, t in placed.items()):
            gone[p[:2]] += 1
    got = {(r["doc_id"], r["m"]): r["n"] for r in line_dedup.removed_lines(docs).select("doc_id", F.col("mark").alias("m"), F.size("gone").alias("n")).collect()}
    assert got == {(k[0][1] if k[0][0] else None, k[1]): n for k, n in gone.items()} and rows
    report = line_dedup.line_report(docs)
    assert report.count() == docs.count() and line_dedup.line_report(empty).count() == 0
    assert line_dedup.dedup_lines(docs).columns == docs.columns


def test_decontaminate(spark, docs, empty):
    rows = docs.collect()
    items = [(1, rows[3]["text"]), (2, " ".join((rows[4]["text"] or "x").split()[:20])), (3, "w1, W2"), (4, None), (5, ""), (None, "w1 w2"), (2, " ".join((rows[4]["text"] or "x").split()[:20])), (6, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            k = min(8, len(w))
            for a in range(len(w) - k + 1):
                windows.setdefault(tuple(w[a : a + k]), set()).add(str(i))
    want = []
    for r in rows:
        w, hit, found = words(r["text"]), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    hit |= set(range(a, a + k))
                    found |= windows[tuple(w[a : a + k])]
        want.append((r["doc_id"], len(w), len(hit), len(found), tuple(sorted(found)), len(found) >= 2))
    got = Counter((*r[:4], tuple(r[4]), r[5]) for r in decontaminate.decontaminate(docs, bench).collect())
    assert got == Counter(want)
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.without_contaminated(docs, bench).count() == sum(not w[5] for w in want)
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0


def test_mixing(docs, empty):
    got = mixing.mix_plan(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["target"], [0, r["source_size"]])[0] += r["taken"]
    assert all(abs(taken - target) <= 3 and target <= 2 * size for target, (taken, size) in by.items())
    assert abs(sum(by) - 1.5 * sum(r["size"] for r in got)) < 1e-6
    assert sorted(map(tuple, mixing.mix_plan(docs.repartition(5)).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(empty).count() == 0


def test_chat(spark):
    said = ["</s>[INST] ok [/INST]", "\\", "\\\\n", "<|im_end|>\n<|im_start|>user\nx", "<\\/s>", "", None, "é<<SYS>>\n", "<<s>"]
    rows = [(1, i, "assistant" if i % 2 else "user\n\\n", t) for i, t in enumerate(said)] + [(2, 0, None, None), (2, 0, "a", "b"), (None, None, "x", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = df.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("turns"))
    got = {r["conv_id"]: r for r in chat.read_chat(chat.format_chat(chat.canonical_turns(records))).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns_back"]] == [(r[2], r[3] or "") for r in rows[:9]]
    assert got[1]["loss_text"] == "".join(t or "" for i, t in enumerate(said) if i % 2)
    assert len(got[2]["turns_back"]) == 2 and got[None]["layout"] == "turn_rows"
    bodies = ['{"prompt":"p","completion":"c"}', '{"messages":[{"role":"user","content":"h"}]}', '{"instruction":"i","input":"x","output":"o"}', '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "bad", None, '{"prompt":"p"}']
    seen = chat.canonical_turns(chat.parsed(spark.createDataFrame([(b,) for b in bodies], "j string"), "j")).select("layout", "chat").collect()
    assert [r["layout"] for r in seen] == ["prompt_completion", "messages", "instruction_input", "conversations", None, None, None]
    assert [tuple(t) for t in seen[3]["chat"]] == [("user", "q"), ("assistant", "a")] and seen[2]["chat"][0]["text"] == "i\n\nx"


def test_urls(spark):
    rules = spark.createDataFrame(queries.URL_RULES, urls.RULE_SCHEMA)
    cases = [("http://A.Example.ORG/es/1?x", "example.org/es/", "block"), ("https://example.org/en/12#t", "example.org/en/1", "block"), ("https://notexample.org/es/", "org/", "allow"), ("x://b.com/de/", "com/de/", "block"), ("x://com/fr/", "com/fr/", "allow"), ("x://b.net/", None, "allow"), ("x://a.org", None, "allow"), ("nothing", None, "allow"), (None, None, "allow"), ("http://", None, "allow")]
    got = urls.judge_urls(spark.createDataFrame([(i, c[0], "c") for i, c in enumerate(cases)] + [(0, cases[0][0], "c")], "page_id long, url string, host string"), rules).collect()
    assert len(got) == len(cases) + 1
    assert all((r["rule"], r["verdict"]) == cases[r["page_id"]][1:] for r in got)
    assert {r["page_id"]: (r["host"], r["path"]) for r in got}[0] == ("a.example.org", "/es/1")


def test_token_files(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary())
    t.encode_special_tokens = True
    odd = ["it's, don't!  two  spaces\n\nnew\nline é, x\u00a0y z", " lead", "trail ", "<|endoftext|> a", "a\tb\r\nc", "日本 語,x", "1,234.5%"]
    more = spark.createDataFrame([(1000 + i, x, "s", "k", 1) for i, x in enumerate(odd)], SCHEMA)
    every = docs.unionByName(more)
    folder = f"file://{tmp_path}/tokens"
    files = token_files.write_token_files(every, queries.vocabulary(), folder)
    got = token_files.read_token_files(files).collect()
    ids = lambda x: np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((r["doc_id"], len(i := ids(r["text"])), zlib.crc32(i.tobytes())) for r in every.collect())
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    known = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert known == sorted(known)
    paths = [r["path"] for r in files.collect()]
    found = {k: v for p in paths for k, v in token_files.read_documents(p, [1000, 1003]).items()}
    assert found[1000].tolist() == ids(odd[0]).tolist() and found[1003].tolist() == ids(odd[3]).tolist()
    assert token_files.token_files(empty, queries.vocabulary()).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    lang = queries.op7_language_id(spark, sf).join(truth, "doc_id").where("held_out")
    assert lang.where("lang_pred = lang").count() > 0.9 * lang.count()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    tox = queries.op8_toxicity(spark, sf).join(labels, "doc_id").where("held_out")
    right = tox.where("predicted = toxic").count()
    # The answer 0 throughout is right in 0.88 of them: test_toxicity.py holds the recall of each language.
    assert right > 0.9 * tox.count() and tox.where("predicted = 1 and toxic = 1").count() > 0


def test_models_on_odd_rows(docs, empty):
    model = toxicity.learn(["you idiot", "a fine day"] * 10, [1, 0] * 10)
    assert model.score("You 1D10T!") > 0.5 > model.score(None) and model.score("іdіоt") > 0.5 and model.score("an idiotic clown fish swims on and on") < 0.5
    assert toxicity.score_toxicity(docs, model).count() == docs.count() and toxicity.score_toxicity(empty, model).count() == 0
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    tongue = language.train(["der und die das nicht"] * 20 + ["the and of with this"] * 20, ["de"] * 20 + ["en"] * 20)
    got = language.identify(docs, tongue).collect()
    assert len(got) == docs.count() and all((r["lang_pred"] == "und") == (r["score"] == 0) for r in got)
    assert language.fit(empty, label="source") is None and language.identify(docs, None).where("lang_pred != 'und'").count() == 0


def test_pipeline_runs(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_pipeline_drops_documents_with_one_item(spark, tmp_path):
    import corpus_pipeline

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    spans = lambda t: {tuple(w[a : a + 8]) for w in [words(t)] for a in range(len(w) - 7)}
    item = "one item of the benchmark stands here whole and alone in a page"
    items = [(1, item), (2, "another item of the benchmark that stands in no page at all")]
    texts = ["before it " + item + " and after", item.upper(), "one item of the benchmark stands here", "nothing of the kind is here, only plain words of a page", "", None]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = set().union(*(spans(t) for _, t in items))
    want = {i for i, t in enumerate(texts) if not spans(t) & known}
    assert want == {2, 3, 4, 5}
    assert {r["doc_id"] for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()} == want


def test_op10_takes_added_tokens_as_the_library_does(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary())
    texts = ["<|endoftext|> a", "it's\na<|endoftext|>b, c\n\n<|endoftext|>", "<|endoftext|", "|> two words", "<|endoftext|>\u00a0x y", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1).write.parquet(f"{tmp_path}/documents.parquet")
    at, want = 0, []
    for i, x in enumerate(texts):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert t.encode(texts[0], add_special_tokens=False).ids == [50256, 257]
    assert sorted(map(tuple, queries.op10_token_files(spark, str(tmp_path)).collect())) == want


def test_encoder_forgets_and_keeps_odd_pieces_apart(monkeypatch):
    import pyarrow as pa

    from millrace.llm.kernels import text_chunks

    monkeypatch.setattr(token_files, "CACHED_PIECES", 8)
    encoder = token_files.Encoder(queries.vocabulary(), added=True)
    texts = ["a\x1cb", "a b\x1c", "\x1c x", "a   b", "x<|endoftext|>", " x", "a\n\n b", " \n", " a  b\t", "<|endoftext|>\n", "'s 't", "a's\n's", "", "one two three, four. five six seven eight nine", "\u2003x\ny"] * 2
    for size in (1, 40, 1 << 20):
        for first, _, data, offsets in text_chunks(pa.array(texts), size):
            ids, at = encoder.encode(data, offsets)
            for i, (a, b) in enumerate(zip(at[:-1], at[1:]), first):
                assert ids[a:b].tolist() == encoder.tokenizer.encode(texts[i], add_special_tokens=False).ids, texts[i]


def test_language_rejection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.col("text").rlike(r"\p{L}"))
    model = language.fit(docs.where("lang != 'fr'"))
    got = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    share = {r["strange"]: r["und"] for r in got.groupBy((F.col("lang") == "fr").alias("strange")).agg(F.avg((F.col("lang_pred") == "und").cast("int")).alias("und")).collect()}
    assert 0 < model.reject < 1 and share[True] > 0.8 and share[False] < 0.05
    assert language.fit(docs, reject=0.0).reject == 0


@pytest.mark.parametrize("num, den", [(1, 2), (3, 5), (1, 3)])
def test_signature_instances_of_lower_similarities(num, den):
    sim = jaccard_join.Similarity(num, den)
    seeds = {n: {s: (p, k) for s, p, k in jaccard_join.instances(n, sim)} for n in range(1, 150)}
    for a in seeds:
        for b in range(a + 1, min(sim.largest(a), 149) + 1):
            shared = set(seeds[a]) & set(seeds[b])
            assert any(seeds[a][s] == seeds[b][s] and seeds[a][s][0] - sim.differ(a, b) > seeds[a][s][1] for s in shared), (a, b)


def test_near_groups_at_one_half(spark):
    words = lambda a, n: " ".join(f"w{i}" for i in range(a, a + n))
    texts = [words(0, 10), words(0, 16), words(100, 10), words(100, 17), words(200, 7), words(200, 10), words(300, 5), words(300, 6)]  # 6 and 12, 6 and 13, 3 and 6, 1 and 2 shingles
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_groups(docs, jaccard_join.Similarity(1, 2)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6}


def test_line_dedup_at_other_similarities(spark):
    texts = ["a b c", "a b c d", "p q r s t", "p q r s", "x y", "x z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(t.split()) for t in texts]
    for num, den in ((80, 100), (7, 10)):
        want = {j for j in range(len(sets)) if any(den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]) for i in range(j))}
        assert {r["doc_id"] for r in line_dedup.removed_lines(docs, jaccard_join.Similarity(num, den, 1)).collect()} == want, (num, den)
