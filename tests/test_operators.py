import json

from pyspark.sql import functions as F

from millrace.functions import templates
from millrace.operators import pairs, select
from millrace.plans import compare, downloads, registry, sft
from millrace.sources import files, wikidump

DATA = "/root/testdata/sf0.001"


def test_split_sizes(spark):
    want = {1: (1, 0), 2: (1, 0), 3: (1, 1), 39: (1, 1), 40: (2, 2), 49: (2, 2), 50: (1, 1), 100: (2, 2), 405: (8, 8), 1568: (31, 31)}
    t, v = select.split_sizes(F.col("n"), 0.02, 0.02)
    got = {r["n"]: (r["t"], r["v"]) for r in spark.createDataFrame([(n,) for n in want], "n long").select("n", t.alias("t"), v.alias("v")).collect()}
    assert got == want


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("s"))
    a, b = (sorted(map(tuple, select.stratified_split(df.repartition(n), "s", "k", 42).collect())) for n in (1, 7))
    assert a == b and len(a) == 500


def test_prepare(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    for name in ("yue-alpaca", "Cantonese-Dialogue", "Cantonese_AllAspectQA_11K", "cantonesewiki_doyouknow"):
        (raw / name).mkdir(parents=True)
    rows = [{"instruction": f"問題{i}係咩嚟㗎", "input": "None", "output": f"答案係第{i}個，好長嘅回覆"} for i in range(60)]
    (raw / "yue-alpaca/train.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n\n")
    (raw / "Cantonese-Dialogue/train.json").write_text(json.dumps(rows[:5] + [{"instruction": "短", "input": "", "output": "x"}], ensure_ascii=False))
    (raw / "Cantonese_AllAspectQA_11K/cantonese_allaspectqa_11k.json").write_text(json.dumps([{"Question": "Question", "Response": "Response"}]))
    (raw / "cantonesewiki_doyouknow/cantonesewiki_doyouknow.csv").write_text('Prompt,FormattedResponse,RawResponse\n"你知唔知""呢個""",,"多行\n回覆內容好長呀"\n')
    stats = sft.prepare(spark, str(raw), str(out), translate=str(raw / "yue-alpaca/train.jsonl"))
    assert stats["sources"]["cantonese-dialogue"] == {"raw": 6, "duplicate": 5, "inst_short": 1}
    assert stats["sources"]["allaspect-qa"] == {"raw": 1, "header": 1}
    assert stats["splits"] == {"train": 58, "val": 1, "test": 2, "all": 61, "mix_train": 118, "translate_in_mix": 60}
    assert stats["sources"]["yue-harmful"] == {}
    assert stats["filters"] == {"min_instruction": 4, "max_instruction": 2000, "min_output": 8, "max_output": 8000, "require_cjk": True, "dedup": "sha1(instruction+input+output)"}
    mix = spark.read.json(f"{out}/mix_train")
    assert mix.count() == 118 and mix.where("source = 'translate-sample' and task = 'translate'").count() == 60


def test_sources(spark, tmp_path):
    (tmp_path / "SHA256SUMS").write_text("# c\n\nabc  *a b.xml\ndef  c.xml\n")
    assert {tuple(r) for r in files.manifest(spark, str(tmp_path / "SHA256SUMS")).collect()} == {("abc", "a b.xml"), ("def", "c.xml")}
    (tmp_path / "bad.jsonl").write_text('{"instruction": "a", "input": "b", "output": "c"}\n{bad\n')
    assert [r["bad_line"] is None for r in files.json_lines_tolerant(spark, str(tmp_path / "bad.jsonl")).collect()] == [True, False]
    assert spark.createDataFrame([('href="2024-01-02/" href="2024-03-01/"',)], "h string").select(files.listed_dates(F.col("h")).alias("d")).first()["d"] == ["2024-03-01", "2024-01-02"]
    page = "<mediawiki xmlns='http://x'><page><title>甲 乙</title><ns>0</ns><id>1</id><revision><id>1</id><text>old</text></revision><revision><id>2</id><text bytes='3'>'''new''' </text></revision></page><page><title>r</title><ns>0</ns><id>2</id><redirect title='x'/><revision><text>y</text></revision></page></mediawiki>"
    (tmp_path / "zhwikisource-latest.xml").write_text(page)
    got = wikidump.pages(spark, str(tmp_path / "zhwikisource-latest.xml"))
    assert [tuple(r) for r in got.select("id", "raw_content", "language", "project").collect()] == [("1", "'''new''' ", "zh", "wikisource")]
    clean = wikidump.cleaned(got, "240101", 3).first()
    assert clean["text"] == "甲 乙\nnew" and json.loads(json.loads(clean["meta"])["extra"])["id"] == "1"


def test_downloads(spark):
    plan = downloads.tasks(spark, {"wikisource": ["zh", "en"], "wikiquote": ["de"]}, only=["wikisource"])
    assert plan.count() == 2 and downloads.tasks(spark, {"a": ["x"], "b": ["y"]}, langs=["p", "q"]).count() == 4
    have = spark.createDataFrame([("wikisource/zhwikisource-latest-pages-articles.xml.bz2", 5), ("wikisource/enwikisource-latest-pages-articles.xml.bz2", 0)], "path string, size long")
    assert [r["lang"] for r in downloads.outstanding(plan, have).collect()] == ["en"]


def test_comparison(spark):
    rows = spark.createDataFrame([("1", "qa", "s", "問題", "", "答")], "id string, task string, source string, instruction string, input string, output string")
    chosen = compare.evaluation_set(spark, rows, [("qa", "s", 3)])
    assert chosen.count() == 7

    def echo(model, prompt):
        if model == "old":
            raise ValueError("no")
        return prompt

    met = compare.compared(chosen, compare.generate(chosen, ["base", "old"], echo), ["base", "old"])
    assert met.where("old = '[ERROR] no'").count() == 7 and met.where("asked_translate").count() == 2
    assert "probe-chat" in compare.report(met, ["base", "old"])


def test_pairs(spark):
    df = spark.createDataFrame([(i, " 粵 ", "国") for i in range(300)] + [(999, "", "x")], "k long, a string, b string")
    n = pairs.mirrored(df, "a", "b", "k").count()
    assert 360 < n < 440


def test_queries_run(spark):
    for name in ("sft_prep", "drop_reasons", "stratified_split", "wiki_plain_text", "char_bleu", "mirror_pairs", "evaluation_set", "validation_sets", "reason_maps"):
        assert registry.queries()[name](spark, DATA).count() > 0
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert templates.SYSTEM


def test_wiki_plain_text_of_deep_templates(spark, tmp_path):
    nested = lambda depth: "{{small|" * depth + "x" + "}}" * depth
    pages = [(d, f"a {nested(d)} b<ref>{nested(d)}</ref>{{{{reflist}}}}") for d in (1, 5, 20)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.queries()["wiki_plain_text"](spark, str(tmp_path)).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict.fromkeys((1, 5, 20), "a x b[1][1] x")


def test_checksums_of_missing_files(spark):
    listed = spark.createDataFrame([("a", "AA"), ("b", "bb"), ("c", "cc"), ("1", "11")], "name string, sha256 string")
    there = spark.createDataFrame([("a", "aa", 5), ("b", "xx", 6), ("1", "11", 7), ("d", "dd", 8)], "name string, found string, size long")
    got = {r["name"]: (r["status"], r["size"]) for r in downloads.verified(listed, there).collect()}
    assert got == {"a": ("ok", 5), "b": ("mismatch", 6), "c": ("missing", 0), "1": ("ok", 7)}
