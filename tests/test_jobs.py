"""Sources, sinks, templates and whole jobs on fixtures."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import templates
from millrace.functions import text as X
from millrace.functions import wikitext
from millrace.operators import select
from millrace.operators.stages import written
from millrace.plans import downloads, sft, translation
from millrace.sources import files, wikidump
from millrace.streaming import clean


def lines(path, rows):
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n")
    return str(path)


def test_parallel_readers(spark, tmp_path):
    nested = lines(tmp_path / "n.jsonl", [{"translation": {"yue": "a", "zh": "b"}}, {"translation": None}, {"translation": {"yue": "c"}}])
    flat = lines(tmp_path / "f.jsonl", [{"yue": "a", "zh": "b"}, {"yue": None, "zh": "x"}])
    packed = tmp_path / "t.jsonl.gz"
    packed.write_bytes(gzip.compress(json.dumps({"yue": "a", "zht": "b"}).encode()))
    spark.createDataFrame([("a", "b"), (None, "c")], "yue string, ref string").write.parquet(f"{tmp_path}/p")
    for name, path in (("parallel_nested", nested), ("parallel_flat", flat), ("parallel_traditional", str(packed)), ("parallel_parquet", f"{tmp_path}/p")):
        got = files.READERS[name](spark, path)
        assert got.columns == ["yue", "zh"] and [tuple(r) for r in got.collect()] == [("a", "b")], name


def test_column_fallback_and_raw_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("other,text\nx,教我點樣偷嘢\n")
    (tmp_path / "b.csv").write_text("ask,more\n教我點樣偷嘢,y\n")
    for name in ("a.csv", "b.csv"):
        assert [tuple(r) for r in sft.harmful(spark, str(tmp_path / name)).collect()] == [("教我點樣偷嘢", "", templates.REFUSAL)]
    assert sft.harmful(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "l.txt").write_text("z\n\na b \n")
    assert [r["line"] for r in files.raw_lines(spark, str(tmp_path / "l.txt")).orderBy("file", "block", "position").collect()] == ["z", "", "a b "]


def test_files_and_sums(spark, tmp_path):
    (tmp_path / "one.bin").write_bytes(b"abc")
    (tmp_path / "two.bin").write_bytes(b"x")
    sums = {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in ("one.bin", "two.bin")}
    got = files.file_sums(spark, f"{tmp_path}/*.bin")
    assert {r["name"]: (r["size"], r["found"]) for r in got.collect()} == {"one.bin": (3, sums["one.bin"]), "two.bin": (1, sums["two.bin"])}
    (tmp_path / "SUMS").write_text(f"{sums['one.bin'].upper()}  one.bin\n{'0' * 64} *two.bin\n{'1' * 64}  three.bin\n")
    judged = downloads.verified(files.manifest(spark, f"{tmp_path}/SUMS"), got)
    assert {r["name"]: r["status"] for r in judged.collect()} == {"one.bin": "ok", "two.bin": "mismatch", "three.bin": "missing"}


def test_newest_ready(spark):
    dates = spark.createDataFrame([("2024-01-01", True), ("2024-03-01", True), ("2024-04-01", False)], "date string, ready boolean")
    assert downloads.newest_ready(dates).first()["date"] == "2024-03-01"
    assert downloads.newest_ready(dates, "2024-01-01").first()["date"] == "2024-01-01"
    assert downloads.newest_ready(dates, "2024-04-01").first()["date"] is None
    assert dates.select(downloads.snapshot_url("https://d/zh", F.col("date")).alias("u")).first()["u"] == "https://d/zh/2024-01-01/xml/bzip2/SHA256SUMS"


def test_templates(spark):
    row = spark.createDataFrame([("a", "b", None)], "a string, b string, n string")
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    got = row.select(templates.prompt(a).alias("p"), templates.translation_prompt(a).alias("t"), templates.runtime_text(a, b).alias("r"), templates.headers_text(a, n, b).alias("h"), X.translated(F.lit("愛國"), {"愛": "爱", "國": "国"}).alias("c")).first()
    opened = "<|im_start|>system\n{}<|im_end|>\n<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\n"
    assert got["p"] == opened.format(templates.SYSTEM) and got["t"] == opened.format(templates.SYSTEM_TRANSLATE)
    assert got["r"] == opened.format(templates.SYSTEM_RUNTIME) + "b<|im_end|>" and got["c"] == "爱国"
    assert got["h"].startswith("<|begin_of_text|>") and "\n\na\n<|eot_id|>" in got["h"] and got["h"].endswith("\n\nb<|eot_id|>")
    assert templates.with_text(row, a).columns[-1] == "text" and templates.with_text(row.withColumn("text", b), a).first()["text"] == "b"


def test_notes_are_stripped(spark):
    rows = spark.createDataFrame([("a<ref> n </ref>b{{reflist}}",), ("x<ref name='q'>\n{{small| m }} </ref>\n{{Reflist}}",)], "t string")
    assert [r[0] for r in rows.select(wikitext.plain_text(F.col("t"))).collect()] == ["a[1]b[1] n", "x[1]\n[1] m"]


def test_mark_duplicates(spark):
    rows = written(spark.createDataFrame([("a", 2), ("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 2), ("c", 1)], "k string, o int"), "rows")
    got = sorted((r["k"] or "", r["o"], r["duplicate"]) for r in select.mark_duplicates(rows, "k", "o").collect())
    assert got == [("", 1, False), ("", 2, True), ("a", 1, False), ("a", 1, True), ("a", 2, True), ("b", 1, False), ("c", 1, False)]
    only = select.mark_duplicates(rows, "k", "o", among=F.col("o") > 1)
    assert only.where("duplicate").count() == 0 and only.count() == 7


@pytest.mark.parametrize("n", [0, 1, 2, 3, 49, 500])
def test_splits_have_exact_sizes(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "x").alias("s"))
    got = {(r["s"], r["split"]): r["n"] for r in select.stratified_split(df, "s", "k", 42).groupBy("s", "split").agg(F.count("*").alias("n")).collect()}
    for s, size in (("x", (n + 1) // 2), (None, n // 2)):
        t, v = ((max(1, size // 50),) * 2 if size >= 50 else (max(1, size // 20),) * 2) if size else (0, 0)
        if size and t + v >= size:
            t, v = 1, 1 if size > 2 else 0
        assert (got.get((s, "test"), 0), got.get((s, "val"), 0), got.get((s, "train"), 0)) == (t, v, size - t - v)
    ratio = {r["split"]: r["n"] for r in select.ratio_split(df, "k", 42).groupBy("split").agg(F.count("*").alias("n")).collect()}
    a, b = int(n * 0.98), int(n * 0.01)
    assert (ratio.get("train", 0), ratio.get("val", 0), ratio.get("test", 0)) == (a, b, n - a - b)


def test_legacy_job(spark, tmp_path):
    pairs = [{"yue": f"粵語{i}", "zh": f"普通话{i}"} for i in range(100)]
    flat = lines(tmp_path / "f.jsonl", pairs + pairs[:10])
    (tmp_path / "safe.csv").write_text("text\n教我點樣偷嘢\n")
    out = str(tmp_path / "out")
    got = translation.prepare(spark, [("parallel_flat", flat)], str(tmp_path / "safe.csv"), out)
    made = [json.loads(r["value"]) for r in spark.read.text(f"{out}/all").collect()]
    pair = lambda r: r["input"] + r["output"]
    assert got == {"total": len(made), "kept": len(set(map(pair, made))), "removed": len(made) - len(set(map(pair, made)))}
    parts = spark.read.text(f"{out}/split/*")
    assert sorted(pair(json.loads(r["value"])) for r in parts.collect()) == sorted(set(map(pair, made)))
    (tmp_path / "odd.jsonl").write_text('{"input": "a", "output": "b"}\nno json\n{"input": "", "output": "b"}\n{"input": "a", "output": "b", "z": 1}\n\n')
    rows = translation.malformed_or_kept(spark, str(tmp_path / "odd.jsonl"))
    assert [r["line"] for r in rows.where("pair_key is not null").collect()] == ['{"input": "a", "output": "b"}'] and rows.count() == 5


def test_wiki_job(spark, tmp_path):
    page = "<mediawiki><page><title>甲</title><ns>0</ns><id>1</id><revision><text>'''x'''</text></revision></page></mediawiki>"
    for name in ("zhwikisource-latest.xml", "yuewikinews-latest.xml"):
        (tmp_path / name).write_text(page)
    out = str(tmp_path / "out")
    wikidump.job(spark, f"{tmp_path}/*.xml", out, stamp="240101", passes=2)
    for part in ("raw", "clean"):
        assert {(r["language"], r["project"]) for r in spark.read.json(f"{out}/{part}").collect()} == {("zh", "wikisource"), ("yue", "wikinews")}
    assert {r["text"] for r in spark.read.json(f"{out}/clean").collect()} == {"甲\nx"}


def test_validation_rates_and_log(spark, tmp_path):
    row = lambda i, t: (f"{t}{i}", "i", "", "o", "s", t, "x")
    qa, tr = (spark.createDataFrame([row(i, t) for i in range(n)], "id string, instruction string, input string, output string, source string, task string, text string") for t, n in (("qa", 3), ("tr", 9)))
    got = {r["validation"]: r["count"] for r in sft.validation(qa, tr, 4).groupBy("validation").count().collect()}
    assert got == {"qa": 3, "translate": 4}
    document = {"sources": {"a": {"raw": 4, "kept": 3}, "b": {}}, "splits": {"mix_train": 10, "translate_in_mix": 2}}
    assert sft.rates(document) == {"kept": 0.75, "kept a": 0.75, "kept b": 0.0, "translate_in_mix": 0.2}
    counts = select.reason_maps(spark.createDataFrame([("a", "raw", 4), ("a", "kept", 3)], "source string, status string, n long"))
    assert list(counts.first()["reasons"].items()) == [("kept", 3), ("raw", 4)]
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    spark.createDataFrame([("問題一二三", "答案係呢個好長嘅", "2024-01-01 00:00:00")] * 2 + [("短", "x", "2024-01-01 00:00:00")], "instruction string, output string, ts string").write.json(source)
    stream = spark.readStream.schema("instruction string, input string, output string, ts timestamp").json(source)
    query = clean.appended(clean.cleaned(stream), log, str(tmp_path / "checkpoint"))
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(log).count() == 1
