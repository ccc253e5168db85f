import json

from pyspark.sql import functions as F

from millrace.functions import scores, templates, wikitext
from millrace.functions import text as X


def one(spark, column, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(column.alias("x")).first()["x"]


def test_normalisation(spark):
    n = X.norm_text(F.col("c0"))
    for given, want in [(None, ""), (" a\r\n b\tc ", "a b c"), ("﻿x", "x"), ("x　y", "x y"), ("x y", "x y"), ("x y", "x y"), ("x​y", "x​y"), ("x\x1cy", "x y")]:
        assert one(spark, n, given) == want
    for given in ("<NoInput>", "None", "N/A", "null", " <no input> "):
        assert one(spark, X.norm_input(F.col("c0")), given) == ""
    assert one(spark, X.norm_input(F.col("c0")), "keep None") == "keep None"


def test_drop_reasons(spark):
    cases = [
        ("Question", "anything long enough", "header"), ("你好嗎呀", "Answer", "header"), ("你好嗎", "x" * 8, "inst_short"), ("你好嗎呀", "x" * 8, None),
        ("你" * 2001, "x" * 9, "inst_long"), ("你好嗎呀", "x" * 7, "out_short"), ("你好嗎呀", "x" * 8001, "out_long"), ("你好嗎呀你好嗎呀", "你好嗎呀你好嗎呀", "identity"),
        ("hello world", "plain ascii reply", "no_cjk"), ("abc", "x" * 7, "inst_short"), ("abcd\U00020000", "plain ascii", "no_cjk"),
    ]
    for ask, reply, want in cases:
        assert one(spark, X.drop_reason(F.col("c0"), F.col("c1")), ask, reply) == want


def test_record_id_and_chatml(spark):
    import hashlib

    assert one(spark, X.record_id(F.col("c0"), F.col("c1"), F.col("c2")), "問", "", "答") == hashlib.sha1("問\n\n答".encode()).hexdigest()[:16]
    text = one(spark, templates.chatml(F.col("c0"), F.col("c1"), F.col("c2")), "問", "入", "答")
    assert text == f"<|im_start|>system\n{templates.SYSTEM}<|im_end|>\n<|im_start|>user\n問\n\n入<|im_end|>\n<|im_start|>assistant\n答<|im_end|>"


def test_flags(spark):
    flag = X.unsolicited_translation(F.col("c0"), F.col("c1"))
    for prompt, reply, want in [("请将以下内容翻译成粤语：x", "x" * 20, False), ("x" * 10, "y" * 7, False), ("x" * 10, "y" * 8, True), ("x" * 10, "y" * 50, True), ("x" * 10, "y" * 51, False), ("x" * 100, "y" * 119, True), ("x" * 100, "y" * 120, False)]:
        assert one(spark, flag, prompt, reply) is want


def test_sizes_and_urls(spark):
    for n, want in [(1023, "1023B"), (1024, "1.0KB"), (1280, "1.2KB"), (2304, "2.2KB"), (1 << 20, "1.0MB"), (1 << 30, "1.00GB")]:
        assert one(spark, X.human_size(F.col("c0").cast("long")), str(n)) == want
    assert one(spark, X.quoted(F.col("c0")), "a b+c/d~e*f中") == "a%20b%2Bc/d~e%2Af%E4%B8%AD"
    assert one(spark, X.completion(F.col("c0")), "user\nx<|im_end|>\nassistant\n 好 <|im_end|>") == "好"


def test_wikitext(spark):
    for given, want in [
        ("{{ProperNoun|廬陵|歐陽脩}}", "歐陽脩"), ("{{ProperNoun|滁}}", "滁"), ("{{另|讓|釀}}", "釀"), ("{{宋代人物}}", ""), ("{{gap}}", ""),
        ("{{small|{{ProperNoun|a|b}}}}", "b"), ("{{lang|en|x}}", "en"), ("{{foo|1|2}}", "2"), ("{{foo}}", ""), ("[[A|B]] [[C]]", "B C"), ("[[Category:X]]y", "y"),
        ("'''b''' ''i''", "b i"), ("a\n\n\n\nb", "a\nb"), ("a<ref>n</ref>b{{reflist}}", "a[1]b[1] n"), (None, ""), ("a\n  b", "a\nb"), ("<onlyinclude>x</onlyinclude>", "x"),
    ]:
        assert one(spark, wikitext.plain_text(F.col("c0"), 3), given) == want, given
    assert one(spark, wikitext.plain_text(F.col("c0"), 3), 'A<ref name="x"/>keep<ref>y</ref>B') == "A[1]B"
    assert one(spark, wikitext.plain_text(F.col("c0"), 3, True), 'A<ref name="x"/>keep<ref>y</ref>B') == "Akeep[1]B"


def test_bleu():
    assert abs(scores.sentence_bleu("abcdef", "abcdef") - 1) < 1e-12
    assert scores.sentence_bleu("abc", "") == 0 == scores.sentence_bleu("abc", "xyz")
    assert 0 < scores.sentence_bleu("abcdef", "abcxef") < 1
