"""Registered queries over the driver's tables, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores, templates, wikitext
from ..functions import text as X
from ..operators import pairs, select
from ..operators.stages import written
from ..sources import files, wikidump
from . import compare, downloads, sft, translation

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The documents have no CJK text, so queries test for letters beyond ASCII.
SCRIPT = "[À-ÿ]"
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
_NORM = lambda c: f"trim(regexp_replace(replace(coalesce({c}, ''), chr(65279), ''), '{_WS}+', ' ', 'g'))"
_STRIP = lambda c: f"regexp_replace(coalesce({c}, ''), '^{_WS}+|{_WS}+$', '', 'g')"
_SYSTEM = templates.SYSTEM
_CHATML = lambda user, reply: f"'<|im_start|>system' || chr(10) || '{_SYSTEM}<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || {user} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || {reply} || '<|im_end|>'"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"SELECT doc_id, {_NORM('text')} AS text, substr(sha1({_NORM('source')} || chr(10) || '' || chr(10) || {_NORM('text')}), 1, 16) AS id FROM documents")
def norm_and_id(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", X.norm_text(F.col("text")).alias("text"), X.norm_text(F.col("source")).alias("s"))
    return d.select("doc_id", "text", X.record_id(F.col("s"), F.lit(""), F.col("text")).alias("id"))


@query(f"SELECT conv_id, turn, {_CHATML('coalesce(role, chr(32))', 'coalesce(text, repeat(chr(32), 0))')} AS rendered FROM conversations")
def chatml_render(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", templates.chatml(F.col("role"), F.lit(""), F.coalesce("text", F.lit(""))).alias("rendered"))


_REASON = f"""CASE WHEN lower(source) IN ('question', 'prompt', 'instruction') THEN 'header' WHEN lower(t) IN ('response', 'output', 'answer') THEN 'header'
  WHEN length(source) < 4 THEN 'inst_short' WHEN length(source) > 2000 THEN 'inst_long' WHEN length(t) < 8 THEN 'out_short' WHEN length(t) > 8000 THEN 'out_long'
  WHEN source = t THEN 'identity' WHEN NOT regexp_matches(source, '{SCRIPT}') AND NOT regexp_matches(t, '{SCRIPT}') THEN 'no_cjk' END"""
_JUDGED = f"""SELECT *, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason IS NULL, id ORDER BY source_rank, doc_id) > 1 THEN 'duplicate' ELSE reason END AS status
  FROM (SELECT *, {_REASON} AS reason, substr(sha1(source || chr(10) || chr(10) || t), 1, 16) AS id
        FROM (SELECT doc_id, source, lang, {_NORM('text')} AS t, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END AS source_rank FROM documents))"""


def _judged(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("source").alias("instruction"), F.lit("").alias("input"), X.norm_text(F.col("text")).alias("output"))
    reason, key = X.drop_reason(F.col("instruction"), F.col("output"), SCRIPT), X.record_id(F.col("instruction"), F.col("input"), F.col("output"))
    rank = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).otherwise(2)
    return sft.with_status(written(d.select("doc_id", "lang", rank.alias("source_rank"), reason.alias("reason"), key.alias("id")), "judged"), "source_rank", "doc_id")


@query(f"SELECT doc_id, id, reason, status FROM ({_JUDGED})")
def drop_reasons(spark, sf_dir):
    return _judged(spark, sf_dir).select("doc_id", "id", "reason", "status")


@query(f"WITH j AS ({_JUDGED}) SELECT lang, coalesce(status, 'kept') AS status, count(*) AS n FROM j GROUP BY ALL UNION ALL SELECT lang, 'raw', count(*) FROM j GROUP BY ALL")
def reason_stats(spark, sf_dir):
    return select.reason_counts(_judged(spark, sf_dir), "lang")


@query("SELECT event_type AS project, grouping(event_type)::TINYINT AS is_total, count(*) AS n, count_if(user_id % 3 = 0) AS success, count_if(user_id % 3 = 1) AS skipped, count_if(user_id % 3 = 2) AS failed, bool_or(user_id % 3 = 2) AS any_failed FROM events GROUP BY ROLLUP (event_type)")
def reason_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("project"), F.when(F.col("user_id") % 3 == 0, "success").when(F.col("user_id") % 3 == 1, "skipped").otherwise("failed").alias("status"))
    return select.status_rollup(e, "project")


@query("SELECT conv_id, turn, text AS instruction, t AS output FROM (SELECT *, lead(role) OVER w AS r, lead(text) OVER w AS t FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND r = 'assistant'")
def qa_pairs(spark, sf_dir):
    return pairs.next_replies(table(spark, sf_dir, "conversations"))


@query("SELECT doc_id, source, md5(text) AS k FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY source, doc_id) = 1")
def priority_dedup(spark, sf_dir):
    return select.first_wins(table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("k")), "k", "source", "doc_id")


@query("SELECT k, count(*) AS n FROM (SELECT md5(text) AS k FROM documents UNION ALL SELECT md5(text) FROM benchmark) GROUP BY k HAVING count(*) > 1")
def dup_counts(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select(F.md5("text").alias("k")).unionByName(table(spark, sf_dir, "benchmark").select(F.md5("text").alias("k")))
    return both.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT doc_id, md5(source || text) AS pair_key FROM documents WHERE coalesce(source, '') != '' AND coalesce(text, '') != '' QUALIFY row_number() OVER (PARTITION BY md5(source || text) ORDER BY doc_id) = 1")
def legacy_dedup(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("input"), F.col("text").alias("output"))
    return translation.deduplicated(d, "doc_id").select("doc_id", "pair_key")


_SPLIT = """SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM documents"""
_SIZES = f"""SELECT *, CASE WHEN n >= 50 THEN greatest(1, floor(n * 0.02::DOUBLE)) ELSE greatest(1, n // 20) END AS t0 FROM ({_SPLIT})"""
_CUTS = f"""SELECT *, CASE WHEN 2 * t0 >= n THEN least(t0, 1) ELSE t0 END AS t, CASE WHEN 2 * t0 >= n THEN least(t0, CASE WHEN n > 2 THEN 1 ELSE 0 END) ELSE t0 END AS v FROM ({_SIZES})"""


@query(f"SELECT doc_id, source, CASE WHEN r <= t THEN 'test' WHEN r <= t + v THEN 'val' ELSE 'train' END AS split FROM ({_CUTS})")
def stratified_split(spark, sf_dir):
    return select.stratified_split(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 42)


@query(f"SELECT source, CASE WHEN r <= t THEN 'test' WHEN r <= t + v THEN 'val' ELSE 'train' END AS split, count(*) AS n FROM ({_CUTS}) GROUP BY ALL")
def split_sizes(spark, sf_dir):
    return stratified_split(spark, sf_dir).groupBy("source", "split").agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE WHEN r <= floor(n * 0.98::DOUBLE) THEN 'train' WHEN r <= floor(n * 0.98::DOUBLE) + floor(n * 0.01::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents)")
def ratio_split(spark, sf_dir):
    return select.ratio_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 42)


_QUOTAS = [("en", "src0", 3), ("fr", "src3", 2), ("de", "src5", 4), ("en", "src1", 5)]


@query(f"SELECT doc_id, lang, source FROM documents JOIN (VALUES {', '.join(map(str, _QUOTAS))}) q(lang, source, quota) USING (lang, source) QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY md5('42:' || doc_id), doc_id) <= any_value(quota) OVER (PARTITION BY lang, source)")
def quota_sample(spark, sf_dir):
    quotas = F.broadcast(spark.createDataFrame(_QUOTAS, "lang string, source string, quota int"))  # a literal list
    return select.quota_sample(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), quotas, ["lang", "source"], "quota", "doc_id", 42)


@query("SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50")
def reservoir_k(spark, sf_dir):
    return select.take_random(table(spark, sf_dir, "documents").select("doc_id", "source"), 50, "doc_id", 42)


@query("SELECT doc_id, lang FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 1000")
def val_take(spark, sf_dir):
    return select.take_random(table(spark, sf_dir, "documents").select("doc_id", "lang"), 1000, "doc_id", 7)


@query("SELECT 'qa' AS kind, doc_id AS key FROM documents UNION ALL (SELECT 'translate', conv_id * 1000 + turn FROM conversations ORDER BY md5('42:' || (conv_id * 1000 + turn)), conv_id * 1000 + turn LIMIT 80)")
def mix_train(spark, sf_dir):
    more = select.take_random(table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("key")), 80, "key", 42)
    return table(spark, sf_dir, "documents").select(F.lit("qa").alias("kind"), F.col("doc_id").alias("key")).unionByName(more.select(F.lit("translate").alias("kind"), "key"))


@query(f"SELECT doc_id, '{templates.REFUSAL}' AS output FROM documents SEMI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)")
def refusal_rows(spark, sf_dir):
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return table(spark, sf_dir, "documents").join(toxic, "doc_id", "left_semi").select("doc_id", F.lit(templates.REFUSAL).alias("output"))


_CHOICE = lambda seed, key, options: f"[{', '.join(repr(o) for o in options)}][('0x' || substr(md5('{seed}:' || {key}), 1, 4))::INT % {len(options)} + 1]"
_PAIR = f"SELECT conv_id * 1000 + turn AS pair_id, {_STRIP('role')} AS a, {_STRIP('text')} AS b FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL"


@query(f"""WITH p AS (SELECT * FROM ({_PAIR}) WHERE a != '' AND b != '')
SELECT pair_id, {_CHOICE(42, 'pair_id', pairs.TO_MANDARIN)} AS instruction, a AS input, b AS output FROM p
UNION ALL SELECT pair_id, {_CHOICE(43, 'pair_id', pairs.TO_CANTONESE)}, b, a FROM p WHERE substr(md5('42:' || pair_id), 1, 4) < '{round(0.33 * 65536):04x}'""")
def mirror_pairs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"), "role", "text")
    return pairs.mirrored(c, "role", "text", "key")


_ASKS = "(about|translate|pour|von)"
_FLAG = f"NOT regexp_matches(instruction, '{_ASKS}') AND length({_STRIP('output')}) >= 8 AND length({_STRIP('output')}) < 120 AND length({_STRIP('output')}) <= length(instruction) + 40"
_QA = SQL["qa_pairs"]


@query(f"SELECT conv_id, turn, regexp_matches(instruction, '{_ASKS}') AS asked, {_FLAG} AS unsolicited FROM ({_QA})")
def translate_flags(spark, sf_dir):
    q = qa_pairs(spark, sf_dir)
    return q.select("conv_id", "turn", X.asks_translation(F.col("instruction"), _ASKS).alias("asked"), X.unsolicited_translation(F.col("instruction"), F.col("output"), _ASKS).alias("unsolicited"))


@query(f"SELECT count(*) AS n, count_if(regexp_matches(instruction, '{_ASKS}')) AS asked, count_if({_FLAG}) AS unsolicited FROM ({_QA})")
def flag_summary(spark, sf_dir):
    return translate_flags(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if("asked").alias("asked"), F.count_if("unsolicited").alias("unsolicited"))


@query("SELECT conv_id, max(text) FILTER (role = 'system') AS base, max(text) FILTER (role = 'user') AS old, max(text) FILTER (role = 'assistant') AS ft FROM conversations GROUP BY conv_id")
def model_pivot(spark, sf_dir):
    wide = table(spark, sf_dir, "conversations").groupBy("conv_id").pivot("role", ["system", "user", "assistant"]).agg(F.max("text"))
    return wide.select("conv_id", F.col("system").alias("base"), F.col("user").alias("old"), F.col("assistant").alias("ft"))


@query("SELECT 'source' AS facet, source AS value, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY ALL")
def grouping_sets_counts(spark, sf_dir):
    return select.count_sets(table(spark, sf_dir, "documents"), ["source", "lang"])


@query("SELECT conv_id, turn, 'https://' || role || '.wikisource.org/wiki/' || replace(url_encode(text), '%2F', '/') AS url FROM conversations")
def title_url(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", wikidump.page_url(F.col("text"), F.col("role")).alias("url"))


_NAME = "replace(replace(replace(url, 'example', 'wikinews'), 'https', 'wikiquote'), 'blog', 'wikisource')"


@query(f"SELECT page_id, split_part(n, 'wiki', 1) AS language, CASE WHEN contains(n, 'wikinews') THEN 'wikinews' WHEN contains(n, 'wikiquote') THEN 'wikiquote' WHEN contains(n, 'wikisource') THEN 'wikisource' ELSE '' END AS project FROM (SELECT page_id, {_NAME} AS n FROM pages)")
def page_lang_from_url(spark, sf_dir):
    """Project and language of names; urls are turned into names of the kind by their parts."""
    name = F.col("url")
    for old, new in (("example", "wikinews"), ("https", "wikiquote"), ("blog", "wikisource")):
        name = F.replace(name, F.lit(old), F.lit(new))
    return table(spark, sf_dir, "pages").select("page_id", name.alias("n")).select("page_id", wikidump.language_of(F.col("n")).alias("language"), wikidump.project_of(F.col("n")).alias("project"))


@query(f"SELECT page_id, {_STRIP('''regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), chr(10) || '{3,}', chr(10), 'g'), '(?m)^ +', '', 'g')''')} AS text FROM pages")
def strip_tags(spark, sf_dir):
    c = F.regexp_replace(wikitext.strip_tags(F.col("html")), r"\n{3,}", "\n")
    return table(spark, sf_dir, "pages").select("page_id", X.strip(F.regexp_replace(c, "(?md)^ +", "")).alias("text"))


@query()
def wiki_plain_text(spark, sf_dir):
    """Tested on fixtures: the pages hold no wiki markup."""
    return table(spark, sf_dir, "pages").select("page_id", wikitext.plain_text(F.col("html")).alias("text"))


_PROJECTS = {"wikisource": ["zh", "en"], "wikiquote": ["de"], "wikinews": ["fr", "es", "en"]}


@query("SELECT project, lang, 'https://dumps.wikimedia.org/' || lang || project || '/latest/' || lang || project || '-latest-pages-articles.xml.bz2' AS url, project || '/' || lang || project || '-latest-pages-articles.xml.bz2' AS path FROM (VALUES ('wikisource', 'zh'), ('wikisource', 'en'), ('wikiquote', 'de'), ('wikinews', 'fr'), ('wikinews', 'es'), ('wikinews', 'en')) t(project, lang)")
def task_plan(spark, sf_dir):
    return downloads.tasks(spark, _PROJECTS)


@query("SELECT p.page_id::VARCHAR AS name, CASE WHEN d.doc_id IS NULL THEN 'missing' WHEN p.page_id % 5 = 0 THEN 'mismatch' ELSE 'ok' END AS status, coalesce(d.n_chars, 0) AS size FROM pages p LEFT JOIN documents d ON p.page_id = d.doc_id")
def checksum_verify(spark, sf_dir):
    listed = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("name"), F.md5(F.when(F.col("page_id") % 5 == 0, F.lit("x")).otherwise(F.col("page_id").cast("string"))).alias("sha256"))
    there = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("name"), F.md5(F.col("doc_id").cast("string")).alias("found"), F.col("n_chars").alias("size"))
    return downloads.verified(listed, there)


@query("SELECT doc_id, CASE WHEN n < 1024 THEN n || 'B' WHEN n < 1048576 THEN printf('%.1fKB', n / 1024.0::DOUBLE) WHEN n < 1073741824 THEN printf('%.1fMB', n / 1048576.0::DOUBLE) ELSE printf('%.2fGB', n / 1073741824.0::DOUBLE) END AS size FROM (SELECT doc_id, n_chars * n_chars AS n FROM documents)")
def human_size(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.human_size(F.col("n_chars") * F.col("n_chars")).alias("size"))


@query("SELECT lang AS folder, grouping(lang)::TINYINT AS is_total, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY ROLLUP (lang)")
def folder_sizes(spark, sf_dir):
    return downloads.sizes(table(spark, sf_dir, "documents").select(F.col("lang").alias("folder"), F.col("n_chars").alias("size")), "folder")


_GRAMS = lambda side, text: f"SELECT item_id, n, {side} AS side, unnest(list_transform(range(1, greatest(length({text}) - n + 2, 1)), lambda i: substr({text}, i, n))) AS gram FROM pair, sizes"


@query(f"""WITH sizes AS (SELECT unnest(range(1, {scores.ORDER + 1}))::BIGINT AS n
), pair AS (SELECT a.item_id, coalesce(a.text, '') AS reference, coalesce(b.text, '') AS said FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1
), grams AS ({_GRAMS(0, 'reference')} UNION ALL {_GRAMS(1, 'said')}
), counted AS (SELECT item_id, n, gram, count_if(side = 0) AS theirs, count_if(side = 1) AS ours FROM grams GROUP BY ALL
), met AS (SELECT item_id, n, sum(least(theirs, ours)) AS hits, sum(ours) AS total FROM counted GROUP BY ALL
), logs AS (SELECT item_id, sum(ln(CASE WHEN coalesce(hits, 0) = 0 THEN {scores.EPSILON} ELSE hits END::DOUBLE / greatest(1, coalesce(total, 0)))) / {scores.ORDER} AS log,
    max(CASE WHEN n = 1 THEN coalesce(hits, 0) END) AS common FROM (SELECT item_id, n FROM pair, sizes) LEFT JOIN met USING (item_id, n) GROUP BY item_id)
SELECT item_id, round(CASE WHEN common = 0 THEN 0 ELSE least(1, exp(1 - length(reference)::DOUBLE / length(said))) * exp(log) END, 9) AS bleu FROM pair JOIN logs USING (item_id)""")
def char_bleu(spark, sf_dir):
    """Each benchmark item against the next one."""
    b = table(spark, sf_dir, "benchmark")
    met = b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other")), "item_id")
    return met.select("item_id", F.round(scores.char_bleu(F.col("text"), F.col("other")), 9).alias("bleu"))


_SAID = "'<|im_start|>assistant' || chr(10) || coalesce(text, '') || '<|im_end|>'"


@query(f"""SELECT {_STRIP(f"replace(split_part({_SAID}, 'assistant' || chr(10), -1), '<|im_end|>', '')")} AS completion, count(*) AS n FROM conversations GROUP BY ALL""")
def completions(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(F.concat(F.lit("<|im_start|>assistant\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>")).alias("c"))
    return c.groupBy(X.completion(F.col("c")).alias("completion")).agg(F.count("*").alias("n"))


_PREP = f"""WITH raw AS (
  SELECT source AS a0, '' AS i0, text AS o0, lang AS source, 'instruct' AS task, 0 AS source_rank FROM documents
  UNION ALL SELECT instruction, '', output, 'conversations', 'dialogue', 1 FROM ({_QA})
), n AS (SELECT {_NORM('a0')} AS instruction, '' AS input, {_NORM('o0')} AS output, source, task, source_rank FROM raw
), j AS (SELECT *, substr(sha1(instruction || chr(10) || input || chr(10) || output), 1, 16) AS id FROM n
  WHERE {_REASON.replace('source', 'instruction').replace('lower(t)', 'lower(output)').replace('length(t)', 'length(output)').replace('= t ', '= output ').replace('(t, ', '(output, ')} IS NULL
), d AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY id ORDER BY source_rank, source) = 1
), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || id), id) AS r, count(*) OVER (PARTITION BY source) AS n FROM d
), s AS (SELECT *, CASE WHEN n >= 50 THEN greatest(1, floor(n * 0.02::DOUBLE)) ELSE greatest(1, n // 20) END AS t0 FROM r
), c AS (SELECT *, CASE WHEN 2 * t0 >= n THEN least(t0, 1) ELSE t0 END AS t, CASE WHEN 2 * t0 >= n THEN least(t0, CASE WHEN n > 2 THEN 1 ELSE 0 END) ELSE t0 END AS v FROM s)
SELECT id, instruction, input, output, source, task, {_CHATML('instruction', 'output')} AS text, CASE WHEN r <= t THEN 'test' WHEN r <= t + v THEN 'val' ELSE 'train' END AS split FROM c"""


@query(_PREP)
def sft_prep(spark, sf_dir):
    """The flagship: two kinds of sources, rules, dedup across sources, template, stratified split."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("instruction"), F.lit("").alias("input"), F.col("text").alias("output"), F.col("lang").alias("source"), F.lit("instruct").alias("task"), F.lit(0).alias("source_rank"))
    talk = qa_pairs(spark, sf_dir).select("instruction", F.lit("").alias("input"), "output", F.lit("conversations").alias("source"), F.lit("dialogue").alias("task"), F.lit(1).alias("source_rank"))
    settings = sft.Settings(script=SCRIPT)
    raw = docs.unionByName(talk)
    # Rows equal in id have the same reason; filtered after the dedup, the planner cannot move copies of the rules below it.
    rows = select.first_wins(sft.normalised(raw, SCRIPT), "id", "source_rank", "source").where("reason is null")
    return select.stratified_split(written(sft.records(rows, settings), "records"), "source", "id", settings.seed, settings.test, settings.val)


_ASKED_FOR = [("instruct", "en", 12), ("instruct", "fr", 10), ("dialogue", "conversations", 8)]


@query(f"""SELECT id, 'heldout' AS bucket, task, source, instruction, input, output AS gold, '{compare.EXPECT}' AS expect
FROM ({_PREP}) JOIN (VALUES {', '.join(map(str, _ASKED_FOR))}) q(task, source, quota) USING (task, source) WHERE split = 'test' AND length(instruction) <= 400
QUALIFY row_number() OVER (PARTITION BY task, source ORDER BY md5('42:' || id), id) <= quota
UNION ALL SELECT id, 'probe', task, 'hand', instruction, '', NULL, expect FROM (VALUES {', '.join(map(str, compare.PROBES))}) p(id, task, instruction, expect)""")
def evaluation_set(spark, sf_dir):
    """Quotas over the prepared rows of the test split and the hand-written probes."""
    return compare.evaluation_set(spark, sft_prep(spark, sf_dir).where("split = 'test'"), _ASKED_FOR)


@query(f"""WITH p AS ({_PREP}) SELECT 'qa' AS validation, id, source, task FROM p WHERE split = 'val'
UNION ALL (SELECT 'translate', id, source, task FROM p WHERE task = 'dialogue' ORDER BY md5('42:' || id), id LIMIT 40)""")
def validation_sets(spark, sf_dir):
    """Both validation sets under their tags; the dialogues stand for translations."""
    rows = sft_prep(spark, sf_dir)
    return sft.validation(rows.where("split = 'val'"), rows.where("task = 'dialogue'"), 40).select("validation", "id", "source", "task")


@query("SELECT project, count(*) AS n FROM (VALUES ('wikisource', 2), ('wikiquote', 1), ('wikinews', 3)) t(project, c), range(c) GROUP BY project")
def tasks_per_project(spark, sf_dir):
    return downloads.per_project(downloads.tasks(spark, _PROJECTS))


@query("SELECT total, kept, total - kept AS removed FROM (SELECT count(*) AS total, count(DISTINCT CASE WHEN coalesce(source, '') != '' AND coalesce(text, '') != '' THEN md5(source || text) END) AS kept FROM documents)")
def legacy_totals(spark, sf_dir):
    """Rows in all, kept and removed by the pair dedup; incomplete rows are removed."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("input"), F.col("text").alias("output"))
    full = (F.coalesce("input", F.lit("")) != "") & (F.coalesce("output", F.lit("")) != "")
    keyed = written(d.select("doc_id", F.when(full, select.pair_key(F.col("input"), F.col("output"))).alias("k")), "keyed")
    marked = select.mark_duplicates(keyed, "k", "doc_id", among=F.col("k").isNotNull())
    return select.totals(marked, F.col("k").isNotNull() & ~F.col("duplicate"))


@query("SELECT sum(n_chars)::DOUBLE / 500 AS mean FROM (SELECT n_chars FROM documents ORDER BY doc_id LIMIT 500)")
def mean_of_first(spark, sf_dir):
    """The score of the first 500 rows in order, over 500 whatever there are; here the score is a length."""
    return scores.mean_of_first(table(spark, sf_dir, "documents"), F.col("n_chars").cast("double"), "doc_id")


_OPEN = lambda system, user: f"'<|im_start|>system' || chr(10) || '{system}<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || {user} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"
_TALK = "coalesce(text, repeat(' ', 0))"
_HEADERS = templates.HEADERS.replace("\n", "' || chr(10) || '").replace("{ask}", "' || role || '").replace("{given}", f"' || {_TALK} || '").replace("{reply}", f"' || {_TALK} || '")


@query(f"""SELECT conv_id, turn, {_OPEN(templates.SYSTEM, _TALK)} AS prompt, {_OPEN(templates.SYSTEM_TRANSLATE, _TALK)} AS translate,
  {_OPEN(templates.SYSTEM_RUNTIME, 'role')} || {_TALK} || '<|im_end|>' AS runtime, '{_HEADERS}' AS headers FROM conversations WHERE role IS NOT NULL""")
def prompt_templates(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("role is not null")
    said, role = F.col("text"), F.col("role")
    return c.select("conv_id", "turn", templates.prompt(said).alias("prompt"), templates.translation_prompt(said).alias("translate"), templates.runtime_text(role, said).alias("runtime"), templates.headers_text(role, said, said).alias("headers"))


@query("SELECT lang, map_from_entries(list((status, n) ORDER BY status)) AS reasons FROM (" + SQL["reason_stats"] + ") GROUP BY lang")
def reason_maps(spark, sf_dir):
    return select.reason_maps(reason_stats(spark, sf_dir), "lang")


_ASKED = f"CASE WHEN {_STRIP('text')} != '' THEN {_STRIP('role')} || chr(10) || chr(10) || {_STRIP('text')} ELSE {_STRIP('role')} END"


@query(f"""SELECT conv_id, turn, CASE WHEN lower(n) IN ({', '.join(repr(x) for x in X.EMPTY_INPUTS)}) THEN '' ELSE n END AS input,
  CASE WHEN coalesce(text, '') = '' THEN role ELSE text END AS reply, {_ASKED} AS prompt FROM (SELECT *, {_NORM("CASE WHEN turn % 5 = 4 THEN ' N/A ' ELSE text END")} AS n FROM conversations)""")
def field_forms(spark, sf_dir):
    """Inputs without placeholders, the first reply that is not empty, and the prompt of two fields."""
    c, text = table(spark, sf_dir, "conversations"), F.col("text")
    given = F.when(F.col("turn") % 5 == 4, " N/A ").otherwise(text)
    return c.select("conv_id", "turn", X.norm_input(given).alias("input"), X.either(text, F.col("role")).alias("reply"), X.user_text(F.col("role"), text).alias("prompt"))


_PLAIN = dict(zip("éèêëáàâäíìîïóòôöúùûüñç", "eeeeaaaaiiiioooouuuunc"))


@query(f"SELECT doc_id, translate(text, '{''.join(_PLAIN)}', '{''.join(_PLAIN.values())}') AS text FROM documents")
def translated_characters(spark, sf_dir):
    """Characters one for one by a table, here accented letters by plain ones."""
    return table(spark, sf_dir, "documents").select("doc_id", X.translated(F.col("text"), _PLAIN).alias("text"))


@query(f"SELECT conv_id, turn, text, text AS kept FROM (SELECT conv_id, turn, text AS said, {_CHATML('role', 'coalesce(text, repeat(chr(32), 0))')} AS text FROM conversations WHERE role IS NOT NULL)")
def text_passthrough(spark, sf_dir):
    """A text column is rendered where there is none, and left alone where there is one."""
    c = table(spark, sf_dir, "conversations").where("role is not null").select("conv_id", "turn", "role", F.col("text").alias("said"))
    rendered = templates.with_text(c, templates.chatml(F.col("role"), F.lit(""), F.coalesce("said", F.lit(""))))
    again = templates.with_text(rendered, F.lit("other"))
    return again.select("conv_id", "turn", "text", F.col("text").alias("kept"))


_INDEX = lambda day: f"strftime(DATE '2024-01-01' + (page_id % {day})::INT, '%Y-%m-%d')"


@query(f"""SELECT page_id, array_to_string(list_reverse_sort(list_distinct([{_INDEX(7)}, {_INDEX(11)}, {_INDEX(365)}, {_INDEX(7)}])), ',') AS dates FROM pages""")
def listed_dates(spark, sf_dir):
    """Dates of directory indexes, newest first; four entries are put behind each page."""
    entry = lambda day: F.concat(F.lit('<a href="'), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % day).cast("int")), "yyyy-MM-dd"), F.lit('/">x</a> '))
    listing = F.concat(F.coalesce("html", F.lit("")), entry(7), entry(11), entry(365), entry(7), F.lit('<a href="latest/">'))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(files.listed_dates(listing), ",").alias("dates"))


@query("SELECT max(substr(o_orderdate::VARCHAR, 1, 10)) FILTER (o_orderstatus = 'F') AS date FROM orders")
def newest_ready(spark, sf_dir):
    """The newest date that is ready."""
    return downloads.newest_ready(table(spark, sf_dir, "orders").select(F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("date"), (F.col("o_orderstatus") == "F").alias("ready")))


@query("SELECT d.doc_id::VARCHAR AS path FROM documents d ANTI JOIN (SELECT page_id FROM pages WHERE length(html) > 0) p ON p.page_id = d.doc_id")
def outstanding_tasks(spark, sf_dir):
    """Documents for which there is no page, or an empty one."""
    there = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), F.length("html").alias("size"))
    return downloads.outstanding(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path")), there)


_MODELS = ("base", "ft")
_TRANSLATED = lambda c: f"NOT regexp_matches(prompt, '{X.ASKS_TRANSLATION}') AND length({_STRIP(c)}) >= 8 AND length({_STRIP(c)}) < 120 AND length({_STRIP(c)}) <= length(prompt) + 40"


@query(f"""SELECT id, bucket, task, source, expect, gold, prompt, regexp_matches(prompt, '{X.ASKS_TRANSLATION}') AS asked_translate, base, ft,
  {_TRANSLATED('base')} AS base_unsolicited_translate, {_TRANSLATED('ft')} AS ft_unsolicited_translate
FROM (SELECT b.item_id::VARCHAR AS id, 'heldout' AS bucket, 'qa' AS task, 'benchmark' AS source, '{compare.EXPECT}' AS expect, substr(b.text, 1, 400) AS gold, {_STRIP('b.text')} AS prompt, d.source AS base, d.text AS ft
      FROM benchmark b LEFT JOIN documents d ON b.item_id = d.doc_id)""")
def compared_models(spark, sf_dir):
    """Replies of two models beside each prompt; the document of the item's number stands for the replies."""
    b, d = table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents")
    rows = b.select(F.col("item_id").cast("string").alias("id"), F.lit("heldout").alias("bucket"), F.lit("qa").alias("task"), F.lit("benchmark").alias("source"), F.lit(compare.EXPECT).alias("expect"), F.substring("text", 1, 400).alias("gold"), F.col("text").alias("instruction"), F.lit("").alias("input"))
    said = F.explode(F.array(F.struct(F.lit("base").alias("model"), F.col("source").alias("reply")), F.struct(F.lit("ft").alias("model"), F.col("text").alias("reply"))))
    replies = d.select(F.col("doc_id").cast("string").alias("id"), said.alias("r")).select("id", "r.model", "r.reply")
    return compare.compared(rows, replies, list(_MODELS))
