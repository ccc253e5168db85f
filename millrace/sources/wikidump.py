"""Pages of XML dumps, by the built-in XML source (plain, gzip or bzip2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import page_url
from ..functions.wikitext import plain_text
from ..operators.stages import written
from .files import write_json

# The projects, in the order in which a later one wins, and the constant host.
PROJECTS = ("wikisource", "wiktionary", "wikibooks", "wikiquote", "wikinews", "wikivoyage", "wikiversity")
HOST, SOURCE_ID = "zh.wikisource.org", 9
PAGE = "id string, title string, ns string, redirect struct<_title:string>, revision array<struct<id:string,text:string>>"


def project_of(name: Column) -> Column:
    out = F.lit("")
    for p in PROJECTS:
        out = F.when(F.contains(name, F.lit(p)), F.lit(p)).otherwise(out)
    return out


def language_of(name: Column, fixed: bool = False) -> Column:
    """What stands before the first ``wiki`` of a file name; ``fixed`` takes the project's name off instead."""
    if not fixed:
        return F.substring_index(name, "wiki", 1)
    out = F.substring_index(name, "wiki", 1)
    for p in PROJECTS:
        out = F.when(F.contains(name, F.lit(p)), F.substring_index(name, p, 1)).otherwise(out)
    return out


def pages(spark: SparkSession, path: str, fixed: bool = False) -> DataFrame:
    """Articles of a dump with the last revision: ``id, url, title, raw_content, language, project``."""
    raw = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(PAGE).load(path)
    name = F.col("_metadata.file_name")
    rows = raw.where("redirect is null and ns = '0' and size(revision) > 0").select("id", "title", F.element_at("revision", -1)["text"].alias("raw_content"), language_of(name, fixed).alias("language"), project_of(name).alias("project"))
    rows = rows.where("id != '' and title != '' and raw_content != ''")
    return rows.select("id", page_url(F.col("title"), F.col("language")).alias("url"), "title", "raw_content", "language", "project")


def job(spark: SparkSession, path: str, out: str, stamp: str | None = None, passes: int = 20, fixed: bool = False) -> None:
    """Dumps to pages and cleaned text: JSON lines in ``raw`` and ``clean``, one folder per language and project."""
    found = written(pages(spark, path, fixed), "pages")
    write_json(found, f"{out}/raw", "language", "project")
    write_json(cleaned(found, stamp, passes, "language", "project"), f"{out}/clean", "language", "project")


def cleaned(rows: DataFrame, stamp: str | None = None, passes: int = 20, *also: str) -> DataFrame:
    """Plain text with its envelope: ``id, text, source, meta``.  The id is a hash of the page, so it does not change when a task runs again."""
    day = F.lit(stamp) if stamp else F.date_format(F.current_date(), "yyMMdd")
    h = F.md5(F.concat_ws("\n", "language", "project", "id", "title"))
    uid = F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    extra = F.to_json(F.struct("id", "title", "raw_content"))
    meta = F.to_json(F.struct(uid.alias("uuid"), "language", F.lit(SOURCE_ID).alias("source_id"), "url", F.lit(HOST).alias("host"), extra.alias("extra")))
    return rows.select(uid.alias("id"), F.concat("title", F.lit("\n"), plain_text(F.col("raw_content"), passes)).alias("text"), F.concat(F.lit("zh_wiki_raw_"), day).alias("source"), meta.alias("meta"), *also)
