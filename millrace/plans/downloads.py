"""Plans and checks of dump downloads; the transport itself is not part of the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DUMPS = "https://dumps.wikimedia.org"


def tasks(spark: SparkSession, projects: dict[str, list[str]], only: list[str] | None = None, langs: list[str] | None = None) -> DataFrame:
    """Project and language with url and path; each project has its own languages, or all have ``langs``."""
    rows = spark.createDataFrame([(p, langs or own) for p, own in projects.items() if only is None or p in only], "project string, langs array<string>")
    rows = rows.select("project", F.explode("langs").alias("lang"))
    prefix = F.concat("lang", "project")
    name = F.concat(prefix, F.lit("-latest-pages-articles.xml.bz2"))
    return rows.select("project", "lang", F.concat(F.lit(f"{DUMPS}/"), prefix, F.lit("/latest/"), name).alias("url"), F.concat("project", F.lit("/"), name).alias("path"))


def per_project(plan: DataFrame) -> DataFrame:
    """Tasks of each project."""
    return plan.groupBy("project").agg(F.count("*").alias("n"))


def outstanding(plan: DataFrame, files: DataFrame) -> DataFrame:
    """Tasks whose file is missing or empty; ``files`` has ``path`` and ``size``."""
    return plan.join(files.where("size > 0").select("path"), "path", "left_anti")


def verified(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Every name of the manifest as ok, mismatch or missing."""
    met = manifest.join(files.select("name", "found", "size"), "name", "left")
    status = F.when(F.col("found").isNull(), "missing").when(F.lower("found") == F.lower("sha256"), "ok").otherwise("mismatch")
    return met.select("name", status.alias("status"), F.coalesce("size", F.lit(0)).cast("long").alias("size"))


def newest_ready(dates: DataFrame, wanted: str | None = None) -> DataFrame:
    """The date asked for, or the newest that is ready; ``dates`` has ``date`` and ``ready``."""
    rows = dates.where("ready")
    return (rows.where(F.col("date") == wanted) if wanted else rows).agg(F.max("date").alias("date"))


def snapshot_url(base: str, date: Column) -> Column:
    return F.concat(F.lit(base + "/"), date, F.lit("/xml/bzip2/SHA256SUMS"))


def sizes(files: DataFrame, group: str) -> DataFrame:
    """Bytes per group and in all."""
    return files.rollup(group).agg(F.grouping(group).alias("is_total"), F.sum("size").cast("long").alias("bytes"))
