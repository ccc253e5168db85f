"""Readers of the raw formats and writers of results; schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASKED = "instruction string, input string, output string"
Reader = Callable[[SparkSession, str], DataFrame]
#: Readers by name, for pipelines that are told their sources.
READERS: dict[str, Reader] = {}


def register(name: str) -> Callable[[Reader], Reader]:
    def keep(reader: Reader) -> Reader:
        READERS[name] = reader
        return reader

    return keep


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any file matches, on whatever store the path names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def json_lines(spark: SparkSession, path: str, schema: str = ASKED) -> DataFrame:
    """JSON lines, compressed or not; blank lines are skipped, a bad line fails the job."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def json_lines_tolerant(spark: SparkSession, path: str, schema: str = ASKED) -> DataFrame:
    """JSON lines with bad ones kept in ``bad_line``, so that they can be counted and dropped."""
    return spark.read.schema(f"{schema}, bad_line string").json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="bad_line")


def json_array(spark: SparkSession, path: str, schema: str = ASKED) -> DataFrame:
    """A file that is one JSON array."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def csv_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, quotes, line breaks in fields and fields of any size; all strings."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', maxCharsPerColumn=-1)


def optional(spark: SparkSession, path: str, reader: Reader, schema: str) -> DataFrame:
    """The source, or no rows of its schema if the file is missing."""
    return reader(spark, path) if exists(spark, path) else spark.createDataFrame([], schema)


def column_or_first(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name if name in df.columns else df.columns[0]}`")


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they are, with their order: file, block, position."""
    rows = spark.read.text(path)
    return rows.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("position"))


@register("parallel_nested")
def parallel_nested(spark: SparkSession, path: str) -> DataFrame:
    """Pairs held in a struct; rows without it go."""
    rows = json_lines(spark, path, "translation struct<yue:string,zh:string>")
    return rows.select(F.col("translation.yue").alias("yue"), F.col("translation.zh").alias("zh")).dropna()


@register("parallel_flat")
def parallel_flat(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, "yue string, zh string").dropna()


@register("parallel_traditional")
def parallel_traditional(spark: SparkSession, path: str) -> DataFrame:
    """Gzip files do not split, so rows are spread before they are worked on."""
    rows = json_lines(spark, path, "yue string, zht string").dropna().withColumnRenamed("zht", "zh")
    return rows.repartition(spark.sparkContext.defaultParallelism)


@register("parallel_parquet")
def parallel_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("yue", F.col("ref").alias("zh")).dropna()


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a checksum file: ``sha256, name``; blank and comment lines go."""
    line = F.trim(F.col("value"))
    shape = r"^(\S+)\s+\**\s*(.+)$"
    return spark.read.text(path).where((line != "") & ~line.startswith("#") & line.rlike(shape)).select(F.regexp_extract(line, shape, 1).alias("sha256"), F.regexp_extract(line, shape, 2).alias("name"))


def file_sums(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and SHA-256 of files; empty files are not listed, and so count as missing."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("found"))


def listed_dates(html: Column) -> Column:
    """Dates of a directory index, newest first."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(html, F.lit(r'href="(\d{4}-\d{2}-\d{2})/"'), 1)), asc=False)


def write_json(df: DataFrame, path: str, *by: str) -> None:
    """JSON lines, one folder per value of ``by``."""
    (df.write.partitionBy(*by) if by else df.write).mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, line: str = "line", by: str | None = None) -> None:
    rows = df.select(F.col(line).alias("value"), *([by] if by else []))
    (rows.write.partitionBy(by) if by else rows.write).mode("overwrite").text(path)
