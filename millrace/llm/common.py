"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words by white space alone (ASCII white space).
SPACES = r"[\x20\x09-\x0D]"
#: What separates the words of :func:`plain_words`: ASCII other than 0-9 and a-z; and the same in any case.
NOT_PLAIN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
NOT_PLAIN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does that faster where every character is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def plain_words(text: Column) -> Column:
    """Array of the lower-cased words of digits, a-z and non-ASCII characters."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_PLAIN + "+"), "")


def count_words(text: Column, gap: str) -> Column:
    """How many runs of other characters a class of separators leaves; 0 for null."""
    edges = F.when(text.rlike("^" + gap), 1).otherwise(0) + F.when(F.substring(text, -1, 1).rlike(gap), 1).otherwise(0)
    return F.when(text != "", F.size(F.split(text, gap + "+")) - edges).otherwise(F.lit(0)).cast("long")


def unused(columns: list[str], name: str) -> str:
    """``name`` with as many underscores before it as keep it apart from ``columns``, which ignore case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def as_rows(df: DataFrame) -> DataFrame:
    """All columns of ``df`` in the one column ``row``, so that no other name can clash with them."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def low_hex(digest: Column) -> Column:
    """Lowercase hex of a binary digest."""
    return F.lower(F.hex(digest))
