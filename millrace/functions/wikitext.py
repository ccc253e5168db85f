"""Wiki markup to plain text by native expressions.

A template pass is one alternation, tried in the order of dispatch, whose
kept argument is in one of three groups; passes are unrolled, innermost
templates first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text_of

# Template names by treatment, endings of names, link prefixes.
DISCARDED = ("header", "reflist", "nonfree", "noteта", "noteta", "gap", "页面", "wikisource", "ws")
ENDINGS = ("作品", "人物", "朝代", "时期", "世纪")
SECOND_ARGUMENT = ("propernoun", "proper noun", "另", "异体字", "異體字")
FIRST_ARGUMENT = ("lang", "s", "del", "center", "right", "left", "quote", "poem", "small", "big", "large", "ruby")
DROPPED_LINKS = ("分类", "Category", "File", "档案")

_ARG = "[^{}|]"


def template_pattern() -> str:
    """One pass over innermost templates; what is kept is ``$1$2$3``."""
    any_of = lambda names: "|".join(names)
    kept = rf"\s*({_ARG}*?)\s*"
    return (
        r"(?iU)\{\{\s*(?:"
        rf"(?:{any_of(DISCARDED)}|{_ARG}*(?:{any_of(ENDINGS)}))\s*(?:\|[^{{}}]*)?"
        rf"|(?:{any_of(SECOND_ARGUMENT)})\s*\|{_ARG}*\|{kept}(?:\|[^{{}}]*)?"
        rf"|(?:{any_of(SECOND_ARGUMENT + FIRST_ARGUMENT)})\s*\|{kept}(?:\|[^{{}}]*)?"
        rf"|[^{{}}]*\|{kept}"
        r"|[^{}|]+"
        r")\}\}"
    )


def expand_templates(c: Column, passes: int = 20) -> Column:
    """Templates replaced by the argument that stands for them."""
    for _ in range(passes):
        c = F.regexp_replace(c, template_pattern(), "$1$2$3")
    return c


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def _joined(body: Column, pattern: str, filling: Column) -> Column:
    parts = F.split(body, pattern)
    return F.aggregate(F.slice(parts, 2, F.size(parts)), F.element_at(parts, 1), lambda a, x: F.concat(a, filling, x))


def plain_text(c: Column, passes: int = 20, keep_after_empty_ref: bool = False) -> Column:
    """Text of a page, with its notes numbered.

    By default an empty ``<ref …/>`` also opens a note, as the pattern of
    notes has it; ``keep_after_empty_ref`` removes those first.  Notes are
    spliced literally.
    """
    whole, inner = r"(?s)<ref[^>]*>.*?</ref>", r"(?s)<ref[^>]*>(.*?)</ref>"
    c = text_of(c)
    if keep_after_empty_ref:
        c = F.regexp_replace(c, "<ref[^>]*/>", "")
    numbered = F.transform(F.split(c, whole), lambda x, i: F.when(i > 0, F.concat(F.lit("["), i.cast("string"), F.lit("]"), x)).otherwise(x))
    texts = F.transform(F.regexp_extract_all(c, F.lit(inner), 1), lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), strip_tags(expand_templates(strip(x), passes))))
    body = F.regexp_replace(F.array_join(numbered, ""), "<ref[^>]*/>", "")
    body = _joined(body, r"(?i)\{\{reflist\}\}", F.array_join(texts, "\n"))
    body = F.regexp_replace(body, r"(?s)<onlyinclude>(.*?)</onlyinclude>", "$1")
    body = strip_tags(expand_templates(body, passes))
    body = F.regexp_replace(body, rf"(?iU)\[\[(?:{'|'.join(DROPPED_LINKS)}):[^\]]*\]\]", "")
    body = F.regexp_replace(body, r"\[\[(?:[^|\]]*\|)?([^\]]+)\]\]", "$1")
    body = F.regexp_replace(body, "'{2,3}", "")
    body = F.regexp_replace(body, r"\n{3,}", "\n")
    return strip(F.regexp_replace(body, "(?md)^ +", ""))
