"""Normalisation, ids and predicates on text columns; all of it native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode and Python have it, the script class, filter bounds, labels.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
CJK = r"[㐀-鿿]"
EMPTY_INPUTS = ("", "<noinput>", "<no input>", "none", "null", "n/a")
HEADER_ASKS = ("question", "prompt", "instruction")
HEADER_REPLIES = ("response", "output", "answer")
ASK_LENGTH, REPLY_LENGTH = (4, 2000), (8, 8000)
ASKS_TRANSLATION = "(请将|請將|翻译成|翻譯成|译成|譯成)"


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """White space of any kind off both ends; null is empty."""
    return F.regexp_replace(text_of(c), rf"^{WS}+|{WS}+\z", "")


def norm_text(c: Column) -> Column:
    """No byte-order marks, every run of white space one space, ends stripped; null is empty."""
    return F.trim(F.regexp_replace(F.replace(text_of(c), F.lit("﻿"), F.lit("")), WS + "+", " "))


def norm_input(c: Column) -> Column:
    """:func:`norm_text`, with placeholders for "no input" made empty."""
    n = norm_text(c)
    return F.when(F.lower(n).isin(*EMPTY_INPUTS), F.lit("")).otherwise(n)


def record_id(ask: Column, given: Column, reply: Column) -> Column:
    """First 16 hex digits of SHA-1 over the three normalised fields."""
    return F.substring(F.sha1(F.concat_ws("\n", ask, given, reply)), 1, 16)


def either(a: Column, b: Column) -> Column:
    """``b`` where ``a`` is null or empty."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def user_text(ask: Column, given: Column) -> Column:
    """Both fields stripped, with a blank line between if there is an input."""
    return F.when(strip(given) != "", F.concat(strip(ask), F.lit("\n\n"), strip(given))).otherwise(strip(ask))


def drop_reason(ask: Column, reply: Column, script: str = CJK, ask_length: tuple[int, int] = ASK_LENGTH, reply_length: tuple[int, int] = REPLY_LENGTH) -> Column:
    """Label of the first rule that a normalised pair breaks, or null."""
    return (
        F.when(F.lower(ask).isin(*HEADER_ASKS), "header")
        .when(F.lower(reply).isin(*HEADER_REPLIES), "header")
        .when(F.length(ask) < ask_length[0], "inst_short")
        .when(F.length(ask) > ask_length[1], "inst_long")
        .when(F.length(reply) < reply_length[0], "out_short")
        .when(F.length(reply) > reply_length[1], "out_long")
        .when(ask == reply, "identity")
        .when(~ask.rlike(script) & ~reply.rlike(script), "no_cjk")
    )


def asks_translation(prompt: Column, pattern: str = ASKS_TRANSLATION) -> Column:
    return text_of(prompt).rlike(pattern)


def unsolicited_translation(prompt: Column, reply: Column, pattern: str = ASKS_TRANSLATION) -> Column:
    """A reply that looks like a short translation though none was asked for."""
    n = F.length(strip(reply))
    return ~asks_translation(prompt, pattern) & (n >= 8) & (n < 120) & (n <= F.length(text_of(prompt)) + 40)


def order_key(seed: int, key: Column) -> Column:
    """Hash that orders rows at random, the same for any partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), text_of(key)))


def bernoulli(seed: int, key: Column, rate: float) -> Column:
    """True for about ``rate`` of the keys, by the first four hex digits of the order key."""
    return F.substring(order_key(seed, key), 1, 4) < f"{round(rate * 65536):04x}"


def choice(seed: int, key: Column, options: list[str]) -> Column:
    """One of the options for each key."""
    digit = F.conv(F.substring(order_key(seed, key), 1, 4), 16, 10).cast("int")
    return F.element_at(F.array(*(F.lit(o) for o in options)), digit % len(options) + 1)


def quoted(c: Column) -> Column:
    """Percent-encoding of a path: letters, digits and ``_.-~/`` stay."""
    out = F.url_encode(c)
    for old, new in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def page_url(title: Column, language: Column) -> Column:
    return F.concat(F.lit("https://"), language, F.lit(".wikisource.org/wiki/"), quoted(title))


def human_size(n: Column) -> Column:
    """Bytes as B, KB, MB or GB; ties round to even."""
    unit = lambda k, digits, name: F.format_string(f"%.{digits}f{name}", F.bround(n / F.lit(float(1 << 10 * k)), digits))
    return F.when(n < 1 << 10, F.concat(n.cast("string"), F.lit("B"))).when(n < 1 << 20, unit(1, 1, "KB")).when(n < 1 << 30, unit(2, 1, "MB")).otherwise(unit(3, 2, "GB"))


def completion(c: Column) -> Column:
    """What follows the last assistant mark (with its line feed, if any has one), without end marks."""
    said = F.when(F.contains(c, F.lit("assistant\n")), F.substring_index(c, "assistant\n", -1)).otherwise(F.substring_index(c, "assistant", -1))
    return strip(F.replace(said, F.lit("<|im_end|>"), F.lit("")))


def translated(c: Column, table: dict[str, str]) -> Column:
    """Characters replaced one for one by a table, such as traditional by simplified forms."""
    return F.translate(c, "".join(table), "".join(table.values()))
