"""Chat formatting: layouts by schema fingerprint, one reversible template (native).

A record's fingerprint is the SHA-256 of its sorted nested field paths, as far
as they are present (a null column, struct or array is absent) and known to a
layout.  The fingerprint selects a declarative mapping to canonical turns
(role, text).  A record with paths of several layouts, such as messages beside
an unrelated prompt, gets the first layout all of whose paths it has, those of
more paths first.  A record that fits no layout gets null turns.

The template opens and closes each turn with marks.  Control strings inside
texts and roles are broken by a backslash after their first character, and
backslashes are doubled, so texts are read back exactly.  The loss mask is
run-length coded: per turn the code points to skip, to learn, and to skip.

Null texts and roles are empty; turns of equal number follow by role, then
text.  Repeated rows give repeated results, an empty table an empty one; long
texts are formatted whole.  Columns of the names that a function adds are
replaced, all others are left as they are.  A conversation is one row of the
result, so one task must hold it whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import unused


@dataclass(frozen=True)
class Layout:
    """A layout: the field paths of a record and how they become turns."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column]

    @property
    def fingerprint(self) -> str:
        return sha256("|".join(sorted(self.paths)).encode()).hexdigest()


def _turn(role: Column | str, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else F.coalesce(role, F.lit(""))
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _pair(ask: str, reply: str, more: str | None = None) -> Callable[[], Column]:
    def turns() -> Column:
        asked = F.col(ask)
        if more:
            asked = F.when(F.col(more) != "", F.concat(asked, F.lit("\n\n"), F.col(more))).otherwise(asked)
        return F.array(_turn("user", asked), _turn("assistant", F.col(reply)))

    return turns


def _list(name: str, role: str, text: str, names: dict[str, str] | None = None, order: str | None = None) -> Callable[[], Column]:
    def turns() -> Column:
        items = F.sort_array(F.transform(name, lambda x: F.struct(x[order].alias("a"), x[role].alias(role), x[text].alias(text)))) if order else F.col(name)

        def one(x: Column) -> Column:
            said = x[role]
            for old, new in (names or {}).items():
                said = F.when(x[role] == old, F.lit(new)).otherwise(said)
            return _turn(said, x[text])

        return F.transform(items, one)

    return turns


LAYOUTS = (
    Layout("turn_rows", ("turns[].turn", "turns[].role", "turns[].text"), _list("turns", "role", "text", order="turn")),
    Layout("messages", ("messages[].role", "messages[].content"), _list("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), _list("conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
    Layout("instruction", ("instruction", "output"), _pair("instruction", "output")),
    Layout("instruction_input", ("instruction", "input", "output"), _pair("instruction", "output", "input")),
    Layout("prompt_completion", ("prompt", "completion"), _pair("prompt", "completion")),
    Layout("prompt_response", ("prompt", "response"), _pair("prompt", "response")),
    Layout("question_answer", ("question", "answer"), _pair("question", "answer")),
)


def present_paths(schema: T.StructType, known: set[str]) -> dict[str, Column]:
    """Known field paths of a schema, each with the condition that a row has it."""
    out: dict[str, Column] = {}

    def walk(fields: list[T.StructField], base: str, at: Column | None, there: Column | None) -> None:
        for f in fields:
            path = f"{base}{f.name}"
            col = F.col(f"`{f.name}`") if at is None else at[f.name]
            has = there if there is not None else col.isNotNull()
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType.fields, f"{path}.", col, None)
            elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
                walk(f.dataType.elementType.fields, f"{path}[].", col, has)
            elif path in known:
                out[path] = has

    walk(schema.fields, "", None, None)
    return out


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add ``layout`` (name or null) and ``chat`` (array of role, text; null without a layout)."""
    there = present_paths(records.schema, {p for x in layouts for p in x.paths})
    mark = F.sha2(F.concat_ws("|", *(F.when(has, F.lit(path)) for path, has in sorted(there.items()))), 256)
    usable = [x for x in layouts if set(x.paths) <= set(there)]
    layout, chat = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for x in sorted(usable, key=lambda x: (len(x.paths), -layouts.index(x))):  # the last one that fits wins
        has = F.lit(True)
        for path in x.paths:
            has &= there[path]
        layout, chat = F.when(has, F.lit(x.name)).otherwise(layout), F.when(has, x.turns()).otherwise(chat)
    own = unused(records.columns, "schema_mark")
    for x in usable:
        fits = F.col(own) == x.fingerprint
        layout, chat = F.when(fits, F.lit(x.name)).otherwise(layout), F.when(fits, x.turns()).otherwise(chat)
    return records.withColumn(own, mark).withColumns({"layout": layout, "chat": chat}).drop(own)


def parsed(records: DataFrame, json: str, layouts_schema: str = "turns array<struct<turn bigint,role string,text string>>, messages array<struct<role string,content string>>, conversations array<struct<`from` string,value string>>, instruction string, input string, output string, prompt string, completion string, response string, question string, answer string") -> DataFrame:
    """Records held as JSON strings, opened into the columns that layouts know.  Bad JSON has no layout.

    A column of ``records`` that has the name of an opened one is kept with an
    underscore before its name.
    """
    opened = T.StructType.fromDDL(layouts_schema).fieldNames()
    own, names = [], [*records.columns, *opened]
    for c in records.columns:
        clash = c.lower() in {x.lower() for x in opened}
        own.append(F.col(f"`{c}`").alias(unused(names, c) if clash else c))
        names.append(unused(names, c))
    return records.select(*own, F.from_json(F.col(f"`{json}`"), layouts_schema).alias("_opened_json_")).select(*(f"`{x}`" for x in records.select(*own).columns), "_opened_json_.*")


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and all strings that must not occur inside a text."""

    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    learn: tuple[str, ...] = field(default=("assistant",))

    def escaped(self, text: Column) -> Column:
        firsts = "|".join(f"{re.escape(c)}(?={'|'.join(re.escape(x[1:]) for x in self.controls if x[0] == c)})" for c in sorted({x[0] for x in self.controls}))
        return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), firsts, r"$0\\")

    @staticmethod
    def unescaped(text: Column) -> Column:
        return F.regexp_replace(text, r"\\(\\?)", "$1")

    def escaped_role(self, role: Column) -> Column:
        return F.replace(self.escaped(role), F.lit("\n"), F.lit("\\n"))

    @staticmethod
    def unescaped_role(role: Column) -> Column:
        parts = F.transform(F.split(role, r"\\\\"), lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit("")))
        return F.array_join(parts, "\\")


def format_chat(records: DataFrame, template: Template = Template(), chat: str = "chat") -> DataFrame:
    """Add ``formatted`` and ``loss_runs`` (array of skip, learn, rest) for the turns in ``chat``."""
    safe = F.transform(chat, lambda t: F.struct(template.escaped_role(t["role"]).alias("role"), template.escaped(t["text"]).alias("text"), t["role"].isin(*template.learn).alias("learn")))
    one = lambda t: F.concat(F.lit(template.open), t["role"], F.lit("\n"), t["text"], F.lit(template.close + "\n"))

    def runs(t: Column) -> Column:
        head, body, tail = F.length(t["role"]) + len(template.open) + 1, F.length(t["text"]), F.lit(len(template.close) + 1)
        return F.struct(F.when(t["learn"], head).otherwise(head + body + tail).alias("skip"), F.when(t["learn"], body).otherwise(F.lit(0)).alias("learn"), F.when(t["learn"], tail).otherwise(F.lit(0)).alias("rest"))

    own = unused([*records.columns, chat], "safe")
    return records.withColumn(own, safe).withColumns({"formatted": F.array_join(F.transform(own, one), ""), "loss_runs": F.transform(own, runs)}).drop(own)


def read_chat(records: DataFrame, template: Template = Template()) -> DataFrame:
    """Read ``formatted`` and ``loss_runs`` back: ``turns_back`` and ``loss_text``."""
    mark, end = re.escape(template.open), re.escape(template.close)
    pieces = F.filter(F.split("formatted", f"(?={mark})"), lambda x: x != "")
    shape = rf"(?s)^{mark}([^\n]*)\n(.*){end}\n$"
    own = unused(records.columns, "pieces")
    turns = F.transform(own, lambda p: F.struct(template.unescaped_role(F.regexp_extract(p, shape, 1)).alias("role"), template.unescaped(F.regexp_extract(p, shape, 2)).alias("text")))
    learnt = F.zip_with(own, "loss_runs", lambda p, r: template.unescaped(F.substring(p, r["skip"] + 1, r["learn"])))
    return records.withColumn(own, pieces).withColumns({"turns_back": turns, "loss_text": F.array_join(learnt, "")}).drop(own)
