"""Prompt templates: literal text with named columns in braces."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# System prompts, refusals and templates.
SYSTEM = "你是一个粤语助手。用粤语回答问题、完成写作或对话。只有用户明确要求翻译时才翻译。不要把普通提问当成翻译任务。"
SYSTEM_TRANSLATE = "你是一个地道的粤语翻译助手。"
SYSTEM_RUNTIME = "你是粤语和普通话都能用的助手。用和用户相同的语言回答：用户用普通话就用普通话，用粤语就用粤语。只有用户明确要求翻译时才翻译。不要把普通提问当成翻译任务。违法、伤人、制作爆炸物等请求直接拒绝，不要追问细节。"
REFUSAL = "唔好意思，呢类违法或者危险嘅请求我帮唔到。如果你系想倾合法、安全嘅问题，我可以用粤语同你倾。"
REFUSAL_FORMAL = "对不起，作为一个人工智能助手，我不能协助你进行此类违规或危险的行为。"
CHATML_OPEN = "<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n{user}<|im_end|>\n<|im_start|>assistant\n"
CHATML = CHATML_OPEN + "{reply}<|im_end|>"
HEADERS = "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n你是一个精通粤语和普通话的助手，请根据要求完成翻译或对话任务。<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n{ask}\n{given}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n{reply}<|eot_id|>"


def render(template: str, **values: Column) -> Column:
    """The template with its named places filled; null values are empty."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(F.coalesce(values[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts) if p))


def chatml(ask: Column, given: Column, reply: Column, system: str = SYSTEM) -> Column:
    """Training text of normalised fields."""
    user = F.when(given != "", F.concat(ask, F.lit("\n\n"), given)).otherwise(ask)
    return render(CHATML, system=F.lit(system), user=user, reply=reply)


def prompt(user: Column, system: str = SYSTEM) -> Column:
    """What a model is given to answer: the text up to the reply."""
    return render(CHATML_OPEN, system=F.lit(system), user=user)


def translation_prompt(given: Column) -> Column:
    """Prompt of the translation baseline: its own system text, and the input alone."""
    return prompt(given, SYSTEM_TRANSLATE)


def runtime_text(user: Column, reply: Column) -> Column:
    """A turn as the served model sees it."""
    return render(CHATML, system=F.lit(SYSTEM_RUNTIME), user=user, reply=reply)


def headers_text(ask: Column, given: Column, reply: Column) -> Column:
    """Training text of the header style: ask and input in two lines."""
    return render(HEADERS, ask=ask, given=given, reply=reply)


def with_text(df: DataFrame, rendered: Column, column: str = "text") -> DataFrame:
    """``df`` as it is if it has the column, else with it rendered."""
    return df if column in df.columns else df.withColumn(column, rendered)
