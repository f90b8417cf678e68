"""Chat messages, model names and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import fixed_values as fv

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def prompt_messages(question: Column, system_prompt: str | Column | None = None) -> Column:
    """An optional system message, only if the prompt is not empty, then the
    question."""
    return _with_system(system_prompt, F.array(_message("user", question)))


def chat_messages(question: Column, response: Column, system_prompt: str | Column | None = None) -> Column:
    """The same with the answer as the last turn."""
    return _with_system(system_prompt, F.array(_message("user", question), _message("assistant", response)))


def _with_system(system_prompt: str | Column | None, turns: Column) -> Column:
    if system_prompt is None:
        return turns
    if isinstance(system_prompt, Column):
        prompt = F.coalesce(system_prompt.cast("string"), F.lit(""))
        system = F.array(_message("system", prompt))
        return F.when(prompt != "", F.concat(system, turns)).otherwise(turns)
    return F.concat(F.array(_message("system", F.lit(system_prompt))), turns) if system_prompt else turns


def base_model(config_json: Column, override: Column | None = None) -> Column:
    """The base model an adapter config names, unless the user names one."""
    named = F.get_json_object(config_json, f"$.{fv.BASE_MODEL_FIELD}")
    if override is None:
        return named
    return F.coalesce(F.when(override != "", override), named)


def fingerprint(text: Column) -> Column:
    """The first 12 hex digits of the SHA-256 of a text."""
    return F.substring(F.sha2(text, 256), 1, 12)


def chunk_id(document: Column, outline: Column, domain: Column, max_chars: int, generator: str) -> Column:
    """Names a chunk together with every setting that shapes its answers, so
    a changed setting makes new work and an unchanged one does not."""
    settings = [F.lit(str(max_chars)), F.lit(generator), F.coalesce(domain, F.lit("")), F.coalesce(outline, F.lit(""))]
    return F.sha2(F.concat_ws("\x1f", *settings, document), 256)
