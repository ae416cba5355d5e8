"""Requests to a chat endpoint as columns: messages with pictures, payloads, addresses, and guards on a growing history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.operators import records

# Where chats are asked for, and the axes that tell prompts apart, in order.
CHAT_PATH = "/chat/completions"
SIGNATURE = ("language", "knowledge_domain", "capability", "conversation_type", "system_prompt_mode", "response_style", "output_format", "difficulty", "context_length", "input_condition", "answer_mode", "visual_domain")
# Why a conversation is given up between two turns.
UNKNOWN_ROLE, NOT_ADVANCED, ROLE_MISMATCH = "unknown_role", "history_not_advanced", "role_mismatch"


def address(base: Column) -> Column:
    """Where to send chats: the base without slashes at its end, and the path."""
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit(CHAT_PATH))


def user_message(text: Column, picture: Column) -> Column:
    """A user's message as JSON: plain text, or with a picture's address the picture and then the text."""
    parts = F.array(F.to_json(F.struct(F.lit("image_url").alias("type"), F.struct(picture.alias("url")).alias("image_url"))), F.to_json(F.struct(F.lit("text").alias("type"), text.alias("text"))))
    many = F.concat(F.lit('{"role":"user","content":['), F.array_join(parts, ","), F.lit("]}"))
    return F.when(picture.isNull(), F.to_json(F.struct(F.lit("user").alias("role"), text.alias("content")))).otherwise(many)


def payload(model: str, messages: Column, temperature: float, thinking: bool, most_tokens: Column, stream: bool = True) -> Column:
    """The request's JSON; messages are an array of JSON texts. A null limit is left out; the thinking switch never is."""
    if thinking is not True and thinking is not False:
        raise TypeError(f"thinking: expected True or False (received: {thinking!r})")
    head = F.to_json(F.struct(F.lit(model).alias("model")))
    limit = F.coalesce(F.concat(F.lit(',"max_tokens":'), most_tokens.cast("string")), F.lit(""))
    rest = f',"temperature":{temperature},"stream":{str(stream).lower()}'
    return F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"messages":['), F.array_join(messages, ","), F.lit("]" + rest), limit, F.lit(f',"chat_template_kwargs":{{"enable_thinking":{str(thinking).lower()}}}}}'))


def one_shot(columns: Mapping[str, Column]) -> Column:
    """struct<ask, answer>: prompts for a dialogue of one exchange, from a coordinate with defaults for what it lacks."""
    value = lambda name, default: F.coalesce(columns[name], F.lit(default)) if name in columns else F.lit(default)
    ask = F.concat(F.lit("Play a real user. Write one user message in "), value("language", "English"), F.lit(" about "), value("knowledge_domain", "general"), F.lit("; the task is "), value("capability", "qa"), F.lit(", the style "), value("conversation_type", "single_turn"), F.lit(". Give the message only."))
    return F.struct(ask.alias("ask"), F.lit("Answer the user's question with care.").alias("answer"))


def guard(spec_roles: Column, history: Column, turn: Column) -> Column:
    """Why a conversation is given up behind a turn (from 0), null if it goes on. history: the roles so far, a leading system one apart."""
    lead = F.when(F.get(history, F.lit(0)) == "system", 1).otherwise(0)
    role = F.get(spec_roles, turn)
    own = F.filter(history, lambda r: r != "system")
    final = turn == F.size(spec_roles) - 1
    odd = records.shape_reason(history).isNotNull() | ~own.eqNullSafe(spec_roles)
    return F.when(~F.coalesce(role.isin("user", "assistant"), F.lit(False)), UNKNOWN_ROLE).when(F.size(history) - lead != turn + 1, NOT_ADVANCED).when(final & odd, ROLE_MISMATCH)


def signature(columns: Mapping[str, Column]) -> Column:
    """What makes a prompt: a struct of all signature axes, null where a coordinate lacks one."""
    return F.struct(*((columns[a].cast("string") if a in columns else F.lit(None).cast("string")).alias(a) for a in SIGNATURE))


def effective(restricted: Sequence[str]) -> list[str]:
    """Restricted axes that reach the prompt."""
    return [a for a in restricted if a in SIGNATURE]


def label(columns: Mapping[str, Column]) -> Column:
    """axis='value' of what a coordinate has, by axis name."""
    quoted = lambda c: F.when(c.contains("'") & ~c.contains('"'), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.array_join(F.filter(F.array(*(F.concat(F.lit(f"{a}="), quoted(columns[a])) for a in sorted(columns))), lambda x: x.isNotNull()), ", ")
