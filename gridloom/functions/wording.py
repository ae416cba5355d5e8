"""Prompts from wording data: templates filled in one pass, requirement clauses, user turn prompts."""

from __future__ import annotations

import json
import re
import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Where a template's fields come from with their defaults, the order of instruction axes, the mode without a prompt.
FIELDS = {"language": ("language", "English"), "capability": ("capability", "qa"), "domain": ("knowledge_domain", "general")}
INSTRUCTION_AXES = ("response_style", "output_format", "difficulty", "context_length", "input_condition", "answer_mode")
NO_PROMPT = "none"


class WordingError(ValueError):
    """Wording that cannot be used."""


def mode_file(mode: str) -> str:
    """The file of a mode; a mode is a name, never a path, and `none` has no wording."""
    if mode == NO_PROMPT or not re.fullmatch(r"[A-Za-z0-9_-]+", mode or ""):
        raise WordingError(f"no wording for mode {mode!r}")
    return f"{mode}.md"


def validated_template(body: str, where: str) -> str:
    body = body.strip()
    if not body:
        raise WordingError(f"{where}: empty")
    try:
        names = {n for _, n, _, _ in string.Formatter().parse(body) if n is not None}
    except ValueError as e:
        raise WordingError(f"{where}: {e}") from e
    if names - set(FIELDS):
        raise WordingError(f"{where}: unknown fields {sorted(names - set(FIELDS))}")
    return body


def rendered(template: str, columns: Mapping[str, Column]) -> Column:
    """A validated template with its fields filled from columns; values are never read as fields themselves."""
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            source, default = FIELDS[name]
            parts.append(F.coalesce(columns[source], F.lit(default)) if source in columns else F.lit(default))
    return F.concat(*parts)


def read_templates(spark: SparkSession, folder: str) -> dict[str, str]:
    """Templates by mode from a folder of Markdown files."""
    rows = spark.read.text(f"{folder}/*.md", wholetext=True).select("value", F.input_file_name().alias("path")).collect()  # a few small files
    named = {r["path"].rpartition("/")[2][:-3]: r["value"] for r in rows}
    return {m: validated_template(b, m) for m, b in named.items() if m != NO_PROMPT}


def validated_sentences(document: object, axis: str, values: Sequence[str]) -> dict[str, str]:
    """A sentence for each value of an axis and nothing else."""
    found = document.get("values") if isinstance(document, dict) else None
    if not isinstance(found, dict) or not found or set(found) != set(values):
        raise WordingError(f"{axis}: expected a sentence for each of {list(values)}")
    if bad := [v for v, t in found.items() if not isinstance(t, str) or not t.strip()]:
        raise WordingError(f"{axis}: no sentence for {bad}")
    return {v: t.strip() for v, t in found.items()}


def read_sentences(spark: SparkSession, folder: str, axes: Mapping[str, Sequence[str]]) -> dict[str, dict[str, str]]:
    """Sentences by axis from a folder of <axis>.json files ({"values": {value: sentence}}); an axis without a file has none."""
    rows = spark.read.text(f"{folder}/*.json", wholetext=True).select("value", F.input_file_name().alias("path")).collect()  # a small file for each axis
    found = {}
    for r in rows:
        axis = r["path"].rpartition("/")[2][:-5]
        if axis not in axes or axis not in INSTRUCTION_AXES:
            raise WordingError(f"{axis}: no axis that takes instructions")
        try:
            document = json.loads(r["value"])
        except ValueError as e:
            raise WordingError(f"{axis}: {e}") from e
        found[axis] = validated_sentences(document, axis, axes[axis])
    return found


def requirement(sentences: Mapping[str, Mapping[str, str]], columns: Mapping[str, Column], lead: str = "Requirements:") -> Column:
    """The lead and the sentences of a row's values in the order of axes; a null value adds nothing, an unknown one is an error."""
    said = []
    for axis in INSTRUCTION_AXES:
        if axis not in columns or axis not in sentences:
            continue
        known = F.create_map(*(F.lit(x) for kv in sentences[axis].items() for x in kv))
        text = F.get(F.array(known[columns[axis]]), F.lit(0))
        said.append(F.when(columns[axis].isNotNull() & text.isNull(), F.raise_error(F.concat(F.lit(f"{axis}: no sentence for "), columns[axis]))).otherwise(text))
    clause = F.concat_ws(" ", *said)
    return F.when(clause == "", "").otherwise(F.concat(F.lit(lead + " "), clause))


def history(messages: Column) -> Column:
    """role: content lines of earlier messages (array of struct<role, content>)."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def user_prompt(messages: Column, columns: Mapping[str, Column], clause: Column, picture: Column | None = None) -> Column:
    """struct<system, user>: what asks for the next user turn. Without history it asks for a first turn; with a picture, for one about it."""
    get = lambda c, d: F.coalesce(columns[c], F.lit(d)) if c in columns else F.lit(d)
    language, topic, task, kind = get("language", "English"), get("knowledge_domain", "general"), get("capability", "qa"), get("conversation_type", "single_turn")
    later = F.size(messages) > 0
    ask = F.concat(F.lit("Write a "), F.when(later, "follow-up ").otherwise(""), F.lit("user message in "), language)
    about = F.concat(F.lit(" on "), topic)
    if picture is not None:
        about = F.concat(F.when(picture.isNotNull(), " about the picture").otherwise(""), about)
    ask = F.concat(ask, about, F.lit(" that asks for "), task, F.lit(", in a "), kind, F.lit(" conversation."))
    system = F.concat_ws(" ", F.lit("You play a real user."), ask, F.when(clause != "", clause), F.lit("Give the message only."))
    user = F.when(later, F.concat(F.lit("So far:\n"), history(messages), F.lit("\n\nWrite the next user message."))).otherwise("Write the first user message.")
    return F.struct(system.alias("system"), user.alias("user"))


def sentence_frame(spark: SparkSession, sentences: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """axis, value, sentence rows."""
    return spark.createDataFrame([(a, v, t) for a, own in sentences.items() for v, t in own.items()], "axis string, value string, sentence string")
