"""Chat messages as ``array<struct<role, content>>`` columns."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions.facts import dashed, numbered

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def message(role: str, content: Column | str) -> Column:
    return F.struct(F.lit(role).alias("role"), (F.lit(content) if isinstance(content, str) else content).alias("content"))


def fill(template: str, **values: Column) -> Column:
    """Template with its named fields replaced by columns; inserted text is never scanned again."""
    pieces = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if field:
            pieces.append(values[field])
    return F.concat(*pieces)


def split_messages(sentence: Column | str, examples: Column | None = None) -> Column:
    """Messages asking for the facts of a sentence.

    ``examples`` is an ``array<struct<sentence:string, facts:array<string>>>``, best match first.
    """
    sentence = F.col(sentence) if isinstance(sentence, str) else sentence
    system = F.array(message("system", fixed.SPLIT_SYSTEM))
    user = F.array(message("user", fill(fixed.SPLIT_USER, sentence=sentence)))
    if examples is None:
        return F.concat(system, user)
    shown = F.flatten(
        F.transform(
            examples,
            lambda e: F.array(
                message("user", fill(fixed.SPLIT_USER, sentence=e["sentence"])),
                message("assistant", F.btrim(dashed(e["facts"]), F.lit(" \t\n\r\f\x0b"))),
            ),
        )
    )
    return F.concat(system, shown, user)


def persona_text() -> Column:
    """One ``key: value`` line per persona column."""
    lines = [F.concat(F.lit(f"{key}: "), F.col(key).cast("string"), F.lit("\n")) for key in fixed.PERSONA_COLUMNS]
    return F.concat(*lines)


def solved_messages() -> Column:
    """A solved persona row as question and answer."""
    answer = F.concat(F.lit("response: "), F.col("response").cast("string"), F.lit("\n"))
    return F.array(message("user", persona_text()), message("assistant", answer))


def answer_messages(shown: Column | None = None) -> Column:
    """Messages asking for an answer to a persona row; ``shown`` holds the messages of solved rows."""
    system = F.array(message("system", fixed.ANSWER_SYSTEM))
    user = F.array(message("user", persona_text()))
    return F.concat(system, user) if shown is None else F.concat(system, shown, user)


def claim_messages(claim: Column | str, references: Column | str) -> Column:
    """Messages asking whether the reference facts entail one claim."""
    claim = F.col(claim) if isinstance(claim, str) else claim
    content = fill(fixed.CHECK_USER, reference_text=dashed(references), claim=claim)
    return F.array(message("system", fixed.CHECK_SYSTEM), message("user", content))


def check_all_messages(claims: Column | str, references: Column | str) -> Column:
    """One message asking for a decision on every claim of an answer."""
    content = fill(fixed.CHECK_ALL, reference_text=dashed(references), claims=numbered(claims))
    return F.array(message("user", content))


def flatten_messages(messages: Column | str) -> Column:
    """Messages as one text for a model without a chat format."""
    lines = F.transform(
        messages, lambda m: F.concat(F.upper(m["role"]), F.lit(": "), m["content"], F.lit("\n"))
    )
    return F.concat(F.array_join(lines, ""), F.lit("ASSISTANT:"))


def prompt_hash(messages: Column | str) -> Column:
    """Key of a prompt: equal messages have equal keys."""
    return F.sha2(F.to_json(messages), 256)
