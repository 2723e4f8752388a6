"""Fact lists: parsing stored lists and model output, writing them back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factgrade.functions.text import sentences, strip

STRICT = {"allowSingleQuotes": "false"}


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_facts() -> Column:
    return F.array().cast("array<string>")


def _wrapped(raw: Column, element: str) -> Column:
    """Parse ``[raw]``: a second JSON value adds an element."""
    return F.from_json(F.concat(F.lit("["), raw, F.lit("]")), f"array<{element}>", STRICT)


def _closed(raw: Column, kind: str) -> Column:
    """True when ``raw`` is complete as the value of an object's field, so that nothing closes it early."""
    return F.from_json(F.concat(F.lit('{"a":'), raw, F.lit(',"z":1}')), f"a {kind}, z int", STRICT)["z"] == 1


def is_json(raw: Column | str) -> Column:
    """True when the whole text is one JSON value."""
    raw = _column(raw)
    return F.coalesce((F.size(_wrapped(raw, "string")) == 1) & _closed(raw, "string"), F.lit(False))


def json_list(raw: Column | str) -> Column:
    """The list of strings a text holds, or null when it is not exactly one JSON list."""
    raw = _column(raw)
    parsed = _wrapped(raw, "array<string>")
    return F.when((F.size(parsed) == 1) & _closed(raw, "array<string>"), F.element_at(parsed, 1))


def parse_facts(raw: Column | str) -> Column:
    """Stored JSON list -> array; anything else -> empty list."""
    return F.coalesce(json_list(raw), no_facts())


def fact_lines(text: Column | str) -> Column:
    """Non-blank trimmed lines."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")


def parse_facts_or_lines(raw: Column | str) -> Column:
    """Stored JSON list -> array; text that is not JSON -> its lines; other JSON or null -> empty list."""
    raw = _column(raw)
    return F.coalesce(json_list(raw), F.when(~is_json(raw), fact_lines(raw)), no_facts())


def listed_facts(output: Column | str) -> Column:
    """Model output -> facts: lines that start with ``- `` or ``* ``, marker removed."""
    lines = F.transform(F.split(output, "\n"), strip)
    marked = F.filter(lines, lambda line: line.startswith("- ") | line.startswith("* "))
    return F.coalesce(F.transform(marked, lambda line: strip(F.substr(line, F.lit(3)))), no_facts())


def sentence_facts(text: Column | str) -> Column:
    """Offline stand-in for the splitting model: every sentence is one fact."""
    return sentences(text)


def facts_json(facts: Column | str) -> Column:
    """Array -> JSON text, for formats without arrays."""
    return F.to_json(facts)


def dashed(facts: Column | str) -> Column:
    """Facts as ``- `` lines."""
    return F.array_join(F.transform(facts, lambda fact: F.concat(F.lit("- "), fact)), "\n")


def numbered(facts: Column | str) -> Column:
    """Facts as lines numbered from 1."""
    return F.array_join(
        F.transform(facts, lambda fact, i: F.concat((i + 1).cast("string"), F.lit(". "), fact)), "\n"
    )
