"""Reading replies: options, decisions, and what kind of reply it is."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions.facts import STRICT, is_json
from factgrade.functions.text import strip


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def match_option(reply: Column | str, options: list[str]) -> Column:
    """Reply mapped to an option: equal, else contained (case ignored), else the reply, else the first option."""
    text = strip(_column(reply))
    low = F.lower(text)
    equal = [F.when(low == o.lower(), F.lit(o)) for o in options]
    inside = [F.when(F.contains(low, F.lit(o.lower())), F.lit(o)) for o in options]
    return F.coalesce(*equal, *inside, F.when(text != "", text), F.lit(options[0]))


def says_yes(reply: Column | str) -> Column:
    return F.coalesce(F.contains(F.upper(_column(reply)), F.lit("YES")), F.lit(False))


def count_yes(reply: Column | str) -> Column:
    """Number of YES decisions in ``{"decisions": [...]}``.

    Without the key the count is 0; a reply of any other shape is searched for the quoted word.
    """
    text = strip(_column(reply))
    listed = F.from_json(text, "decisions array<string>", STRICT)["decisions"]
    keys = F.json_object_keys(text)
    value_kind = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json(text), "$.decisions", "variant")
    )
    searched = F.regexp_count(F.upper(text), F.lit('"YES"'))
    of_object = (
        F.when(~F.array_contains(keys, "decisions"), 0)
        .when(listed.isNotNull(), F.size(F.filter(listed, lambda d: F.upper(d) == "YES")))
        .when(value_kind == "STRING", 0)
        .otherwise(searched)
    )
    return F.coalesce(F.when(is_json(text) & keys.isNotNull(), of_object).otherwise(searched), F.lit(0)).cast("int")


def reply_status(reply: Column | str) -> Column:
    """ok, temporary (ask again), permanent (do not), or missing (ask)."""
    reply = _column(reply)
    worth_repeating = F.lower(reply).rlike("|".join(re.escape(w) for w in fixed.TEMPORARY_FAILURES))
    return (
        F.when(reply.isNull() | (reply == ""), "missing")
        .when(~reply.startswith(fixed.FAILURE_PREFIX), "ok")
        .when(worth_repeating, "temporary")
        .otherwise("permanent")
    )
