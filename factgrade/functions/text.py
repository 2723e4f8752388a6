"""Text expressions: sentences, tokens, lengths, names, refusal rule inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factgrade import fixed

WHITESPACE = " \t\n\r\f\x0b"


def strip(text: Column | str) -> Column:
    """Text without leading and trailing white space."""
    return F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(WHITESPACE))


def sentences(text: Column | str) -> Column:
    """Split at white space that follows ``.``, ``!`` or ``?``; blank pieces are dropped."""
    pieces = F.split(text, r"(?<=[.!?])\s+")
    return F.coalesce(
        F.filter(F.transform(pieces, strip), lambda s: s != ""),
        F.array().cast("array<string>"),
    )


def tokens(text: Column | str) -> Column:
    """Split at single spaces; case and punctuation stay."""
    return F.split(text, " ")


def word_set(text: Column | str) -> Column:
    """Distinct lower-case words; anything but letters and digits separates."""
    words = F.split(F.lower(text), r"[^\p{L}\p{Nd}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def head(text: Column | str, n: int = fixed.CLASSIFIER_CHARS) -> Column:
    """What a bounded classifier sees: null becomes empty, then the first ``n`` characters."""
    column = F.col(text) if isinstance(text, str) else text
    return F.substring(F.coalesce(column.cast("string"), F.lit("")), 1, n)


def label_id(label: Column | str) -> Column:
    """``LABEL_3`` -> 3."""
    return F.element_at(F.split(label, "_"), -1).try_cast("int")


def claim_density(length: Column | str, k_gen: Column | str) -> Column:
    """Characters per claim; no claims count as one."""
    length = F.col(length) if isinstance(length, str) else length
    k_gen = F.col(k_gen) if isinstance(k_gen, str) else k_gen
    return length / F.when(k_gen == 0, 1).otherwise(k_gen)


def delta_k(k_gen: Column | str, k_gt: Column | str) -> Column:
    """How many more claims the answer makes than the ground truth."""
    k_gen = F.col(k_gen) if isinstance(k_gen, str) else k_gen
    k_gt = F.col(k_gt) if isinstance(k_gt, str) else k_gt
    return k_gen - k_gt


def source_id(file_name: Column | str) -> Column:
    """Model name held in a result file's name: prefix and ``.csv`` removed wherever they occur."""
    column = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.replace(F.replace(column, F.lit(fixed.RESULTS_PREFIX), F.lit("")), F.lit(".csv"), F.lit(""))


def renamed_output(file_name: Column | str, suffix: str) -> Column:
    """``a.csv`` -> ``a_ready.csv`` or ``a_reference.csv``."""
    column = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.replace(column, F.lit(".csv"), F.lit(suffix))


def short_model_name(model: Column | str) -> Column:
    """The part of a model name after the last slash."""
    return F.element_at(F.split(model, "/"), -1)
