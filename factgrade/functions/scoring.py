"""Scores of an answer and the refusal rule."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions.text import word_set


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _share(part: Column, whole: Column) -> Column:
    """part / whole, at most 1; 0 when there is nothing to share."""
    return F.when(whole > 0, F.least(F.lit(1.0), part / whole)).otherwise(F.lit(0.0))


def precision_at_k(supported: Column | str, k_gen: Column | str) -> Column:
    return _share(_column(supported), _column(k_gen))


def recall_at_k(supported: Column | str, k_gt: Column | str) -> Column:
    return _share(_column(supported), _column(k_gt))


def f1_at_k(supported: Column | str, k_gen: Column | str, k_gt: Column | str) -> Column:
    p = precision_at_k(supported, k_gen)
    r = recall_at_k(supported, k_gt)
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def is_refusal(label: Column | str, score: Column | str) -> Column:
    """Disclaimers and direct answers pass; other labels count only when the classifier is sure."""
    return ~_column(label).isin(fixed.PASSING_LABELS) & (_column(score) >= fixed.REFUSAL_THRESHOLD)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, even inside a function over an array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def looks_refused(text: Column | str) -> Column:
    """Offline stand-in for the refusal classifier: a refusal phrase at a word boundary, case ignored."""
    phrases = "|".join(re.escape(p) for p in fixed.REFUSAL_PHRASES)
    return F.coalesce(F.lower(_column(text)).rlike(rf"\b(?:{phrases})\b"), F.lit(False))


def overlapping_claims(claims: Column | str, references: Column | str, share: float = 0.5) -> Column:
    """Offline stand-in for the checking model: the claims whose words mostly occur in the reference facts.

    Both lists sit on the same row, so nothing is shuffled and no claim-fact pairs are built.
    """
    claims = _column(claims)

    def supported(words: Column, known: Column) -> Column:
        return (F.size(words) > 0) & (F.size(F.array_intersect(words, known)) >= share * F.size(words))

    return _let(
        word_set(F.array_join(references, "\n")),
        lambda known: F.filter(claims, lambda claim: _let(word_set(claim), lambda words: supported(words, known))),
    )


def exact_claims(claims: Column | str, references: Column | str) -> Column:
    """The distinct claims that occur word for word among the reference facts."""
    return F.array_intersect(claims, references)
