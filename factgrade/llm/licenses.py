"""License notices: fixed phrases, and an exact set-similarity join of text blocks with license templates.

Tokens are ordered by their frequency over all documents, the rarest first.  A block contains a template to the
share ``threshold`` only if it holds one of the template's first tokens in this order (prefix filter), has enough
tokens (length filter), and has enough tokens left after the place where both lists meet (positional filter).  What
passes is counted exactly.  Everything is a column expression: blocks of a document never leave their row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: The phrases of the base rule and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices as their licenses word them.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "all rights reserved"),
)
#: Between words: ASCII characters other than letters and digits.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """Lower-cased words; empty strings may stand at the ends.

    ``lower`` also changes letters beyond A-Z.  That moves no word boundary and makes no listed phrase or token out
    of another word, for none of them can come from such a letter.
    """
    return F.split(F.lower(text), GAP)


def count_words(words: Column) -> Column:
    ends = (F.element_at(words, 1) == "").cast("int") + ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")
    return (F.size(words) - ends).cast("bigint")


def phrase_starts(words: Column, phrase: list[str]) -> Column:
    """Positions from 0 at which the words of the phrase follow one another."""
    first = F.when(F.element_at(words, 1) == "", 1).otherwise(0)
    at = F.filter(
        F.transform(words, lambda w, i: F.when(w == phrase[0], i)),
        lambda i: i.isNotNull(),
    )
    rest = list(enumerate(phrase[1:], 1))
    at = F.filter(at, lambda i: reduce(lambda a, b: a & b, [F.get(words, i + k) == word for k, word in rest]))
    return F.transform(at, lambda i: (i - first).cast("bigint"))


def constant(value: str) -> Callable[[Column], Column]:
    return lambda _: F.lit(value)


def array_of(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


class Index:
    """Templates as ranks of tokens in frequency order, with an index from prefix tokens to templates."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[str, int], threshold: float) -> None:
        self.tokens = [set(re.findall("[0-9a-z]+", text)) for _, text in templates]
        self.labels = [label for label, _ in templates]
        self.order = sorted(set().union(*self.tokens), key=lambda t: (frequency.get(t, 0), t))
        rank = {t: k for k, t in enumerate(self.order)}
        self.ranks = [sorted(rank[t] for t in tokens) for tokens in self.tokens]
        self.need = [math.ceil(threshold * len(r) - 1e-9) for r in self.ranks]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for template, (ranks, need) in enumerate(zip(self.ranks, self.need)):
            for place, r in enumerate(ranks[: len(ranks) - need + 1]):
                self.prefix.setdefault(r, []).append((template, place))

    def prefix_tokens(self) -> list[str]:
        return [self.order[r] for r in sorted(self.prefix)]

    def matches(self, block_words: Column) -> Column:
        """Templates that a block contains: array of struct(label, containment)."""
        rank_of = F.map_from_arrays(array_of(self.order), array_of(list(range(len(self.order)))))
        sizes = [len(r) for r in self.ranks]
        entries = F.map_from_arrays(
            array_of(sorted(self.prefix)),
            F.array(
                *[
                    F.array(*[F.struct(F.lit(t).alias("t"), F.lit(sizes[t] - p).alias("left"), F.lit(self.need[t]).alias("need")) for t, p in self.prefix[r]])
                    for r in sorted(self.prefix)
                ]
            ),
        )
        lists = F.array(*[array_of(r) for r in self.ranks])
        ranked = F.array_sort(F.transform(F.array_intersect(block_words, array_of(self.order)), lambda w: rank_of[w]))

        def candidates(ranks: Column) -> Column:
            found = F.transform(
                ranks,
                lambda r, q: F.filter(
                    F.coalesce(entries[r], F.filter(entries[F.lit(min(self.prefix))], lambda e: F.lit(False))),
                    lambda e: (F.size(ranks) >= e["need"]) & (F.least(e["left"], F.size(ranks) - q) >= e["need"]),
                ),
            )
            return F.array_distinct(F.transform(F.flatten(found), lambda e: e["t"]))

        def verified(ranks: Column) -> Column:
            counted = F.transform(
                candidates(ranks),
                lambda t: F.struct(t.alias("t"), F.size(F.array_intersect(ranks, F.get(lists, t))).alias("n")),
            )
            enough = F.filter(counted, lambda c: c["n"] >= F.get(array_of(self.need), c["t"]))
            return F.transform(
                enough,
                lambda c: F.struct(
                    F.get(array_of(self.labels), c["t"]).alias("label"), (c["n"] / F.get(array_of(sizes), c["t"])).alias("containment")
                ),
            )

        return F.flatten(F.transform(F.array(ranked), verified))


def token_frequency(docs: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many documents each of the given tokens stands; one small row per token reaches the driver."""
    there = F.array_intersect(split_words(F.col("text")), array_of(tokens))
    rows = docs.select(F.explode(there).alias("token")).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def blocks(text: Column) -> Column:
    """Lines, and paragraphs of several lines."""
    return F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n")))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Adds ``n_words``, ``places`` and ``matches`` of each whole ``text`` to the columns of ``keep``.

    ``places`` are starts of the fixed phrases with their labels, ``matches`` the labels and containments of the
    templates that some line or paragraph holds to at least ``threshold``.  Null and empty texts have neither.
    Rows are independent: repeated ones are kept, and an empty table gives an empty one.  The templates are a
    constant of a few rows; they and their tokens are part of the expressions.
    """
    keep = ["doc_id"] if keep is None else keep
    tokens = sorted({t for _, text in templates for t in re.findall("[0-9a-z]+", text)})
    clean = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    index = Index(list(templates), token_frequency(clean.select(F.col("_text").alias("text")), tokens), threshold)
    split = clean.withColumn("_words", split_words(F.col("_text")))
    words = F.col("_words")
    heads = sorted({p.split()[0] for p in PHRASES})
    places = F.flatten(
        F.array(
            *[
                F.arrays_zip(starts.alias("start"), F.transform(starts, constant(label)).alias("label"))
                for starts, label in ((phrase_starts(words, p.split()), label) for p, label in PHRASES.items())
            ]
        )
    )
    found = F.flatten(F.transform(blocks(F.col("_text")), lambda b: index.matches(F.array_distinct(split_words(b)))))
    none = "cast(array() as array<struct<{}>>)"
    return split.select(
        *keep,
        count_words(words).alias("n_words"),
        F.when(F.arrays_overlap(words, array_of(heads)), places).otherwise(F.expr(none.format("start:bigint,label:string"))).alias("places"),
        F.when(F.arrays_overlap(words, array_of(index.prefix_tokens())), found)
        .otherwise(F.expr(none.format("label:string,containment:double")))
        .alias("matches"),
    )


def label_text(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
