"""Sentence boundaries learned from the texts themselves.

Whether a period ends a sentence depends on the word before it.  A word that nearly always has a period, is short and
may have more periods inside is an abbreviation; a word that comes after sentence ends more often than chance allows
is a frequent sentence starter, and opens a sentence even after an abbreviation.  Both are likelihood-ratio tests over
counts of the whole corpus (Kiss and Strunk, Unsupervised Multilingual Sentence Boundary Detection, 2006), so nothing
is trained by hand and no word list is needed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgrade.functions.text import strip
from factgrade.operators import skew
from factgrade.sources import shared

# Fixed values of the published method.
ABBREVIATION_SCORE = 0.3
STARTER_SCORE = 30.0
PERIOD_IF_ABBREVIATION = 0.99

#: So many learned words may travel inside an expression; more are joined.
LISTED_WORDS = 20_000

SPACE = r" \t\n\x0B\f\r"
CLOSERS = r"""["')\]]"""
TOKEN = rf"[^{SPACE}]+"
EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
HAS_PERIOD = r"[\p{L}\p{N}]\.[^\p{L}\p{N}]*$"
SENTENCE_END = rf"[.!?]{CLOSERS}{{0,2}}$"
CALL_END = rf"[!?]{CLOSERS}{{0,2}}$"
CAPITAL = r"^[^\p{L}\p{N}]*\p{Lu}"
SMALL = r"^[^\p{L}\p{N}]*\p{Ll}"
CUT = rf"(?<=[.!?]{CLOSERS}{{0,2}})(?=[{SPACE}])"


def word_of(token: Column) -> Column:
    """The lower-case word of a token, without what stands around it; periods inside stay."""
    return F.regexp_replace(F.lower(token), EDGES, "")


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n_period, n_bare): how often each word has a period after it, and how often not.

    Tokens are counted as they stand; only distinct ones are looked at.
    """
    tokens = texts.select(F.explode(F.split(text, f"[{SPACE}]+")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    words = tokens.select(word_of(F.col("token")).alias("word"), F.col("token").rlike(HAS_PERIOD).alias("period"), "n")
    return (
        words.where(F.col("word") != "")
        .groupBy("word")
        .agg(
            F.coalesce(F.sum(F.when(F.col("period"), F.col("n"))), F.lit(0)).alias("n_period"),
            F.coalesce(F.sum(F.when(~F.col("period"), F.col("n"))), F.lit(0)).alias("n_bare"),
        )
    )


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """``counts`` with ``score``: how much better "always a period" explains a word than chance does.

    Long words and those that also occur without a period are marked down, periods inside count in favour.  One row
    with the totals comes to the driver.
    """
    total = counts.agg(F.sum("n_period").alias("p"), F.sum(F.col("n_period") + F.col("n_bare")).alias("n")).first()
    chance = min(max((total["p"] or 0) / max(total["n"] or 0, 1), 1e-9), 1 - 1e-9)
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    ratio = F.col("n_period") * F.log(F.lit(PERIOD_IF_ABBREVIATION / chance)) + F.col("n_bare") * F.log(
        F.lit((1 - PERIOD_IF_ABBREVIATION) / (1 - chance))
    )
    inside = F.length("word") - letters + 1
    score = 2 * ratio * F.exp(-letters) * inside * F.pow(letters.cast("double"), -F.col("n_bare").cast("double"))
    return counts.withColumn("score", F.when(F.col("word").rlike(r"\p{L}"), score).otherwise(0.0))


def _pieces(text: Column) -> Column:
    """The text cut wherever a sentence might end; pieces keep the white space before them."""
    return F.split(F.coalesce(text, F.lit("")), CUT)


def _last(piece: Column) -> Column:
    # From the end: a search from the start would try every token of the piece.
    return F.regexp_extract(piece, rf"(?s)\A(?:.*[{SPACE}])?({TOKEN})\z", 1)


def _first(piece: Column) -> Column:
    return F.regexp_extract(piece, f"^[{SPACE}]*({TOKEN})", 1)


def starter_scores(texts: DataFrame, counts: DataFrame, abbreviations: DataFrame, text: str = "text") -> DataFrame:
    """(word, n_after, n, score): words after sure sentence ends, and the likelihood ratio of the two going together.

    Sure is an end whose word is neither an abbreviation nor a single letter.  Pairs of words are counted before they
    meet the abbreviations, and are stored, so that the texts are read once.  ``counts`` and ``abbreviations`` are read
    several times: give stored tables.
    """
    pieces = texts.select(_pieces(F.col(text)).alias("p"))
    numbers = F.when(F.size("p") > 1, F.sequence(F.lit(1), F.size("p") - 1)).otherwise(F.array().cast("array<int>"))
    pairs = pieces.select(
        F.explode(F.transform(numbers, lambda i: F.struct(_last(F.get("p", i - 1)).alias("a"), _first(F.get("p", i)).alias("b")))).alias("x")
    )
    pairs = pairs.groupBy("x.a", "x.b").agg(F.count("*").alias("n"))
    seen = pairs.select(word_of(F.col("a")).alias("before"), word_of(F.col("b")).alias("word"), "n")
    seen = seen.where(F.col("word") != "").groupBy("before", "word").agg(F.sum("n").alias("k"))
    seen = shared.materialise(seen, "pairs")
    known = abbreviations.select(F.col("word").alias("before"), F.lit(True).alias("known"))
    sure = skew.lookup_join(seen, known, ["before"]).where(F.col("known").isNull() & ~F.col("before").rlike(r"^\p{L}$"))
    after = sure.groupBy("word").agg(F.sum("k").alias("n_after"))
    both = after.join(counts.select("word", (F.col("n_period") + F.col("n_bare")).alias("n")), "word")
    both = shared.materialise(both, "starts")
    ends = both.agg(F.coalesce(F.sum("n_after"), F.lit(0))).first()[0]
    total = counts.agg(F.coalesce(F.sum(F.col("n_period") + F.col("n_bare")), F.lit(0))).first()[0]
    together, alone = F.col("n_after").cast("double"), F.col("n") - F.col("n_after").cast("double")
    inside, outside = F.lit(float(ends)), F.lit(float(total - ends))

    def likelihood(k: Column, n: Column, p: Column) -> Column:
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(n > k, (n - k) * F.log(1 - p)).otherwise(0.0)

    share, general = together / inside, F.col("n") / F.lit(float(max(total, 1)))
    ratio = 2 * (
        likelihood(together, inside, share)
        + likelihood(alone, outside, alone / outside)
        - likelihood(together, inside, general)
        - likelihood(alone, outside, general)
    )
    return both.withColumn("score", F.when(share > general, ratio).otherwise(0.0))


@dataclass(frozen=True)
class Boundaries:
    """Learned words as tables of one column, ``word``, and as lists where they are few enough."""

    abbreviations: DataFrame
    starters: DataFrame
    listed: tuple[list[str], list[str]] | None
    listed_words: int = LISTED_WORDS


def scored_words(texts: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The abbreviations as a stored table of one column, ``word``, and the starters with their scores.

    Both come from two passes over the texts: one counts words, one counts pairs around possible ends.
    """
    counts = shared.materialise(word_counts(texts, text), "words")
    scores = abbreviation_scores(counts)
    short = shared.materialise(scores.where(F.col("score") >= ABBREVIATION_SCORE).select("word"), "abbreviations")
    return short, starter_scores(texts, counts, short, text)


def learn(texts: DataFrame, text: str = "text", listed_words: int = LISTED_WORDS) -> Boundaries:
    """Abbreviations and sentence starters of a corpus, from two aggregations over all of it."""
    short, found = scored_words(texts, text)
    starters = shared.materialise(found.where(F.col("score") >= STARTER_SCORE).select("word"), "starters")
    listed = None
    if short.count() + starters.count() <= listed_words:
        listed = tuple(sorted(r["word"] for r in table.collect()) for table in (short, starters))
    return Boundaries(short, starters, listed, listed_words)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _ends(before: Column, after: Column, short: Callable[[Column], Column], starter: Callable[[Column], Column]) -> Column:
    """Whether a sentence ends between two tokens, the first of which has a mark for it."""

    def decide(x: Column) -> Column:
        word = x["word"]
        abbreviated = _abbreviated(word, short)
        return (
            F.when(x["before"].rlike(CALL_END), True)
            .when(word == "", ~x["after"].rlike(SMALL))
            .when(abbreviated, x["after"].rlike(CAPITAL) & starter(word_of(x["after"])))
            .when(word.rlike(r"^\p{N}+$"), ~x["after"].rlike(SMALL))
            .otherwise(True)
        )

    return _once(F.struct(before.alias("before"), after.alias("after"), word_of(before).alias("word")), decide)


def _among(words: list[str]) -> Callable[[Column], Column]:
    return lambda c: c.isin(words) if words else F.lit(False)


def _sentences(pieces: Column, ends: Column) -> Column:
    """The pieces joined over all cuts but those numbered in ``ends``; cut i comes before piece i, counted from 0."""

    def between(starts: Column) -> Column:
        def from_to(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(starts, i + 1), F.size(pieces))
            return strip(F.array_join(F.slice(pieces, start + 1, end - start), ""))

        return F.filter(F.transform(starts, from_to), lambda s: s != "")

    return _once(F.concat(F.array(F.lit(0)), ends), between)


def _marked(text: Column) -> Column:
    """The pieces of a text, with the last and the first token of each as ``marks``."""

    def marked(pieces: Column) -> Column:
        marks = F.transform(pieces, lambda p: F.struct(_last(p).alias("last"), _first(p).alias("first")))
        return F.struct(pieces.alias("pieces"), marks.alias("marks"))

    return _once(_pieces(text), marked)


def _cuts(marks: Column) -> Column:
    return F.when(F.size(marks) > 1, F.sequence(F.lit(1), F.size(marks) - 1)).otherwise(F.array().cast("array<int>"))


def _abbreviated(word: Column, short: Callable[[Column], Column]) -> Column:
    return short(word) | word.rlike(r"^\p{L}$")


def _real_cuts(marks: Column, short: Callable[[Column], Column], starter: Callable[[Column], Column]) -> Column:
    return F.filter(_cuts(marks), lambda i: _ends(F.get(marks, i - 1)["last"], F.get(marks, i)["first"], short, starter))


def _doubtful(df: DataFrame, short: Callable[[Column], Column], text: str) -> DataFrame:
    """(word): what stands with a capital after abbreviations and initials; no other word is looked for among the starters."""

    def words(x: Column) -> Column:
        marks = x["marks"]
        pairs = F.transform(_cuts(marks), lambda i: F.struct(F.get(marks, i - 1)["last"].alias("before"), F.get(marks, i)["first"].alias("after")))
        found = F.filter(pairs, lambda x: ~x["before"].rlike(CALL_END) & x["after"].rlike(CAPITAL) & _abbreviated(word_of(x["before"]), short))
        return F.transform(found, lambda x: x["after"])

    tokens = df.select(F.explode(_once(_marked(F.col(text)), words)).alias("token")).distinct()
    return tokens.select(word_of(F.col("token")).alias("word")).distinct()


def _listed(df: DataFrame, model: Boundaries, text: str) -> tuple[list[str], list[str]] | None:
    """Abbreviations, and those starters that ``df`` needs, where they are few enough for an expression."""
    if model.listed is not None:
        return model.listed
    if model.abbreviations.count() > model.listed_words:
        return None
    short = sorted(r["word"] for r in model.abbreviations.collect())
    needed = model.starters.join(_doubtful(df, _among(short), text), "word", "left_semi")
    starters = sorted(r["word"] for r in needed.limit(model.listed_words + 1).collect())
    return (short, starters) if len(short) + len(starters) <= model.listed_words else None


def add_sentences(df: DataFrame, model: Boundaries, text: str = "text", column: str = "sentences") -> DataFrame:
    """``df`` with the sentences of a text as an array; a null text has none.

    Few learned words are part of the expression and nothing leaves the row.  Of too many, those that decide something
    in these texts are found by a pass over them first.  If these are too many as well, words are joined to the
    places in question, and only row numbers and places are shuffled before the texts meet them.
    """
    listed = _listed(df, model, text)
    if listed is not None:
        short, starters = (_among(words) for words in listed)

        def split(x: Column) -> Column:
            return _once(_real_cuts(x["marks"], short, starters), lambda ends: _sentences(x["pieces"], ends))

        return df.withColumn(column, _once(_marked(F.col(text)), split))
    numbered = shared.materialise(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")

    def pairs(x: Column) -> Column:
        def pair(i: Column) -> Column:
            return F.struct(i.alias("i"), F.get(x["marks"], i - 1)["last"].alias("before"), F.get(x["marks"], i)["first"].alias("after"))

        return F.transform(_cuts(x["marks"]), pair)

    # A place by itself: no row carries its text along.
    places = numbered.select("_row", F.explode(_once(_marked(F.col(text)), pairs)).alias("x")).select("_row", "x.*")
    places = places.withColumns({"_short": word_of(F.col("before")), "_starter": word_of(F.col("after"))})
    for table, key in ((model.abbreviations, "_short"), (model.starters, "_starter")):
        known = table.select(F.col("word").alias(key), F.lit(True).alias(f"{key}_known"))
        places = skew.lookup_join(places, known, [key])
    known = [lambda _, k=k: F.col(f"{k}_known").isNotNull() for k in ("_short", "_starter")]
    ends = places.where(_ends(F.col("before"), F.col("after"), *known)).groupBy("_row").agg(F.sort_array(F.collect_list("i")).alias("_ends"))
    joined = numbered.join(ends, "_row", "left").withColumn("_ends", F.coalesce("_ends", F.array().cast("array<int>")))
    joined = joined.withColumn("_pieces", _pieces(F.col(text)))
    return joined.withColumn(column, _sentences(F.col("_pieces"), F.col("_ends"))).drop("_row", "_pieces", "_ends")
