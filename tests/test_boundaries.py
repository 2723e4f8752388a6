"""Sentence boundaries learned from texts, against a plain Python version."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from factgrade.operators import boundaries
from factgrade.plans import evaluate as ev
from factgrade.plans.prepare import prepare, sentence_rows

SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"


def word_of(token):
    return re.sub(rf"^[^{LETTER}0-9]+|[^{LETTER}0-9]+$", "", token.lower())


def tokens(text):
    return [t for t in SPACE.split(text or "") if t]


def learned(texts):
    """(abbreviations, starters) by counting in plain Python."""
    period, bare, pairs = Counter(), Counter(), Counter()
    for text in texts:
        ts = tokens(text)
        for a, b in zip(ts, [*ts[1:], None]):
            word = word_of(a)
            if word:
                (period if re.search(rf"[{LETTER}0-9]\.[^{LETTER}0-9]*$", a) else bare)[word] += 1
            if b is not None and re.search(r"""[.!?]["')\]]{0,2}$""", a) and word_of(b):
                pairs[word, word_of(b)] += 1
    n = sum(period.values()) + sum(bare.values())
    p = sum(period.values()) / n
    short = set()
    for w in set(period) | set(bare):
        letters = len(w.replace(".", ""))
        ll = 2 * (period[w] * math.log(0.99 / p) + bare[w] * math.log(0.01 / (1 - p)))
        if re.search(rf"[{LETTER}]", w) and ll * math.exp(-letters) * (len(w) - letters + 1) * letters ** -bare[w] >= 0.3:
            short.add(w)
    after = Counter()
    for (a, b), k in pairs.items():
        if a not in short and not re.fullmatch(rf"[{LETTER}]", a):
            after[b] += k
    ends, starters = sum(after.values()), set()

    def like(k, m, q):
        return (k * math.log(q) if k > 0 else 0) + ((m - k) * math.log(1 - q) if m > k else 0)

    for w, k in after.items():
        total = period[w] + bare[w]
        s, g, o = k / ends, total / n, (total - k) / (n - ends)
        if s > g and 2 * (like(k, ends, s) + like(total - k, n - ends, o) - like(k, ends, g) - like(total - k, n - ends, g)) >= 30:
            starters.add(w)
    return short, starters


def split(text, short, starters):
    out, held = [], []
    ts = tokens(text)
    for a, b in zip(ts, [*ts[1:], None]):
        held.append(a)
        end, word = b is not None and re.search(r"""[.!?]["')\]]{0,2}$""", a), word_of(a)
        if end and not re.search(r"""[!?]["')\]]{0,2}$""", a):
            small = re.match(rf"[^{LETTER}0-9]*[a-zß-öø-ÿ]", b)
            capital = re.match(rf"[^{LETTER}0-9]*[A-ZÀ-ÖØ-Þ]", b)
            if not word:
                end = not small
            elif word in short or re.fullmatch(rf"[{LETTER}]", word):
                end = bool(capital) and word_of(b) in starters
            elif re.fullmatch("[0-9]+", word):
                end = not small
        if end:
            out.append(" ".join(held))
            held = []
    return [*out, " ".join(held)] if held else out


def corpus():
    rng = random.Random(11)
    words = "house river garden Monday letter window Édouard morning teacher market bridge yellow silent number".split()
    texts = []
    for _ in range(400):
        parts = []
        for _ in range(rng.randrange(1, 7)):
            start = rng.choice(["The", "However", "He", "In"])
            middle = rng.choices(words, k=rng.randrange(2, 8))
            for i in range(len(middle)):
                if rng.random() < 0.25:
                    middle[i] = rng.choice(["Dr. Smith", "approx. five", "e.g. this", "J. Brown", "no. 3", "U.S. mail", "3. of", 'the "end." of', "wait ... or"])
            parts.append(" ".join([start, *middle]) + rng.choice([".", ".", ".", "!", "?", '."', ".)", "..."]))
        texts.append(rng.choice([" ", "  ", "\n"]).join(parts))
    return [*texts, None, "", " \n ", ".", "no end", "x" * 50_000, "Dr. " * 3000, "One. The two."]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(corpus())), "row_id int, text string").repartition(4)


def test_learned_words_and_sentences(spark, texts):
    short, starters = learned(corpus())
    assert {"dr", "approx", "e.g", "u.s"} <= short and {"the", "however"} <= starters
    assert not {"house", "monday"} & short
    model = boundaries.learn(texts)
    assert (set(model.listed[0]), set(model.listed[1])) == (short, starters)
    expected = {i: split(t, short, starters) for i, t in enumerate(corpus())}
    joined = boundaries.learn(texts, listed_words=0)
    assert joined.listed is None
    for m in (model, joined):
        got = boundaries.add_sentences(texts, m).select("row_id", "sentences").collect()
        assert {r["row_id"]: [" ".join(tokens(s)) for s in r["sentences"]] for r in got} == expected


def test_white_space_inside_sentences_stays(spark, texts):
    df = spark.createDataFrame([("Ask Dr.  Smith\tnow.  However he left.",)], "text string")
    got = boundaries.add_sentences(df, boundaries.learn(texts)).first()["sentences"]
    assert got == ["Ask Dr.  Smith\tnow.", "However he left."]


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "text string")
    model = boundaries.learn(none)
    assert model.listed == ([], [])
    df = spark.createDataFrame([("A dog. B cat.",), (None,)], "text string")
    assert [r["sentences"] for r in boundaries.add_sentences(df, model).collect()] == [["A dog.", "B cat."], []]


def test_plans_use_learned_boundaries(spark, texts):
    model = boundaries.learn(texts)
    df = spark.createDataFrame([(1, "q", "Dr. Smith came. The end came.")], "row_id bigint, prompt string, response string")
    assert prepare(df, "", learned=model).first()["response_facts"] == ["Dr. Smith came.", "The end came."]
    assert sentence_rows(df, "response", ["row_id"], model).count() == 2
    got = ev.evaluate(df, learned=model).first()
    assert (got["afg_k_gen"], got["afg_k_gt"], got["score"]) == (2, 2, 1.0)
    assert ev.evaluate(df).first()["afg_k_gen"] == 3


def test_counts_meet_once(spark, texts):
    """One shuffle for the counts of words, whatever the number of tokens."""
    plan = boundaries.word_counts(texts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(word") == 1 and "Python" not in plan
    split_ = boundaries.add_sentences(texts.select("text"), boundaries.learn(texts)).select(F.size("sentences"))
    assert "hashpartitioning" not in split_._jdf.queryExecution().executedPlan().toString()


def test_texts_are_read_once_for_each_count(spark):
    """Words and pairs are counted in one job each, whatever reads the counts later."""
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    rows = spark.createDataFrame([("Ask Dr. Smith. The end.",), ("He left. The door.",)], "text string").coalesce(1)
    boundaries.scored_words(rows.select(F.udf(seen)("text").alias("text")))[1].collect()
    assert read.value == 4


def test_many_starters_of_which_few_are_needed(spark, texts):
    """Starters beyond the limit stay outside the expression unless they stand after an abbreviation; texts stay in place."""
    short, starters = learned(corpus())
    extra = spark.createDataFrame([(f"never{i}",) for i in range(50)], "word string")
    limit = len(short) + len(starters)
    model = boundaries.learn(texts)
    many = boundaries.Boundaries(model.abbreviations, model.starters.union(extra), None, limit)
    got = boundaries.add_sentences(texts, many).select("row_id", "sentences")
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    expected = {i: split(t, short, starters) for i, t in enumerate(corpus())}
    assert {r["row_id"]: [" ".join(tokens(s)) for s in r["sentences"]] for r in got.collect()} == expected


def test_places_do_not_carry_their_text(spark):
    """Beyond the limit, what is exploded grows with the text: no place holds all pieces."""
    df = spark.createDataFrame([("Dr. Smith came. " * 20_000,)], "text string")
    model = boundaries.Boundaries(*(spark.createDataFrame([(w,)], "word string") for w in ("dr", "smith")), None, 0)
    assert len(boundaries.add_sentences(df, model).first()["sentences"]) == 40_000
