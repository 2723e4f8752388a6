"""BM25 against a direct calculation."""

import math

import pytest
from pyspark.sql import functions as F

from factgrade.operators import retrieve

CORPORA = {
    "plain": ["the cat sat on the mat", "a dog ran", "the dog and the cat", "nothing here", "cat  cat cat", "a b c d"],
    "one": ["only one here"],
    "two equal": ["same words", "same words"],
    "common terms": ["a b", "a b", "a b c", "a b", "a b", "a b"],
}
QUESTIONS = ["the cat", "dog dog ran", "zzz qqq", "a b c", "same", "only words here", "cat  sat", "b b b x"]


def brute_force(corpus, question, n=3):
    docs = [d.split(" ") for d in corpus]
    size, mean_len = len(docs), sum(map(len, docs)) / len(docs)
    df = {t: sum(t in d for d in docs) for t in {t for d in docs for t in d}}
    idf = {t: math.log(size - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    scores = []
    for i, d in enumerate(docs):
        norm = 1.5 * (1 - 0.75 + 0.75 * len(d) / mean_len)
        s = sum(idf.get(t, 0) * d.count(t) * 2.5 / (d.count(t) + norm) for t in question.split(" "))
        scores.append((round(s, 6), i))
    return [(i, s) for s, i in sorted(scores, reverse=True)[:n]]


@pytest.mark.parametrize("name", CORPORA)
@pytest.mark.parametrize("small", [True, False])
def test_top_examples(spark, name, small):
    corpus = CORPORA[name]
    examples = spark.createDataFrame(list(enumerate(corpus)), "example_id int, sentence string")
    asked = spark.createDataFrame([(q,) for q in QUESTIONS + QUESTIONS], "sentence string")
    weights = retrieve.term_weights(examples)
    weights = retrieve.Weights(weights.table, small)
    got = {}
    for r in retrieve.top_examples(asked, examples, weights=weights).orderBy("sentence", "rank").collect():
        got.setdefault(r["sentence"], []).append((r["example_id"], r["score"]))
    for q in QUESTIONS:
        expected = brute_force(corpus, q)
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in expected], abs=2e-6), q
        assert [i for i, _ in got[q]] == [i for i, _ in expected], q


def test_examples_come_best_first(spark):
    rows = [(i, s, [f"fact {i}"]) for i, s in enumerate(CORPORA["plain"])]
    examples = spark.createDataFrame(rows, "example_id int, sentence string, facts array<string>")
    asked = spark.createDataFrame([("the cat sat",)], "sentence string")
    got = retrieve.with_examples(asked, examples).first()["examples"]
    expected = [i for i, _ in brute_force(CORPORA["plain"], "the cat sat")]
    assert [e["facts"] for e in got] == [[f"fact {i}"] for i in expected]
    assert [e["sentence"] for e in got] == [CORPORA["plain"][i] for i in expected]


def test_sentences_are_shuffled_not_pairs(spark):
    examples = spark.createDataFrame(list(enumerate(CORPORA["plain"])), "example_id int, sentence string")
    asked = spark.createDataFrame([(q,) for q in QUESTIONS], "sentence string")
    weights = retrieve.Weights(retrieve.term_weights(examples).table.select(F.col("*")), True)
    plan = retrieve.top_examples(asked, examples, weights=weights)._jdf.queryExecution().executedPlan().toString()
    above_join = plan.split("BroadcastHashJoin")[0]
    assert "Exchange" not in above_join
    assert "WindowGroupLimit" in above_join


def test_scores_are_summed_by_number(spark):
    """Neither scores nor ranks are keyed by the text of a sentence."""
    examples = spark.createDataFrame(list(enumerate(CORPORA["plain"])), "example_id int, sentence string")
    asked = spark.createDataFrame([(q,) for q in QUESTIONS], "sentence string")
    weights = retrieve.Weights(retrieve.term_weights(examples).table, True)
    plan = retrieve.top_examples(asked, examples, weights=weights)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[_id" in plan and "keys=[sentence" not in plan
