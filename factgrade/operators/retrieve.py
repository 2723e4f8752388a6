"""BM25: find the example sentences that are most like a sentence.

Examples are ``(example_id, sentence, facts)``; of two equally good ones the higher id wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions.text import tokens
from factgrade.operators import skew
from factgrade.sources import shared

# Splitting at single spaces never yields a token that holds a space, so this one is free.
PAD = " "
FAN_OUT = 2


def _postings(examples: DataFrame) -> DataFrame:
    """(example_id, len, term, tf): how often each term occurs in each example."""
    listed = examples.select("example_id", tokens("sentence").alias("_t"))
    return (
        listed.select("example_id", F.size("_t").alias("len"), F.explode("_t").alias("term"))
        .groupBy("example_id", "len", "term")
        .agg(F.count("*").alias("tf"))
    )


def corpus_stats(examples: DataFrame) -> DataFrame:
    """One row: number of examples, their mean length in tokens, and a bound on the weight table's bytes."""
    length = F.size(tokens("sentence"))
    return examples.agg(
        F.count("*").alias("n_examples"),
        F.avg(length).alias("avg_len"),
        F.sum(F.octet_length("sentence") + 256 * length).alias("weight_bytes"),
    )


def _raw_idf(n: int, df: Column) -> Column:
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def _idf_summary(examples: DataFrame, n: int) -> Row:
    """Mean and lowest idf over the terms, before any replacement."""
    df = _postings(examples).groupBy("term").agg(F.count("*").alias("df"))
    return df.agg(F.avg(_raw_idf(n, F.col("df"))).alias("mean"), F.min(_raw_idf(n, F.col("df"))).alias("low")).first()


def _idf(n: int, mean: float | None, df: Column) -> Column:
    """An idf below zero becomes a fixed part of the mean idf."""
    raw = _raw_idf(n, df)
    return F.when(raw < 0, fixed.BM25_EPSILON * (mean or 0.0)).otherwise(raw)


def term_stats(examples: DataFrame) -> DataFrame:
    """(term, df, idf)."""
    n = corpus_stats(examples).first()["n_examples"]
    mean = _idf_summary(examples, n)["mean"]
    found = _postings(examples).groupBy("term").agg(F.count("*").alias("df"))
    return found.withColumn("idf", _idf(n, mean, F.col("df")))


@dataclass(frozen=True)
class Weights:
    """``table`` is (term, example_id, weight): what one occurrence of a term in a query adds to a score.

    The pad term gives weight 0 to the examples that win when nothing matches: the last ones.  Should any
    weight be negative, an example that shares no term can beat one that does, so all are padded then.
    ``small`` says whether the table may be broadcast.
    """

    table: DataFrame
    small: bool


def term_weights(examples: DataFrame, n: int = fixed.EXAMPLES_SHOWN) -> Weights:
    """Weights of an example corpus.  Two one-row results come to the driver: corpus figures and mean idf."""
    corpus = corpus_stats(examples).first()
    idf = _idf_summary(examples, corpus["n_examples"])
    tf, avg_len = F.col("tf"), corpus["avg_len"] or 1.0
    postings = _postings(examples)
    frequency = postings.groupBy("term").agg(F.count("*").alias("df"))
    small = (corpus["weight_bytes"] or 0) <= skew.BROADCAST_LIMIT_BYTES
    norm = fixed.BM25_K1 * (1 - fixed.BM25_B + fixed.BM25_B * F.col("len") / avg_len)
    weight = _idf(corpus["n_examples"], idf["mean"], F.col("df")) * tf * (fixed.BM25_K1 + 1) / (tf + norm)
    counted = skew.lookup_join(postings, frequency, ["term"], "inner", small=small)
    scored = counted.select("term", "example_id", weight.alias("weight"))
    padded = examples.select("example_id")
    if (idf["mean"] or 0.0) >= 0:
        padded = padded.orderBy(F.desc("example_id")).limit(n)
    pads = padded.select(F.lit(PAD).alias("term"), "example_id", F.lit(0.0).alias("weight"))
    return Weights(scored.unionByName(pads), small)


def _numbered(sentences: DataFrame) -> DataFrame:
    """(_id, sentence): the distinct sentences, stored so that their numbers stay, and spread by number.

    They go to more partitions than the shuffle made, because each sentence grows by the number of examples it shares a
    term with; from there on scoring and ranking stay in the partition, on numbers instead of texts.
    """
    asked = sentences.select("sentence").where(F.col("sentence").isNotNull()).distinct()
    asked = shared.materialise(asked.withColumn("_id", F.monotonically_increasing_id()).select("_id", "sentence"), "asked")
    return asked.repartition(FAN_OUT * skew.shuffle_partitions(asked), "_id")


def _best(asked: DataFrame, n: int, weights: Weights) -> DataFrame:
    """(_id, rank, example_id, score)."""
    query = asked.select("_id", F.explode(F.concat(tokens("sentence"), F.array(F.lit(PAD)))).alias("term"))
    scored = (
        skew.lookup_join(query, weights.table, ["term"], "inner", small=weights.small)
        .groupBy("_id", "example_id")
        .agg(F.round(F.sum("weight"), 6).alias("score"))
    )
    best = Window.partitionBy("_id").orderBy(F.desc("score"), F.desc("example_id"))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n).select("_id", "rank", "example_id", "score")


def top_examples(
    sentences: DataFrame, examples: DataFrame, n: int = fixed.EXAMPLES_SHOWN, weights: Weights | None = None
) -> DataFrame:
    """(sentence, rank, example_id, score) for each distinct sentence; ties go to the higher id.

    Repeats are dropped first.
    """
    asked = _numbered(sentences)
    best = _best(asked, n, weights or term_weights(examples, n))
    return best.join(asked.hint("merge"), "_id").select("sentence", "rank", "example_id", "score")


def with_examples(sentences: DataFrame, examples: DataFrame, n: int = fixed.EXAMPLES_SHOWN) -> DataFrame:
    """(sentence, examples): each distinct sentence with its best examples, best first."""
    weights = term_weights(examples, n)
    asked = _numbered(sentences)
    chosen = _best(asked, n, weights)
    texts = examples.select("example_id", F.struct("sentence", "facts").alias("shown"))
    listed = skew.lookup_join(chosen, texts, ["example_id"], "inner", small=weights.small)
    ranked = F.sort_array(F.collect_list(F.struct("rank", "shown")))
    shown = listed.groupBy("_id").agg(F.transform(ranked, lambda r: r["shown"]).alias("examples"))
    return shown.join(asked.hint("merge"), "_id").select("sentence", "examples")
