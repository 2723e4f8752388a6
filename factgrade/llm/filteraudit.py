"""Audit of a set of filters: what each removes in every order of application, and its fair share.

The states of the audit are the subsets of filters that were applied; an edge adds one filter.  What an edge removes
depends on its state alone, so the k! orders share 2^k states and k 2^(k-1) edges.  Counting the orders that reach a
state (forward) and that lead from one to the end (backward) weights every edge by the orders that run through it:
the weighted sum of an edge's removals is its part of the Shapley value, and the steps of an order are read from the
edges on its path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from hashlib import sha256
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factgrade.llm.common import map_rows, materialise, utf8
from factgrade.operators.skew import salted_join

#: Bits of the filters on a text alone.
SHORT, REPETITIVE, CAPITALS, SYMBOLS = 1, 2, 4, 8
#: Bit of the filter on repeated texts.
COPY = 16
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
CAPITAL_BYTES, SYMBOL_BYTES = bytes(range(0x41, 0x5B)), b"#$%&*|"


def failed_bits(text: str | None) -> int:
    """Which of the text filters a text fails; a null text is empty."""
    data = utf8(text)
    words = data.split()
    bits = SHORT if len(words) < MIN_WORDS else 0
    if 100 * len(set(words)) < DISTINCT_PERCENT * len(words):
        bits |= REPETITIVE
    if 100 * (len(data) - len(data.translate(None, CAPITAL_BYTES))) > CAPITAL_PERCENT * len(text or ""):
        bits |= CAPITALS
    return bits | SYMBOLS if len(data) != len(data.translate(None, SYMBOL_BYTES)) else bits


def _checker() -> Callable[[list[str | None]], list[tuple]]:
    return lambda texts: [(failed_bits(t), sha256(utf8(t)).digest()) for t in texts]


def failed_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents per language and set of failed filters (a sum of bits).

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic; other columns are not read.  A null text
    is empty, a null language the part ``""``.  A copy is a row whose text a row with a smaller id has, too; rows that
    share the smallest id are not copies, and a row without an id is none and makes none.  A document that several
    label rows name is good, or toxic, if one of them says so.  Repeated rows count one by one.

    Texts stand for themselves by their SHA-256.  Equal rows are counted before they are shuffled, and a text's rows
    are reduced to a few per language before its smallest id is looked up, so a hot text or source is no burden.
    """
    named = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("part"))
    thin = map_rows(named, ["text"], _checker, "bits int, digest binary", ["doc_id", "part"])
    thin = materialise(thin.groupBy("doc_id", "part", "bits", "digest").agg(F.count("*").alias("n")), "failed")
    told = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = salted_join(thin, told, ["doc_id"]).na.fill({"good": False, "toxic": False})
    numbered = F.col("doc_id").isNotNull()
    per_text = marked.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(numbered, F.col("n"))), F.lit(0)).alias("n_numbered"),
        F.min(F.when(numbered, F.struct("doc_id", "n"))).alias("first"),
    )
    lowest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    copies = F.col("n_numbered") - F.when(F.col("first.doc_id") == lowest, F.col("first.n")).otherwise(0)
    kinds = per_text.withColumn("copies", F.coalesce(copies, F.lit(0)))
    both = F.array(
        F.struct(F.col("bits").alias("failed"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("bits") + COPY).alias("failed"), F.col("copies").alias("n")),
    )
    counted = kinds.select("part", "good", "toxic", F.inline(both))
    return counted.groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """For every subset of ``k`` filters: in how many orders it is reached, and in how many it can be completed."""
    full = 2**k - 1
    reaching, leaving = [0] * (full + 1), [0] * (full + 1)
    reaching[0] = leaving[full] = 1
    for state in range(1, full + 1):
        reaching[state] = sum(reaching[state ^ 1 << f] for f in range(k) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        leaving[state] = sum(leaving[state | 1 << f] for f in range(k) if not state >> f & 1)
    return reaching, leaving


def lattice(k: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders that run through this edge)."""
    reaching, leaving = path_counts(k)
    return [(s, f, reaching[s] * leaving[s | 1 << f]) for s in range(2**k) for f in range(k) if not s >> f & 1]


def order_steps(names: str) -> Iterable[tuple[str, int, int, int]]:
    """(order, step, state before it, filter) for every order of the filters."""
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            yield "".join(names[i] for i in order), step, state, f
            state |= 1 << f


def audit(sets: DataFrame, names: str = FILTERS) -> DataFrame:
    """What every filter does at every step of every order, per part.

    ``sets`` is (part, failed, n, good, toxic): weighted sets of failed filters, bit i for the i-th letter of
    ``names``; several rows of a set are added up.  Returns part, filter_order, step and the counts kept, removed,
    redundant, unique_fails, good_lost, toxic_lost and shapley.  No sets, no rows.  Orders and edges grow with the
    factorial of the number of filters, so there may be at most 7; the number of documents plays no part here.
    """
    if not 1 <= len(names) <= 7:
        raise ValueError("1 to 7 filters")
    spark = sets.sparkSession
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(w).alias("orders")) for s, f, w in lattice(len(names))])
    failed, bit, state = F.col("failed"), F.expr("shiftleft(1, e.filter)"), F.col("e.state")
    before, here = failed.bitwiseAND(state) != 0, failed.bitwiseAND(bit) != 0

    def total(condition: Column, n: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0)).cast("bigint")

    reduced = sets.groupBy("part", "failed").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    on_edges = (
        reduced.withColumn("e", F.explode(edges))
        .groupBy("part", "e.state", "e.filter", "e.orders")
        .agg(
            total(~before & ~here).alias("kept"),
            total(~before & here).alias("removed"),
            total(before & here).alias("redundant"),
            total(failed == bit).alias("unique_fails"),
            total(~before & here, "good").alias("good_lost"),
            total(~before & here, "toxic").alias("toxic_lost"),
        )
    )
    share = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter"))
    on_edges = on_edges.withColumn("shapley", share.cast("bigint"))
    steps = spark.createDataFrame(list(order_steps(names)), "filter_order string, step int, state int, filter int")
    return on_edges.join(F.broadcast(steps), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
