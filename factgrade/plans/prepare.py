"""Ground truth -> table of facts, computed once and reused by every evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgrade.functions import facts as fx
from factgrade.functions.prompts import split_messages
from factgrade.functions.text import sentences
from factgrade.operators import replies, retrieve, skew
from factgrade.operators.boundaries import Boundaries, add_sentences
from factgrade.sources import storage


def sentence_rows(df: DataFrame, text: str, keys: list[str], learned: Boundaries | None = None) -> DataFrame:
    """(keys, sentence_no, sentence), numbered from 0; ``learned`` boundaries take the place of the fixed rule."""
    if learned is None:
        return df.select(*keys, F.posexplode(sentences(text)).alias("sentence_no", "sentence"))
    split = add_sentences(df.select(*keys, text), learned, text, "_sentences")
    return split.select(*keys, F.posexplode("_sentences").alias("sentence_no", "sentence"))


def with_facts(df: DataFrame, text: str, learned: Boundaries | None, column: str) -> DataFrame:
    """Offline stand-in for the splitting model, added as a column: every sentence is one fact."""
    return df.withColumn(column, fx.sentence_facts(text)) if learned is None else add_sentences(df, learned, text, column)


def split_prompts(sentence_table: DataFrame, examples: DataFrame | None = None) -> DataFrame:
    """(sentence, messages, prompt_hash) for each distinct sentence."""
    if examples is None or examples.isEmpty():
        asked = sentence_table.select("sentence").distinct().withColumn("messages", split_messages("sentence"))
    else:
        asked = retrieve.with_examples(sentence_table, examples).select(
            "sentence", split_messages("sentence", F.col("examples")).alias("messages")
        )
    return replies.with_prompt_hash(asked)


def collect_facts(fact_rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, facts, failed_calls): the fact lists of a text's sentences, joined in order.

    A sentence without an outcome counts as failed.
    """
    ordered = F.sort_array(F.collect_list(F.struct("sentence_no", F.coalesce("facts", fx.no_facts()).alias("facts"))))
    return fact_rows.groupBy(*keys).agg(
        F.flatten(F.transform(ordered, lambda o: o["facts"])).alias("facts"),
        F.sum(F.coalesce("failed", F.lit(1))).cast("int").alias("failed_calls"),
    )


def derive_facts(
    df: DataFrame,
    text: str,
    store: str,
    make_backend: Callable | None,
    examples: DataFrame | None = None,
    keys: tuple[str, ...] = ("row_id",),
    parallel: int | None = None,
    commits: int = replies.COMMITS,
    rounds: int = 1,
    learned: Boundaries | None = None,
) -> DataFrame:
    """(keys, facts, failed_calls) of a text column; texts without sentences may be left out.

    Without a backend every sentence is one fact and nothing leaves the row.
    """
    keys = list(keys)
    if make_backend is None:
        return with_facts(df, text, learned, "facts").select(*keys, "facts", F.lit(0).alias("failed_calls"))
    rows = storage.materialise(sentence_rows(df, text, keys, learned), "sentences")
    prompts = storage.materialise(split_prompts(rows, examples), "prompts")
    stored = replies.ask_pending(
        prompts.select("prompt_hash", "messages"), store, make_backend, parallel, commits=commits, rounds=rounds
    )
    asked = prompts.select("sentence", "prompt_hash")
    small = skew.fits_broadcast(stored, asked)
    per_sentence = replies.join_replies(asked, stored, small).select(
        "sentence",
        F.when(F.col("status") == "ok", fx.listed_facts("reply")).otherwise(fx.no_facts()).alias("facts"),
        (F.col("status") != "ok").cast("int").alias("failed"),
    )
    return collect_facts(skew.lookup_join(rows, per_sentence, ["sentence"], small=small), keys)


def prepare(
    df: DataFrame,
    store: str,
    make_backend: Callable | None = None,
    examples: DataFrame | None = None,
    parallel: int | None = None,
    commits: int = replies.COMMITS,
    rounds: int = 1,
    learned: Boundaries | None = None,
) -> DataFrame:
    """All columns of the dataset plus response_facts and response_facts_count; needs a stable ``row_id``.

    Calls that fail for the moment are made again in up to ``rounds`` rounds.  ``learned`` are sentence boundaries from
    ``boundaries.learn``, for texts with abbreviations.
    """
    if make_backend is None:
        listed = with_facts(df, "response", learned, "response_facts")
    else:
        derived = derive_facts(
            df, "response", store, make_backend, examples, parallel=parallel, commits=commits, rounds=rounds, learned=learned
        )
        # Written once: whoever stitches the facts measures and reads the table more than once.
        listed = storage.materialise(df.join(derived.select("row_id", F.col("facts").alias("response_facts")), "row_id", "left"), "prepared")
    return listed.withColumn("response_facts", F.coalesce("response_facts", fx.no_facts())).withColumn(
        "response_facts_count", F.size("response_facts")
    )
