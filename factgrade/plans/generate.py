"""Persona questions -> model answers."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions.prompts import answer_messages
from factgrade.operators import clean, replies
from factgrade.sources import examples as ex
from factgrade.sources import storage


def with_tasks(df: DataFrame, tasks: list[tuple[str, str]]) -> DataFrame:
    """One row per question and task (model, context), context being ``zero`` or ``few``."""
    listed = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(c).alias("context")) for m, c in tasks])
    return df.withColumn("_task", F.explode(listed)).select(*df.columns, "_task.model", "_task.context")


def persona_prompts(df: DataFrame, few_shot: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """Add messages for every persona row; ``few_shot`` holds the few solved rows shown before it."""
    shown = None if few_shot is None else ex.shown_messages(few_shot, order).select("shown").scalar()
    return df.withColumn("messages", answer_messages(shown))


def run_tasks(
    df: DataFrame,
    tasks: list[tuple[str, str]],
    store: str,
    backend_for: Callable[[str], Callable],
    folder: str,
    few_shot: DataFrame | None = None,
    form: str = "parquet",
    parallel: int | None = None,
    commits: int = replies.COMMITS,
    rounds: int = 1,
) -> dict[tuple[str, str], str]:
    """Answer the dataset once per (model, context) and write one table each; returns where they are.

    Every model has its own part of the reply store, under its full name with slashes escaped, so a stopped run goes
    on with what is missing and models of different makers never share replies.
    """
    written = {}
    for model, context in tasks:
        if context not in ("zero", "few"):
            raise ValueError(f"unknown context: {context}")
        name = quote(model, safe="")
        shown = few_shot if context == "few" else None
        answered = generate(df, f"{store}/{name}", backend_for(model), shown, parallel, commits, rounds)
        written[model, context] = storage.write_generated(answered, f"{name}_{context}", folder, form)
    return written


def generate(
    df: DataFrame,
    store: str,
    make_backend: Callable,
    few_shot: DataFrame | None = None,
    parallel: int | None = None,
    commits: int = replies.COMMITS,
    rounds: int = 1,
) -> DataFrame:
    """The dataset with ``generated_response`` and ``reply_status``; all columns stay.

    Failed and unfinished replies are null answers, so they are never graded as text.  Calls that fail for the moment
    are made again in up to ``rounds`` rounds.
    """
    complete = clean.drop_incomplete(clean.require_columns(df, fixed.PERSONA_COLUMNS), fixed.PERSONA_COLUMNS)
    asked = replies.with_prompt_hash(persona_prompts(complete, few_shot))
    stored = replies.ask_pending(replies.distinct_prompts(asked), store, make_backend, parallel, commits=commits, rounds=rounds)
    answered = replies.join_replies(asked.drop("messages"), stored)
    return answered.withColumn("generated_response", F.when(F.col("status") == "ok", F.col("reply"))).withColumnRenamed(
        "status", "reply_status"
    ).drop("reply", "prompt_hash")
