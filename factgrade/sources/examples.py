"""Example tables shown to the model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions.prompts import solved_messages
from factgrade.operators.clean import require_columns


def read_demos(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object {sentence: [facts]}, or a folder of them, as (example_id, sentence, facts).

    Ids rise in file order; those of a single file are 0, 1, 2 and so on.
    """
    whole = spark.read.text(path, wholetext=True)
    pairs = F.from_json("value", "map<string,array<string>>")
    listed = whole.select(F.explode(pairs).alias("sentence", "facts"))
    return listed.select(F.monotonically_increasing_id().alias("example_id"), "sentence", "facts")


def read_few_shot(spark: SparkSession, path: str) -> DataFrame:
    """Solved persona rows: a JSON array of records with a response."""
    return require_columns(
        spark.read.option("multiLine", True).json(path), [*fixed.PERSONA_COLUMNS, "response"]
    ).select(*fixed.PERSONA_COLUMNS, "response")


def shown_messages(few_shot: DataFrame, order: str | None = None) -> DataFrame:
    """One row: the messages of all solved rows, in row order.  They are part of every prompt, so they are few."""
    key = F.col(order) if order else F.monotonically_increasing_id()
    listed = few_shot.select(F.struct(key.alias("k"), solved_messages().alias("m")).alias("x")).agg(
        F.sort_array(F.collect_list("x")).alias("xs")
    )
    return listed.select(F.flatten(F.transform("xs", lambda x: x["m"])).alias("shown"))
