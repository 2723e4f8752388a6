"""How the shared tables stand in for datasets, answers and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions import facts as fx
from factgrade.functions import scoring
from factgrade.functions.text import sentences
from factgrade.operators import skew, verify
from factgrade.sources import storage


# Known schemas save the pass over the file footers.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Documents with their text, on all cores even when the file is a single piece."""
    return skew.spread(table(spark, sf, "documents").select("doc_id", "text", *columns), "doc_id")


def pairs_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Questions with their ground truth and, where there is one, a later answer of the same conversation.

    The joins are on conversation and turn, which together are unique: a long conversation is spread out.
    """
    turns = table(spark, sf, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    said = turns.where(F.col("role") == "assistant")

    def later(shift: int, name: str) -> DataFrame:
        return said.select("conv_id", (F.col("turn") - shift).alias("turn"), F.col("text").alias(name))

    on = ["conv_id", "turn"]
    return (
        asked.join(later(1, "response"), on)
        .join(later(3, "generated_response"), on, "left")
        .select(
            (F.col("conv_id") * 1000000 + F.col("turn")).alias("row_id"),
            "conv_id",
            "turn",
            "prompt",
            "response",
            "generated_response",
        )
    )


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Questions with ground truth and answer; without a later answer the ground truth is graded."""
    return pairs_raw(spark, sf).withColumn("generated_response", F.coalesce("generated_response", "response"))


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    """Question, facts of its ground truth, number of facts."""
    facts = fx.sentence_facts("response")
    return pairs_raw(spark, sf).select("row_id", "prompt", facts.alias("response_facts")).withColumn(
        "response_facts_count", F.size("response_facts")
    )


def stored_prepared(spark: SparkSession, sf: str) -> DataFrame:
    """The same as the table a preparation run leaves behind."""
    return storage.materialise(prepared(spark, sf), "prepared")


def personas(spark: SparkSession, sf: str) -> DataFrame:
    """Questions asked by described persons."""

    def pick(values: list[str], by: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(by, F.lit(len(values))) + 1).cast("int"))

    conv, turn = F.col("conv_id"), F.col("turn")
    return pairs_raw(spark, sf).select(
        "row_id",
        "prompt",
        pick(["Under 18", "18-25", "26-45", "46-65", "Over 65"], conv).alias("targetAgeGroup"),
        pick(["female", "male"], turn).alias("genderIdentity"),
        pick(["secondary", "tertiary"], conv + turn).alias("educationBackground"),
        pick(["nurse", "retail", "student"], conv).alias("targetProfession"),
        pick(["low", "medium", "high"], turn).alias("digitalLiteracy"),
        pick(["England", "Scotland", "Wales", "Northern Ireland"], conv).alias("geoRegion"),
        pick(["low", "medium", "high"], conv + turn).alias("householdIncomeStatus"),
        "response",
    )


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as answers: every sentence is one fact."""
    return documents(spark, sf, "lang", "source").select(
        "doc_id",
        F.col("lang").alias("domain"),
        F.col("source").alias("model"),
        F.length("text").alias("char_count"),
        sentences("text").alias("gen_facts"),
    ).withColumn("k_gen", F.size("gen_facts"))


def references(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items as ground truths."""
    return table(spark, sf, "benchmark").select("item_id", sentences("text").alias("gt_facts"))


def examples(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items as solved examples."""
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("example_id"), F.col("text").alias("sentence"), sentences("text").alias("facts")
    )


def classified(spark: SparkSession, sf: str) -> DataFrame:
    """What the refusal classifier says about the labelled documents."""
    kind = F.when(F.col("toxic") == 1, F.col("doc_id") % 3).when(F.col("quality") == 1, 5).otherwise(3)
    return table(spark, sf, "labels").select(
        "doc_id",
        F.concat(F.lit("LABEL_"), kind.cast("string")).alias("label"),
        (0.90 + (F.col("doc_id") % 10) / 100).alias("label_score"),
    )


def matched(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the benchmark item it quotes, if any."""
    return verify.match_reference(answers(spark, sf), references(spark, sf))


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Graded documents: the table all reports are made from.  Unlabelled documents count as direct answers."""
    flagged = (
        matched(spark, sf)
        .join(classified(spark, sf), "doc_id", "left")
        .na.fill({"label": "LABEL_5", "label_score": 1.0})
    )
    scored = verify.score_rows(
        verify.flag_refusals(flagged),
        F.size(scoring.exact_claims("quoted", "gt_facts")),
        F.col("k_gen"),
        F.size("gt_facts"),
    )
    return scored.select(
        "doc_id",
        "domain",
        "model",
        F.concat(F.lit(fixed.RESULTS_PREFIX), "model", F.lit(".csv")).alias("source_file"),
        "char_count",
        "is_abstained",
        "abstention_type",
        "score",
        "supported_claims",
        "afg_k_gen",
        "afg_k_gt",
    )
