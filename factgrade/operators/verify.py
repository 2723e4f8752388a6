"""Claims of an answer against the facts of its ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions import scoring
from factgrade.functions.text import label_id
from factgrade.operators import skew


def label_table(spark: SparkSession) -> DataFrame:
    """The six classes of the refusal classifier."""
    entries = [F.struct(F.lit(k).alias("label_id"), F.lit(v).alias("meaning")) for k, v in fixed.LABEL_MEANINGS.items()]
    return spark.range(1).select(F.inline(F.array(*entries)))


def flag_refusals(df: DataFrame, label: str = "label", score: str = "label_score") -> DataFrame:
    """Add label_id, abstention_type and is_abstained from the classifier's label and score."""
    flagged = df.withColumn("label_id", label_id(label)).withColumn(
        "is_abstained", scoring.is_refusal("label_id", score)
    )
    kinds = F.broadcast(label_table(df.sparkSession))
    return flagged.join(kinds, "label_id", "left").withColumn(
        "abstention_type", F.when(F.col("is_abstained"), F.col("meaning"))
    ).drop("meaning")


def flag_by_keywords(df: DataFrame, text: str = "generated_response") -> DataFrame:
    """Add is_abstained and abstention_type without a classifier."""
    flag = scoring.looks_refused(text)
    kind = F.when(flag, F.lit(fixed.LABEL_MEANINGS[0]))
    return df.withColumns({"is_abstained": flag, "abstention_type": kind})


def supported_per_row(claims: DataFrame, supported: str = "supported", key: str = "row_id") -> DataFrame:
    """Number of supported claims of each row, from one row per claim."""
    return claims.groupBy(key).agg(F.count_if(F.col(supported)).alias("supported_claims"))


def score_rows(
    df: DataFrame, supported: Column, k_gen: Column | None = None, k_gt: Column | None = None
) -> DataFrame:
    """Add supported_claims, the fact counts and the score.

    The counts are the lengths of gen_facts and gt_facts unless given.  Refused rows score 0 and make no
    claims; rows without a reference score 0.
    """
    refused = F.coalesce(F.col("is_abstained"), F.lit(False))
    k_gen = F.size("gen_facts") if k_gen is None else k_gen
    k_gt = F.size("gt_facts") if k_gt is None else k_gt
    return (
        df.withColumn("afg_k_gen", F.when(refused, 0).otherwise(k_gen).cast("int"))
        .withColumn("afg_k_gt", F.coalesce(k_gt, F.lit(0)).cast("int"))
        .withColumn("supported_claims", F.when(refused, 0).otherwise(F.coalesce(supported, F.lit(0))).cast("int"))
        .withColumn("score", scoring.f1_at_k("supported_claims", "afg_k_gen", "afg_k_gt"))
    )


def match_reference(
    answers: DataFrame, references: DataFrame, limit: int = skew.BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Find the ground truth an answer quotes and how much of it.

    ``answers`` is (doc_id, gen_facts, ...), ``references`` is (item_id, gt_facts).  The reference of an
    answer is the one with the lowest item id that shares a fact with it.  Adds item_id, quoted (the answer's
    facts found in any reference) and gt_facts of the chosen reference.

    A fact is first reduced to its lowest item, so a fact that many items share never multiplies rows.  References
    that are too large to broadcast are met by a 128-bit hash of each sentence: the texts of answers are not
    shuffled, and sentences that match nothing leave the plan at the join.
    """
    small = skew.fits_broadcast(references, limit=limit)
    lowest = (
        references.select("item_id", F.explode(F.array_distinct("gt_facts")).alias("fact"))
        .groupBy("fact")
        .agg(F.min("item_id").alias("item_id"))
    )
    carried = [c for c in answers.columns if c not in ("doc_id", "gen_facts")]
    claims = answers.select("doc_id", *carried, F.explode_outer(F.array_distinct("gen_facts")).alias("fact"))
    if not small:
        digest = F.unhex(F.md5("fact")).alias("digest")
        hashed = answers.select("doc_id", F.explode(F.array_distinct("gen_facts")).alias("fact")).select("doc_id", digest)
        hits = skew.salted_join(hashed, lowest.select(digest, "fact", "item_id"), ["digest"], "inner")
        hits = hits.groupBy("doc_id").agg(F.min("item_id").alias("item_id"), F.collect_set("fact").alias("quoted"))
        chosen = answers.select("doc_id", *carried).join(hits, "doc_id", "left")
        chosen = chosen.withColumn("quoted", F.coalesce("quoted", F.array().cast("array<string>")))
        return skew.lookup_join(chosen, references, ["item_id"], small=False)
    found = skew.lookup_join(claims, lowest, ["fact"], small=True)
    quoted = F.collect_set(F.when(F.col("item_id").isNotNull(), F.col("fact")))
    chosen = found.groupBy("doc_id").agg(
        F.min("item_id").alias("item_id"), quoted.alias("quoted"), *[F.any_value(c).alias(c) for c in carried]
    )
    return skew.lookup_join(chosen, references, ["item_id"], small=small)
