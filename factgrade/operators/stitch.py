"""Attach ground-truth facts to generated answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgrade.operators import skew

FACT_COLUMNS = ["response_facts", "response_facts_count"]


def reference_by_prompt(reference: DataFrame, order: str | None = "row_id") -> DataFrame:
    """One fact list per prompt: that of the lowest row id."""
    facts = [c for c in FACT_COLUMNS if c in reference.columns]
    kept = F.min(F.struct(order, *facts)) if order in reference.columns else F.min(F.struct(*facts))
    return (
        reference.where(F.col("prompt").isNotNull())
        .groupBy("prompt")
        .agg(kept.alias("_kept"))
        .select("prompt", *[F.col(f"_kept.{c}").alias(c) for c in facts])
    )


def _copies(reference: DataFrame) -> DataFrame:
    """Reference rows with equal contents as one row and their number."""
    facts = [c for c in FACT_COLUMNS if c in reference.columns]
    return reference.where(F.col("prompt").isNotNull()).groupBy("prompt", *facts).agg(F.count("*").alias("_copies"))


def stitch(
    generated: DataFrame, reference: DataFrame, keep_duplicates: bool = False, limit: int = skew.BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Left join of fact list and count on prompt; tables that have facts already are left alone.

    Rows in = rows out, unless ``keep_duplicates``: then an answer is repeated for every reference row of
    its prompt.  Equal reference rows travel as one row and are repeated only after the join.
    """
    if "response_facts" in generated.columns:
        return generated
    facts = [c for c in FACT_COLUMNS if c in reference.columns]
    order = ["row_id"] if "row_id" in reference.columns else []
    slim = reference.select(F.col("prompt").cast("string").alias("prompt"), *order, *facts)
    generated = generated.withColumn("prompt", F.col("prompt").cast("string"))
    small = skew.fits_broadcast(slim, limit=limit)
    if not keep_duplicates:
        return skew.lookup_join(generated, reference_by_prompt(slim), ["prompt"], small=small)
    joined = skew.lookup_join(generated, _copies(slim), ["prompt"], small=small)
    copy = F.sequence(F.lit(1), F.coalesce(F.col("_copies").cast("int"), F.lit(1)))
    return joined.withColumn("_copy", F.explode(copy)).drop("_copy", "_copies")
