"""From raw documents to token ids: quality, near-duplicates, benchmark passages, personal data, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade.llm import decontaminate, neardup, pieces, pii, quality
from factgrade.llm.common import materialise, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of copies and near copies."""
    return neardup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without, or with few, words from benchmark windows."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces, with digests of the ids and of the text decoded from them."""
    return pieces.round_trip(docs, with_ids=True)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("pieces", tokenise),
]

#: The classifier, the field and the pieces cannot be put as SQL; the tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
