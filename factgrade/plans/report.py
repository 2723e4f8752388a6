"""From written results of many models to the tables of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.operators import report

STAMP = r"_[0-9]{8}_[0-9]{6}/[^/]+$"


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """All result tables that ``storage.write_results`` left below a folder, columns by name.

    A row without a ``model`` gets the name of its result folder, less the common prefix and the time stamp.
    """
    # Parts of summaries are text files; a schema merged over all tables keeps the columns that only some have.
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("mergeSchema", True)
    df = reader.parquet(folder)
    path = F.url_decode(F.col("_metadata.file_path"))
    name = F.regexp_replace(F.element_at(F.split(F.regexp_replace(path, STAMP, ""), "/"), -1), f"^{fixed.RESULTS_PREFIX}", "")
    return df.withColumn("model", F.coalesce("model", name) if "model" in df.columns else name)


def report_tables(results: DataFrame) -> dict[str, DataFrame]:
    """The report of a table of results with ``domain`` and ``model``."""
    return {
        "summary": report.summary(results, ["model"]),
        "refusals": report.refusal_breakdown(results),
        "domain_model_mean": report.domain_model_mean(results),
        "domain_model_matrix": report.domain_model_matrix(results),
        "boxplot": report.boxplot(results),
        "outliers": report.outliers(results),
        "regression": report.regression(results),
    }
