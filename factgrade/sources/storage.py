"""Output tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factgrade import fixed
from factgrade.operators import report
from factgrade.sources.shared import materialise, remove, shared_folder


__all__ = ["materialise", "remove", "shared_folder"]


def csv_ready(df: DataFrame) -> DataFrame:
    """Lists and structs as JSON text, since CSV has neither."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def write_table(df: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists", by: list[str] | None = None) -> str:
    """Write as parquet, JSON Lines or CSV, optionally one sub-folder per value of ``by``.

    For sub-folders the rows are rebalanced first: a rare value ends in one file, a frequent one in several.
    """
    if by:
        df = df.hint("rebalance", *by)
    if form == "csv":
        writer = csv_ready(df).write.options(
            header=True, escape='"', quote='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    else:
        writer = df.write
    writer = writer.mode(mode).format(form)
    (writer.partitionBy(*by) if by else writer).save(path)
    return path


def stamped(base: str, when: datetime | None = None) -> str:
    return f"{base}_{(when or datetime.now()).strftime('%Y%m%d_%H%M%S')}"


def write_results(results: DataFrame, base: str, form: str = "parquet", when: datetime | None = None) -> str | None:
    """Results and their summary under a time-stamped name; nothing is written for an empty table."""
    spark = results.sparkSession
    path = write_table(results, stamped(base, when), form)
    stored = spark.read.schema(results.schema).format(form).load(path) if form != "csv" else materialise(results, "results")
    if stored.isEmpty():
        remove(spark, path)
        return None
    breakdown = report.breakdown_text(stored).first()[0] if "abstention_type" in stored.columns else ""
    text = report.render(report.summary(stored).first(), breakdown)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(f"{path}_summary")
    return path


def write_prepared(df: DataFrame, input_path: str, form: str = "csv", mode: str = "errorifexists") -> str:
    """The prepared table beside its input file, under its default name."""
    return write_table(df, reference_path(input_path), form, mode)


def write_by_model(results: DataFrame, base: str, when: datetime | None = None) -> str:
    """Results of several models under one time-stamped name, a folder per model."""
    return write_table(results, stamped(base, when), by=["model"])


def write_generated(df: DataFrame, label: str, folder: str, form: str = "parquet", when: datetime | None = None) -> str:
    return write_table(df, stamped(f"{folder}/{label}_generated_responses", when), form)


def reference_path(path: str) -> str:
    """Default name of the prepared table of an input file."""
    return path.replace(".csv", fixed.REFERENCE_SUFFIX)


def write_ready(stitched: DataFrame, folder: str, form: str = "parquet", mode: str = "errorifexists") -> str:
    """One stitched output per input file, named after it."""
    name = F.replace(F.col("source_file"), F.lit(".csv"), F.lit(fixed.READY_SUFFIX))
    return write_table(stitched.withColumn("ready_file", name), folder, form, mode, by=["ready_file"])
