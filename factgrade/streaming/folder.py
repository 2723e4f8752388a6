"""Grade result files as they arrive in a folder, each file once."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factgrade.operators import report
from factgrade.sources.tables import read_files


def grade_folder(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    grade: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    glob: str = "*.[cC][sS][vV]",
    files_per_batch: int = 1000,
    state: str | None = None,
) -> None:
    """Grade every CSV file that the checkpoint has not seen and return when all are done.

    Columns go by their names, whatever their order in a file.  Each batch goes to its own sub-folder, which a repeated
    batch overwrites: a restart neither loses nor doubles rows.  With ``state``, the report state of each batch is kept
    in a folder of its own, under the same rule; ``read_state`` adds them up for ``report.reports_of_state``.  The graded
    rows then have ``model`` and ``domain``.
    """
    files = (
        spark.readStream.option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
        .select(F.col("_metadata.file_path").alias("path"))
    )

    def write(batch: DataFrame, number: int) -> None:
        # At most ``files_per_batch`` names; each file is then read by its own header.
        paths = sorted(unquote(r["path"]) for r in batch.distinct().collect())
        if paths:
            part = f"{output}/batch={number}"
            graded = grade(read_files(spark, paths, schema))
            graded.write.mode("overwrite").parquet(part)
            if state:
                written = spark.read.schema(graded.schema).parquet(part)
                report.report_state(written).write.mode("overwrite").parquet(f"{state}/batch={number}")

    query = (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """The report state of all batches so far, one row per key."""
    return report.merged(spark.read.parquet(state).drop("batch"))
