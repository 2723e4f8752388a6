"""First rows, row keys and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factgrade import fixed


def first_per_group(df: DataFrame, group: str, order: str, n: int = fixed.SUBSET_ROWS) -> DataFrame:
    """First ``n`` rows of each file.

    Spark cuts every task's rows of a group to ``n`` before the shuffle, so one huge file does not
    pile up in a single task.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Union by name; columns a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def reassemble(rows: DataFrame, outcomes: DataFrame, key: str = "row_id") -> DataFrame:
    """Put outcomes that were finished in any order back on their rows."""
    return rows.join(outcomes, key, "left")
