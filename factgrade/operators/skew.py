"""Joins that stay balanced when one key holds a large part of the rows.

A side is broadcast only when its measured size is under a limit.  Beyond it the join is a
shuffle join in which the rows of each hot key are spread over several partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_BYTES = 64
HOT_FACTOR = 4
SAMPLE_FRACTION = 0.01
MIN_SAMPLED = 20


def measured_bytes(df: DataFrame) -> int:
    """Size of a table, taken by one parallel pass over it: text by its length, 64 bytes for anything else."""

    def size(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            found = F.octet_length(c) + 64
        elif field.dataType == T.ArrayType(T.StringType()):
            found = F.octet_length(F.array_join(c, "")) + 64 * F.size(c)
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            found = 8 * F.octet_length(F.to_json(c))
        else:
            return F.lit(64)
        return F.coalesce(found, F.lit(64))

    row = reduce(lambda a, b: a + b, [size(f) for f in df.schema.fields], F.lit(ROW_BYTES))
    return df.select(row.cast("bigint").alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]


def fits_broadcast(*tables: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether tables together stay under the limit.

    Rows are counted first, which costs a stored table no more than its footers: one with too many rows is
    never read for this.
    """
    if sum(df.count() for df in tables) * ROW_BYTES > limit:
        return False
    total = 0
    for df in tables:
        total += measured_bytes(df)
        if total > limit:
            return False
    return True


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a table that was read in fewer pieces than half the cores; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if 2 * df.rdd.getNumPartitions() <= cores else df


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(
    df: DataFrame, keys: list[str], fraction: float = SAMPLE_FRACTION, factor: float | None = None
) -> DataFrame | None:
    """Keys that would fill more than ``factor`` average partitions, with the pieces to cut them into.

    At most ``partitions / factor`` keys can qualify, so they are few whatever the input, and they are fixed
    here: both sides of a join see the same list.  They are estimated on a sample; a key that is missed or found
    in error changes the layout of a join, never its result.
    """
    parts, factor = shuffle_partitions(df), HOT_FACTOR if factor is None else factor
    sampled = df.select(*keys).sample(fraction, seed=7) if fraction < 1 else df.select(*keys)
    counts = sampled.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    pieces = F.greatest(F.lit(2), F.ceil(F.col("_n") * parts / max(total, 1)).cast("int"))
    hot = counts.where((F.col("_n") * parts > factor * total) & (F.col("_n") >= MIN_SAMPLED))
    hot = hot.select(*keys, pieces.alias("_pieces"))
    found = hot.collect()
    return df.sparkSession.createDataFrame(found, hot.schema) if found else None


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    fraction: float = SAMPLE_FRACTION,
    factor: float | None = None,
) -> DataFrame:
    """``left`` (possibly skewed) joined to ``right``; hot keys are spread over their pieces.

    The piece of a left row depends on its contents only, so a recomputed task puts it where it was.  The right
    rows of a hot key are repeated once per piece, all other rows are shuffled once.  Rows with a null key match
    nothing and are spread too.  Without hot keys this is an ordinary join.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports left and inner joins")
    hot = hot_keys(left, keys, fraction, factor)
    if hot is None:
        return left.join(right, keys, how)
    hot = F.broadcast(hot)
    # Maps cannot be hashed.
    others = [f.name for f in left.schema.fields if f.name not in keys and "map<" not in f.dataType.simpleString()]
    mixed = F.xxhash64(*others) if others else F.lit(0)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    pieces = F.when(no_key, shuffle_partitions(left)).otherwise(F.coalesce(F.col("_pieces"), F.lit(1)))
    salted_left = left.join(hot, keys, "left").withColumn("_piece", F.pmod(mixed, pieces).cast("int"))
    salted_right = right.join(hot, keys, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    )
    return salted_left.drop("_pieces").join(salted_right.drop("_pieces"), [*keys, "_piece"], how).drop("_piece")


def lookup_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", small: bool | None = None
) -> DataFrame:
    """Join a large table to a reference table whose size decides the strategy.

    ``small`` is the outcome of ``fits_broadcast`` on the table the reference was made from; without it the
    reference itself is measured.
    """
    if fits_broadcast(right) if small is None else small:
        return left.join(F.broadcast(right), keys, how)
    return salted_join(left, right, keys, how)
