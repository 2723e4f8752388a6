"""Confidence band of the regression line, by a Poisson bootstrap.

A replicate counts every row as often as a Poisson number of mean 1 says, which is what drawing with replacement comes
to in a large table.  The number is a hash of the row's key and the replicate, so replicates need no second look at the
data and are the same in every run.  One pass adds up the five sums from which a straight line follows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgrade.functions import text

REPLICATES, POINTS = 100, 21
#: Parts of a digest, each of which is the random number of one replicate.
PER_DIGEST, DIGITS = 4, 8


def poisson_steps() -> list[float]:
    """Chances of at most 0, 1, 2, ... occurrences, as far as numbers of 32 bits tell them from 1."""
    steps, chance = [], math.exp(-1)
    while 1 - (total := sum(steps[-1:]) + chance) > 2.0 ** -(4 * DIGITS):
        steps.append(total)
        chance /= len(steps)
    return steps


def replicate_weights(key: Column, replicates: int) -> Column:
    """How often each replicate counts a row: an array, from a digest of the key for every four of them."""

    def weight(part: Column) -> Column:
        u = F.conv(part, 16, 10).cast("double") / float(16**DIGITS)
        return sum(((u >= step).cast("int") for step in poisson_steps()), F.lit(0))

    def digest(block: Column) -> Column:
        full = F.md5(F.concat(key.cast("string"), F.lit(":"), block.cast("string")))
        return F.transform(F.sequence(F.lit(0), F.lit(PER_DIGEST - 1)), lambda i: weight(F.substr(full, i * DIGITS + 1, F.lit(DIGITS))))

    blocks = -(-replicates // PER_DIGEST)
    return F.slice(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), digest)), 1, replicates)


def replicate_lines(df: DataFrame, x: Column, y: Column, key: str, replicates: int = REPLICATES) -> DataFrame:
    """(replicate, slope, intercept); replicates in which x has one value only have none."""
    rows = df.select(x.cast("double").alias("x"), y.cast("double").alias("y"), F.col(key).alias("key"))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("key").isNotNull())
    weighted = rows.select("x", "y", F.posexplode(replicate_weights(F.col("key"), replicates)).alias("replicate", "w")).where("w > 0")
    w, x_, y_ = F.col("w"), F.col("x"), F.col("y")
    sums = weighted.groupBy("replicate").agg(
        F.sum(w).alias("n"), F.sum(w * x_).alias("sx"), F.sum(w * y_).alias("sy"), F.sum(w * x_ * x_).alias("sxx"), F.sum(w * x_ * y_).alias("sxy")
    )
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.when(spread > 0, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / spread)
    lines = sums.select("replicate", "n", "sx", "sy", slope.alias("slope")).where(F.col("slope").isNotNull())
    return lines.select("replicate", "slope", ((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")).alias("intercept"))


def regression_band(
    results: DataFrame, key: str = "row_id", replicates: int = REPLICATES, points: int = POINTS, level: float = 0.95
) -> DataFrame:
    """(delta_k, fitted, low, high): the line of score over delta_k at evenly spread points, and its band.

    ``key`` tells rows apart.  The band is between the quantiles of the replicates' lines at each point, as many values
    as there are replicates.  Without a line, for want of rows or of different delta_k, there are no rows.
    """
    x, y = text.delta_k("afg_k_gen", "afg_k_gt").cast("double"), F.col("score")
    scored = F.when(y.isNotNull(), x)
    line = results.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.min(scored).alias("first"), F.max(scored).alias("last")
    ).first()
    slope, intercept, first, last = [float("nan")] * 4 if line["slope"] is None else line
    places = [] if line["slope"] is None else [first + i * (last - first) / max(points - 1, 1) for i in range(points)]
    at = F.array(*[F.lit(p) for p in places]).cast("array<double>")
    each = replicate_lines(results, x, y, key, replicates).select("slope", "intercept", F.explode(at).alias("delta_k"))
    height = F.col("intercept") + F.col("slope") * F.col("delta_k")
    banded = each.groupBy("delta_k").agg(F.percentile(height, [(1 - level) / 2, (1 + level) / 2]).alias("q"))
    fitted = F.lit(intercept) + F.lit(slope) * F.col("delta_k")
    return banded.select("delta_k", fitted.alias("fitted"), F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
