"""Exact quantiles of columns with any number of distinct values.

For every quantile of every group the two neighbouring order statistics are looked for at once.  A round takes pivots
for each search interval from a mergeable sketch of its values, counts exactly what lies at and between them, and goes
on with the bucket that holds the wanted rank, from its lowest to its highest value.  However the values are spread, a
bucket has little more than its share of the rows, or a single value.  Once few rows are left they are put in order.
No task sees more of a group than that, and the intervals are a small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factgrade.operators import skew
from factgrade.sources import shared

PIVOTS = 63
#: Rows of an interval that are put in order instead of being cut further.
FEW = 4096


def group_key(by: list[str]) -> Column:
    """One column for the grouping columns, in which nulls are equal."""
    return F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))


def _bucket() -> Column:
    """Even numbers between pivots, odd ones for the values that are pivots."""
    below = F.size(F.filter("pivots", lambda p: p < F.col("v")))
    return below + F.size(F.filter("pivots", lambda p: p <= F.col("v")))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: list[float],
    by: list[str] | None = None,
    count: str | None = None,
    pivots: int = PIVOTS,
    few: int = FEW,
) -> DataFrame:
    """(by..., n, quantiles): an array in the order of ``probabilities``, linear between neighbouring values.

    ``count`` names a column that says how often a row's value occurs.  Values that are null or not finite take no part,
    nor do counts below 1; a group without values has no row.
    """
    by = by or []
    amount = F.col(count).cast("bigint") if count else F.lit(1).cast("bigint")
    rows = df.select(group_key(by).alias("g"), F.col(value).cast("double").alias("v"), amount.alias("n"))
    rows = rows.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")) & (F.col("n") > 0))
    rows = shared.materialise(rows, "values")

    place = F.array(*[F.lit(float(p)) for p in probabilities])
    whole = rows.groupBy("g").agg(F.sum("n").alias("total"), F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
    ranks = F.array_distinct(F.flatten(F.transform(place, lambda p: F.array(F.floor(p * (F.col("total") - 1)), F.ceil(p * (F.col("total") - 1))))))
    # Values that lie below the interval, by their counts, and rows inside.
    state = whole.select("g", F.explode(ranks).alias("rank"), F.lit(0).cast("bigint").alias("before"), F.col("rows").alias("inside"), "low", "high")
    state = shared.materialise(state, "intervals")
    open_ = (F.col("inside") > few) & (F.col("low") < F.col("high"))
    shares = [(i + 1) / (pivots + 1) for i in range(pivots)]
    while not (left := state.where(open_)).isEmpty():
        met = skew.lookup_join(rows, left.drop("inside"), ["g"], "inner").where(F.col("v").between(F.col("low"), F.col("high")))
        sketch = F.array_distinct(F.percentile_approx("v", shares, 10 * (pivots + 1)))
        cut = shared.materialise(met.groupBy("g", "rank", "before", "low", "high").agg(sketch.alias("pivots")), "pivots")
        met = skew.lookup_join(rows, cut, ["g"], "inner").where(F.col("v").between(F.col("low"), F.col("high")))
        counted = met.groupBy("g", "rank", "before", _bucket().alias("bucket")).agg(
            F.sum("n").alias("n"), F.count("*").alias("inside"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        earlier = Window.partitionBy("g", "rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        chosen = counted.where(F.col("rank").between(F.col("before"), F.col("before") + F.col("n") - 1))
        state = shared.materialise(state.where(~open_).unionByName(chosen.select(*state.columns)), "intervals")

    found = state.where(F.col("low") == F.col("high")).select("g", "rank", F.col("low").alias("v"))
    rest = skew.lookup_join(rows, state.where(F.col("low") < F.col("high")), ["g"], "inner")
    rest = rest.where(F.col("v").between(F.col("low"), F.col("high"))).groupBy("g", "rank", "before", "v").agg(F.sum("n").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("g", "rank").orderBy("v"))
    rest = rest.withColumn("upto", upto).where(F.col("rank").between(F.col("upto") - F.col("n"), F.col("upto") - 1))
    known = F.map_from_entries(F.collect_list(F.struct("rank", "v")))
    values = found.unionByName(rest.select("g", "rank", "v")).groupBy("g").agg(known.alias("known"))

    def between(p: Column) -> Column:
        at = p * (F.col("total") - 1)
        low, high = F.element_at("known", F.floor(at)), F.element_at("known", F.ceil(at))
        return low + (high - low) * (at - F.floor(at))

    joined = whole.join(values, "g")
    keys = [F.col(f"g.`{c}`").alias(c) for c in by]
    return joined.select(*keys, F.col("total").alias("n"), F.transform(place, between).alias("quantiles"))
