"""Joins with hot keys give what plain joins give, and are really spread."""

import pytest
from pyspark.sql import functions as F

from factgrade.operators import skew


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def left(spark):
    """A third of the rows share a key, a sixth has none."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 6 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    )
    return spark.range(6000).select(F.col("id").alias("row_id"), key.alias("k"))


@pytest.fixture
def right(spark):
    rows = [(f"k{i}", i) for i in range(0, 500, 2)] + [("hot", 1), ("hot", 2), (None, 3)]
    return spark.createDataFrame(rows, "k string, v int")


def rows(df):
    return sorted((r["row_id"], str(r["k"]), -1 if r["v"] is None else r["v"]) for r in df.collect())


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, many_partitions, left, right, how):
    got = skew.salted_join(left, right, ["k"], how, fraction=1.0)
    assert rows(got) == rows(left.join(right, ["k"], how))


def test_hot_keys_are_found_and_bounded(spark, many_partitions, left):
    hot = {r["k"]: r["_pieces"] for r in skew.hot_keys(left, ["k"], fraction=1.0).collect()}
    assert set(hot) == {"hot", None}
    assert hot["hot"] == 22  # a third of 64 partitions
    assert skew.hot_keys(left.select("row_id"), ["row_id"], fraction=1.0) is None


def test_hot_key_reaches_many_partitions(spark, many_partitions, left, right):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.salted_join(left, right, ["k"], fraction=1.0)
        used = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert used > 10


def test_size_decides_the_join(spark, left, right):
    def plan(small):
        return skew.lookup_join(left, right, ["k"], small=small)._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(True)
    assert "broadcast" not in plan(False)
    assert skew.fits_broadcast(right)
    assert not skew.fits_broadcast(right, limit=100)
    assert not skew.fits_broadcast(right, right, limit=skew.measured_bytes(right) + 1)


def test_measured_bytes_grows_with_the_text(spark):
    small = spark.createDataFrame([("a", ["b"])], "x string, y array<string>")
    large = spark.createDataFrame([("a" * 1000, ["b" * 1000])], "x string, y array<string>")
    assert skew.measured_bytes(large) - skew.measured_bytes(small) == 1998
    assert skew.measured_bytes(small.limit(0)) == 0


def test_spread_leaves_large_inputs_alone(spark):
    few = spark.range(10).repartition(2)
    assert skew.spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 10, 1, 20)
    assert skew.spread(many, "id").rdd.getNumPartitions() == 20
