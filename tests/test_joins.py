"""The salted join gives what the plain join gives, also with one hot key."""

import pytest
from pyspark.sql import functions as F

from incident_engine.operators.joins import fits_broadcast, heavy_keys, join_keyed, join_spread


@pytest.fixture(scope="module")
def sides(spark):
    large = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 40).alias("k"), (F.col("id") % 11).alias("v"))
    keyed = spark.createDataFrame([(i, f"n{i}") for i in range(5, 30)] + [(9, "again")], "k long, name string")
    return large, keyed


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", [True, False, None])
def test_equals_plain_join(sides, how, broadcast):
    large, keyed = sides
    got = join_keyed(large, keyed, ["k"], how, broadcast=broadcast, salts=5)
    plain = large.join(keyed, ["k"], how)
    assert got.columns == plain.columns
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_hot_key_spreads_over_many_tasks(spark, sides):
    large, keyed = sides
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = join_keyed(large.filter("k = 7"), keyed, ["k"], broadcast=False)
        assert got.groupBy(F.spark_partition_id()).count().count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bound_is_checked_in_rows_and_bytes(spark):
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 100))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=9_000)
    assert fits_broadcast(df.limit(0), max_rows=0, max_bytes=0)


def test_other_join_types_are_refused(sides):
    with pytest.raises(ValueError, match="salted side"):
        join_keyed(*sides, ["k"], "outer")


def test_sketch_names_the_keys_above_their_share_alone(spark):
    rows = spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 2 == 0, -1).when(F.col("id") % 10 == 1, -2).otherwise(F.col("id"))
        .alias("k"))
    found = heavy_keys(rows, ["k"], 20)
    keys = {spark.range(1).select(F.xxhash64(F.lit(k).cast("long"))).first()[0]: k for k in (-1, -2)}
    assert {keys[h]: n for h, n in found.items()} == {-1: 10, -2: 2}
    assert heavy_keys(rows.limit(0), ["k"], 20) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_null_keys_never_reach_the_shuffle(spark, how):
    """Nine rows in ten have no key, half of the others one key; every task gets its share."""
    large = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, None).when(F.col("id") % 20 == 0, 7)
        .otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    keyed = spark.range(0, 30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = large.join(keyed, ["k"], how)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = join_spread(large, keyed, ["k"], how, tasks=8)
        assert got.columns == plain.columns
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
        if how == "inner":
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == plain.count() and max(sizes) < 0.4 * sum(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
