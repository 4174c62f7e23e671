"""Bloom-split suppression against the plain anti join."""

import pytest
from pyspark.sql import functions as F

from canvass.operators import suppression as SU


def frames(spark):
    # a third of all rows share one key; nulls and repeats on both sides
    df = spark.range(9000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 101 == 1, None).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("scope"))
    df = df.unionAll(df.where("id < 50")).withColumn("_hit", F.lit("mine"))
    listed = spark.range(2000).select((F.col("id") * 5).alias("k"), F.lit("s1").alias("scope"), F.lit(0).alias("id"))
    listed = listed.unionAll(listed.where("k < 99")).unionAll(
        spark.sql("select cast(null as bigint) k, 's1' scope, 0 id"))
    return df.drop("_hit"), listed


@pytest.mark.parametrize("on", [["k"], ["scope", "k"]])
def test_equals_the_plain_join(spark, on):
    df, listed = frames(spark)
    got = sorted(map(str, SU.anti_split(df, listed, on).collect()))
    assert got == sorted(map(str, df.join(listed.select(*on), on, "left_anti").select(*df.columns).collect()))


def test_few_false_alarms_and_no_missed_key(spark):
    df, listed = frames(spark)
    keys = listed.select("k").dropna()
    n = keys.count()
    clear, hits = SU.split_by_filter(df, keys, ["k"], -(-n // SU.KEYS_PER_BLOCK))
    assert clear.join(keys, "k", "left_semi").isEmpty()
    true = df.join(keys.distinct(), "k", "left_semi").count()
    assert true <= hits.count() <= true + 0.02 * df.count()
    assert hits.where("k is null").isEmpty()


def test_empty_and_other_types(spark, monkeypatch):
    df, listed = frames(spark)
    assert SU.anti_split(df, listed.limit(0), "k").count() == df.count()
    assert SU.anti_split(df.limit(0), listed, "k").isEmpty()
    want = SU.anti_split(df, listed, "k").count()
    assert SU.anti_split(df, listed.withColumn("k", F.col("k").cast("int")), "k").count() == want
    monkeypatch.setattr(SU, "MAX_BLOCKS", 1)
    assert SU.anti_split(df, listed, "k").count() == want
