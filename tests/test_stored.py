"""SNK3 / SNK4: stored tables stay whole whatever happens to a write."""

import pytest
from pyspark.sql import functions as F

from canvass.sources.stored import StoredTable


def _rows(df):
    return sorted((tuple(r) for r in df.select("k", "v").collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return StoredTable(spark, str(tmp_path / "t"), ("k",), 16)


def test_replace_and_failing_writes(spark, table):
    with pytest.raises(ValueError):
        table.read()
    first = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert table.replace(first) and table.read().count() == 1000
    broken = first.withColumn("v", F.when(F.col("k") == 999, F.raise_error(F.lit("lost"))).otherwise(F.lit("b")))
    for write in (table.replace, table.upsert):
        with pytest.raises(Exception, match="lost"):
            write(broken)
        assert table.version() == 1
        assert table.read().groupBy("v").count().collect()[0].asDict() == {"v": "a", "count": 1000}
    assert not table.replace(first.limit(0)) and table.version() == 1       # empty: nothing replaced
    reader = table.read()
    assert table.replace(first.where("k < 10").withColumn("v", F.lit("c")))
    assert _rows(table.read()) == [(i, "c") for i in range(10)]
    assert reader.count() == 1000                                           # a reader keeps its version


def test_upsert_rewrites_only_buckets_of_incoming_keys(spark, table):
    table.replace(spark.range(2000).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    before = {r["bucket"]: r["folder"] for r in table.commits().collect()}
    touched = table.upsert(spark.createDataFrame([(5, "new"), (-1, "new"), (None, "x"), (-1, "twice")], "k long, v string"))
    after = {r["bucket"]: r["folder"] for r in table.commits().collect()}
    assert 0 < len(touched) <= 3
    assert {b for b in before if before[b] != after[b]} == set(touched)
    want = [(i, "new" if i == 5 else "a") for i in range(2000)] + [(-1, "new"), (-1, "twice"), (None, "x")]
    assert _rows(table.read()) == sorted(want, key=repr)
    assert table.vacuum_list().count() == len(touched)
    # a null key deletes nothing
    table.upsert(spark.createDataFrame([(None, "y")], "k long, v string"))
    assert sorted(r["v"] for r in table.read().where("k is null").collect()) == ["x", "y"]
    assert table.upsert(spark.createDataFrame([], "k long, v string")) == []


def test_upsert_into_nothing_and_hot_key(spark, tmp_path):
    t = StoredTable(spark, str(tmp_path / "hot"), ("a", "k"), 4)
    rows = spark.range(900).select(F.lit(1).alias("a"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    assert t.upsert(rows)
    assert t.read().count() == 900 and t.read().where("k = 7").count() == 301
    t.upsert(spark.createDataFrame([(1, 7, 0)], "a int, k long, v long"))
    assert t.read().count() == 600
