"""Property tests: the skew-safe scans equal their one-window-per-key forms."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from canvass.operators.scan import numbered, prior_max

rows = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
                          st.integers(min_value=0, max_value=5000),
                          st.one_of(st.none(), st.integers(min_value=-50, max_value=50))),
                min_size=1, max_size=80, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, width=st.sampled_from([1, 7, 64, 1 << 16]))
def test_prior_max_property(spark, data, width):
    df = spark.createDataFrame(data, "k string, arrival long, v long")
    got = prior_max(df, ["k"], "arrival", "v", "p", bucket_width=width)
    w = Window.partitionBy("k").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("p", F.max("v").over(w))
    assert sorted(got.collect()) == sorted(want.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, parts=st.integers(min_value=1, max_value=9))
def test_numbered_property(spark, data, parts):
    df = spark.createDataFrame(data, "k string, arrival long, v long")
    got = numbered(df, ["k"], ["arrival"], out="rn", partitions=parts)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("arrival")).cast("long"))
    assert sorted(got.collect()) == sorted(want.collect())
