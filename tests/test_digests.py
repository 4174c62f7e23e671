"""Range digests: the same rows as the full diffs, and only changed ranges go on."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from canvass.operators import diff as DF
from canvass.operators import digests as DG
from canvass.operators import groups as G


def _set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_one_per_cent_changed_reads_few_ranges(spark):
    old = spark.range(20000).select(F.col("id").alias("m"), (F.col("id") % 5).alias("g"))
    new = old.withColumn("g", F.when(F.col("m").between(5000, 5199), 9).otherwise(F.col("g")))
    values = [F.col("g"), F.col("m")]
    a, b = DG.only_changed(old, new, values, values, DG.key_range("m", 64))
    assert a.count() == b.count() and a.count() <= 64 * 5
    assert _set(DG.membership_delta(old, new, ["g", "m"], DG.key_range("m", 64))) == _set(G.membership_delta(old, new, ["g", "m"]))
    assert _set(DG.membership_delta(old, new, ["g", "m"], DG.hash_range(["m"], 4096))) == _set(G.membership_delta(old, new, ["g", "m"]))
    assert DG.changed_ranges(old, old.repartition(7), values, values, DG.key_range("m", 64)).count() == 0


def test_nulls_repeats_and_empty(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None), ("c", 700)], "g string, m long")
    new = spark.createDataFrame([("a", 1), (None, 2), ("b", None), ("d", None), (None, 700)], "g string, m long")
    for x, y in ((old, new), (new, old), (old, old.limit(0)), (old.limit(0), new), (old.limit(0), old.limit(0))):
        assert _set(DG.membership_delta(x, y, ["g", "m"], DG.key_range("m", 10))) == _set(G.membership_delta(x, y, ["g", "m"]))


def test_field_diff_over_all_pairs_of_values(spark):
    old = [None, "", "0", "1", "1.0", "1.4", "2", "Yes", "No", "abc", "2024-01-01", "2024-1-1"]
    kinds = {"double": [None, 0.0, 1.0, 1.4, 2.0], "string": [None, "", "0", "1", "Yes", "No", "abc", "1.0"],
             "date": [None, dt.date(2024, 1, 1), dt.date(2024, 1, 2)]}
    for typ, news in kinds.items():
        pairs = [(i, o, n) for i, (o, n) in enumerate(itertools.product(old, news))]
        x = spark.createDataFrame(pairs, f"k long, o string, f {typ}")
        stored, wanted = x.select("k", F.col("o").alias("f")), x.select("k", "f")
        for kind in ([DF.DATE] if typ == "date" else [DF.PLAIN, DF.INT, DF.YESNO]):
            for sms in ([True] if typ == "date" else [True, False]):
                rules = [DF.FieldRule("f", kind)]
                want = _set(DF.diff_fields(stored, wanted, "k", rules, sms))
                assert _set(DG.diff_fields(stored, wanted, "k", rules, DG.key_range("k", 1), sms)) == want, (typ, kind, sms)
