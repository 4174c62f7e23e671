"""Scans on more rows than a range-partition sample holds; null groups; overlapping phases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from canvass.operators import phases as P
from canvass.operators import scan as S


def test_numbers_are_whole_on_a_large_table_with_payload(spark):
    df = spark.range(0, 1_200_000, 1, 8).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("int")).alias("g"),
        F.repeat(F.col("id").cast("string"), 6).alias("payload"))
    one = S.numbered(df, [], ["k"]).where("rn != k + 1")
    assert one.count() == 0
    got = S.numbered(df, ["g"], ["k"])
    assert got.where(F.col("rn") != F.floor(F.col("k") / 3) + 1).count() == 0
    assert got.count() == 1_200_000 and S.batches(df, 1000, ["k"], ["g"]).select("g", "batch").distinct().count() == 1200


def test_running_max_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, i, i * 7 % 11) for i in range(40)] + [("a", i, i * 5 % 13) for i in range(40)], "k string, t long, v int")
    got = {(r.k, r.t): r.m for r in S.prior_max(df, ["k"], "t", "v", "m", bucket_width=8).collect()}
    for k, f in ((None, lambda i: i * 7 % 11), ("a", lambda i: i * 5 % 13)):
        assert [got[k, i] for i in range(40)] == [None] + [max(f(j) for j in range(i)) for i in range(1, 40)]


@pytest.mark.parametrize("latest", [True, False])
def test_asof_scan_equals_broadcast_on_a_large_table(spark, latest):
    day = F.date_add(F.lit(dt.date(1900, 1, 1)), F.col("id").cast("int"))
    keys = spark.range(0, 1_000_000).select(day.alias("day"))
    bounds = spark.range(5, 1_000_000, 1777).select(day.alias("b"))
    a = P.asof_bound(keys, "day", bounds, "b", "bound", latest_le=latest, bounds_small=True)
    b = P.asof_bound(keys, "day", bounds, "b", "bound", latest_le=latest, bounds_small=False)
    assert b.count() == 1_000_000 and a.exceptAll(b).count() == 0


@pytest.mark.parametrize("limit", [200_000, 0])
def test_sites_in_overlapping_phases(spark, monkeypatch, limit):
    monkeypatch.setattr(P, "BROADCAST_SPANS", limit)
    d0 = dt.date(2024, 1, 1)
    days = lambda n: d0 + dt.timedelta(n)
    phases = [(days(s), days(s + n)) for s, n in ((0, 40), (3, 2), (3, 60), (20, 0), (50, 5), (9, -2))]
    sites = [(i, days(i), days(i + i % 7)) for i in range(80)]
    got = sorted((r.site, r.timeframe_start) for r in P.sites_by_phase(
        spark.createDataFrame(sites, "site int, start_date date, end_date date"),
        spark.createDataFrame(phases, "timeframe_start date, timeframe_end date")).collect())
    assert got == sorted((i, a) for i, s, e in sites for a, b in phases if a <= s <= b and e >= a)
