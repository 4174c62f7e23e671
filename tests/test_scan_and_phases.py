"""Skew-safe numbering and the as-of scan against plain window forms."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from canvass.operators import phases as PH
from canvass.operators import scan as S


def test_numbered_equals_row_number(spark):
    rows = [(g, i) for g in ("hot",) * 1 for i in range(500)] + [("x", i) for i in range(37)]
    df = spark.createDataFrame(rows, "g string, k long")
    got = S.numbered(df, ["g"], ["k"], out="rn", partitions=7)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("long"))
    assert sorted(got.collect()) == sorted(want.collect())
    b = S.batches(df, 100, ["k"], ["g"]).filter(F.col("g") == "hot").groupBy("batch").count().collect()
    assert sorted((r["batch"], r["count"]) for r in b) == [(i, 100) for i in range(5)]


def test_asof_scan_equals_broadcast(spark):
    days = spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(days=i),) for i in range(0, 400, 3)], "ds date")
    starts = spark.createDataFrame([(dt.date(2020, m, 1),) for m in range(2, 13)], "boundary date")
    ends = spark.createDataFrame([(dt.date(2020, m, 28),) for m in range(1, 12)], "boundary date")
    for latest, b in ((True, starts), (False, ends)):
        fast = PH.asof_bound(days, "ds", b, "boundary", "x", latest_le=latest)
        scan = PH._asof_scan(days.select("ds").distinct(), "ds", b.distinct(), "boundary", "x", latest)
        assert sorted(fast.collect()) == sorted(scan.collect())


def test_assign_phase_inner_semantics(spark):
    days = spark.createDataFrame([(dt.date(2018, 10, d),) for d in (10, 11, 15, 31)], "ds date")
    starts = spark.createDataFrame([(dt.date(2018, 10, 11),), (dt.date(2018, 10, 15),)], "boundary date")
    ends = spark.createDataFrame([(dt.date(2018, 10, 14),), (dt.date(2018, 10, 21),)], "boundary date")
    got = {r["ds"].day: (r["timeframe_start"].day, r["timeframe_end"].day)
           for r in PH.assign_phase(days, "ds", starts, ends).collect()}
    assert got == {11: (11, 14), 15: (15, 21)}


def test_sites_by_phase_large_calendar_path(spark, monkeypatch):
    phases = spark.createDataFrame(
        [(dt.date(2018, 10, 11), dt.date(2018, 10, 14)), (dt.date(2018, 10, 15), dt.date(2018, 10, 21)),
         (dt.date(2018, 10, 22), dt.date(2018, 10, 26))], "timeframe_start date, timeframe_end date")
    sites = spark.createDataFrame(
        [(1, dt.date(2018, 10, 12), dt.date(2018, 10, 20)), (2, dt.date(2018, 10, 15), dt.date(2018, 10, 15)),
         (3, dt.date(2018, 10, 1), dt.date(2018, 10, 30)), (4, dt.date(2018, 10, 26), dt.date(2018, 10, 27))],
        "site int, start_date date, end_date date")
    small = sorted(tuple(r) for r in PH.sites_by_phase(sites, phases).collect())
    monkeypatch.setattr(PH, "BROADCAST_BOUNDARIES", 1)
    large = sorted(tuple(r) for r in PH.sites_by_phase(sites, phases)
                   .select("site", "start_date", "end_date", "timeframe_start", "timeframe_end").collect())
    assert [r[0] for r in small] == [1, 2, 4]
    assert large == small


def test_sites_by_phase_of_any_length(spark):
    import random

    rnd = random.Random(3)
    day = dt.date(1990, 1, 1)
    phases = [(day + dt.timedelta(days=(a := rnd.randrange(12000))), day + dt.timedelta(days=a + n))
              for n in [0, 1, 2, 6, 30, 364, 9000, 12000] + [rnd.randrange(40) for _ in range(60)]]
    odd = [(None, day), (day, None), (day + dt.timedelta(days=9), day), phases[0]]
    phases += odd + [(dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    sites = [(i, (s := day + dt.timedelta(days=rnd.randrange(14000))), s + dt.timedelta(days=rnd.randrange(50)))
             for i in range(400)] + [(900, None, day), (901, day, None), (902, phases[0][0], phases[0][1])]
    got = PH.sites_by_phase(spark.createDataFrame(sites, "site int, start_date date, end_date date"),
                            spark.createDataFrame(phases, "timeframe_start date, timeframe_end date"))
    want = [(i, a, b) for i, s, e in sites for a, b in phases
            if None not in (s, e, a, b) and a <= s <= b and e >= a]
    assert sorted((r["site"], r["timeframe_start"], r["timeframe_end"]) for r in got.collect()) == sorted(want)


def test_sites_by_phase_lists_are_logarithmic(spark):
    day = dt.date(2000, 1, 1)
    ph = spark.createDataFrame([(0, n) for n in (1, 7, 365, 20000)], "a long, b long")
    n = {r["b"]: len(r["n"]) for r in ph.select("b", PH._dyadic_nodes(F.col("a") + 1, F.col("b") + 1).alias("n")).collect()}
    assert n[1] == 1 and all(v <= 2 * k.bit_length() for k, v in n.items())
    none = spark.createDataFrame([], "timeframe_start date, timeframe_end date")
    sites = spark.createDataFrame([(1, day, day)], "site int, start_date date, end_date date")
    assert PH.sites_by_phase(sites, none).count() == 0
