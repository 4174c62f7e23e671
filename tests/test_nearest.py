"""Grid nearest / tolerance / radius operators against brute force."""

import math
import random

from pyspark.sql import functions as F

from canvass.functions import geo
from canvass.operators import nearest as nn


def hav(lat0, lng0, lat1, lng1):
    r = math.radians
    a = math.sin((r(lat1) - r(lat0)) / 2) ** 2 + math.cos(r(lat0)) * math.cos(r(lat1)) * math.sin((r(lng1) - r(lng0)) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_METRES * math.asin(min(1.0, math.sqrt(a))) / geo.METRES_PER_MILE


def points(seed, n, lat0=40.0, lng0=-97.0, span=6.0):
    rnd = random.Random(seed)
    return [(i, lat0 + rnd.random() * span, lng0 + rnd.random() * span) for i in range(n)]


def test_nearest_matches_brute_force_with_several_passes(spark):
    o = points(1, 300)
    p = points(2, 40) + [(1000, 40.5, -96.5), (1001, 40.5, -96.5)]  # exact tie -> smaller id
    odf = spark.createDataFrame(o, "oid long, olat double, olng double")
    pdf = spark.createDataFrame(p, "pid long, plat double, plng double")
    # a tiny first cell forces several coarsening passes
    got = nn.band_candidates(odf, pdf, ["oid"], "pid", "olat", "olng", "plat", "plng", start_edge=1e-4)
    got = {r["oid"]: min((r["distance"], r["pid"]) for r in [r]) for r in got.collect()}
    best = nn.nearest(odf, pdf, ["oid"], "pid", "olat", "olng", "plat", "plng").collect()
    best = {r["oid"]: (r["distance"], r["pid"]) for r in best}
    for oid, la, ln in o:
        want = min((round(hav(la, ln, pla, pln), 6), pid) for pid, pla, pln in p)
        assert best[oid][1] == want[1]
        assert abs(best[oid][0] - want[0]) < 1e-6
    assert set(got) == set(best)


def test_tolerance_rule(spark):
    # origin 0: two sites within 1e-5 miles -> the earlier start wins; exact tie keeps both
    o = spark.createDataFrame([(0, 41.0, -95.0), (1, 41.0, -95.0)], "oid long, olat double, olng double")
    p = spark.createDataFrame(
        [(10, 41.1, -95.0, "2020-01-05", 0), (11, 41.1, -95.0, "2020-01-03", 0),
         (12, 41.1, -95.0, "2020-01-01", 1), (13, 41.1, -95.0, "2020-01-01", 1),
         (14, 41.3, -95.0, "2019-01-01", 1)],
        "pid long, plat double, plng double, start string, grp int")
    o = o.withColumn("grp", F.col("oid").cast("int"))
    r = nn.nearest_with_tolerance(o, p, ["oid"], "pid", "olat", "olng", "plat", "plng", "start", match=["grp"])
    got = sorted((x["oid"], x["pid"]) for x in r.collect())
    assert got == [(0, 11), (1, 12), (1, 13)]


def test_within_radius_matches_brute_force(spark):
    o = points(3, 120)
    p = points(4, 150)
    odf = spark.createDataFrame(o, "oid long, olat double, olng double")
    pdf = spark.createDataFrame(p, "pid long, plat double, plng double")
    got = {(r["oid"], r["pid"]) for r in nn.within_radius(odf, pdf, "olat", "olng", "plat", "plng", 40.0).collect()}
    want = {(a, b) for a, la, ln in o for b, pla, pln in p if round(hav(la, ln, pla, pln), 6) <= 40.0}
    assert got == want


def test_dense_cluster_refines_first_cell_and_stays_exact(spark):
    import random
    rnd = random.Random(5)
    # a third of the sites packed into a ~1-mile square, the rest spread out
    spread = points(6, 400)
    cluster = [(1000 + i, 41.0 + rnd.random() * 0.01, -95.0 + rnd.random() * 0.01) for i in range(200)]
    p = spread + cluster
    o = points(7, 150) + [(900 + i, 41.005 + rnd.random() * 0.002, -95.005 + rnd.random() * 0.002)
                          for i in range(30)]
    odf = spark.createDataFrame(o, "oid long, olat double, olng double")
    pdf = spark.createDataFrame(p, "pid long, plat double, plng double")
    pts = nn._with_xyz(pdf.select("pid", "plat", "plng"), "plat", "plng", "_p")
    coarse = nn._initial_edge(nn._poi_stats(pdf, "plat", "plng", []))
    old = nn.MAX_POINTS_PER_CELL
    nn.MAX_POINTS_PER_CELL = 32
    try:
        assert nn._refine_edge(pts, [], coarse) < coarse
        best = {r["oid"]: (r["distance"], r["pid"])
                for r in nn.nearest(odf, pdf, ["oid"], "pid", "olat", "olng", "plat", "plng").collect()}
    finally:
        nn.MAX_POINTS_PER_CELL = old
    for oid, la, ln in o:
        want = min((round(hav(la, ln, pla, pln), 6), pid) for pid, pla, pln in p)
        assert best[oid][1] == want[1], oid


def test_stacked_points_fill_several_lists(spark, monkeypatch):
    # a third of all points on one spot: lists are split, ties and bands stay exact
    monkeypatch.setattr(nn, "LIST_POINTS", 16)
    p = points(8, 120) + [(1000 + i, 41.0, -95.0) for i in range(60)]
    o = points(9, 80) + [(900 + i, 41.0 + i * 1e-3, -95.0) for i in range(20)] + [(990, None, 1.0)]
    odf = spark.createDataFrame(o, "oid long, olat double, olng double")
    pdf = spark.createDataFrame(p, "pid long, plat double, plng double")
    got = {(r["oid"], r["pid"]) for r in nn.band_candidates(
        odf, pdf, ["oid"], "pid", "olat", "olng", "plat", "plng", band=0.5).collect()}
    want = set()
    for oid, la, ln in o:
        if la is not None:
            dist = {pid: round(hav(la, ln, pla, pln), 6) for pid, pla, pln in p}
            want |= {(oid, pid) for pid, x in dist.items() if x <= min(dist.values()) + 0.5}
    assert {x for x in got ^ want} == set()


def test_no_candidate_is_shuffled(spark):
    odf = spark.createDataFrame(points(1, 50), "oid long, olat double, olng double")
    pdf = spark.createDataFrame(points(2, 40), "pid long, plat double, plng double")
    spark.catalog.clearCache()
    out = nn.band_candidates(odf, pdf, ["oid"], "pid", "olat", "olng", "plat", "plng", start_edge=2.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert {r["oid"] for r in out.collect()} == set(range(50))
