"""The k smallest ids within a radius, against all pairs measured in numpy."""

import math
import random

import pytest

from canvass.operators import radius
from canvass.operators.nearest import SPHERE_MILES

R = SPHERE_MILES.radius


def _miles(a, b):
    la, lb = math.radians(a[0]), math.radians(b[0])
    dl = math.radians(b[1] - a[1])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(dl / 2) ** 2
    return 2 * R * math.asin(math.sqrt(h))


def _brute(origins, pois, dist, k):
    out = {}
    for o, la, ln in origins:
        ids = sorted(p for p, pa, pn in set(pois) if _miles((la, ln), (pa, pn)) <= dist)
        out[o] = ids[:k]
    return {o: v for o, v in out.items() if v}


def _run(spark, origins, pois, dist, k):
    o = spark.createDataFrame(origins, "o long, la double, ln double")
    p = spark.createDataFrame(pois, "p long, pa double, pn double")
    got = {}
    for r in radius.first_k_within(o, p, "o", "p", "la", "ln", "pa", "pn", dist, k).collect():
        got.setdefault(r["o"], []).append(r["p"])
    return {o: sorted(v) for o, v in got.items()}


@pytest.mark.parametrize("dist,k", [(30.0, 3), (400.0, 5)])
def test_dense_cluster_and_wide_spread(spark, dist, k):
    rnd = random.Random(7)
    pois = [(i, 40 + rnd.gauss(0, 0.3), -75 + rnd.gauss(0, 0.3)) for i in range(3000, 4500)]
    pois += [(i, rnd.uniform(25, 48), rnd.uniform(-120, -70)) for i in range(600)]
    # smaller ids lie outside most radii: the rim has to be opened
    rnd.shuffle(pois)
    origins = [(i, 40 + rnd.gauss(0, 0.5), -75 + rnd.gauss(0, 0.5)) for i in range(150)]
    origins += [(1000 + i, rnd.uniform(25, 48), rnd.uniform(-120, -70)) for i in range(50)]
    assert _run(spark, origins, pois, dist, k) == _brute(origins, pois, dist, k)


def test_stacked_points_are_measured_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(radius, "FEW_POINTS", 0)
    monkeypatch.setattr(radius, "MAX_LEVELS", 2)
    rnd = random.Random(3)
    pois = [(i, 10 + (i % 40) * 1e-3, 20.0) for i in range(400)]
    origins = [(i, 10 + rnd.uniform(-0.5, 0.5), 20 + rnd.uniform(-0.5, 0.5)) for i in range(80)]
    assert _run(spark, origins, pois, 20.0, 4) == _brute(origins, pois, 20.0, 4)


@pytest.mark.parametrize("few", [0, 1024])
def test_odd_rows(spark, monkeypatch, few):
    monkeypatch.setattr(radius, "FEW_POINTS", few)
    pois = [(1, 0.0, 179.99), (1, 0.0, 179.99), (2, 0.0, -179.99), (3, None, 0.0), (None, 0.0, 180.0), (4, 89.99, 0.0)]
    origins = [(1, 0.0, 180.0), (2, 90.0, 77.0), (3, None, 1.0), (None, 0.0, 180.0), (5, -45.0, 0.0)]
    assert _run(spark, origins, pois, 10.0, 3) == {1: [1, 2], 2: [4]}
    assert _run(spark, origins, [], 10.0, 3) == {}
    assert _run(spark, [], pois, 10.0, 3) == {}


def test_rows_met_grow_with_the_rows(spark):
    """A radius that holds nearly all points: an origin meets lists of cells, not the points."""
    rnd = random.Random(11)
    pois = [(i, 40 + rnd.uniform(-1, 1), -75 + rnd.uniform(-1, 1)) for i in range(8000)]
    origins = [(i, 40 + rnd.uniform(-1, 1), -75 + rnd.uniform(-1, 1)) for i in range(200)]
    assert _run(spark, origins, pois, 60.0, 3) == _brute(origins, pois, 60.0, 3)
