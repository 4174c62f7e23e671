"""Nearest-point and radius operators (J16, J17, J22, W6) without a cross join.

The reference pairs every origin with every point of interest and ranks the
pairs. Here points are bucketed into a 3-D grid over the unit sphere (a
chord-length grid, so cells are the same size at every latitude), each point
of interest is copied into the 27 cells around its own, and origins find
candidates with an equi join on the cell id. Any point outside the 3x3x3
block around an origin's cell is at least one cell edge ``h`` away in chord
length, i.e. at least ``R * 2 * asin(h / 2)`` along the sphere. An origin
whose best candidate is closer than that bound has its exact answer; the
rest go to a coarser grid (edge x4). Once the edge reaches 2 the block holds
the whole sphere, so the loop always ends with exact results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.functions import geo
from canvass.operators.sizing import broadcast_if_small

_OFFSETS = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
_ROUND_MARGIN = 2e-6  # distances are compared after rounding to 6 places


@dataclass(frozen=True)
class Metric:
    """A distance formula and the sphere radius (in output units) it uses."""
    fn: callable
    radius: float


SPHERE_MILES = Metric(geo.sphere_miles, geo.EARTH_RADIUS_METRES / geo.METRES_PER_MILE)
COSINE_MILES = Metric(geo.cosine_miles, geo.EARTH_RADIUS_MILES)


def _unit_xyz(lat: Column, lng: Column) -> tuple[Column, Column, Column]:
    la, ln = F.radians(lat), F.radians(lng)
    return F.cos(la) * F.cos(ln), F.cos(la) * F.sin(ln), F.sin(la)


def _with_xyz(df: DataFrame, lat: str, lng: str, prefix: str) -> DataFrame:
    x, y, z = _unit_xyz(F.col(lat), F.col(lng))
    return df.withColumn(f"{prefix}x", x).withColumn(f"{prefix}y", y).withColumn(f"{prefix}z", z)


def _chord2() -> Column:
    return (F.pow(F.col("_ox") - F.col("_px"), 2) + F.pow(F.col("_oy") - F.col("_py"), 2)
            + F.pow(F.col("_oz") - F.col("_pz"), 2))


def _cell_xyz(prefix: str, h: float) -> Column:
    return F.struct(F.floor(F.col(f"{prefix}x") / h).alias("cx"), F.floor(F.col(f"{prefix}y") / h).alias("cy"),
                    F.floor(F.col(f"{prefix}z") / h).alias("cz"))


def _neighbours_xyz(prefix: str, h: float) -> Column:
    bx, by, bz = [F.floor(F.col(f"{prefix}{a}") / h) for a in "xyz"]
    return F.array(*[F.struct((bx + i).alias("cx"), (by + j).alias("cy"), (bz + k).alias("cz"))
                     for i, j, k in _OFFSETS])


def _cell(lat: Column, lng: Column, h: float) -> Column:
    x, y, z = _unit_xyz(lat, lng)
    return F.struct(F.floor(x / h).alias("cx"), F.floor(y / h).alias("cy"), F.floor(z / h).alias("cz"))


def _neighbour_cells(lat: Column, lng: Column, h: float) -> Column:
    x, y, z = _unit_xyz(lat, lng)
    bx, by, bz = F.floor(x / h), F.floor(y / h), F.floor(z / h)
    return F.array(*[F.struct((bx + i).alias("cx"), (by + j).alias("cy"), (bz + k).alias("cz"))
                     for i, j, k in _OFFSETS])


def bound_for_edge(h: float, metric: Metric) -> float:
    """Smallest sphere distance from an origin to any point outside its 3x3x3 block."""
    return metric.radius * 2.0 * math.asin(min(1.0, h / 2.0))


def edge_for_distance(dist: float, metric: Metric) -> float:
    """Cell edge whose block bound is at least ``dist``."""
    ang = dist / metric.radius
    return min(2.0, 2.0 * math.sin(min(math.pi / 2, ang / 2.0)) * 1.0000001 + 1e-12)


def _poi_stats(pois: DataFrame, p_lat: str, p_lng: str, match: list[str]):
    """One small aggregate over the point side: count, match groups, largest
    group, extent."""
    per = pois.groupBy(*match).agg(F.count(F.lit(1)).alias("_n"),
                                   F.min(p_lat).alias("_a0"), F.max(p_lat).alias("_a1"),
                                   F.min(p_lng).alias("_b0"), F.max(p_lng).alias("_b1"))
    return per.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("g"), F.max("_n").alias("gmax"),
                   F.min("_a0").alias("a0"), F.max("_a1").alias("a1"),
                   F.min("_b0").alias("b0"), F.max("_b1").alias("b1")).first()


def _initial_edge(st) -> float:
    """Edge sized so a cell holds about one point of interest per match group."""
    if not st or not st["n"]:
        return 2.0
    lat_span = math.radians(max(st["a1"] - st["a0"], 1e-3))
    lng_span = math.radians(max(st["b1"] - st["b0"], 1e-3)) * max(
        math.cos(math.radians(max(abs(st["a0"]), abs(st["a1"])))), 0.05)
    per_group = max(1.0, st["n"] / max(1, st["g"] or 1))
    spacing = math.sqrt(lat_span * lng_span / per_group)
    # The block bound is about one edge; groups of a handful of points need
    # a wider first edge or many origins spill into a second pass.
    factor = 2.0 if per_group >= 16 else 4.0
    return min(2.0, max(factor * spacing, 1e-5))


# Densest cell allowed at the first pass: a cluster holding many points (say
# a third of all sites in one town) shrinks the first cell until no cell
# holds more than this many, so origins there compare with few candidates.
MAX_POINTS_PER_CELL = 256
MAX_REFINEMENTS = 6


def _refine_edge(pois: DataFrame, match: list[str], h: float, n_points: int | None = None) -> float:
    """Shrink ``h`` (x4 per step) while some cell holds too many points. One
    small aggregate per step; sparse origins later coarsen pass by pass."""
    if n_points is not None and n_points <= MAX_POINTS_PER_CELL:
        return h                       # no cell can hold more points than that
    for _ in range(MAX_REFINEMENTS):
        keys = [F.floor(F.col(f"_p{a}") / h).alias(f"_c{a}") for a in "xyz"]
        densest = (pois.groupBy(*match, *keys).agg(F.count(F.lit(1)).alias("_n"))
                   .agg(F.max("_n")).first()[0])
        if densest is None or densest <= MAX_POINTS_PER_CELL or h < 1e-6:
            break
        h /= 4.0
    return h


# Broadcast the 27x-copied point side only under this many copies. The
# copied rows hold just the id, match keys, coordinates and cell (about 100
# bytes), so the bound keeps the broadcast near 40 MB; other point columns
# are joined back by id after the search.
BROADCAST_POI_COPIES = 400_000


# Groups of so few points are compared whole, in one pass: more passes of a
# grid cost more than so many chords.
WHOLE_GROUP = 64
# Points in one list of a cell. A cell with more (points stacked on nearly the
# same place) has several lists, dealt by a hash of the point's id.
LIST_POINTS = 8_192


def _point_lists(pois: DataFrame, match: list[str], poi_id: str, fields: list[str], h: float, split: bool) -> DataFrame:
    """One row per cell (or several, each of about ``LIST_POINTS``) with the points ``_pts`` of the 27 cells around."""
    spread = pois.withColumn("_cell", F.explode(_neighbours_xyz("_p", h)))
    keys = [*match, "_cell"]
    if split:
        counts = spread.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / LIST_POINTS).alias("_lists"))
        spread = spread.join(counts, keys).withColumn("_list", F.pmod(F.xxhash64(poi_id, F.lit(1)), F.col("_lists")))
        keys.append("_list")
    return spread.groupBy(*keys).agg(F.collect_list(F.struct(*fields)).alias("_pts")).drop("_list")


def _chord(p: Column) -> Column:
    """Straight-line distance from the row's origin to point ``p`` on the unit sphere."""
    return F.sqrt(F.pow(F.col("_ox") - p["_px"], 2) + F.pow(F.col("_oy") - p["_py"], 2)
                  + F.pow(F.col("_oz") - p["_pz"], 2))


def _within_least(points: Column, measure, slack: float) -> Column:
    """The points whose measure is within ``slack`` of the least. The least is
    bound to a lambda's variable, so it is worked out once a list and not
    once a point, wherever the optimiser moves the expression."""
    least = F.array_min(F.transform(points, measure))
    return F.transform(F.array(least), lambda m: F.filter(points, lambda p: measure(p) <= m + F.lit(slack)))[0]


def band_candidates(origins: DataFrame, pois: DataFrame, origin_id: list[str], poi_id: str,
                    o_lat: str, o_lng: str, p_lat: str, p_lng: str, *,
                    match: list[str] | None = None, metric: Metric = SPHERE_MILES,
                    band: float = 0.0, digits: int = 6, start_edge: float | None = None,
                    dist_col: str = "distance") -> DataFrame:
    """For every origin, all points of interest whose rounded distance is within
    ``band`` of the origin's minimum, exactly.

    ``match`` columns must be equal on both sides (e.g. county, phase). The
    result holds the origin columns, the point columns and ``dist_col``
    (rounded to ``digits``). Origins with no point of interest give no row.
    An origin meets one list of points, that of its cell, and keeps of it only
    the band around its least distance, inside the row: no candidate is
    shuffled. Only where a match group is longer than a list may hold can an origin meet several
    lists; then the least distance is taken over their bands.
    Each pass is persisted (later passes and the result both read it); from
    the fourth pass on it is checkpointed to the session's checkpoint folder
    to cut the growing lineage.
    """
    match = list(match or [])
    o_cols = [c for c in origins.columns]
    p_cols = [c for c in pois.columns if c not in match]
    clash = set(o_cols) & set(p_cols)
    if clash:
        raise ValueError(f"origin and poi columns clash: {sorted(clash)}")
    origins = origins.filter(F.col(o_lat).isNotNull() & F.col(o_lng).isNotNull())
    pois = pois.filter(F.col(p_lat).isNotNull() & F.col(p_lng).isNotNull())
    core_cols = [poi_id, *match, p_lat, p_lng]
    extra = [c for c in pois.columns if c not in core_cols]
    payload = pois.select(poi_id, *extra) if extra else None
    pois = pois.select(*core_cols)
    st = _poi_stats(pois, p_lat, p_lng, match)
    poi_small = (st["n"] or 0) * len(_OFFSETS) <= BROADCAST_POI_COPIES
    # Unit vectors once per row; pairs are first pruned by chord length
    # (three multiply-adds), the trigonometric distance runs on survivors only.
    pois = _with_xyz(pois, p_lat, p_lng, "_p")
    # a cell never holds more points than the largest match group
    whole = (st["gmax"] or 0) <= WHOLE_GROUP
    h = start_edge or (2.0 if whole else _refine_edge(pois, match, _initial_edge(st), st["gmax"]))
    pending = _with_xyz(origins, o_lat, o_lng, "_o")
    o_names, o_cols = o_cols, o_cols + ["_ox", "_oy", "_oz"]
    slack = (band + 1e-5) / metric.radius + 1e-12
    # one list per cell unless some group of points could overfill it
    split = (st["gmax"] or 0) > LIST_POINTS
    results: list[DataFrame] = []
    while True:
        final = h >= 2.0
        bound = bound_for_edge(h, metric)
        lists = _point_lists(pois, match, poi_id, [poi_id, p_lat, p_lng, "_px", "_py", "_pz"], h, split)
        lists = F.broadcast(lists) if poi_small else lists
        met = pending.withColumn("_cell", _cell_xyz("_o", h)).join(lists, on=match + ["_cell"], how="left").drop("_cell")
        near = F.transform(
            _within_least(F.col("_pts"), _chord, slack),
            lambda p: F.struct(F.round(metric.fn(F.col(o_lat), F.col(o_lng), p[p_lat], p[p_lng]), digits).alias("_d"),
                               *[p[c].alias(c) for c in (poi_id, p_lat, p_lng)]))
        scored = (met.withColumn("_near", near).drop("_pts")
                  .withColumn("_least", F.array_min(F.transform("_near", lambda p: p["_d"]))))
        if split:
            # a cell's points may lie in several lists, each cut to its own band by now
            scored = scored.withColumn("_least", F.min("_least").over(Window.partitionBy(*origin_id)))
        ok = F.lit(True) if final else (F.col("_least") + F.lit(band + _ROUND_MARGIN) < F.lit(bound))
        scored = scored.withColumn("_ok", F.coalesce(ok, F.lit(False)))
        if not final:
            # Later passes and the result both read this pass: keep it once.
            # Past a few passes the lineage is cut with a reliable checkpoint.
            scored = (scored.checkpoint(eager=True) if len(results) >= 3
                      else scored.persist(StorageLevel.MEMORY_AND_DISK))
        best = F.transform(F.array("_least"), lambda m: F.filter("_near", lambda p: p["_d"] <= m + F.lit(band)))[0]
        results.append(scored.filter("_ok").withColumn("_p", F.explode(best))
                       .select(*o_names, *[F.col("_p")[c].alias(c) for c in (poi_id, p_lat, p_lng)],
                               F.col("_p")["_d"].alias(dist_col)))
        if final:
            break
        pending = scored.filter(~F.col("_ok")).select(*o_cols)
        if split:
            pending = pending.dropDuplicates(origin_id)
        if pending.isEmpty():
            break
        h = min(2.0, h * 4.0)
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    if payload is not None:
        out = out.join(payload, poi_id, "left")   # point columns back, by id
    return out


def nearest(origins: DataFrame, pois: DataFrame, origin_id: list[str], poi_id: str,
            o_lat: str, o_lng: str, p_lat: str, p_lng: str, *, match: list[str] | None = None,
            metric: Metric = SPHERE_MILES, digits: int = 6, dist_col: str = "distance",
            max_dist: float | None = None) -> DataFrame:
    """Nearest point of interest per origin (J16/W6): one row per origin, ties on
    the rounded distance go to the smallest ``poi_id``."""
    cands = band_candidates(origins, pois, origin_id, poi_id, o_lat, o_lng, p_lat, p_lng,
                            match=match, metric=metric, band=0.0, digits=digits, dist_col=dist_col)
    rn = F.row_number().over(Window.partitionBy(*origin_id).orderBy(F.col(dist_col).asc(),
                                                                    F.col(poi_id).asc()))
    out = cands.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")
    if max_dist is not None:
        out = out.filter(F.col(dist_col) < F.lit(max_dist))
    return out


def nearest_with_tolerance(origins: DataFrame, pois: DataFrame, origin_id: list[str], poi_id: str,
                           o_lat: str, o_lng: str, p_lat: str, p_lng: str, tiebreak: str, *,
                           match: list[str] | None = None, metric: Metric = COSINE_MILES,
                           eps: float = 1e-5, cap: float = 500.0, digits: int = 6,
                           dist_col: str = "distance") -> DataFrame:
    """Nearest with tolerance.

    A candidate ``a`` loses to ``b`` when ``|a-b| < eps`` and ``b`` has the
    earlier ``tiebreak``, or when ``a`` is farther by at least ``eps``. Every
    candidate no other beats is kept (exact ties all stay), then ``a < cap``.
    Survivors lie within ``eps`` of the minimum and can only be beaten by a
    candidate within ``2*eps`` of it, so the band search returns every row the
    rule needs; the "no earlier tiebreak within eps" test is a range-frame
    window over the distance, not a pairwise self join.
    """
    scale = 10 ** digits
    cands = band_candidates(origins, pois, origin_id, poi_id, o_lat, o_lng, p_lat, p_lng,
                            match=match, metric=metric, band=2 * eps, digits=digits,
                            dist_col=dist_col)
    # Compare rounded distances in integral 10^-digits units: exact, and range
    # frames need integral offsets anyway.
    units = int(round(eps * scale))
    key = F.round(F.col(dist_col) * scale).cast("long")
    wband = Window.partitionBy(*origin_id).orderBy(F.col("_k")).rangeBetween(-(units - 1), units - 1)
    wall = Window.partitionBy(*origin_id)
    out = (cands.withColumn("_k", key)
           .withColumn("_kmin", F.min("_k").over(wall))
           .withColumn("_first", F.min(tiebreak).over(wband))
           .filter((F.col("_k") - F.col("_kmin") < F.lit(units))
                   & ~(F.col("_first") < F.col(tiebreak)))
           .filter(F.col(dist_col) < F.lit(cap))
           .drop("_k", "_kmin", "_first"))
    return out


def within_radius(origins: DataFrame, pois: DataFrame, o_lat: str, o_lng: str, p_lat: str, p_lng: str,
                  max_dist: float, *, match: list[str] | None = None, metric: Metric = SPHERE_MILES,
                  digits: int = 6, dist_col: str = "distance") -> DataFrame:
    """All (origin, poi) pairs with distance <= ``max_dist`` (J22), by one grid
    equi join whose cell edge covers the radius: exact, no cross product."""
    match = list(match or [])
    h = edge_for_distance(max_dist, metric)
    pois = _with_xyz(pois, p_lat, p_lng, "_p")
    spread = pois.withColumn("_cell", F.explode(_neighbours_xyz("_p", h)))
    spread = broadcast_if_small(spread, BROADCAST_POI_COPIES)   # callers pass narrow point frames
    keyed = _with_xyz(origins, o_lat, o_lng, "_o").withColumn("_cell", _cell_xyz("_o", h))
    # chord prefilter (a little slack), then the exact rounded distance
    reach = 2.0 * math.sin(min(math.pi / 2, max_dist / metric.radius / 2.0)) + 1e-9
    d = F.round(metric.fn(F.col(o_lat), F.col(o_lng), F.col(p_lat), F.col(p_lng)), digits)
    return (keyed.join(spread, on=match + ["_cell"], how="inner").drop("_cell")
            .filter(_chord2() <= F.lit(reach * reach))
            .withColumn(dist_col, d).filter(F.col(dist_col) <= F.lit(max_dist))
            .drop("_ox", "_oy", "_oz", "_px", "_py", "_pz"))


def top_k_per(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows per key under a total order (Catalyst plans a WindowGroupLimit)."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= k).drop("_rn")
