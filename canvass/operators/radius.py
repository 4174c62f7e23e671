"""Radius search with a limit (J22): the ``k`` smallest ids within a distance of every origin.

Ranking all pairs within the radius costs the square of the rows where places
are dense. Here the points lie in a hierarchy of cells on the unit sphere (a
chord-length grid, each level half the edge of the one above), and every cell
keeps the ``k`` smallest ids in it. An origin walks from the top:

* a cell wholly outside the radius is left out, before any join;
* a cell wholly inside gives its ``k`` smallest, unmeasured: no other point of
  it can be among the origin's ``k``;
* of a cell on the rim the listed points are measured. The cell is opened
  (into its next level) only if it holds more points than it lists and its last
  listed id is smaller than the origin's ``k``-th found so far: all unlisted
  ids are greater than the last listed.

After the last level the points of the cells that are still open are measured
one by one. So an origin meets a handful of cells a level, whatever the number
of points within its radius.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.operators.nearest import (_OFFSETS, BROADCAST_POI_COPIES, SPHERE_MILES, Metric, _cell_xyz, _with_xyz,
                                       edge_for_distance, top_k_per, within_radius)
from canvass.operators.sizing import broadcast_if_small

LEAF_POINTS = 64     # levels are added until no cell of the last one holds more points
MAX_LEVELS = 14      # ... or so many: 2^-14 of the radius, points stacked on one place
# So few points are measured whole: an origin meets this many at most, and the
# rounds of the hierarchy would cost more.
FEW_POINTS = 1_024
_AXES = "xyz"


def _reach(dist: float, metric: Metric) -> float:
    return 2.0 * math.sin(min(math.pi / 2, max(dist, 0.0) / metric.radius / 2.0))


def _near2(cell: Column, h: float) -> Column:
    """Squared chord from the row's origin to the nearest place of a cell."""
    def axis(a: str) -> Column:
        o, lo = F.col(f"_o{a}"), cell[f"c{a}"] * F.lit(h)
        gap = F.greatest(lo - o, o - lo - F.lit(h), F.lit(0.0))
        return gap * gap
    return axis("x") + axis("y") + axis("z")


def _far2(cell: Column, h: float) -> Column:
    """Squared chord from the row's origin to the farthest corner of a cell."""
    def axis(a: str) -> Column:
        o, lo = F.col(f"_o{a}"), cell[f"c{a}"] * F.lit(h)
        far = F.greatest(F.abs(o - lo), F.abs(o - lo - F.lit(h)))
        return far * far
    return axis("x") + axis("y") + axis("z")


def _children(cell: Column) -> Column:
    return F.array(*[F.struct(*[(cell[f"c{a}"] * 2 + d).alias(f"c{a}") for a, d in zip(_AXES, (i, j, k))])
                     for i in (0, 1) for j in (0, 1) for k in (0, 1)])


def _levels(pois: DataFrame, match: list[str], h: float, n: int) -> int:
    """Number of levels below the first; one small aggregate a level."""
    for level in range(MAX_LEVELS):
        if n <= LEAF_POINTS:
            return level
        cell = _cell_xyz("_p", h / 2 ** level).alias("_cell")
        n = (pois.groupBy(*match, cell).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]) or 0
    return MAX_LEVELS if n > LEAF_POINTS else MAX_LEVELS - 1


def _pyramid(pois: DataFrame, match: list[str], poi_id: str, point: Column, h: float, levels: int, k: int) -> list[DataFrame]:
    """Cells of every level, top first: (match, _cell, _first = its k smallest points, _n). Each level is made
    of the lists of the level below, so no list or group is ever longer than 8 k."""
    fine = pois.withColumn("_cell", _cell_xyz("_p", h / 2 ** levels))
    keys = [*match, "_cell"]
    counts = fine.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(poi_id).asc(), *[F.col(f"_p{a}") for a in _AXES]))
    lists = (fine.withColumn("_rn", rank).where(F.col("_rn") <= k)
             .groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("_first")))
    out = [lists.join(counts, keys).persist(StorageLevel.MEMORY_AND_DISK)]
    for _ in range(levels):
        up = F.struct(*[F.floor(F.col("_cell")[f"c{a}"] / 2).alias(f"c{a}") for a in _AXES])
        out.insert(0, out[0].withColumn("_cell", up).groupBy(*keys)
                   .agg(F.slice(F.sort_array(F.flatten(F.collect_list("_first"))), 1, k).alias("_first"),
                        F.sum("_n").alias("_n")).persist(StorageLevel.MEMORY_AND_DISK))
    return out


def first_k_within(origins: DataFrame, pois: DataFrame, origin_id: str, poi_id: str, o_lat: str, o_lng: str,
                   p_lat: str, p_lng: str, max_dist: float, k: int, *, match: list[str] | None = None,
                   metric: Metric = SPHERE_MILES, digits: int = 6, dist_col: str = "distance") -> DataFrame:
    """(``origin_id``, ``match``, ``poi_id``, ``dist_col``): for every origin the ``k`` smallest ids among the points
    whose distance, rounded to ``digits``, is at most ``max_dist``; exact.

    ``match`` columns must be equal on both sides. Origin ids must be unique. Equal
    points (id and coordinates) count once; points at other places that share an id
    count each. Rows without an id or coordinates take no part,
    empty tables give no rows. The state of a round is persisted, from the fourth on
    checkpointed.
    """
    match = list(match or [])
    eps = max(1e-5, 10.0 ** -digits)
    inner, outer = _reach(max_dist - eps, metric) - 1e-9, _reach(max_dist + eps, metric) + 1e-9
    h = edge_for_distance(max_dist + eps, metric)
    pois = pois.where(F.col(poi_id).isNotNull() & F.col(p_lat).isNotNull() & F.col(p_lng).isNotNull())
    pois = pois.select(*match, poi_id, p_lat, p_lng).distinct()
    origins = origins.where(F.col(origin_id).isNotNull() & F.col(o_lat).isNotNull() & F.col(o_lng).isNotNull())
    origins = origins.select(origin_id, o_lat, o_lng, *match)
    n = pois.count()
    if n <= FEW_POINTS:
        pairs = within_radius(origins, pois, o_lat, o_lng, p_lat, p_lng, max_dist, match=match, metric=metric,
                              digits=digits, dist_col=dist_col)
        first = top_k_per(pairs, [origin_id], [F.col(c).asc() for c in (poi_id, p_lat, p_lng)], k)
        return first.select(origin_id, *match, poi_id, dist_col)
    pois = _with_xyz(pois, p_lat, p_lng, "_p")
    point = F.struct(F.col(poi_id).alias("id"), F.col(p_lat).alias("lat"), F.col(p_lng).alias("lng"))
    levels = _levels(pois, match, h, n)
    cells = _pyramid(pois, match, poi_id, point, h, levels, k)

    def measured(points: Column) -> Column:
        d = lambda p: F.round(metric.fn(F.col(o_lat), F.col(o_lng), p["lat"], p["lng"]), digits)
        return F.filter(points, lambda p: d(p) <= F.lit(max_dist))

    def merged(grouped) -> list[Column]:
        kept = [F.any_value(c).alias(c) for c in [o_lat, o_lng, "_ox", "_oy", "_oz", *match]]
        lists = F.flatten(F.array(F.any_value("_best"), F.flatten(F.collect_list("_found"))))
        return [*kept, F.slice(F.sort_array(F.array_distinct(lists)), 1, k).alias("_best")]

    # Dealt by origin: what a few input files hold is spread over all tasks before it is multiplied, and the
    # rounds group by origin without another shuffle wherever the cells are broadcast.
    state = _with_xyz(origins.repartition(origin_id), o_lat, o_lng, "_o")
    base = _cell_xyz("_o", h)
    state = state.withColumn("_best", F.array().cast(cells[0].schema["_first"].dataType)).withColumn(
        "_open", F.array(*[F.struct(*[(base[f"c{a}"] + d).alias(f"c{a}") for a, d in zip(_AXES, o)]) for o in _OFFSETS]))
    done: list[DataFrame] = []
    rims: DataFrame | None = state
    for level, table in enumerate(cells):
        edge = h / 2 ** level
        reachable = F.filter("_open", lambda c: _near2(c, edge) <= F.lit(outer * outer))  # noqa: B023
        # below the top an origin stays, with what it found, also where no cell is left to it
        spread = rims.withColumn("_cell", F.explode_outer(reachable) if level else F.explode(reachable)).drop("_open")
        met = spread.join(broadcast_if_small(table, BROADCAST_POI_COPIES // max(8, k)), [*match, "_cell"],
                          "left" if level else "inner")
        inside = _far2(F.col("_cell"), edge) <= F.lit(inner * inner if inner > 0 else -1.0)
        met = (met.withColumn("_in", inside)
               .withColumn("_found", F.when(F.col("_in"), F.col("_first")).otherwise(measured(F.col("_first"))))
               .withColumn("_rim", F.when(~F.col("_in") & (F.col("_n") > F.size("_first")),
                                          F.struct(F.element_at("_first", -1)["id"].alias("last"), F.col("_cell").alias("cell")))))
        state = met.groupBy(origin_id).agg(*merged(met), F.collect_list("_rim").alias("_rims"))
        worst = F.when(F.size("_best") >= k, F.try_element_at("_best", F.lit(k))["id"])
        open_ = F.filter("_rims", lambda r: F.col("_worst").isNull() | (r["last"] <= F.col("_worst")))
        state = (state.withColumn("_worst", worst).withColumn("_open", F.transform(open_, lambda r: r["cell"]))
                 .drop("_rims", "_worst"))
        state = state.checkpoint(eager=True) if level >= 3 else state.persist(StorageLevel.MEMORY_AND_DISK)
        done.append(state.where(F.size("_open") == 0))
        rims = state.where(F.size("_open") > 0)
        if rims.isEmpty():
            rims = None
            break
        if level < levels:
            rims = rims.withColumn("_open", F.flatten(F.transform("_open", _children)))
    if rims is not None:
        # the cells left open at the last level: their points, one by one
        pts = pois.withColumn("_cell", _cell_xyz("_p", h / 2 ** levels)).select(*match, "_cell", point.alias("_point"))
        met = rims.withColumn("_cell", F.explode("_open")).drop("_open").join(pts, [*match, "_cell"])
        met = met.withColumn("_found", measured(F.array("_point"))).where(F.size("_found") > 0)
        # a listed point is in _best already: distinct keeps it from counting twice
        ranked = F.row_number().over(Window.partitionBy(origin_id).orderBy(F.col("_point")))
        late = (met.select(origin_id, "_point").distinct().withColumn("_rn", ranked).where(F.col("_rn") <= k)
                .groupBy(origin_id).agg(F.collect_list("_point").alias("_late")))
        both = F.array_distinct(F.flatten(F.array("_best", F.coalesce("_late", F.slice("_best", 1, 0)))))
        done.append(rims.drop("_open").join(late, origin_id, "left")
                    .withColumn("_best", F.slice(F.sort_array(both), 1, k)).drop("_late"))
    cols = [origin_id, o_lat, o_lng, *match, "_best"]
    out = done[0].select(*cols)
    for d in done[1:]:
        out = out.unionByName(d.select(*cols))
    p = F.col("_p")
    return (out.withColumn("_p", F.explode("_best"))
            .select(origin_id, *match, p["id"].alias(poi_id),
                    F.round(metric.fn(F.col(o_lat), F.col(o_lng), p["lat"], p["lng"]), digits).alias(dist_col)))
