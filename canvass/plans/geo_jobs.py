"""Geo jobs bound to the driver tables: P2 nearest office, P1 nearest site by
phase with tolerance, J13 phase mapping, J22 radius search."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.geo import cosine_miles_sql, sphere_miles_sql
from canvass.operators import nearest as nn
from canvass.operators.joins import CONFIG_ROWS
from canvass.operators.phases import assign_phase, sites_by_phase
from canvass.operators.radius import first_k_within
from canvass.operators.sizing import broadcast_if_small
from canvass.plans import derive as d
from canvass.sources.tables import Tables

MESSAGE_PREFIX = "Your nearest office is at "


def nearest_poi(spark: SparkSession, base: str) -> DataFrame:
    t = Tables(spark, base)
    origins = d.customer_geo(t.customer).select("c_custkey", "c_lat", "c_lng")
    pois = d.supplier_geo(t.supplier).select("s_suppkey", "s_name", "s_lat", "s_lng")
    res = nn.nearest(origins, pois, ["c_custkey"], "s_suppkey", "c_lat", "c_lng", "s_lat", "s_lng")
    return res.select(F.col("c_custkey").alias("origin_key"), "s_suppkey", "distance",
                      F.concat(F.lit(MESSAGE_PREFIX), F.col("s_name"), F.lit("!")).alias("message"))


NEAREST_POI_SQL = f"""
WITH o AS (SELECT c_custkey, {d.CUSTOMER_LAT_SQL} AS c_lat, {d.CUSTOMER_LNG_SQL} AS c_lng FROM customer),
p AS (SELECT s_suppkey, s_name, {d.SUPPLIER_LAT_SQL} AS s_lat, {d.SUPPLIER_LNG_SQL} AS s_lng FROM supplier),
x AS (SELECT o.c_custkey, p.s_suppkey, p.s_name,
             round({sphere_miles_sql('o.c_lat', 'o.c_lng', 'p.s_lat', 'p.s_lng')}, 6) AS distance
        FROM o CROSS JOIN p),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance, s_suppkey) AS rn FROM x)
SELECT c_custkey AS origin_key, s_suppkey, distance,
       '{MESSAGE_PREFIX}' || s_name || '!' AS message
  FROM r WHERE rn = 1
"""


# Phase boundaries are data: quarter starts and quarter ends of the order dates.
def _phase_bounds(orders: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    days = orders.select(F.to_date("o_orderdate").alias("ds")).distinct()
    starts = days.select(F.trunc("ds", "quarter").alias("boundary")).distinct()
    ends = days.select(F.date_sub(F.add_months(F.trunc("ds", "quarter"), 3), 1).alias("boundary")).distinct()
    return days, starts, ends


def phase_asof(spark: SparkSession, base: str) -> DataFrame:
    t = Tables(spark, base)
    days, starts, ends = _phase_bounds(t.orders)
    m = assign_phase(days, "ds", starts, ends)
    return m.select(F.date_format("ds", "yyyy-MM-dd").alias("ds"),
                    F.date_format("timeframe_start", "yyyy-MM-dd").alias("timeframe_start"),
                    F.date_format("timeframe_end", "yyyy-MM-dd").alias("timeframe_end"))


_PHASE_CTE = """
days AS (SELECT DISTINCT cast(o_orderdate AS date) AS ds FROM orders),
starts AS (SELECT DISTINCT cast(date_trunc('quarter', ds) AS date) AS b FROM days),
ends AS (SELECT DISTINCT cast(date_trunc('quarter', ds) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS date) AS b FROM days),
mapping AS (
  SELECT d.ds, max(s.b) AS timeframe_start, min(e.b) AS timeframe_end
    FROM days d JOIN starts s ON s.b <= d.ds JOIN ends e ON e.b >= d.ds
   GROUP BY d.ds)"""

PHASE_ASOF_SQL = f"""
WITH {_PHASE_CTE}
SELECT strftime(ds, '%Y-%m-%d') AS ds, strftime(timeframe_start, '%Y-%m-%d') AS timeframe_start,
       strftime(timeframe_end, '%Y-%m-%d') AS timeframe_end FROM mapping
"""


def nearest_by_phase_tolerance(spark: SparkSession, base: str) -> DataFrame:
    """P1 core: per (phase, customer) the nearest open site in the same nation,
    1e-5-mile tolerance preferring the earlier start date, under 500 miles."""
    res = nearest_sites(spark, base)
    return res.select(F.date_format("timeframe_start", "yyyy-MM-dd").alias("timeframe_start"),
                      F.date_format("timeframe_end", "yyyy-MM-dd").alias("timeframe_end"),
                      "c_custkey", "site_id",
                      F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
                      "distance_to_site")


def nearest_sites(spark: SparkSession, base: str, phase_end: Callable[[str], Column] | None = None) -> DataFrame:
    """Typed form of ``nearest_by_phase_tolerance`` (dates stay dates). ``phase_end``: a condition on the end of a
    phase; only phases that meet it are searched (each has a search of its own)."""
    t = Tables(spark, base)
    days, starts, ends = _phase_bounds(t.orders)
    # The phase calendar is a small dimension read by several size checks and
    # joins below: keep it once.
    phases = assign_phase(days, "ds", starts, ends).select("timeframe_start", "timeframe_end").distinct()
    if phase_end is not None:
        phases = phases.where(phase_end("timeframe_end"))
    phases = phases.persist(StorageLevel.MEMORY_AND_DISK)
    sites = d.supplier_sites(t.supplier).select(
        F.col("s_nationkey").alias("county"), "s_suppkey", "s_lat", "s_lng", "start_date", "end_date")
    sp = sites_by_phase(sites, phases)
    people = d.customer_geo(t.customer).select("c_custkey", F.col("c_nationkey").alias("county"),
                                               "c_lat", "c_lng")
    # One origin per (person, phase open in the person's county): phases are a
    # small dimension, so this matches the reference's phases x people rows.
    # People are dealt before they are multiplied by the phases: a shuffle of
    # one row a person, which a broadcast (county, phase) list leaves in place.
    # Where the lists of the search are broadcast too, its windows use the same partitions.
    county_phases = broadcast_if_small(sp.select("county", "timeframe_start", "timeframe_end").distinct(), CONFIG_ROWS)
    origins = people.repartition("c_custkey").join(county_phases, "county")
    res = nn.nearest_with_tolerance(
        origins, sp.withColumnRenamed("s_suppkey", "site_id"),
        ["c_custkey", "timeframe_start", "timeframe_end"], "site_id",
        "c_lat", "c_lng", "s_lat", "s_lng", "start_date",
        match=["county", "timeframe_start", "timeframe_end"], metric=nn.COSINE_MILES,
        eps=1e-5, cap=500.0, dist_col="distance_to_site")
    return res.select("timeframe_start", "timeframe_end", "c_custkey", "site_id", "start_date",
                      "distance_to_site")


NEAREST_BY_PHASE_TOLERANCE_SQL = f"""
WITH {_PHASE_CTE},
phases AS (SELECT DISTINCT timeframe_start, timeframe_end FROM mapping),
sites AS (SELECT s_suppkey AS site_id, s_nationkey AS county, {d.SUPPLIER_LAT_SQL} AS s_lat,
                 {d.SUPPLIER_LNG_SQL} AS s_lng, {d.SITE_START_SQL} AS start_date, {d.SITE_END_SQL} AS end_date
            FROM supplier),
people AS (SELECT c_custkey, c_nationkey AS county, {d.CUSTOMER_LAT_SQL} AS c_lat, {d.CUSTOMER_LNG_SQL} AS c_lng
             FROM customer),
cand AS (
  SELECT p.timeframe_start, p.timeframe_end, v.c_custkey, s.site_id, s.start_date,
         round({cosine_miles_sql('v.c_lat', 'v.c_lng', 's.s_lat', 's.s_lng')}, 6) AS distance_to_site
    FROM phases p CROSS JOIN people v
    JOIN sites s ON s.county = v.county
     AND s.start_date <= p.timeframe_end AND s.start_date >= p.timeframe_start
     AND s.end_date >= p.timeframe_start)
SELECT strftime(a.timeframe_start, '%Y-%m-%d') AS timeframe_start,
       strftime(a.timeframe_end, '%Y-%m-%d') AS timeframe_end,
       a.c_custkey, a.site_id, strftime(a.start_date, '%Y-%m-%d') AS start_date, a.distance_to_site
  FROM cand a
  LEFT JOIN cand b
    ON b.timeframe_start = a.timeframe_start AND b.timeframe_end = a.timeframe_end
   AND b.c_custkey = a.c_custkey
   AND CASE WHEN abs(round(a.distance_to_site * 1000000) - round(b.distance_to_site * 1000000)) < 10
            THEN a.start_date > b.start_date
            ELSE a.distance_to_site > b.distance_to_site END
 WHERE b.c_custkey IS NULL AND a.distance_to_site < 500.0
"""


RADIUS_MILES = 50.0
RADIUS_TOP = 3
RADIUS_FROM, RADIUS_TO = "1995-06-01", "1999-12-31"
RADIUS_TYPES = (0, 1, 2)


def radius_events(spark: SparkSession, base: str) -> DataFrame:
    """Per customer, the first 3 sites (by id) within 50 miles that start in
    a time range, are of a listed type and not full (positive balance). The
    filters come before the join; cells wholly inside the radius answer from their lists."""
    t = Tables(spark, base)
    origins = d.customer_geo(t.customer).select("c_custkey", "c_lat", "c_lng")
    open_ = (F.col("start_date").between(F.lit(RADIUS_FROM).cast("date"), F.lit(RADIUS_TO).cast("date"))
             & (F.col("s_nationkey") % 4).isin(*RADIUS_TYPES) & (F.col("s_acctbal") > 0))
    pois = d.supplier_sites(t.supplier).where(open_).select("s_suppkey", "s_lat", "s_lng")
    return first_k_within(origins, pois, "c_custkey", "s_suppkey", "c_lat", "c_lng", "s_lat", "s_lng", RADIUS_MILES, RADIUS_TOP)


RADIUS_EVENTS_SQL = f"""
WITH o AS (SELECT c_custkey, {d.CUSTOMER_LAT_SQL} AS c_lat, {d.CUSTOMER_LNG_SQL} AS c_lng FROM customer),
p AS (SELECT s_suppkey, {d.SUPPLIER_LAT_SQL} AS s_lat, {d.SUPPLIER_LNG_SQL} AS s_lng FROM supplier
       WHERE {d.SITE_START_SQL} BETWEEN DATE '{RADIUS_FROM}' AND DATE '{RADIUS_TO}'
         AND s_nationkey % 4 IN {RADIUS_TYPES} AND s_acctbal > 0),
x AS (SELECT o.c_custkey, p.s_suppkey,
             round({sphere_miles_sql('o.c_lat', 'o.c_lng', 'p.s_lat', 'p.s_lng')}, 6) AS distance
        FROM o CROSS JOIN p),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY s_suppkey) AS rn
        FROM x WHERE distance <= {RADIUS_MILES})
SELECT c_custkey, s_suppkey, distance FROM r WHERE rn <= {RADIUS_TOP}
"""
