"""P11 end to end: a text asks for events near a postal code; the answer is the first open
event within the radius, its time in its own zone and its link with a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions.geo import sphere_miles_sql
from canvass.functions.text import add_utm_source
from canvass.functions.timefmt import epoch_seconds, local_event_time
from canvass.operators.radius import first_k_within
from canvass.plans import derive as d
from canvass.plans.event_jobs import ZONES
from canvass.plans.geo_jobs import RADIUS_FROM, RADIUS_MILES, RADIUS_TO, RADIUS_TYPES
from canvass.sources.tables import Tables

SPONSORS = tuple(range(15))


def event_lookup(spark: SparkSession, base: str, utm_source: str = "sms flow", max_dist: float = RADIUS_MILES,
                 types: tuple[int, ...] = RADIUS_TYPES, start: str = RADIUS_FROM, end: str = RADIUS_TO,
                 sponsors: tuple[int, ...] = SPONSORS) -> DataFrame:
    """One row per request: ``status`` 400 without a postal code in the text, else 200 with ``count`` 0 or 1 and the
    event: id, local time, link. Events of listed sponsors and types that start in the time range and are not full."""
    t = Tables(spark, base)
    text = F.when(F.col("c_custkey") % 7 == 0, F.lit("events please")).otherwise(
        F.concat(F.lit("EVENTS "), F.lpad(((F.col("c_custkey") * 37) % 99999).cast("string"), 5, "0")))
    asked = d.customer_geo(t.customer).select("c_custkey", "c_lat", "c_lng", C.extract_postal_code(text).alias("zip"))
    asked = asked.withColumn("ok", F.coalesce(F.col("zip") != "", F.lit(False)))
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("s_suppkey") % len(ZONES) + 1).cast("int"))
    open_ = (F.col("start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
             & (F.col("s_nationkey") % 4).isin(*types) & (F.col("s_acctbal") > 0) & F.col("s_nationkey").isin(*sponsors))
    events = d.supplier_sites(t.supplier).where(open_).withColumn("zone", zone)
    near = first_k_within(asked.where("ok"), events.select("s_suppkey", "s_lat", "s_lng"), "c_custkey", "s_suppkey",
                          "c_lat", "c_lng", "s_lat", "s_lng", max_dist, 1)
    # some links carry a query of their own
    link = F.concat(F.lit("https://events.example.org/e/"), F.col("s_suppkey").cast("string"),
                    F.when(F.col("s_suppkey") % 6 == 0, F.lit("?ref=1")).otherwise(F.lit("")))
    shown = events.select("s_suppkey", local_event_time(epoch_seconds(F.col("start_date").cast("timestamp")).cast("long"), F.col("zone")).alias("time"),
                          add_utm_source(link, utm_source).alias("url"))
    return (asked.select("c_custkey", "ok").join(near.join(shown, "s_suppkey"), "c_custkey", "left")
            .select("c_custkey", F.when(F.col("ok"), 200).otherwise(400).alias("status"),
                    F.when(F.col("ok"), F.when(F.col("s_suppkey").isNull(), 0).otherwise(1)).alias("count"),
                    "s_suppkey", "distance", "time", "url"))


EVENT_LOOKUP_SQL = f"""
WITH o AS (SELECT c_custkey, {d.CUSTOMER_LAT_SQL} AS c_lat, {d.CUSTOMER_LNG_SQL} AS c_lng, c_custkey % 7 <> 0 AS ok FROM customer),
p AS (SELECT s_suppkey, {d.SUPPLIER_LAT_SQL} AS s_lat, {d.SUPPLIER_LNG_SQL} AS s_lng,
             strftime(timezone(({ZONES!r})[s_suppkey % {len(ZONES)} + 1], timezone('UTC', cast({d.SITE_START_SQL} AS timestamp))), '%a, %b %-d at %-I:%M %p') AS time,
             'https://events.example.org/e/' || s_suppkey || CASE WHEN s_suppkey % 6 = 0 THEN '?ref=1' ELSE '?utm_source=sms%20flow' END AS url
        FROM supplier
       WHERE {d.SITE_START_SQL} BETWEEN DATE '{RADIUS_FROM}' AND DATE '{RADIUS_TO}'
         AND s_nationkey % 4 IN {RADIUS_TYPES} AND s_acctbal > 0 AND s_nationkey IN {SPONSORS}),
x AS (SELECT c_custkey, p.*, round({sphere_miles_sql('c_lat', 'c_lng', 's_lat', 's_lng')}, 6) AS distance FROM o CROSS JOIN p WHERE ok),
n AS (SELECT * FROM x WHERE distance <= {RADIUS_MILES} QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY s_suppkey) = 1)
SELECT o.c_custkey, CASE WHEN ok THEN 200 ELSE 400 END AS status, CASE WHEN ok THEN CASE WHEN s_suppkey IS NULL THEN 0 ELSE 1 END END AS count,
       s_suppkey, distance, time, url
  FROM o LEFT JOIN n ON n.c_custkey = o.c_custkey
"""
