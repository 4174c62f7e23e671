"""Distance expressions (X7, X8, U1). Plain Column arithmetic: stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sphere radii used by the two distance formulas.
EARTH_RADIUS_MILES = 3959.0          # law-of-cosines formula (X7)
EARTH_RADIUS_METRES = 6371008.8      # mean Earth radius for the haversine form (X8)
METRES_PER_MILE = 1609.0             # divisor used when reporting miles (X8)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def cosine_miles(lat0, lng0, lat1, lng1) -> Column:
    """Great-circle miles by the spherical law of cosines, R = 3959.

    The ``acos`` argument is clamped to [-1, 1]: rounding can push it just
    past 1 for (nearly) equal points, which would give NaN.
    """
    lat0, lng0, lat1, lng1 = map(_c, (lat0, lng0, lat1, lng1))
    arg = (F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * F.cos(F.radians(lng1) - F.radians(lng0))
           + F.sin(F.radians(lat0)) * F.sin(F.radians(lat1)))
    return F.lit(EARTH_RADIUS_MILES) * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), arg)))


def haversine_metres(lat0, lng0, lat1, lng1) -> Column:
    lat0, lng0, lat1, lng1 = map(_c, (lat0, lng0, lat1, lng1))
    dlat = F.radians(lat1) - F.radians(lat0)
    dlng = F.radians(lng1) - F.radians(lng0)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * F.pow(F.sin(dlng / 2), 2))
    return F.lit(2 * EARTH_RADIUS_METRES) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def sphere_miles(lat0, lng0, lat1, lng1) -> Column:
    """Sphere distance in metres divided by 1609."""
    return haversine_metres(lat0, lng0, lat1, lng1) / F.lit(METRES_PER_MILE)


# SQL text of the same formulas, shared by the SQL twins and the SQL UDF.
def cosine_miles_sql(lat0: str, lng0: str, lat1: str, lng1: str) -> str:
    return (f"({EARTH_RADIUS_MILES} * acos(greatest(-1.0, least(1.0, "
            f"cos(radians({lat0})) * cos(radians({lat1})) * cos(radians({lng1}) - radians({lng0})) "
            f"+ sin(radians({lat0})) * sin(radians({lat1}))))))")


def sphere_miles_sql(lat0: str, lng0: str, lat1: str, lng1: str) -> str:
    return (f"({2 * EARTH_RADIUS_METRES} * asin(least(1.0, sqrt("
            f"pow(sin((radians({lat1}) - radians({lat0})) / 2), 2) + "
            f"cos(radians({lat0})) * cos(radians({lat1})) * "
            f"pow(sin((radians({lng1}) - radians({lng0})) / 2), 2)))) / {METRES_PER_MILE})")


def register_distance_function(spark) -> None:
    """Register ``compute_distance_between_points`` as a SQL function.

    A SQL-bodied temporary function is inlined by the analyzer: no Python runs.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION compute_distance_between_points"
        "(lat0 DOUBLE, lng0 DOUBLE, lat1 DOUBLE, lng1 DOUBLE) RETURNS DOUBLE RETURN "
        + cosine_miles_sql("lat0", "lng0", "lat1", "lng1"))
