"""Contact and geo columns derived from the driver tables.

The driver tables carry no contact or location data, so these formulas give
each customer an email, phone and point, and each supplier a point and a
date window. Every formula exists twice — as a Column and as SQL text — so
the Spark job and its SQL twin read the same inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The derivation formulas shared with the SQL twins.
CUSTOMER_LAT_SQL = "(cast(40.4 as double) + cast((c_custkey * 37) % 310 as double) / 100.0)"
CUSTOMER_LNG_SQL = "(cast(-96.6 as double) + cast((c_custkey * 53) % 640 as double) / 100.0)"
SUPPLIER_LAT_SQL = "(cast(40.4037 as double) + cast((s_suppkey * 41) % 300 as double) / 97.0)"
SUPPLIER_LNG_SQL = "(cast(-96.5971 as double) + cast((s_suppkey * 59) % 610 as double) / 97.0)"
CUSTOMER_EMAIL_SQL = "concat(replace(lower(c_name), '#', '.'), '@example.com')"
CUSTOMER_PHONE_SQL = "cast(2000000000 + c_custkey * 7919 as varchar)"
# Site window (P1): opens on a day spread over 1995-2001, stays open 0..59 days.
SITE_START_SQL = "(date '1995-01-01' + cast((s_suppkey * 97) % 2400 as integer))"
SITE_END_SQL = "(date '1995-01-01' + cast((s_suppkey * 97) % 2400 + s_suppkey % 60 as integer))"


def customer_geo(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        (F.lit(40.4) + ((k * 37) % 310).cast("double") / F.lit(100.0)).alias("c_lat"),
        (F.lit(-96.6) + ((k * 53) % 640).cast("double") / F.lit(100.0)).alias("c_lng"))


def supplier_geo(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal",
        (F.lit(40.4037) + ((k * 41) % 300).cast("double") / F.lit(97.0)).alias("s_lat"),
        (F.lit(-96.5971) + ((k * 59) % 610).cast("double") / F.lit(97.0)).alias("s_lng"))


def supplier_sites(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    base = F.lit("1995-01-01").cast("date")
    return supplier_geo(supplier).select(
        "*",
        F.date_add(base, ((k * 97) % 2400).cast("int")).alias("start_date"),
        F.date_add(base, ((k * 97) % 2400 + k % 60).cast("int")).alias("end_date"))


def customer_email(c_name: Column | str = "c_name") -> Column:
    c = F.col(c_name) if isinstance(c_name, str) else c_name
    return F.concat(F.replace(F.lower(c), F.lit("#"), F.lit(".")), F.lit("@example.com"))


def customer_phone(c_custkey: Column | str = "c_custkey") -> Column:
    c = F.col(c_custkey) if isinstance(c_custkey, str) else c_custkey
    return (F.lit(2000000000) + c * 7919).cast("string")
