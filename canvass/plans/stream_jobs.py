"""Streaming jobs bound to the driver tables.

Orders become donation events (email from the customer key, arrival = order
key, paid time = order date, amount = order total, recurring = urgent
priority). They are staged as JSON files in the session's shared checkpoint
folder, streamed through the stateful donor operator, and the final state
per donor is read back. That final state must equal the batch rollup, so
the SQL twin is the batch one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.plans import derive as d
from canvass.plans.event_jobs import BINDING_DEBATE_DAYS, DONOR_ROLLUP_SQL, DONOR_SALT
from canvass.session import ensure_checkpoint_dir
from canvass.sources.tables import Tables
from canvass.streaming import donations as SD


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster: ``spark.checkpoint.dir`` names shared storage there)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/canvass-{name}-{uuid.uuid4().hex}"


def orders_as_donations(spark: SparkSession, base: str) -> DataFrame:
    o = Tables(spark, base).orders
    paid = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return o.select(
        F.struct(F.lit("Pat").alias("firstname"), F.lit("Doe").alias("lastname"),
                 F.col("o_orderstatus").alias("city"),
                 F.concat(F.lit("customer."), F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
                          F.lit("@example.com")).alias("email"),
                 (F.lit(2000000000) + F.col("o_custkey") * 7919).cast("string").alias("phone")).alias("donor"),
        F.struct(F.col("o_orderkey").cast("string").alias("orderNumber"),
                 (F.col("o_orderpriority") == "1-URGENT").alias("isRecurring")).alias("contribution"),
        F.array(F.struct(F.lit(1).alias("sequence"), F.col("o_totalprice").cast("string").alias("amount"),
                         paid.alias("paidAt"))).alias("lineitems"),
        F.col("o_orderdate").alias("received_at"),
        F.col("o_orderkey").alias("arrival"))


def donor_stream(spark: SparkSession, base: str) -> DataFrame:
    """ST1 + ST2 + SRC2 end to end; final donor state per email."""
    root = scratch_folder(spark, "donor-stream")
    orders_as_donations(spark, base).write.mode("overwrite").json(f"{root}/in")
    good, _bad = SD.read_donations(spark, f"{root}/in", streaming=True, max_files_per_trigger=64)
    donors = SD.donor_table(spark, f"{root}/donors")
    SD.donor_stream(SD.flatten_donation(good), donors, f"{root}/checkpoint", BINDING_DEBATE_DAYS).trigger(
        availableNow=True).start().awaitTermination()
    final = SD.donor_rows(donors.latest(), DONOR_SALT)
    return final.select(
        "email", "donor_id", F.round("total_donation_amount", 2).alias("total_donation_amount"),
        "last_donation_amount", F.date_format("last_donation_ts", "yyyy-MM-dd HH:mm:ss").alias("last_donation_ts"),
        "last_donation_dt", F.col("city").alias("status"), "badges", "n_donations")


DONOR_STREAM_SQL = DONOR_ROLLUP_SQL


def run_deliveries(deliveries: list[DataFrame], root: str, writer) -> None:
    """Each delivery lands in the input folder, then the stream runs over what is new: a scheduled job, restarted
    from its checkpoint every time. ``writer`` makes the stream's writer from the input stream."""
    spark = deliveries[0].sparkSession
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        writer(stream).trigger(availableNow=True).start().awaitTermination()


# Orders as donations that are received up to a quarter of an hour after they were paid.
_RECEIVED = "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 900)"
_RECEIVED_SQL = "(o_orderdate + to_seconds(o_orderkey % 900))"
# Receipts are delivered by day, but every fiftieth one with the next delivery.
_CUTS = ("1994-03-01", "1996-06-01")


def _lagged_orders(spark: SparkSession, base: str) -> DataFrame:
    return Tables(spark, base).orders.select(
        "o_orderkey", F.col("o_orderkey").alias("arrival"), F.col("o_orderkey").cast("string").alias("order_number"),
        F.col("o_orderdate").alias("paid_at"), F.expr(_RECEIVED).alias("received_at"), d.customer_phone(F.col("o_custkey")).alias("phone"),
        F.concat(F.lit("customer."), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.lit("Pat").alias("firstname"), F.lit("Doe").alias("lastname"))


def lag_windows(spark: SparkSession, base: str) -> DataFrame:
    """ST3 + X19 as a running stream of four deliveries: average and largest lag per five minutes of receipt, and
    the events that came after their window was closed."""
    root = scratch_folder(spark, "lag")
    rows = _lagged_orders(spark, base).select("o_orderkey", "paid_at", "received_at")
    part = sum(F.when(F.col("received_at") >= F.lit(c).cast("timestamp"), 1).otherwise(0) for c in _CUTS) + F.when(F.col("o_orderkey") % 50 == 0, 1).otherwise(0)
    windows = SD.lag_table(spark, f"{root}/windows")
    run_deliveries([rows.where(part == i) for i in range(len(_CUTS) + 2)], root,
                   lambda s: SD.lag_stream(s, windows, f"{root}/out", f"{root}/checkpoint"))
    closed = spark.read.parquet(f"{root}/out/closed").select("window_start", "avg_lag_seconds", "max_lag_seconds", "events")
    still = windows.latest().where("open and events > 0").select("window_start", F.col("lag_sum") / F.col("events"), "lag_max", "events")
    late = spark.read.parquet(f"{root}/out/late").groupBy("window_start").agg(
        F.avg("lag_seconds"), F.max("lag_seconds").cast("double"), F.count(F.lit(1)))
    both = closed.union(still).withColumn("late", F.lit(False)).union(late.withColumn("late", F.lit(True)))
    return both.select("late", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                       F.round("avg_lag_seconds", 6).alias("avg_lag"), F.col("max_lag_seconds").alias("max_lag"), "events")


LAG_WINDOWS_SQL = f"""
WITH r AS (
  SELECT cast(o_orderkey % 900 AS double) AS lag, {_RECEIVED_SQL} AS received,
         {" + ".join(f"cast({_RECEIVED_SQL} >= timestamp '{c}' AS integer)" for c in _CUTS)} + cast(o_orderkey % 50 = 0 AS integer) AS delivery
    FROM orders),
marks AS (SELECT d.delivery, (SELECT max(received) FROM r WHERE r.delivery < d.delivery) - INTERVAL 10 minutes AS mark
            FROM (SELECT DISTINCT delivery FROM r) d),
w AS (SELECT r.*, time_bucket(INTERVAL 5 minutes, received) AS start, coalesce(time_bucket(INTERVAL 5 minutes, received) + INTERVAL 5 minutes <= mark, false) AS late
        FROM r JOIN marks USING (delivery))
SELECT late, strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, round(avg(lag), 6) AS avg_lag, max(lag) AS max_lag, count(*) AS events
  FROM w GROUP BY 1, start
"""


def new_subscribers(spark: SparkSession, base: str) -> DataFrame:
    """ST5 as a running stream of three deliveries: valid, unknown phones that pass the lag gate, each sent once."""
    root = scratch_folder(spark, "subscribers")
    known = Tables(spark, base).customer.where("c_mktsegment = 'BUILDING'").select(d.customer_phone().alias("phone_number"))
    rows = _lagged_orders(spark, base)
    sent = SD.subscriber_table(spark, f"{root}/sent")
    run_deliveries([rows.where(F.col("o_orderkey") % 3 == i) for i in range(3)], root,
                   lambda s: SD.subscriber_stream(s, sent, known, f"{root}/checkpoint"))
    return sent.log().select("phone11", F.col("arrival").alias("o_orderkey"), "email")


NEW_SUBSCRIBERS_SQL = f"""
WITH r AS (SELECT o_orderkey, o_custkey, cast(2000000000 + o_custkey * 7919 AS varchar) AS p, o_orderkey % 900 AS lag, {_RECEIVED_SQL} AS received FROM orders)
SELECT '1' || p AS phone11, o_orderkey, 'customer.' || o_custkey || '@example.com' AS email FROM r
 WHERE regexp_full_match(p, '[2-9][0-9]{{2}}[2-9][0-9]{{6}}')
   AND (lag <= 300 OR hour(received) >= 13 OR hour(received) < 1)
   AND p NOT IN (SELECT {d.CUSTOMER_PHONE_SQL} FROM customer WHERE c_mktsegment = 'BUILDING')
QUALIFY row_number() OVER (PARTITION BY p ORDER BY o_orderkey % 3, o_orderkey) = 1
"""


def cancellation_keys(spark: SparkSession, base: str) -> DataFrame:
    """ST6: cancelled donations archived by their own stream and read back with their keys."""
    root = scratch_folder(spark, "cancellations")
    at = F.when(F.col("event_id") % 3 == 0, F.date_format(F.col("ts") + F.expr("interval 30 hours"), "yyyy-MM-dd'T'HH:mm:ss'-04:00'"))
    events = Tables(spark, base).events.select(
        F.struct(F.col("event_id").cast("string").alias("orderNumber"), at.alias("cancelledAt")).alias("contribution"),
        (F.col("ts") + F.expr("interval 61 seconds")).alias("received_at"))
    run_deliveries([events.where("contribution.orderNumber % 2 = 0"), events.where("contribution.orderNumber % 2 = 1")], root,
                   lambda s: SD.archive_cancellations(s, f"{root}/out", f"{root}/checkpoint"))
    back = spark.read.schema("archive_key string, order_number string").json(f"{root}/out")
    return back.select("order_number", "archive_key")


CANCELLATION_KEYS_SQL = """
SELECT cast(event_id AS varchar) AS order_number,
       'cancellations/' || strftime(ts + to_seconds(61), '%Y-%m-%d_%H:%M:%S') || '_' ||
       strftime(ts + INTERVAL 34 hours, '%Y-%m-%d_%H:%M:%S') || '_' || event_id || '.json' AS archive_key
  FROM events WHERE event_id % 3 = 0
"""
