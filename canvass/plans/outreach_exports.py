"""End-to-end exports bound to the driver tables.

* ``sms_optin_export`` (P6): several feeds in one layout (S1) -> per-feed
  merge by phone (A1) -> valid NANP numbers only (F3), zip5 (F5), feed
  recency in New York days (F14) -> newest action per number with its feed
  (W3) -> minus numbers already known (J6, both sides cut to ten digits) ->
  distinct rows (A7).
* ``email_export`` (P3): feeds merged by canonical e-mail (A1, F1) -> minus
  known subscribers unless re-subscribing, never blacklisted (J7, A5, A6,
  F2) -> syntax + domain validation, invalid rows go to rejects (X18) -> at
  most N accepted per source type, counting only accepted rows (W8).
  ``email_export_parts`` also returns the rejects and per-type counts (A9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions import filters as FL
from canvass.functions import timefmt as TF
from canvass.operators import aggregates as A
from canvass.operators import dedupe as D
from canvass.operators import joins as J
from canvass.operators.sizing import broadcast_if_small
from canvass.operators.scan import numbered
from canvass.plans import derive as d
from canvass.plans.sync_jobs import resubscribe_filter
from canvass.sources.tables import Tables

SMS_AS_OF = "2024-01-31 12:00:00"
SMS_RECENT_DAYS = 30
KNOWN_BALANCE = 8000


def _customer_feed(t: Tables) -> DataFrame:
    last_order = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("action_ts"))
    phone = d.customer_phone()
    raw = F.when(F.col("c_custkey") % 13 == 0, F.left(phone, F.lit(9))).otherwise(phone)
    return (t.customer.join(last_order, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(raw.alias("phone_number"),
                    F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
                    ((F.col("c_custkey") * 37) % 99999).cast("string").alias("postal_code"),
                    "action_ts", F.lit("customers").alias("action_type")))


def _signup_feed(t: Tables) -> DataFrame:
    ev = t.events.filter(F.col("event_type") == "signup")
    per = ev.groupBy("user_id").agg(F.max("ts").alias("action_ts"))
    return (per.filter(TF.recent("action_ts", SMS_AS_OF, SMS_RECENT_DAYS))
            .select(F.concat(F.lit("1"), (F.lit(2000000000) + F.col("user_id") * 7919).cast("string"))
                    .alias("phone_number"), F.lit(None).cast("string").alias("first_name"),
                    F.lit(None).cast("string").alias("postal_code"), "action_ts",
                    F.lit("signups").alias("action_type")))


def sms_optin_export(spark: SparkSession, base: str, faithful: bool = False) -> DataFrame:
    """``faithful=True`` keeps the reference's quirk: known numbers are cut to
    ten digits but candidates are compared as written, so an 11-digit
    candidate is never suppressed. The default cuts both sides."""
    t = Tables(spark, base)
    feeds = D.union_feeds(_customer_feed(t), _signup_feed(t))
    valid = feeds.filter(C.is_valid_phone("phone_number")).withColumn("phone10", C.phone10("phone_number"))
    newest = D.latest_by(valid, ["phone10"], ["action_ts", "action_type"],
                         ["first_name", "postal_code", "action_ts", "action_type"])
    known = t.customer.filter(F.col("c_acctbal") > KNOWN_BALANCE).select(C.phone10(d.customer_phone()).alias("phone10"))
    if faithful:
        raw = valid.select("phone10", F.col("phone_number").alias("_raw")).distinct()
        keep = J.subtract_known(raw, known.withColumnRenamed("phone10", "_raw"), "_raw").select("phone10").distinct()
        out = newest.join(keep, "phone10", "left_semi")
    else:
        out = J.subtract_known(newest, known, "phone10")
    return out.select(F.col("phone10").alias("phone_number"), "first_name",
                      C.zip5("postal_code").alias("postal_code"),
                      F.date_format("action_ts", "yyyy-MM-dd").alias("action_date"), "action_type").distinct()


_NYD = "cast(timezone('America/New_York', timezone('UTC', {x})) AS date)"
SMS_OPTIN_EXPORT_SQL = f"""
WITH lo AS (SELECT o_custkey, max(o_orderdate) AS action_ts FROM orders GROUP BY 1),
cf AS (SELECT CASE WHEN c_custkey % 13 = 0 THEN left({d.CUSTOMER_PHONE_SQL}, 9) ELSE {d.CUSTOMER_PHONE_SQL} END
                AS phone_number,
              split_part(c_name, '#', 1) AS first_name, cast((c_custkey * 37) % 99999 AS varchar) AS postal_code,
              lo.action_ts, 'customers' AS action_type
         FROM customer LEFT JOIN lo ON c_custkey = lo.o_custkey),
sg AS (SELECT user_id, max(ts) AS action_ts FROM events WHERE event_type = 'signup' GROUP BY 1),
sf AS (SELECT '1' || cast(2000000000 + user_id * 7919 AS varchar) AS phone_number, NULL AS first_name,
              NULL AS postal_code, action_ts, 'signups' AS action_type
         FROM sg WHERE action_ts >= TIMESTAMP '{SMS_AS_OF}' - INTERVAL {SMS_RECENT_DAYS + 2} DAY
          AND date_diff('day', {_NYD.format(x='action_ts')}, {_NYD.format(x=f"TIMESTAMP '{SMS_AS_OF}'")})
              <= {SMS_RECENT_DAYS}),
f AS (SELECT * FROM cf UNION ALL SELECT * FROM sf),
v AS (SELECT *, right(phone_number, 10) AS phone10 FROM f WHERE regexp_full_match(phone_number, '1?[2-9][0-9]{{9}}')),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY phone10
                                                  ORDER BY action_ts DESC NULLS LAST, action_type DESC) AS rn
                       FROM v) WHERE rn = 1),
k AS (SELECT right({d.CUSTOMER_PHONE_SQL}, 10) AS phone10 FROM customer WHERE c_acctbal > {KNOWN_BALANCE})
SELECT DISTINCT phone10 AS phone_number, first_name,
       CASE WHEN regexp_full_match(lpad(left(postal_code, 5), 5, '0'), '[0-9]{{5}}')
            THEN lpad(left(postal_code, 5), 5, '0') END AS postal_code,
       strftime(action_ts, '%Y-%m-%d') AS action_date, action_type
  FROM n WHERE phone10 NOT IN (SELECT phone10 FROM k)
"""

CAPPED_EXPORT = 200   # the limit of the registered capped job


def email_export_parts(spark: SparkSession, base: str, cap: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(exports, rejects, counts per source type). ``cap``: exports per source
    type at most (W8), a run parameter; none by default."""
    t = Tables(spark, base)
    cand = resubscribe_filter(spark, base)
    # source type and id: customers that ordered are "shop", the others "crm"
    buyers = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_shop", F.lit(True))
    cust = t.customer.select("c_custkey", "c_nationkey", d.customer_email().alias("email")).join(
        buyers, "c_custkey", "left")
    x = cand.join(cust, "email").withColumn(
        "ext_type", F.when(F.col("_shop"), F.lit("shop")).otherwise(F.lit("crm")))
    nat = t.nation.select("n_nationkey", (F.col("n_regionkey") != 2).alias("domain_ok"))
    x = (x.join(broadcast_if_small(nat, J.CONFIG_ROWS), F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .withColumn("valid", FL.email_syntax_ok("email") & F.coalesce("domain_ok", F.lit(False))))
    rejects = x.filter(~F.col("valid")).select("email", "ext_type", F.lit("undeliverable").alias("reason"))
    exports = x.filter("valid")
    if cap is None:     # a whole ranking of a few types: no window per type
        exports = numbered(exports, ["ext_type"], ["c_custkey", "email"], out="rank_in_type")
    else:               # the literal limit cuts every partition before the shuffle
        rn = F.row_number().over(Window.partitionBy("ext_type").orderBy("c_custkey", "email"))
        exports = exports.withColumn("_rank", rn).filter(F.col("_rank") <= cap).withColumn("rank_in_type", F.col("_rank").cast("long"))
    exports = (exports.select("email", "ext_type", F.col("c_custkey").cast("string").alias("ext_id"),
                       "is_resubscribe", "rank_in_type"))
    counts = A.counts_by(x, "ext_type", ~F.col("valid"))
    return exports, rejects, counts


def email_export(spark: SparkSession, base: str) -> DataFrame:
    """Every valid candidate, ranked within its source type."""
    return email_export_parts(spark, base)[0]


def email_export_capped(spark: SparkSession, base: str) -> DataFrame:
    """P3 + W8: the same with a limit per source type."""
    return email_export_parts(spark, base, CAPPED_EXPORT)[0]


def _resub_sql() -> str:
    from canvass.plans.sync_jobs import RESUBSCRIBE_FILTER_SQL
    return RESUBSCRIBE_FILTER_SQL


EMAIL_EXPORT_SQL = f"""
WITH cand AS ({_resub_sql()}),
buyers AS (SELECT DISTINCT o_custkey FROM orders),
cust AS (SELECT c_custkey, c_nationkey, {d.CUSTOMER_EMAIL_SQL} AS email,
                CASE WHEN b.o_custkey IS NOT NULL THEN 'shop' ELSE 'crm' END AS ext_type
           FROM customer LEFT JOIN buyers b ON b.o_custkey = c_custkey),
x AS (SELECT cand.email, cand.is_resubscribe, cust.c_custkey, cust.ext_type,
             regexp_full_match(cand.email, '{FL.EMAIL_SYNTAX.replace("'", "''")}')
             AND coalesce(n.n_regionkey <> 2, false) AS valid
        FROM cand JOIN cust ON cust.email = cand.email LEFT JOIN nation n ON n.n_nationkey = cust.c_nationkey),
r AS (SELECT *, row_number() OVER (PARTITION BY ext_type ORDER BY c_custkey) AS rank_in_type FROM x WHERE valid)
SELECT email, ext_type, cast(c_custkey AS varchar) AS ext_id, is_resubscribe, rank_in_type
  FROM r
"""

EMAIL_EXPORT_CAPPED_SQL = EMAIL_EXPORT_SQL + f" WHERE rank_in_type <= {CAPPED_EXPORT}"
