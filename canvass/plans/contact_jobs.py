"""Contact, dedupe, join and suppression jobs bound to the driver tables
(A1-A8, W1-W5, F7, F8, F19, F22, J2-J12, J18, S1, S2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions.timefmt import epoch_seconds
from canvass.operators import aggregates as A
from canvass.operators import dedupe as D
from canvass.operators import joins as J
from canvass.plans import derive as d
from canvass.sources.tables import Tables

# SQL for the derived user contact of an event row (user_id -> customer).
USER_EMAIL_SQL = "('customer.' || lpad(cast(user_id AS varchar), 9, '0') || '@example.com')"
USER_PHONE_SQL = "cast(2000000000 + user_id * 7919 AS varchar)"


def user_email(col: str = "user_id"):
    return F.concat(F.lit("customer."), F.lpad(F.col(col).cast("string"), 9, "0"), F.lit("@example.com"))


def user_phone(col: str = "user_id"):
    return (F.lit(2000000000) + F.col(col) * 7919).cast("string")


# ---------------------------------------------------------------- merge_contacts
def merge_contacts(spark: SparkSession, base: str) -> DataFrame:
    """A1 + A2 + F1 + F19: customers and event users merged by canonical email."""
    t = Tables(spark, base)
    email = d.customer_email()
    cust = t.customer.select(
        F.when(F.col("c_custkey") % 2 == 0, F.upper(email))
         .otherwise(F.concat(F.lit(" "), email, F.lit(" "))).alias("raw_email"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        d.customer_phone().alias("phone_number"),
        C.id_text(F.col("c_custkey")).alias("ext_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("source"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("subsource"),
        F.lit(None).cast("double").alias("action_epoch"))
    users = (t.events.groupBy("user_id").agg(F.max(epoch_seconds(F.col("ts"))).alias("action_epoch"))
             .select(user_email().alias("raw_email"), F.lit(None).cast("string").alias("first_name"),
                     F.lit(None).cast("string").alias("phone_number"),
                     C.id_text(F.col("user_id")).alias("ext_id"),
                     F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("subsource"),
                     "action_epoch"))
    feeds = D.union_feeds(cust, users)
    merged = D.merge_by_key(feeds, C.canon_email("raw_email"),
                            ["first_name", "phone_number", "ext_id", "source", "subsource", "action_epoch"],
                            key_name="email", count_as="n_rows")
    return merged.withColumn("action_epoch", F.round("action_epoch", 6))


MERGE_CONTACTS_SQL = f"""
WITH cust AS (
  SELECT CASE WHEN c_custkey % 2 = 0 THEN upper({d.CUSTOMER_EMAIL_SQL})
              ELSE ' ' || {d.CUSTOMER_EMAIL_SQL} || ' ' END AS raw_email,
         split_part(c_name, '#', 1) AS first_name, {d.CUSTOMER_PHONE_SQL} AS phone_number,
         cast(c_custkey AS varchar) AS ext_id, split_part(c_name, '#', 1) AS source,
         split_part(c_name, '#', 2) AS subsource, cast(NULL AS double) AS action_epoch
    FROM customer),
users AS (
  SELECT {USER_EMAIL_SQL} AS raw_email, NULL AS first_name, NULL AS phone_number,
         cast(user_id AS varchar) AS ext_id, NULL AS source, NULL AS subsource,
         max(epoch(ts)) AS action_epoch
    FROM events GROUP BY user_id),
feeds AS (SELECT * FROM cust UNION ALL SELECT * FROM users)
SELECT trim(lower(raw_email)) AS email, max(first_name) AS first_name, max(phone_number) AS phone_number,
       max(ext_id) AS ext_id, max(source) AS source, max(subsource) AS subsource,
       round(max(action_epoch), 6) AS action_epoch, count(*) AS n_rows
  FROM feeds GROUP BY trim(lower(raw_email))
"""


# ---------------------------------------------------------------- windows
FIRST_TOUCH_SINCE = "1996-01-01"


def first_touch(spark: SparkSession, base: str) -> DataFrame:
    """Earliest order per customer since a date."""
    o = Tables(spark, base).orders.filter(F.col("o_orderdate") >= F.lit(FIRST_TOUCH_SINCE).cast("timestamp"))
    r = D.first_per_key(o, ["o_custkey"], [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()])
    return r.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_date"),
                    "o_orderpriority")


FIRST_TOUCH_SQL = f"""
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS first_date, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC, o_orderkey ASC) AS rn
    FROM orders WHERE o_orderdate >= TIMESTAMP '{FIRST_TOUCH_SINCE}') WHERE rn = 1
"""


def latest_per_key(spark: SparkSession, base: str) -> DataFrame:
    """Latest line per order by ship date; line number, part and
    extended price break ties (the data repeats line numbers). ``max_by``, no window."""
    li = Tables(spark, base).lineitem
    r = D.latest_by(li, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_extendedprice"],
                    ["l_linenumber", "l_shipdate", "l_quantity"])
    return r.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
                    "l_quantity")


LATEST_PER_KEY_SQL = """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
                                                     l_partkey DESC, l_extendedprice DESC) AS rn
    FROM lineitem) WHERE rn = 1
"""


def best_record(spark: SparkSession, base: str) -> DataFrame:
    """Best line per order by six keys, all DESC NULLS LAST, line number last."""
    li = Tables(spark, base).lineitem
    order = [F.col(c).desc_nulls_last() for c in
             ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_partkey")]
    r = D.first_per_key(li, ["l_orderkey"], order + [F.col("l_linenumber").asc()])
    return r.select("l_orderkey", "l_linenumber", "l_partkey")


BEST_RECORD_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
      l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
      l_tax DESC NULLS LAST, l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_linenumber ASC) AS rn
    FROM lineitem) WHERE rn = 1
"""

EVENT_TYPES = ["view", "signup", "error", "click", "purchase"]


def last_action_type(spark: SparkSession, base: str) -> DataFrame:
    """Newest action over five unioned feeds, keeping which feed won."""
    ev = Tables(spark, base).events
    feeds = [ev.filter(F.col("event_type") == t).select("user_id", "ts", "event_id",
                                                        F.lit(f"feed_{t}").alias("action_type"))
             for t in EVENT_TYPES]
    r = D.latest_by(D.union_feeds(*feeds), ["user_id"], ["ts", "event_id"], ["action_type", "ts", "event_id"])
    return r.select("user_id", "action_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("action_ts"),
                    "event_id")


LAST_ACTION_TYPE_SQL = """
SELECT user_id, action_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS action_ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM (
    """ + "\n    UNION ALL\n    ".join(
    f"SELECT user_id, ts, event_id, 'feed_{t}' AS action_type FROM events WHERE event_type = '{t}'"
    for t in EVENT_TYPES) + """)) WHERE rn = 1
"""


# ---------------------------------------------------------------- aggregates
# The reference flags > 120 distinct emails per user-day; synthetic events are
# about two per user-day, so the binding counts distinct events above 4.
BULK_THRESHOLD = 4


def bulk_loaders(spark: SparkSession, base: str) -> DataFrame:
    """A4: users with more than the threshold of distinct items on any day."""
    ev = Tables(spark, base).events
    return A.bulk_users(ev, "user_id", F.to_date("ts"), "event_id", BULK_THRESHOLD)


BULK_LOADERS_SQL = f"""
SELECT DISTINCT user_id FROM (
  SELECT user_id, cast(ts AS date) AS day, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2)
 WHERE n > {BULK_THRESHOLD}
"""

UNIVERSES = {"in_univ": "BUILDING", "in_gotv_univ": "MACHINERY", "in_canv_univ": "FURNITURE"}


def precinct_scores(spark: SparkSession, base: str) -> DataFrame:
    """A3 + F8: per-nation stats of positive balances within the universes,
    then each customer's score with the precinct fallback."""
    c = Tables(spark, base).customer
    c = c.withColumn("score", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    for flag, seg in UNIVERSES.items():
        c = c.withColumn(flag, F.col("c_mktsegment") == F.lit(seg))
    any_u = F.col("in_univ") | F.col("in_gotv_univ") | F.col("in_canv_univ")
    stats = A.precinct_stats(c.filter(any_u), "c_nationkey", "c_custkey", "score")
    r = c.join(stats, "c_nationkey", "left")
    gotv = (F.when(F.col("score").isNotNull(), F.col("score"))
            .when(any_u, F.coalesce(F.col("avg_score"), F.lit(0.0)))
            .otherwise(F.lit(0.0)))
    return r.select("c_custkey", "c_nationkey", "persons", "persons_scored",
                    F.round("total_score", 4).alias("total_score"), F.round("avg_score", 6).alias("avg_score"),
                    F.round(gotv, 6).alias("gotv_score"))


PRECINCT_SCORES_SQL = """
WITH c AS (
  SELECT *, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS score,
         c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') AS any_u FROM customer),
s AS (
  SELECT c_nationkey, count(c_custkey) AS persons, sum(score) AS total_score,
         count(score) AS persons_scored, sum(score) / count(score) AS avg_score
    FROM c WHERE any_u GROUP BY c_nationkey)
SELECT c.c_custkey, c.c_nationkey, s.persons, s.persons_scored, round(s.total_score, 4) AS total_score,
       round(s.avg_score, 6) AS avg_score,
       round(CASE WHEN c.score IS NOT NULL THEN c.score WHEN c.any_u THEN coalesce(s.avg_score, 0)
                  ELSE 0 END, 6) AS gotv_score
  FROM c LEFT JOIN s USING (c_nationkey)
"""


# ---------------------------------------------------------------- joins / flags
def membership_flags(spark: SparkSession, base: str) -> DataFrame:
    """F7 + J2 + J4 + A8: flags from one conditional aggregate over the orders
    and one left join on the customer key."""
    t = Tables(spark, base)
    o = F.col
    by = t.orders.groupBy(o("o_custkey").alias("c_custkey")).agg(
        F.max((o("o_orderstatus") == "F").cast("int")).alias("in_univ"),
        F.max((o("o_orderpriority") == "1-URGENT").cast("int")).alias("in_canv"),
        F.max(((o("o_totalprice") > 300000) & (o("o_orderstatus") == "O")).cast("int")).alias("voted"),
        F.max(F.when(o("o_orderpriority") == "2-HIGH", o("o_orderkey"))).alias("myc_id"))
    c = t.customer.select("c_custkey").join(by, "c_custkey", "left")
    return c.select("c_custkey", *[F.coalesce(f, F.lit(0)).alias(f) for f in ("in_univ", "in_canv", "voted")],
                    (1 - F.coalesce("voted", F.lit(0))).alias("no_vote"), "myc_id")


MEMBERSHIP_FLAGS_SQL = """
SELECT c.c_custkey,
       CASE WHEN u.o_custkey IS NULL THEN 0 ELSE 1 END AS in_univ,
       CASE WHEN cv.o_custkey IS NULL THEN 0 ELSE 1 END AS in_canv,
       CASE WHEN v.o_custkey IS NULL THEN 0 ELSE 1 END AS voted,
       CASE WHEN v.o_custkey IS NULL THEN 1 ELSE 0 END AS no_vote,
       m.myc_id
  FROM customer c
  LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') u ON u.o_custkey = c.c_custkey
  LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') cv ON cv.o_custkey = c.c_custkey
  LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'O') v
    ON v.o_custkey = c.c_custkey
  LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS myc_id FROM orders WHERE o_orderpriority = '2-HIGH'
              GROUP BY o_custkey) m ON m.o_custkey = c.c_custkey
"""

TARGETED_NATIONS = [7, 13, 19]
REQUESTED_SINCE = "2000-01-01"
MOVED_NATIONS = [9, 24]


def target_universe(spark: SparkSession, base: str) -> DataFrame:
    """flagged, not already requested, not moved away; district list, OR of three
    signals and a long-text test as 0/1 columns."""
    t = Tables(spark, base)
    flags = membership_flags(spark, base)
    c = t.customer.join(flags, "c_custkey").filter(
        (F.col("in_univ") == 1) & ~F.col("c_nationkey").isin(MOVED_NATIONS))
    requested = t.orders.filter((F.col("o_orderstatus") == "P")
                                & (F.col("o_orderdate") >= F.lit(REQUESTED_SINCE).cast("timestamp")))
    c = J.subtract_known(c, requested, "c_custkey", "o_custkey")
    return c.select(
        "c_custkey",
        F.when(F.col("c_nationkey").isin(TARGETED_NATIONS), 1).otherwise(0).alias("targeted_sd"),
        F.when((F.col("in_canv") == 1) | (F.col("voted") == 1) | (F.col("c_acctbal") > 5000), 1)
         .otherwise(0).alias("is_strong"),
        F.when(F.length("c_mktsegment") > 8, 1).otherwise(0).alias("is_rally"))


TARGET_UNIVERSE_SQL = f"""
WITH f AS ({MEMBERSHIP_FLAGS_SQL})
SELECT c.c_custkey,
       CASE WHEN c.c_nationkey IN ({', '.join(map(str, TARGETED_NATIONS))}) THEN 1 ELSE 0 END AS targeted_sd,
       CASE WHEN f.in_canv = 1 OR f.voted = 1 OR c.c_acctbal > 5000 THEN 1 ELSE 0 END AS is_strong,
       CASE WHEN length(c.c_mktsegment) > 8 THEN 1 ELSE 0 END AS is_rally
  FROM customer c JOIN f USING (c_custkey)
 WHERE f.in_univ = 1 AND NOT (c.c_nationkey IN ({', '.join(map(str, MOVED_NATIONS))}))
   AND c.c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
                             AND o_orderdate >= TIMESTAMP '{REQUESTED_SINCE}' AND o_custkey IS NOT NULL)
"""


def anti_subscribed(spark: SparkSession, base: str) -> DataFrame:
    """J6 + F4: customer phones minus phones already subscribed (both sides
    cut to ten digits)."""
    t = Tables(spark, base)
    c = t.customer.select("c_custkey", C.phone10(d.customer_phone()).alias("phone"))
    known = (t.events.filter(F.col("event_type") == "signup")
             .select(C.phone10(F.concat(F.lit("1"), user_phone())).alias("phone")))
    return J.subtract_known(c, known, "phone")


ANTI_SUBSCRIBED_SQL = f"""
SELECT c_custkey, right({d.CUSTOMER_PHONE_SQL}, 10) AS phone FROM customer
 WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'signup'
                     AND right('1' || {USER_PHONE_SQL}, 10) = right({d.CUSTOMER_PHONE_SQL}, 10))
"""

SUPPRESSION_REGIONS = ["AMERICA", "ASIA", "EUROPE"]


def suppress_by_region(spark: SparkSession, base: str) -> DataFrame:
    """Per-region suppression lists in one anti join on (region, key)."""
    t = Tables(spark, base)
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    c = t.customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("r_name").alias("region"))
    listed = (t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
              .select(F.col("o_custkey").alias("c_custkey")).distinct())
    lists = J.tag_lists(listed, SUPPRESSION_REGIONS, "region")
    return J.suppress(c, lists, "c_custkey", "region")


SUPPRESS_BY_REGION_SQL = f"""
WITH c AS (SELECT c_custkey, r_name AS region FROM customer
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
l AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
SELECT c.c_custkey, c.region FROM c
  LEFT JOIN l ON l.o_custkey = c.c_custkey AND c.region IN ({', '.join(f"'{r}'" for r in SUPPRESSION_REGIONS)})
 WHERE l.o_custkey IS NULL
"""

RECENT_SINCE = "2000-01-01"


def semi_recent(spark: SparkSession, base: str) -> DataFrame:
    """Customers with an order since a date (``IN (subquery)``)."""
    t = Tables(spark, base)
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit(RECENT_SINCE).cast("timestamp")).select(
        F.col("o_custkey").alias("c_custkey"))
    return J.semi(t.customer.select("c_custkey", "c_name"), recent, "c_custkey")


SEMI_RECENT_SQL = f"""
SELECT c_custkey, c_name FROM customer
 WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{RECENT_SINCE}')
"""


def phone_class(spark: SparkSession, base: str) -> DataFrame:
    """7-digit wireless blocks plus two port lists -> C / L / null."""
    t = Tables(spark, base)
    c = t.customer.select("c_custkey", d.customer_phone().alias("phone"))
    o = t.orders
    blocks = o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.substring(d.customer_phone(F.col("o_custkey")), 1, 7).alias("block"))
    to_w = o.filter(F.col("o_orderstatus") == "F").select(d.customer_phone(F.col("o_custkey")).alias("p"))
    to_l = t.customer.filter(F.col("c_mktsegment") == "AUTOMOBILE").select(d.customer_phone().alias("p"))
    r = J.classify_phone(c, "phone", blocks, to_w, to_l)
    return r.select("c_custkey", "phone", "phone_type")


PHONE_CLASS_SQL = f"""
WITH c AS (SELECT c_custkey, {d.CUSTOMER_PHONE_SQL} AS phone, c_mktsegment FROM customer),
b AS (SELECT DISTINCT substring(cast(2000000000 + o_custkey * 7919 AS varchar), 1, 7) AS block
        FROM orders WHERE o_orderpriority = '1-URGENT'),
w AS (SELECT DISTINCT cast(2000000000 + o_custkey * 7919 AS varchar) AS p FROM orders WHERE o_orderstatus = 'F'),
l AS (SELECT DISTINCT phone AS p FROM c WHERE c_mktsegment = 'AUTOMOBILE')
SELECT c.c_custkey, c.phone,
       CASE WHEN l.p IS NOT NULL THEN 'L' WHEN b.block IS NOT NULL OR w.p IS NOT NULL THEN 'C' END AS phone_type
  FROM c LEFT JOIN b ON b.block = substring(c.phone, 1, 7)
  LEFT JOIN w ON w.p = c.phone LEFT JOIN l ON l.p = c.phone
"""


def identity_match(spark: SparkSession, base: str) -> DataFrame:
    """J18 + P8: event users (canonical e-mail and phone) with all their CRM ids
    (by e-mail) and active SMS profiles (by phone, else by e-mail)."""
    t = Tables(spark, base)
    users = A.canonical_identity(
        t.events.select("user_id").distinct().select("user_id", user_email().alias("e"), user_phone().alias("p")), "e", "p")
    crm = t.customer.select(d.customer_email().alias("email"), F.col("c_custkey").alias("cons_id"))
    # every third customer uses another number in the SMS list; some numbers are shared
    shift = F.when(F.col("c_custkey") % 3 == 0, F.lit(500000)).when(F.col("c_custkey") % 3 == 1, -1).otherwise(0)
    sms = t.customer.select(
        F.concat(F.lit("1"), d.customer_phone(F.col("c_custkey") + shift)).alias("phone"),
        F.upper(d.customer_email()).alias("email"), F.col("c_custkey").alias("profile_id"),
        F.when(F.col("c_acctbal") > 0, F.lit("Active Subscriber")).otherwise(F.lit("Profile")).alias("status"),
        F.when(F.col("c_nationkey") == 3, F.lit("2024-01-01")).alias("opted_out_at"))
    return A.match_identity(users, crm, sms)


IDENTITY_MATCH_SQL = f"""
WITH u AS (
  SELECT user_id, trim(lower({USER_EMAIL_SQL})) AS email,
         CASE WHEN regexp_full_match({USER_PHONE_SQL}, '[2-9][0-9]{{2}}[2-9][0-9]{{6}}') THEN '1' || {USER_PHONE_SQL} END AS phone
    FROM (SELECT DISTINCT user_id FROM events)),
p AS (
  SELECT c_custkey AS profile_id, lower({d.CUSTOMER_EMAIL_SQL}) AS email,
         '1' || cast(2000000000 + (c_custkey + CASE c_custkey % 3 WHEN 0 THEN 500000 WHEN 1 THEN -1 ELSE 0 END) * 7919 AS varchar) AS phone
    FROM customer WHERE c_acctbal > 0 AND c_nationkey IS DISTINCT FROM 3),
j AS (
  SELECT u.user_id, coalesce(a.profile_id, b.profile_id) AS member_id
    FROM u LEFT JOIN p a ON a.phone = u.phone LEFT JOIN p b ON b.email = u.email)
SELECT DISTINCT u.user_id, 'crm' AS target, c_custkey AS member_id
  FROM u JOIN customer ON trim(lower({d.CUSTOMER_EMAIL_SQL})) = u.email
UNION
SELECT DISTINCT user_id, 'sms', member_id FROM j WHERE member_id IS NOT NULL
"""


def canonical_identity(spark: SparkSession, base: str) -> DataFrame:
    """One id per canonical (e-mail, phone) pair, over customers and event users."""
    t = Tables(spark, base)
    people = t.customer.select(F.upper(d.customer_email()).alias("e"), F.concat(F.lit("+1 "), d.customer_phone()).alias("p")).unionByName(
        t.events.select(user_email().alias("e"), F.when(F.col("user_id") % 4 != 0, user_phone()).alias("p")))
    return A.canonical_identity(people, "e", "p").groupBy("email", "phone", "identity_id").agg(F.count(F.lit(1)).alias("n_records"))


CANONICAL_IDENTITY_SQL = f"""
WITH r AS (
  SELECT upper({d.CUSTOMER_EMAIL_SQL}) AS e, {d.CUSTOMER_PHONE_SQL} AS p FROM customer
  UNION ALL
  SELECT {USER_EMAIL_SQL}, CASE WHEN user_id % 4 <> 0 THEN {USER_PHONE_SQL} END FROM events),
k AS (SELECT lower(e) AS email, CASE WHEN regexp_full_match(p, '[2-9][0-9]{{2}}[2-9][0-9]{{6}}') THEN '1' || p END AS phone FROM r)
SELECT email, phone, md5(coalesce(email, '') || '|' || coalesce(phone, '')) AS identity_id, count(*) AS n_records
  FROM k GROUP BY email, phone
"""


def union_feeds_q(spark: SparkSession, base: str) -> DataFrame:
    """Bag union of orders and events in one layout."""
    t = Tables(spark, base)
    a = t.orders.select(F.lit("orders").alias("feed"), F.col("o_custkey").alias("person_key"),
                        F.date_format("o_orderdate", "yyyy-MM-dd").alias("action_day"))
    b = t.events.select(F.lit("events").alias("feed"), F.col("user_id").alias("person_key"),
                        F.date_format("ts", "yyyy-MM-dd").alias("action_day"))
    return D.union_feeds(a, b)


UNION_FEEDS_SQL = """
SELECT 'orders' AS feed, o_custkey AS person_key, strftime(o_orderdate, '%Y-%m-%d') AS action_day FROM orders
UNION ALL
SELECT 'events' AS feed, user_id AS person_key, strftime(ts, '%Y-%m-%d') AS action_day FROM events
"""


def distinct_union(spark: SparkSession, base: str) -> DataFrame:
    """Set union of the people seen in orders and in events."""
    t = Tables(spark, base)
    return D.distinct_union(t.orders.select(F.col("o_custkey").alias("person_key")),
                            t.events.select(F.col("user_id").alias("person_key")))


DISTINCT_UNION_SQL = "SELECT o_custkey AS person_key FROM orders UNION SELECT user_id FROM events"
