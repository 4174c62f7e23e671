"""P6 as one job over the driver tables: ten feeds of people who agreed to texts, in one
layout, less the numbers that are subscribed.

The feeds stand for: donors of the last days; event people by their latest of five
kinds of action; the voter files of four states (latest address and e-mail of a
person, wireless numbers only; in the second, phones entered on the day of the
answer; in the last two, reached people, landline ports excluded); canvass
answers of three committees; sign-up attempts, the latest of each number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions import timefmt as TF
from canvass.operators import dedupe as D
from canvass.operators import joins as J
from canvass.operators.suppression import anti_split
from canvass.plans import derive as d
from canvass.sources import sinks as SK
from canvass.sources.tables import Tables

AS_OF, DAYS, DAYS_LATE = "2024-01-31 12:00:00", 15, 16
KNOWN_BALANCE = 8000
LAYOUT = ["phone_number", "first_name", "last_name", "email", "postal_code", "addr1", "city", "state", "country", "action_date", "action_type"]
ACTIONS = ["signup", "click", "view", "error"]
COMMITTEES = {"national": "click", "A": "view", "D": "error"}
VOTER_STATES = {"A": (0, 4), "B": (5, 9), "C": (10, 14), "D": (15, 24)}


def feed(df: DataFrame, action_type: str, **cols) -> DataFrame:
    values = {"country": F.lit("US"), **cols, "action_type": F.lit(action_type)}
    return df.select(*[(values[c] if c in values else F.lit(None)).cast("string").alias(c) for c in LAYOUT])


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


def people(t: Tables) -> DataFrame:
    """Customers as contacts: some numbers with a leading 1, some without a usable postal code, some nameless."""
    phone = d.customer_phone()
    return t.customer.select(
        F.col("c_custkey").alias("user_id"), d.customer_email().alias("email"), phone.alias("phone10"),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("1"), phone)).otherwise(phone).alias("phone"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))).alias("given"),
        F.col("c_mktsegment").alias("family"), F.col("c_nationkey").alias("nation"),
        F.when(F.col("c_acctbal") < 0, F.lit("n/a")).otherwise(((F.col("c_custkey") * 37) % 99999).cast("string")).alias("zip"))


def _of(t: Tables, kind: str) -> DataFrame:
    return t.events.where(F.col("event_type") == kind).select("user_id", "ts", "value", "event_id")


def contributions(t: Tables) -> DataFrame:
    x = (_of(t, "purchase").where(TF.recent("ts", AS_OF, DAYS) & (F.col("value") > 50)).join(people(t), "user_id")
         .where(C.is_valid_phone("phone")).withColumn("zip", C.zip5("zip")))
    m = D.merge_by_key(x, "phone", ["given", "family", "email", "zip", "ts"], "number")
    return feed(m, "contribution", phone_number=F.col("number"), first_name=F.col("given"), last_name=F.col("family"), email=F.col("email"),
                postal_code=F.col("zip"), action_date=_day("ts"))


def event_people(t: Tables) -> DataFrame:
    p = people(t)
    by_mail = p.select("user_id", C.canon_email("email").alias("address"))
    acts = [_of(t, k).join(by_mail, "user_id").select("address", F.col("ts").alias("at"), F.lit(k).alias("kind")) for k in ACTIONS]
    ordered = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("at")).join(by_mail, "user_id")
    last = D.latest_by(D.union_feeds(*acts, ordered.select("address", "at", F.lit("created").alias("kind"))), ["address"], ["at", "kind"], ["at", "kind"])
    x = (p.where("family in ('HOUSEHOLD', 'BUILDING')").withColumn("address", C.canon_email("email")).join(last, "address")
         .where(TF.recent("at", AS_OF, DAYS)).where(C.is_valid_phone("phone")).withColumn("zip", C.zip5("zip")))
    m = D.merge_by_key(x, "phone", ["given", "family", "address", "zip", "at"], "number")
    return feed(m, "event_people", phone_number=F.col("number"), first_name=F.col("given"), last_name=F.col("family"), email=F.col("address"),
                postal_code=F.col("zip"), action_date=_day("at"))


def _details(t: Tables, x: DataFrame) -> DataFrame:
    """Latest address and latest e-mail of every person (W2), joined on."""
    o = t.orders.select(F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderkey", "o_orderstatus")
    home = D.latest_by(o.where("o_orderstatus <> 'F'").withColumn("home", F.concat(F.col("o_orderkey").cast("string"), F.lit(" Elm St"))),
                       ["user_id"], ["o_orderdate", "o_orderkey"], ["home"])
    mail = D.latest_by(o.withColumn("mail", F.concat(F.lit("u"), F.col("o_orderkey").cast("string"), F.lit("@example.com"))),
                       ["user_id"], ["o_orderdate", "o_orderkey"], ["mail"])
    return x.join(home, "user_id", "left").join(mail, "user_id", "left")


def _in_state(t: Tables, state: str) -> DataFrame:
    lo, hi = VOTER_STATES[state]
    return people(t).where(F.col("nation").between(lo, hi))


def _classed(t: Tables, x: DataFrame, landline_wins: bool) -> DataFrame:
    blocks = t.orders.where("o_orderpriority = '1-URGENT'").select(F.substring(d.customer_phone(F.col("o_custkey")), 1, 7).alias("b"))
    to_w = t.orders.where("o_orderstatus = 'F'").select(d.customer_phone(F.col("o_custkey")).alias("p"))
    to_l = t.customer.where("c_mktsegment = 'AUTOMOBILE'").select(d.customer_phone().alias("p"))
    return J.classify_phone(x, "phone10", blocks, to_w, to_l, landline_wins=landline_wins).where("phone_type = 'C'")


def _voter(x: DataFrame, state: str, day=None) -> DataFrame:
    cols = dict(phone_number=F.col("phone10"), first_name=F.col("given"), last_name=F.col("family"), email=F.col("mail"), postal_code=F.col("zip"),
                addr1=F.col("home"), state=F.lit(state))
    return feed(x, f"voter_{state}", **cols, **({"action_date": _day(day)} if day is not None else {}))


def voter_a(t: Tables) -> DataFrame:
    agreed = _of(t, "signup").where(TF.recent("ts", AS_OF, DAYS)).select("user_id")
    x = J.semi(_in_state(t, "A").where("given is not null"), agreed, "user_id")
    return _voter(_details(t, _classed(t, x, False)), "A")


def voter_b(t: Tables) -> DataFrame:
    """Of the people who agreed, the phones entered on that day; without one the number is null."""
    agreed = _of(t, "click").where("value > 50").select("user_id", F.to_date("ts").alias("day")).distinct()
    entered = _of(t, "signup").select("user_id", F.to_date("ts").alias("day")).distinct().withColumn("_entered", F.lit(True))
    x = agreed.join(entered, ["user_id", "day"], "left").join(_in_state(t, "B"), "user_id")
    x = x.withColumn("phone10", F.when(F.col("_entered"), F.col("phone10")))
    return _voter(_details(t, x), "B", "day").distinct()


def _voter_late(t: Tables, state: str) -> DataFrame:
    agreed = _of(t, "view").where(TF.recent("ts", AS_OF, DAYS_LATE)).select("user_id")
    reached = t.orders.where("o_orderstatus <> 'F'").select(F.col("o_custkey").alias("user_id"))
    x = J.semi(J.semi(_in_state(t, state).where("given is not null"), agreed, "user_id"), reached, "user_id")
    return _voter(_details(t, _classed(t, x, True)), state)


def canvass_answers(t: Tables, committee: str) -> DataFrame:
    yes = _of(t, COMMITTEES[committee]).where("value > 90").select("user_id", F.to_date("ts").alias("day")).distinct()
    x = yes.join(people(t), "user_id")
    return feed(x, f"canvass_{committee}", phone_number=F.col("phone"), first_name=F.col("given"), last_name=F.col("family"),
                email=F.col("email"), postal_code=F.col("zip"), action_date=_day("day")).distinct()


def attempts(t: Tables) -> DataFrame:
    x = (_of(t, "signup").where("value > 20").join(people(t), "user_id").withColumn("number", C.phone10("phone"))
         .where(C.is_valid_phone("number")))
    x = D.first_per_key(x, ["number"], [F.col("ts").desc(), F.col("event_id").desc()])
    return feed(x, "attempt", phone_number=F.col("number"), first_name=F.col("given"), last_name=F.col("family"), email=F.col("email"),
                postal_code=C.zip5("zip"), action_date=_day("ts"))


def sms_upload(spark: SparkSession, base: str) -> DataFrame:
    """All ten feeds, less subscribed numbers (J6, both sides cut to ten digits; rows without a number stay), with
    the payload of each row that has a number."""
    t = Tables(spark, base)
    feeds = [contributions(t), event_people(t), voter_a(t), voter_b(t), _voter_late(t, "C"), _voter_late(t, "D"),
             *[canvass_answers(t, c) for c in COMMITTEES], attempts(t)]
    known = t.customer.where(F.col("c_acctbal") > KNOWN_BALANCE).select(C.phone10(d.customer_phone()).alias("_phone10"))
    x = anti_split(D.union_feeds(*feeds).withColumn("_phone10", C.phone10("phone_number")), known, "_phone10").drop("_phone10")
    payload = SK.profile_payload(F.col("phone_number"), ["first_name", "email", "postal_code"], [], [])
    return x.withColumn("payload", F.when(F.col("phone_number").isNotNull(), payload))


def _recent_sql(x: str, days: int) -> str:
    ny = "cast(timezone('America/New_York', timezone('UTC', {})) AS date)"
    return f"date_diff('day', {ny.format(x)}, {ny.format(f'TIMESTAMP {chr(39)}{AS_OF}{chr(39)}')}) <= {days}"


_N = "cast(NULL AS varchar)"
_ZIP5 = "CASE WHEN regexp_full_match(lpad(left(zip, 5), 5, '0'), '[0-9]{5}') THEN lpad(left(zip, 5), 5, '0') END"
_OK = "regexp_full_match(phone, '1?[2-9][0-9]{9}')"


def _late_sql(state: str) -> str:
    lo, hi = VOTER_STATES[state]
    return f"""SELECT phone10, given, family, mail, zip, home, {_N}, '{state}', 'US', {_N}, 'voter_{state}'
  FROM people LEFT JOIN home USING (user_id) LEFT JOIN mail USING (user_id)
 WHERE nation BETWEEN {lo} AND {hi} AND given IS NOT NULL AND (block OR to_w) AND NOT to_l
   AND user_id IN (SELECT user_id FROM events WHERE event_type = 'view' AND {_recent_sql('ts', DAYS_LATE)})
   AND user_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F')"""


def _canvass_sql(committee: str) -> str:
    return f"""SELECT DISTINCT phone, given, family, email, zip, {_N}, {_N}, {_N}, 'US', strftime(ts, '%Y-%m-%d'), 'canvass_{committee}'
  FROM events JOIN people USING (user_id) WHERE event_type = '{COMMITTEES[committee]}' AND value > 90"""


SMS_UPLOAD_SQL = f"""
WITH people AS (
  SELECT c_custkey AS user_id, {d.CUSTOMER_EMAIL_SQL} AS email, {d.CUSTOMER_PHONE_SQL} AS phone10,
         CASE WHEN c_nationkey % 2 = 0 THEN '1' || {d.CUSTOMER_PHONE_SQL} ELSE {d.CUSTOMER_PHONE_SQL} END AS phone,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN split_part(c_name, '#', 1) END AS given, c_mktsegment AS family, c_nationkey AS nation,
         CASE WHEN c_acctbal < 0 THEN 'n/a' ELSE cast((c_custkey * 37) % 99999 AS varchar) END AS zip,
         left({d.CUSTOMER_PHONE_SQL}, 7) IN (SELECT left(cast(2000000000 + o_custkey * 7919 AS varchar), 7) FROM orders WHERE o_orderpriority = '1-URGENT') AS block,
         c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS to_w, c_mktsegment = 'AUTOMOBILE' AS to_l
    FROM customer),
home AS (SELECT o_custkey AS user_id, o_orderkey || ' Elm St' AS home FROM orders WHERE o_orderstatus <> 'F'
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
mail AS (SELECT o_custkey AS user_id, 'u' || o_orderkey || '@example.com' AS mail FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
acts AS (SELECT user_id, ts AS act, event_type AS kind FROM events WHERE event_type IN ('signup', 'click', 'view', 'error')
         UNION ALL SELECT o_custkey, o_orderdate, 'created' FROM orders),
last AS (SELECT trim(lower(email)) AS address, max(act) AS act FROM acts JOIN people USING (user_id) GROUP BY 1),
feeds AS (
SELECT phone AS phone_number, max(given) AS first_name, max(family) AS last_name, max(email) AS email, max({_ZIP5}) AS postal_code, {_N} AS addr1,
       {_N} AS city, {_N} AS state, 'US' AS country, strftime(max(ts), '%Y-%m-%d') AS action_date, 'contribution' AS action_type
  FROM events JOIN people USING (user_id) WHERE event_type = 'purchase' AND value > 50 AND {_recent_sql('ts', DAYS)} AND {_OK} GROUP BY phone
UNION ALL
SELECT phone, max(given), max(family), max(address), max({_ZIP5}), {_N}, {_N}, {_N}, 'US', strftime(max(act), '%Y-%m-%d'), 'event_people'
  FROM people JOIN last ON address = trim(lower(email)) WHERE family IN ('HOUSEHOLD', 'BUILDING') AND {_recent_sql('act', DAYS)} AND {_OK} GROUP BY phone
UNION ALL
SELECT phone10, given, family, mail, zip, home, {_N}, 'A', 'US', {_N}, 'voter_A'
  FROM people LEFT JOIN home USING (user_id) LEFT JOIN mail USING (user_id)
 WHERE nation <= 4 AND given IS NOT NULL AND (block OR to_w)
   AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup' AND {_recent_sql('ts', DAYS)})
UNION ALL
SELECT DISTINCT CASE WHEN s.day IS NOT NULL THEN phone10 END, given, family, mail, zip, home, {_N}, 'B', 'US', strftime(a.day, '%Y-%m-%d'), 'voter_B'
  FROM (SELECT DISTINCT user_id, cast(ts AS date) AS day FROM events WHERE event_type = 'click' AND value > 50) a
  LEFT JOIN (SELECT DISTINCT user_id, cast(ts AS date) AS day FROM events WHERE event_type = 'signup') s ON s.user_id = a.user_id AND s.day = a.day
  JOIN people ON people.user_id = a.user_id LEFT JOIN home ON home.user_id = a.user_id LEFT JOIN mail ON mail.user_id = a.user_id
 WHERE nation BETWEEN 5 AND 9
UNION ALL {_late_sql('C')}
UNION ALL {_late_sql('D')}
UNION ALL {_canvass_sql('national')}
UNION ALL {_canvass_sql('A')}
UNION ALL {_canvass_sql('D')}
UNION ALL
SELECT * FROM (SELECT right(phone, 10), given, family, email, {_ZIP5}, {_N}, {_N}, {_N}, 'US', strftime(ts, '%Y-%m-%d'), 'attempt'
  FROM events JOIN people USING (user_id) WHERE event_type = 'signup' AND value > 20
  QUALIFY row_number() OVER (PARTITION BY right(phone, 10) ORDER BY ts DESC, event_id DESC) = 1)),
known AS (SELECT right({d.CUSTOMER_PHONE_SQL}, 10) AS k FROM customer WHERE c_acctbal > {KNOWN_BALANCE})
SELECT feeds.*, CASE WHEN phone_number IS NOT NULL THEN '{{"phone_number":"1' || right(phone_number, 10) || '"' ||
         coalesce(',"first_name":"' || first_name || '"', '') || coalesce(',"email":"' || email || '"', '') ||
         coalesce(',"postal_code":"' || postal_code || '"', '') || '}}' END AS payload
  FROM feeds WHERE phone_number IS NULL OR right(phone_number, 10) NOT IN (SELECT k FROM known)
"""
