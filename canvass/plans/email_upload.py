"""P3 as one job over the driver tables: seven feeds merged by canonical e-mail, less
suppressed people and bulk loaders, less subscribers (unless they may be
re-subscribed), checked, limited per type, logged, and rendered as records.

The feeds stand for: event people and hosts, community members, shop customers
(first order's attribution), donor-system contacts, canvass answers, the voter
file (lists per state, bulk loaders) and SMS profiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions.timefmt import epoch_seconds
from canvass.operators import aggregates as A
from canvass.operators import dedupe as D
from canvass.operators import joins as J
from canvass.operators import upload as U
from canvass.operators.sizing import broadcast_if_small
from canvass.plans import derive as d
from canvass.plans.sync_jobs import _KNOWN_EMAIL_SQL, _known_email
from canvass.sources.tables import Tables

SHOP_FROM = "1996-01-01"
BULK_PER_DAY = 3                      # of this binding; a run parameter of ``bulk_users``
LIMIT = 150
GROUPS, TYPE_FIELD = [11, 12], 5
TYPE_GROUPS = {"events": 21, "shop": 23, "voter": 26}
STATES = ["STATE_A", "STATE_B", "STATE_C"]
PART_END = "\x1f"
RECORD_PARTS = {"firstname": "firstname", "source": "source", "addr1": "cons_addr/addr1", "zip": "cons_addr/zip", "country": "cons_addr/country",
                "phone": "cons_phone/phone", "phone_type": "cons_phone/phone_type", "xml_email": "cons_email/email",
                "kind": f"cons_field[@id='{TYPE_FIELD}']/value"}


def _zip():
    return F.lpad(((F.col("c_custkey") * 37) % 99999).cast("string"), 5, "0")


def _given():
    return F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))


def _state(nation_key: str = "c_nationkey"):
    """Every nation stands for a state; the first three have suppression lists."""
    return F.when(F.col(nation_key) < 3, F.element_at(F.array(*[F.lit(s) for s in STATES]), (F.col(nation_key) + 1).cast("int"))).otherwise(
        F.concat(F.lit("STATE_"), F.col(nation_key).cast("string")))


def _people(t: Tables) -> DataFrame:
    """Customers with an address as people type it: other case, spaces."""
    typed = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit(" "), F.upper(d.customer_email()))).otherwise(d.customer_email())
    return t.customer.select("*", typed.alias("typed_email"), d.customer_email().alias("email"), d.customer_phone().alias("phone"),
                             _given().alias("given"), _zip().alias("zip"), _state().alias("state"))


def event_people(t: Tables) -> DataFrame:
    """A2 + A1: latest participation or hosting, merged by address."""
    took = t.events.where("event_type = 'signup'").groupBy("user_id").agg(F.max(epoch_seconds("ts")).alias("at"))
    hosted = t.orders.where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("user_id")).agg(F.max(epoch_seconds("o_orderdate")).alias("at"))
    x = _people(t).where("c_mktsegment = 'HOUSEHOLD'").join(D.union_feeds(took, hosted), F.col("user_id") == F.col("c_custkey"), "left")
    x = x.withColumn("id_text", F.col("c_custkey").cast("string"))
    m = D.merge_by_key(x, C.canon_email("typed_email"), ["given", "c_mktsegment", "zip", "phone", "id_text", "at"], "address")
    return U.feed(m, "events", email=F.col("address"), first_name=F.col("given"), last_name=F.col("c_mktsegment"), postal_code=F.col("zip"),
                  phone_number=F.col("phone"), ext_id=F.col("id_text"), action_epoch=F.col("at"))


def community(t: Tables) -> DataFrame:
    """members with a first name and a postal code."""
    x = t.supplier.withColumn("zip", F.when(F.col("s_acctbal") >= 0, F.lpad(((F.col("s_suppkey") * 41) % 99999).cast("string"), 5, "0")))
    host = F.concat(F.lit("@N"), F.col("s_nationkey").cast("string"), F.lit(".example.org"))
    return U.feed(x.where("s_name is not null and zip is not null"), "community",
                  email=C.canon_email(F.concat(F.replace("s_name", F.lit("#"), F.lit(".")), host)),
                  first_name=F.split_part(F.col("s_name"), F.lit("#"), F.lit(1)), postal_code=F.col("zip"),
                  ext_id=F.col("s_suppkey"), action_epoch=(F.col("s_suppkey") * 86400000).cast("double") / 1000)


def shop(t: Tables) -> DataFrame:
    """W1 + F19: attribution from the first order since ``SHOP_FROM``; latest opt-in."""
    o = t.orders.withColumn("ref", F.concat_ws("#", "o_orderpriority", "o_orderstatus"))
    first = D.first_per_key(o.where(F.col("o_orderdate") >= F.lit(SHOP_FROM).cast("timestamp")), ["o_custkey"],
                            [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]).select("o_custkey", "ref")
    optin = t.orders.where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.max(epoch_seconds("o_orderdate")).alias("at"))
    x = (_people(t).where("c_mktsegment <> 'FURNITURE'").withColumnRenamed("c_custkey", "o_custkey")
         .join(first, "o_custkey", "left").join(optin, "o_custkey", "left"))
    # some shops let people leave the end of the domain out
    email = F.when(F.col("c_acctbal") > 9000, F.replace("email", F.lit(".com"), F.lit(""))).otherwise(F.col("email"))
    return U.feed(x, "shop", email=C.canon_email(email), first_name=F.col("given"), last_name=F.col("c_mktsegment"), postal_code=F.col("zip"),
                  addr1=F.concat_ws(" ", F.col("o_custkey").cast("string"), F.lit("Main St & Oak")), city=F.lit("Ames"), state_cd=F.col("state"),
                  phone_number=F.col("phone"), ext_id=F.col("o_custkey"), source=F.split_part("ref", F.lit("#"), F.lit(1)),
                  subsource=F.split_part("ref", F.lit("#"), F.lit(2)), action_epoch=F.col("at"))


def donor_contacts(t: Tables) -> DataFrame:
    """W2 + F13: latest address entered by hand, not through an interface account."""
    users = t.supplier.select(F.col("s_suppkey").alias("user"), F.concat(F.col("s_name"), F.when(
        F.col("s_nationkey") % 5 == 0, F.lit(".api")).otherwise(F.lit(""))).alias("username"))
    added = (t.orders.where("o_orderpriority = '1-URGENT' and o_orderstatus <> 'F'")
             .select("o_custkey", "o_orderdate", "o_orderkey", (F.col("o_orderkey") % 10).alias("user")))
    x = (added.join(users, "user").where(~F.col("username").like("%.api"))
         .join(_people(t), F.col("o_custkey") == F.col("c_custkey")).withColumn("address", C.canon_email("typed_email")))
    x = D.first_per_key(x, ["address"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return U.feed(x, "donors", email=F.col("address"), first_name=F.col("given"), postal_code=F.col("zip"),
                  addr1=F.when(F.col("c_acctbal") >= 0, F.concat(F.col("c_custkey").cast("string"), F.lit(" Elm St"))),
                  state_cd=F.col("state"), phone_number=F.col("phone"), ext_id=F.col("c_custkey"))


def canvass_answers(t: Tables) -> DataFrame:
    """A1 over an action join: people who said yes."""
    yes = t.events.where("event_type in ('click', 'view')").select("user_id", epoch_seconds("ts").alias("at"))
    x = yes.join(_people(t), F.col("user_id") == F.col("c_custkey")).withColumn("id_text", F.col("user_id").cast("string"))
    m = D.merge_by_key(x, C.canon_email("typed_email"), ["given", "zip", "state", "phone", "id_text", "at"], "address")
    return U.feed(m, "canvass", email=F.col("address"), first_name=F.col("given"), postal_code=F.col("zip"), state_cd=F.col("state"),
                  phone_number=F.col("phone"), ext_id=F.col("id_text"), action_epoch=F.col("at"))


def suppressed(t: Tables) -> DataFrame:
    """One list of (state, id); each list holds for its own state only."""
    c = t.customer
    a = D.union_feeds(c.where("c_acctbal < -500").select(F.col("c_custkey").alias("id")),
                      t.events.where("event_type = 'error' and value > 90").select(F.col("user_id").alias("id")))
    b = t.orders.where("o_orderpriority = '5-LOW' and o_totalprice > 300000").select(F.col("o_custkey").alias("id"))
    cc = c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    return D.distinct_union(*[J.tag_lists(x, [s], "state") for s, x in zip(STATES, (a, b, cc))])


def voter_file(t: Tables) -> DataFrame:
    """Addresses by person and state, less the states' lists, bulk loaders and interface accounts."""
    p = _people(t)
    em = (t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 10).alias("user"))
          .join(p, F.col("o_custkey") == F.col("c_custkey")))
    users = t.supplier.where("s_suppkey < 10").select(F.col("s_suppkey").alias("user"), (F.col("s_acctbal") < 1000).alias("is_api"))
    hand = broadcast_if_small(users.where("not is_api").select("user"), J.CONFIG_ROWS)
    # a day of a user's is a quarter of the year here, as orders are few
    bulk = A.bulk_users(em.join(hand, "user").withColumn("loader", F.concat_ws("-", "user", "state")), "loader",
                        F.date_trunc("quarter", "day"), "typed_email", BULK_PER_DAY)
    x = (em.join(hand, "user").withColumn("loader", F.concat_ws("-", "user", "state")).join(bulk, "loader", "left_anti")
         .withColumn("id", F.col("c_custkey")))
    x = J.suppress(x, suppressed(t), "id", "state")
    homes = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.concat(F.col("c_custkey").cast("string"), F.lit(" Pine St")).alias("home"))
    x = J.left_join_where(x.drop("home"), homes, ["id"], None)
    return U.feed(x, "voter", email=C.canon_email("typed_email"), first_name=F.col("given"), postal_code=F.col("zip"), addr1=F.col("home"),
                  state_cd=F.col("state"), phone_number=F.when(F.col("c_nationkey") != 4, F.col("phone")),
                  ext_id=F.concat_ws("-", "state", F.col("id").cast("string"))).distinct()


def sms_profiles(t: Tables) -> DataFrame:
    """A1: profiles by address."""
    x = (t.events.where("event_type = 'purchase'").select("user_id", epoch_seconds("ts").alias("at"))
         .join(_people(t), F.col("user_id") == F.col("c_custkey")).withColumn("id_text", F.concat(F.lit("p"), F.col("user_id").cast("string"))))
    m = D.merge_by_key(x, C.canon_email("typed_email"), ["given", "zip", "phone", "id_text", "at"], "address")
    return U.feed(m, "sms", email=F.col("address"), first_name=F.col("given"), postal_code=F.col("zip"), phone_number=F.col("phone"),
                  ext_id=F.col("id_text"), action_epoch=F.col("at"))


FEEDS = (event_people, community, shop, donor_contacts, canvass_answers, voter_file, sms_profiles)


def candidates(t: Tables) -> DataFrame:
    """S1, then J7 with A5 and A6: all feeds, less subscribers and addresses never to be written to."""
    ev = t.events
    known = A.sub_state(ev.where("event_type in ('signup', 'error') and value < 95"), C.canon_email(_known_email()),
                        F.when(F.col("event_type") == "error", epoch_seconds("ts")), F.col("event_type") == "error")
    stg = ev.where("event_type = 'error' and value >= 60").select(
        _known_email().alias("email"), (F.col("event_id") % 3 == 0).alias("is_resubscribe"),
        F.when(F.col("value") >= 300, F.lit("deadrcpt")).otherwise(F.lit("unsub")).alias("reason"))
    black = A.blacklist(stg, "email", "is_resubscribe", "reason")
    return J.eligible_or_resubscribe(D.union_feeds(*[f(t) for f in FEEDS]), known, black, "email", "action_epoch")


def seen(spark: SparkSession, base: str, limit: int | None = None, dry_run: bool = False) -> DataFrame:
    t = Tables(spark, base)
    domains = (t.nation.where("n_regionkey <> 2").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(".example.org")).alias("domain"))
               .unionByName(spark.range(1).select(F.lit("example.com").alias("domain"))))
    existing = t.customer.where("c_acctbal > 5000").select(d.customer_email().alias("email"))
    replies = t.customer.where("c_nationkey <> 3").select(
        d.customer_email().alias("email"), (F.col("c_custkey") % 2 == 0).alias("was_new"), (F.col("c_nationkey") == 7).alias("was_error"))
    return U.process(candidates(t), domains, existing, replies, limit, dry_run)


def email_upload(spark: SparkSession, base: str) -> DataFrame:
    """Every row of the run, all types without a limit."""
    x = seen(spark, base)
    return x.withColumn("action_epoch", F.round("action_epoch", 3)).withColumn("unsub_epoch", F.round("unsub_epoch", 3))


def email_upload_limited(spark: SparkSession, base: str) -> DataFrame:
    """P3 + W8 + A9: a dry run of at most ``LIMIT`` accepted rows a type, counted."""
    return U.run_counts(seen(spark, base, LIMIT, dry_run=True))


def email_upload_records(spark: SparkSession, base: str) -> DataFrame:
    """SNK7: the nested records of the people to create, read back from their XML."""
    r = U.records(seen(spark, base), GROUPS, TYPE_GROUPS, TYPE_FIELD)

    body = r.withColumn("xml", F.regexp_replace("record", r"^<\?[^>]*>", ""))
    # every XPath call parses the record anew: one call reads all parts, with a character between them that XML cannot hold
    parts = F.xpath_string("xml", F.lit("concat(" + f", '{PART_END}', ".join(f"/api/cons/{p}" for p in RECORD_PARTS.values()) + ")"))
    x = body.withColumn("_parts", F.split(parts, PART_END, -1))
    value = {c: F.get("_parts", F.lit(i)) for i, c in enumerate(RECORD_PARTS)}
    return x.select("email", "ext_type", "ext_id", *[v.alias(c) for c, v in value.items() if c != "kind"],
                    F.array_join(F.xpath("xml", F.lit("/api/cons/cons_group/@id")), ",").alias("groups"), value["kind"].alias("kind"))


# ------------------------------------------------------------ the twin, feed by feed
_TYPED = f"CASE WHEN c_custkey % 5 = 0 THEN ' ' || upper({d.CUSTOMER_EMAIL_SQL}) ELSE {d.CUSTOMER_EMAIL_SQL} END"
_N = "cast(NULL AS varchar)"
_E = "cast(NULL AS double)"
_CANDIDATES_SQL = f"""
people AS (SELECT *, {_TYPED} AS typed_email, {d.CUSTOMER_EMAIL_SQL} AS email0, {d.CUSTOMER_PHONE_SQL} AS phone,
                  split_part(c_name, '#', 1) AS given, lpad(cast((c_custkey * 37) % 99999 AS varchar), 5, '0') AS zip,
                  'STATE_' || CASE c_nationkey WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE cast(c_nationkey AS varchar) END AS state
             FROM customer),
part AS (SELECT user_id, max(epoch(ts)) AS act FROM events WHERE event_type = 'signup' GROUP BY 1
         UNION ALL SELECT o_custkey, max(epoch(o_orderdate)) FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
f1 AS (SELECT trim(lower(typed_email)) AS email, max(given) AS first_name, max(c_mktsegment) AS last_name, max(zip) AS postal_code,
              {_N} AS addr1, {_N} AS addr2, {_N} AS city, {_N} AS state_cd, max(phone) AS phone_number, 'events' AS ext_type,
              max(cast(c_custkey AS varchar)) AS ext_id, {_N} AS source, {_N} AS subsource, max(act) AS action_epoch
         FROM people LEFT JOIN part ON user_id = c_custkey WHERE c_mktsegment = 'HOUSEHOLD' GROUP BY 1),
f2 AS (SELECT trim(lower(replace(s_name, '#', '.') || '@N' || s_nationkey || '.example.org')), split_part(s_name, '#', 1), {_N},
              lpad(cast((s_suppkey * 41) % 99999 AS varchar), 5, '0'), {_N}, {_N}, {_N}, {_N}, {_N}, 'community', cast(s_suppkey AS varchar),
              {_N}, {_N}, cast(s_suppkey * 86400 AS double)
         FROM supplier WHERE s_acctbal >= 0 AND s_name IS NOT NULL),
firsts AS (SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '{SHOP_FROM}'
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1),
optin AS (SELECT o_custkey, max(epoch(o_orderdate)) AS act FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
f3 AS (SELECT trim(lower(CASE WHEN c_acctbal > 9000 THEN replace(email0, '.com', '') ELSE email0 END)), given, c_mktsegment, zip,
              c_custkey || ' Main St & Oak', {_N}, 'Ames', state, phone, 'shop', cast(c_custkey AS varchar), firsts.o_orderpriority,
              firsts.o_orderstatus, optin.act
         FROM people LEFT JOIN firsts ON firsts.o_custkey = c_custkey LEFT JOIN optin ON optin.o_custkey = c_custkey
        WHERE c_mktsegment <> 'FURNITURE'),
f4 AS (SELECT trim(lower(typed_email)), given, {_N}, zip, CASE WHEN c_acctbal >= 0 THEN c_custkey || ' Elm St' END, {_N}, {_N}, state, phone,
              'donors', cast(c_custkey AS varchar), {_N}, {_N}, {_E}
         FROM orders JOIN supplier ON s_suppkey = o_orderkey % 10 JOIN people ON c_custkey = o_custkey
        WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' AND s_nationkey % 5 <> 0
      QUALIFY row_number() OVER (PARTITION BY trim(lower(typed_email)) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
f5 AS (SELECT trim(lower(typed_email)), max(given), {_N}, max(zip), {_N}, {_N}, {_N}, max(state), max(phone), 'canvass',
              max(cast(user_id AS varchar)), {_N}, {_N}, max(epoch(ts))
         FROM events JOIN people ON user_id = c_custkey WHERE event_type IN ('click', 'view') GROUP BY 1),
em AS (SELECT people.*, o_custkey, cast(o_orderdate AS date) AS day, o_orderkey % 10 AS usr
         FROM orders JOIN people ON c_custkey = o_custkey JOIN supplier ON s_suppkey = o_orderkey % 10 WHERE NOT s_acctbal < 1000),
bulk AS (SELECT DISTINCT usr, state FROM (SELECT usr, state, date_trunc('quarter', day) AS q, count(DISTINCT typed_email) AS n
           FROM em GROUP BY 1, 2, 3) WHERE n > {BULK_PER_DAY}),
sup_a AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < -500
          UNION ALL SELECT user_id FROM events WHERE event_type = 'error' AND value > 90),
sup_b AS (SELECT o_custkey AS id FROM orders WHERE o_orderpriority = '5-LOW' AND o_totalprice > 300000),
sup_c AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING'),
f6 AS (SELECT DISTINCT trim(lower(typed_email)), given, {_N}, zip, CASE WHEN c_acctbal >= 0 THEN c_custkey || ' Pine St' END, {_N}, {_N}, state,
              CASE WHEN c_nationkey <> 4 THEN phone END, 'voter', state || '-' || c_custkey, {_N}, {_N}, {_E}
         FROM em
        WHERE NOT EXISTS (SELECT 1 FROM bulk WHERE bulk.usr = em.usr AND bulk.state = em.state)
          AND NOT (state = 'STATE_A' AND c_custkey IN (SELECT id FROM sup_a WHERE id IS NOT NULL))
          AND NOT (state = 'STATE_B' AND c_custkey IN (SELECT id FROM sup_b))
          AND NOT (state = 'STATE_C' AND c_custkey IN (SELECT id FROM sup_c))),
f7 AS (SELECT trim(lower(typed_email)), max(given), {_N}, max(zip), {_N}, {_N}, {_N}, {_N}, max(phone), 'sms',
              max('p' || user_id), {_N}, {_N}, max(epoch(ts))
         FROM events JOIN people ON user_id = c_custkey WHERE event_type = 'purchase' GROUP BY 1),
feeds AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2 UNION ALL SELECT * FROM f3 UNION ALL SELECT * FROM f4
          UNION ALL SELECT * FROM f5 UNION ALL SELECT * FROM f6 UNION ALL SELECT * FROM f7),
known AS (SELECT trim(lower({_KNOWN_EMAIL_SQL})) AS kemail, max(CASE WHEN event_type = 'error' THEN epoch(ts) END) AS unsub_epoch,
                 bool_or(event_type = 'error') AS isunsub
            FROM events WHERE event_type IN ('signup', 'error') AND value < 95 GROUP BY 1),
stg AS (SELECT {_KNOWN_EMAIL_SQL} AS bemail, event_id % 3 = 0 AS is_resubscribe,
               CASE WHEN value >= 300 THEN 'deadrcpt' ELSE 'unsub' END AS reason
          FROM events WHERE event_type = 'error' AND value >= 60),
black AS (SELECT bemail FROM stg GROUP BY bemail, is_resubscribe HAVING count(*) >= 2 UNION SELECT bemail FROM stg WHERE reason ILIKE '%deadrcpt%'),
cand AS (SELECT feeds.*, kemail IS NOT NULL AS is_resubscribe, unsub_epoch
           FROM feeds LEFT JOIN known ON replace(kemail, '.', '') = replace(email, '.', '')
          WHERE (kemail IS NULL OR (isunsub AND unsub_epoch IS NOT NULL AND unsub_epoch < action_epoch))
            AND NOT EXISTS (SELECT 1 FROM black WHERE replace(trim(lower(bemail)), '.', '') = replace(email, '.', '')))"""

_SEEN_SQL = f"""WITH {_CANDIDATES_SQL},
v AS (SELECT cand.*, regexp_full_match(email, '[a-z0-9.]+@[a-z0-9-]+([.][a-z0-9-]+)*[.][a-z]{{2,}}')
             AND split_part(email, '@', 2) IN (SELECT 'n' || n_nationkey || '.example.org' FROM nation WHERE n_regionkey <> 2 UNION ALL SELECT 'example.com')
             AS valid, email IN (SELECT {d.CUSTOMER_EMAIL_SQL} FROM customer WHERE c_acctbal > 5000) AS have FROM cand),
seen AS (SELECT v.* EXCLUDE (valid, have), CASE WHEN NOT valid THEN 'rejected' WHEN is_resubscribe THEN 'resubscribe' ELSE 'create' END AS outcome,
                CASE WHEN valid THEN have END AS did_exist, valid FROM v)"""

EMAIL_UPLOAD_SQL = f"""{_SEEN_SQL}
SELECT seen.* EXCLUDE (valid) REPLACE (round(action_epoch, 3) AS action_epoch, round(unsub_epoch, 3) AS unsub_epoch),
       CASE WHEN outcome = 'create' AND c_nationkey <> 3 THEN c_custkey % 2 = 0 END AS was_new,
       CASE WHEN outcome = 'create' AND c_nationkey <> 3 THEN c_nationkey = 7 END AS was_error
  FROM seen LEFT JOIN people ON people.email0 = seen.email
"""

EMAIL_UPLOAD_LIMITED_SQL = f"""{_SEEN_SQL},
a AS (SELECT *, coalesce(sum(CASE WHEN valid THEN 1 ELSE 0 END) OVER (PARTITION BY ext_type ORDER BY email, ext_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM seen)
SELECT ext_type, count(*) AS n_rows, count(*) FILTER (WHERE outcome = 'create') AS n_sent,
       count(*) FILTER (WHERE valid AND NOT did_exist) AS n_new, count(*) FILTER (WHERE outcome = 'resubscribe') AS n_resubscribe,
       count(*) FILTER (WHERE outcome = 'rejected') AS n_rejected
  FROM a WHERE before < {LIMIT} GROUP BY 1
"""

EMAIL_UPLOAD_RECORDS_SQL = f"""{_SEEN_SQL}
SELECT email, ext_type, ext_id, first_name AS firstname, coalesce(source, '') AS source, coalesce(addr1, '') AS addr1, postal_code AS zip,
       'US' AS country, coalesce(phone_number, '') AS phone, CASE WHEN phone_number IS NULL THEN '' ELSE 'home' END AS phone_type,
       email AS xml_email, '11,12' || CASE ext_type WHEN 'events' THEN ',21' WHEN 'shop' THEN ',23' WHEN 'voter' THEN ',26' ELSE '' END AS groups,
       ext_type AS kind
  FROM seen WHERE outcome = 'create'
"""
