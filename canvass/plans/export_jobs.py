"""Export-side jobs bound to the driver tables: signup groups with status
rules (F6, F10, F11, F15), the early-vote invite export (P1 tail: W4, J10,
F20, F16), config-map groups (J24), e-mail validation against a domain
table (X18), donor lookup (J23), map merge with defaults (AR10) and a
day-matched join (J20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.functions import filters as FL
from canvass.functions.timefmt import before_ds
from canvass.operators import joins as J
from canvass.operators.donors import donor_id
from canvass.operators.sizing import broadcast_if_small
from canvass.plans import geo_jobs as G
from canvass.plans.event_jobs import DONOR_SALT
from canvass.sources.tables import Tables

SIGNUP_DS = "1998-06-01"
EXCLUDED_TYPES = ["5-LOW"]


def event_signups(spark: SparkSession, base: str) -> DataFrame:
    """Orders as event sign-ups: soft-deleted rows out, excluded statuses out
    (null statuses too), attended-or-unknown only, then past/upcoming groups
    around the run date in New York time (past groups upper-cased)."""
    o = Tables(spark, base).orders.select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("signup_type"), "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).alias("attended"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000), F.col("o_orderdate"))
         .alias("deleted_date"))
    kept = o.filter(FL.not_deleted("deleted_date") & FL.exclude_status("signup_type", EXCLUDED_TYPES)
                    & FL.attended_or_unknown("attended"))
    grp = F.when(before_ds("o_orderdate", SIGNUP_DS), F.concat(F.lit("past_"), F.upper("signup_type"))) \
           .otherwise(F.concat(F.lit("upcoming_"), F.col("signup_type")))
    return kept.select("o_orderkey", "o_custkey", grp.alias("group_name"))


EVENT_SIGNUPS_SQL = f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority AS signup_type, o_orderdate,
                  CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS attended,
                  CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN o_orderdate END AS deleted_date
             FROM orders)
SELECT o_orderkey, o_custkey,
       CASE WHEN timezone('America/New_York', timezone('UTC', o_orderdate)) < TIMESTAMP '{SIGNUP_DS}'
            THEN 'past_' || upper(signup_type) ELSE 'upcoming_' || signup_type END AS group_name
  FROM o
 WHERE deleted_date IS NULL AND signup_type NOT IN ({", ".join(f"'{x}'" for x in EXCLUDED_TYPES)})
   AND (attended IS NULL OR attended = 1)
"""

INVITE_AS_OF = "1998-01-01"
TARGETED = [7, 13, 19]


def _phones(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("vanid"), (F.lit(3000000000) + F.col("o_orderkey")).cast("string").alias("phone"),
        F.when(F.col("o_orderstatus").isin("F", "O"), "C").otherwise("L").alias("phone_type"),
        (F.col("o_totalprice") / 1000).cast("int").alias("phone_quality_rank"),
        (F.col("o_orderkey") % 20).alias("wrongnumber"))


def best_phone(phones: DataFrame) -> DataFrame:
    """One cell phone per voter: fewer than 12 wrong-number marks, best
    quality rank (nulls last), phone text as the final tie-break."""
    ok = phones.filter((F.col("phone_type") == "C") & (F.col("wrongnumber") < 12))
    rn = F.row_number().over(Window.partitionBy("vanid").orderBy(
        F.col("phone_quality_rank").desc_nulls_last(), F.col("phone").desc()))
    return ok.withColumn("_rn", rn).filter("_rn = 1").select("vanid", "phone")


def invite_export(spark: SparkSession, base: str) -> DataFrame:
    """P1 tail: nearest site per phase with the voter's best phone (voters
    without one drop out), in the invite layout, for upcoming send dates."""
    t = Tables(spark, base)
    # a site starts within its phase, so phases that end before the first send date give no row
    near = G.nearest_sites(spark, base, lambda end: FL.upcoming(F.date_sub(end, 1), INVITE_AS_OF))
    ph = best_phone(_phones(t.orders))
    x = (near.join(ph, near["c_custkey"] == ph["vanid"], "inner")
         .join(t.customer, "c_custkey"))
    send = F.date_sub("start_date", 1)
    blurb = F.when(F.col("site_id") % 3 == 0, F.lit("Rally at noon")).otherwise(F.lit(""))
    out = x.select(
        F.col("c_custkey").alias("Custom ID"),
        F.initcap(F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"), "phone",
        send.alias("send_date"), F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
        F.concat(F.lit("Site "), F.col("site_id").cast("string")).alias("evipLocation"),
        F.when(F.length(blurb) > 5, 1).otherwise(0).alias("evipIsRally"),
        F.col("c_nationkey").alias("County"),
        F.when(F.col("c_nationkey").isin(TARGETED), 1).otherwise(0).alias("isTargetedSD"),
        F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("isStrongDem"))
    out = out.filter(FL.upcoming(F.col("send_date"), INVITE_AS_OF))
    return out.withColumn("send_date", F.date_format("send_date", "yyyy-MM-dd"))


INVITE_EXPORT_SQL = f"""
WITH near AS ({G.NEAREST_BY_PHASE_TOLERANCE_SQL}),
ph AS (SELECT o_custkey AS vanid, cast(3000000000 + o_orderkey AS varchar) AS phone,
              CASE WHEN o_orderstatus IN ('F', 'O') THEN 'C' ELSE 'L' END AS phone_type,
              cast(trunc(o_totalprice / 1000) AS integer) AS phone_quality_rank, o_orderkey % 20 AS wrongnumber
         FROM orders),
best AS (SELECT vanid, phone FROM (
           SELECT *, row_number() OVER (PARTITION BY vanid ORDER BY phone_quality_rank DESC NULLS LAST,
                                        phone DESC) AS rn
             FROM ph WHERE phone_type = 'C' AND wrongnumber < 12) WHERE rn = 1),
x AS (SELECT n.*, b.phone, c.c_name, c.c_nationkey, c.c_acctbal,
             cast(n.start_date AS date) - 1 AS send_date,
             CASE WHEN n.site_id % 3 = 0 THEN 'Rally at noon' ELSE '' END AS blurb
        FROM near n JOIN best b ON n.c_custkey = b.vanid JOIN customer c ON c.c_custkey = n.c_custkey)
SELECT c_custkey AS "Custom ID",
       upper(substr(split_part(c_name, '#', 1), 1, 1)) || lower(substr(split_part(c_name, '#', 1), 2)) AS first_name,
       split_part(c_name, '#', 2) AS last_name, phone, strftime(send_date, '%Y-%m-%d') AS send_date,
       start_date, 'Site ' || cast(site_id AS varchar) AS evipLocation,
       CASE WHEN length(blurb) > 5 THEN 1 ELSE 0 END AS evipIsRally, c_nationkey AS County,
       CASE WHEN c_nationkey IN ({", ".join(map(str, TARGETED))}) THEN 1 ELSE 0 END AS isTargetedSD,
       CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS isStrongDem
  FROM x WHERE send_date >= DATE '{INVITE_AS_OF}' + 1
"""

# Configured (question, answer) -> group map (J24): data, not code.
GROUP_CONFIG = [("signup", 0, "grp_signup_low"), ("signup", 1, "grp_signup_mid"),
                ("purchase", 1, "grp_buy_mid"), ("click", 4, "grp_click_high"), ("view", 3, "grp_view_3")]


def config_groups(spark: SparkSession, base: str) -> DataFrame:
    """(question, answer) -> group through a configured map, broadcast
    after a size check; actions outside the map do not match."""
    ev = Tables(spark, base).events
    cfg = spark.createDataFrame(GROUP_CONFIG, "question string, answer int, group_name string")
    cfg = broadcast_if_small(cfg, J.CONFIG_ROWS)
    x = ev.withColumn("answer", F.floor(F.col("value") / 100).cast("int"))
    return (x.join(cfg, (x["event_type"] == cfg["question"]) & (x["answer"] == cfg["answer"]), "inner")
            .select("event_id", "user_id", "group_name"))


CONFIG_GROUPS_SQL = f"""
SELECT e.event_id, e.user_id, c.group_name
  FROM events e JOIN (VALUES {", ".join(f"('{q}', {a}, '{g}')" for q, a, g in GROUP_CONFIG)}) c(question, answer, group_name)
    ON c.question = e.event_type AND c.answer = cast(floor(e.value / 100) AS integer)
"""


def email_validation(spark: SparkSession, base: str) -> DataFrame:
    """Syntax check per address, then one status per distinct domain
    (an input table, here derived from nation/region), joined back."""
    t = Tables(spark, base)
    local = F.replace(F.lower("c_name"), F.lit("#"), F.lit("."))
    dom = F.concat(F.lower("n_name"), F.lit(".example.com"))
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(F.col("c_custkey") % 11 == 0, F.concat(local, dom))
                      .otherwise(F.concat(local, F.lit("@"), dom)).alias("email"))
    domains = t.nation.select(dom.alias("domain"), (F.col("n_regionkey") != 2).alias("domain_ok")).distinct()
    x = c.withColumn("syntax_ok", FL.email_syntax_ok("email")).withColumn("domain", FL.email_domain("email"))
    x = x.join(broadcast_if_small(domains, J.CONFIG_ROWS), "domain", "left")
    return x.select("c_custkey", "email", "syntax_ok",
                    (F.col("syntax_ok") & F.coalesce(F.col("domain_ok"), F.lit(False))).alias("deliverable"))


_RX = FL.EMAIL_SYNTAX.replace("'", "''")
EMAIL_VALIDATION_SQL = f"""
WITH c AS (SELECT c_custkey,
                  CASE WHEN c_custkey % 11 = 0 THEN replace(lower(c_name), '#', '.') || lower(n_name) || '.example.com'
                       ELSE replace(lower(c_name), '#', '.') || '@' || lower(n_name) || '.example.com' END AS email
             FROM customer JOIN nation ON c_nationkey = n_nationkey),
d AS (SELECT DISTINCT lower(n_name) || '.example.com' AS domain, n_regionkey <> 2 AS domain_ok FROM nation),
x AS (SELECT c.*, regexp_full_match(email, '{_RX}') AS syntax_ok,
             lower(split_part(email, '@', -1)) AS domain FROM c)
SELECT x.c_custkey, x.email, x.syntax_ok, x.syntax_ok AND coalesce(d.domain_ok, false) AS deliverable
  FROM x LEFT JOIN d USING (domain)
"""


def donor_lookup(spark: SparkSession, base: str) -> DataFrame:
    """Typed e-mail -> donor id, exact match first, else the
    lower-cased address; the typed form is kept."""
    t = Tables(spark, base)
    em = F.concat(F.lit("customer."), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("@example.com"))
    donors = t.orders.select(em.alias("email")).distinct().withColumn("donor_id", donor_id(F.col("email"), DONOR_SALT))
    typed = F.concat(F.lit("customer."), F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit("@example.com"))
    req = t.customer.select(F.when(F.col("c_custkey") % 3 == 0, F.upper(typed)).otherwise(typed).alias("typed_email"))
    r = J.fallback_lookup(req, F.col("typed_email"), donors, "email", F.lower(F.col("email")), ["donor_id"])
    return r.select("typed_email", "donor_id")


_DEMAIL = "'customer.' || lpad(cast(o_custkey AS varchar), 9, '0') || '@example.com'"
_TEMAIL = "'customer.' || lpad(cast(c_custkey AS varchar), 9, '0') || '@example.com'"
DONOR_LOOKUP_SQL = f"""
WITH d AS (SELECT DISTINCT {_DEMAIL} AS email FROM orders),
d2 AS (SELECT email, substring(translate(base64(from_hex(md5('{DONOR_SALT}' || email))), '+/', '-_'), 1, 12) AS donor_id
         FROM d),
r AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN upper({_TEMAIL}) ELSE {_TEMAIL} END AS typed_email FROM customer)
SELECT r.typed_email, coalesce(e.donor_id, l.donor_id) AS donor_id
  FROM r LEFT JOIN d2 e ON e.email = r.typed_email
  LEFT JOIN (SELECT lower(email) AS lk, min(donor_id) AS donor_id FROM d2 GROUP BY 1) l ON l.lk = lower(r.typed_email)
"""

PROP_DEFAULTS = {"k": 0, "j": 1}


def merge_props(spark: SparkSession, base: str) -> DataFrame:
    """AR10: defaults merged with each event's own properties, later wins
    (``map_concat`` under the LAST_WIN key policy)."""
    ev = Tables(spark, base).events
    defaults = F.create_map(*[x for k, v in PROP_DEFAULTS.items() for x in (F.lit(k), F.lit(v))])
    m = F.map_concat(defaults, F.from_json("props", "map<string,int>"))
    return ev.select("event_id", m["k"].alias("k"), m["j"].alias("j"))


MERGE_PROPS_SQL = f"""
SELECT event_id, coalesce(try_cast(props->>'k' AS integer), {PROP_DEFAULTS['k']}) AS k,
       coalesce(try_cast(props->>'j' AS integer), {PROP_DEFAULTS['j']}) AS j FROM events
"""


def day_matched(spark: SparkSession, base: str) -> DataFrame:
    """Sign-ups and clicks of the same user on the same calendar day,
    each side first reduced to one row per (user, day)."""
    ev = Tables(spark, base).events.withColumn("day", F.to_date("ts"))
    s = ev.filter(F.col("event_type") == "signup").groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("signups"))
    c = ev.filter(F.col("event_type") == "click").groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("clicks"))
    return s.join(c, ["user_id", "day"]).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


DAY_MATCHED_SQL = """
WITH s AS (SELECT user_id, cast(ts AS date) AS day, count(*) AS signups FROM events WHERE event_type = 'signup' GROUP BY 1, 2),
c AS (SELECT user_id, cast(ts AS date) AS day, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT s.user_id, strftime(s.day, '%Y-%m-%d') AS day, s.signups, c.clicks FROM s JOIN c USING (user_id, day)
"""
