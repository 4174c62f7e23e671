"""Sync jobs bound to the driver tables: suppression with re-subscribe
(J7, A5, A6, F2), field pivot and diffs (A10, D1, D2), audience groups
(F23, A11, S4, S5), caps and batches (W8, SNK6), run counts (A9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions.timefmt import epoch_seconds
from canvass.operators import aggregates as A
from canvass.operators import diff as DF
from canvass.operators import groups as G
from canvass.operators import joins as J
from canvass.operators import scan as S
from canvass.plans import derive as d
from canvass.plans.contact_jobs import EVENT_TYPES, IDENTITY_MATCH_SQL, identity_match, user_phone
from canvass.sources.tables import Tables


# ------------------------------------------------------------ resubscribe_filter
def _known_email():
    return F.concat(F.lit("Customer"), F.lpad(F.col("user_id").cast("string"), 9, "0"), F.lit("@Example.com"))


_KNOWN_EMAIL_SQL = "('Customer' || lpad(cast(user_id AS varchar), 9, '0') || '@Example.com')"


def resubscribe_filter(spark: SparkSession, base: str) -> DataFrame:
    """J7 + A5 + A6 + F2: all contacts minus known subscribers, except known
    people who unsubscribed before a later qualifying action; never anyone
    on the blacklist. Matching is on the dotless email key."""
    t = Tables(spark, base)
    ev = t.events
    buys = (ev.filter(F.col("event_type") == "purchase").groupBy("user_id")
            .agg(F.max(epoch_seconds("ts")).alias("action_epoch")))
    combined = (t.customer.select("c_custkey", d.customer_email().alias("email"))
                .join(buys, F.col("c_custkey") == F.col("user_id"), "left").select("email", "action_epoch"))
    known = A.sub_state(ev.filter(F.col("event_type").isin("signup", "error")),
                        C.canon_email(_known_email()),
                        F.when(F.col("event_type") == "error", epoch_seconds("ts")),
                        F.col("event_type") == "error")
    stg = ev.filter((F.col("event_type") == "error") & (F.col("value") >= 100)).select(
        _known_email().alias("email"), (F.col("value") >= 200).alias("is_resubscribe"),
        F.when(F.col("value") >= 300, F.lit("deadrcpt")).otherwise(F.lit("unsub")).alias("reason"))
    black = A.blacklist(stg, "email", "is_resubscribe", "reason")
    r = J.eligible_or_resubscribe(combined, known, black, "email", "action_epoch")
    return r.select("email", F.round("action_epoch", 6).alias("action_epoch"), "is_resubscribe",
                    F.round("unsub_epoch", 6).alias("unsub_epoch"))


RESUBSCRIBE_FILTER_SQL = f"""
WITH buys AS (SELECT user_id, max(epoch(ts)) AS action_epoch FROM events WHERE event_type = 'purchase' GROUP BY 1),
combined AS (SELECT {d.CUSTOMER_EMAIL_SQL} AS email, b.action_epoch FROM customer c
               LEFT JOIN buys b ON c.c_custkey = b.user_id),
known AS (SELECT trim(lower({_KNOWN_EMAIL_SQL})) AS email,
                 max(CASE WHEN event_type = 'error' THEN epoch(ts) END) AS unsub_epoch,
                 bool_or(event_type = 'error') AS isunsub
            FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1),
stg AS (SELECT {_KNOWN_EMAIL_SQL} AS email, value >= 200 AS is_resubscribe,
               CASE WHEN value >= 300 THEN 'deadrcpt' ELSE 'unsub' END AS reason
          FROM events WHERE event_type = 'error' AND value >= 100),
black AS (SELECT DISTINCT email FROM stg GROUP BY email, is_resubscribe HAVING count(*) >= 2
          UNION SELECT DISTINCT email FROM stg WHERE reason ILIKE '%deadrcpt%')
SELECT c.email, round(c.action_epoch, 6) AS action_epoch, k.email IS NOT NULL AS is_resubscribe,
       round(k.unsub_epoch, 6) AS unsub_epoch
  FROM combined c
  LEFT JOIN known k ON replace(trim(lower(k.email)), '.', '') = replace(trim(lower(c.email)), '.', '')
  LEFT JOIN black b ON replace(trim(lower(b.email)), '.', '') = replace(trim(lower(c.email)), '.', '')
 WHERE (k.email IS NULL OR (k.isunsub AND k.unsub_epoch IS NOT NULL AND k.unsub_epoch < c.action_epoch))
   AND b.email IS NULL
"""


# ------------------------------------------------------------ fields
def pivot_fields(spark: SparkSession, base: str) -> DataFrame:
    """A10: long (user, event type, value) -> one column per type (max value)."""
    ev = Tables(spark, base).events
    return A.pivot_fields(ev, "user_id", "event_type", "value", EVENT_TYPES, ids=ev)


PIVOT_FIELDS_SQL = "SELECT user_id, " + ", ".join(
    f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in EVENT_TYPES) + \
    " FROM events GROUP BY user_id"

CUT = "2024-01-16"


def _crm_sides(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    ev = Tables(spark, base).events
    cut = F.lit(CUT).cast("timestamp")
    old_long = (ev.filter(F.col("ts") < cut).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
                .select("user_id", "event_type",
                        F.when(F.col("n") == 1, F.lit("")).otherwise((F.col("n") - 1).cast("string")).alias("value")))
    stored = A.pivot_fields(old_long, "user_id", "event_type", "value", EVENT_TYPES, ids=ev)
    cnt = {t: F.count_if((F.col("event_type") == t) & (F.col("ts") >= cut)) for t in EVENT_TYPES}
    wanted = ev.groupBy("user_id").agg(*[F.when(c == 0, F.lit(None)).otherwise(c - 1).alias(t)
                                         for t, c in cnt.items()])
    return stored, wanted


def field_diff_crm(spark: SparkSession, base: str) -> DataFrame:
    """D1 over stored (first half, pivoted EAV text) vs wanted (second half counts)."""
    stored, wanted = _crm_sides(spark, base)
    return DF.diff_fields(stored, wanted, "user_id", [DF.FieldRule(t) for t in EVENT_TYPES])


def _crm_sql_sides() -> str:
    old_cols = ", ".join(f"max(CASE WHEN name = '{t}' THEN value END) AS {t}" for t in EVENT_TYPES)
    new_cols = ", ".join(
        f"CASE WHEN count(*) FILTER (WHERE event_type = '{t}' AND ts >= TIMESTAMP '{CUT}') = 0 THEN NULL "
        f"ELSE count(*) FILTER (WHERE event_type = '{t}' AND ts >= TIMESTAMP '{CUT}') - 1 END AS {t}"
        for t in EVENT_TYPES)
    return f"""
old_long AS (SELECT user_id, event_type AS name,
                    CASE WHEN count(*) = 1 THEN '' ELSE cast(count(*) - 1 AS varchar) END AS value
               FROM events WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1, 2),
ids AS (SELECT DISTINCT user_id FROM events),
o AS (SELECT ids.user_id, {old_cols} FROM ids LEFT JOIN old_long USING (user_id) GROUP BY ids.user_id),
n AS (SELECT user_id, {new_cols} FROM events GROUP BY user_id)"""


def _blank(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


def _crm_cond(t: str) -> str:
    o, n = f"o.{t}", f"n.{t}"
    return (f"(NOT ({n} = 0 AND {_blank(o)}) AND (({_blank(o)} AND {n} IS NOT NULL) "
            f"OR ({o} IS NOT NULL AND {o} <> '' AND {n} IS NULL) OR try_cast({o} AS double) <> cast({n} AS double)))")


FIELD_DIFF_CRM_SQL = f"""
WITH {_crm_sql_sides()}
SELECT DISTINCT n.user_id, {", ".join(f"cast(n.{t} AS varchar) AS {t}" for t in EVENT_TYPES)}
  FROM o JOIN n USING (user_id)
 WHERE ({" OR ".join(_crm_cond(t) for t in EVENT_TYPES)})
   AND ({" OR ".join(f"n.{t} IS NOT NULL" for t in EVENT_TYPES)})
"""

SMS_RULES = [DF.FieldRule("view", DF.INT), DF.FieldRule("signup", DF.YESNO), DF.FieldRule("error", DF.PLAIN),
             DF.FieldRule("click", DF.DATE), DF.FieldRule("purchase", DF.IGNORE)]


def field_diff_sms(spark: SparkSession, base: str) -> DataFrame:
    """D2 with one field of each kind (int, yes/no, plain, date, ignored)."""
    ev = Tables(spark, base).events
    cut = F.lit(CUT).cast("timestamp")
    late, early = F.col("ts") >= cut, F.col("ts") < cut

    def is_(t):
        return F.col("event_type") == t
    c2 = {t: F.count_if(is_(t) & late) for t in EVENT_TYPES}
    c1 = {t: F.count_if(is_(t) & early) for t in EVENT_TYPES}
    click_all = F.max(F.when(is_("click"), F.col("ts")))
    click_early = F.max(F.when(is_("click") & early, F.col("ts")))
    per_user = ev.groupBy("user_id").agg(
        F.round(F.avg(F.when(is_("view") & late, F.col("value"))), 1).alias("view"),
        F.when(c2["signup"] == 0, F.lit(0)).when(c2["signup"] == 1, F.lit(1)).alias("signup"),
        F.when(c2["error"] == 0, F.lit(None)).otherwise(c2["error"] - 1).alias("error"),
        F.to_date(F.max(F.when(is_("click") & late, F.col("ts")))).alias("click"),
        c2["purchase"].alias("purchase"),
        F.round(F.avg(F.when(is_("view") & early, F.col("value"))), 1).cast("string").alias("o_view"),
        F.when(c1["signup"] == 0, F.lit(None)).when(c1["signup"] == 1, F.lit("Yes"))
         .when(c1["signup"] == 2, F.lit("No")).when(c1["signup"] == 3, F.lit("")).otherwise(F.lit("1")).alias("o_signup"),
        F.when(c1["error"] == 0, F.lit(None)).when(c1["error"] == 1, F.lit(""))
         .otherwise((c1["error"] - 1).cast("string")).alias("o_error"),
        F.date_format(F.when(F.col("user_id") % 2 == 0, click_all).otherwise(click_early), "yyyy-MM-dd").alias("o_click"),
        c1["purchase"].cast("string").alias("o_purchase"))
    keyed = per_user.withColumn("phone_number", user_phone())
    wanted = keyed.select("phone_number", *[r.name for r in SMS_RULES])
    stored = keyed.select("phone_number", *[F.col(f"o_{r.name}").alias(r.name) for r in SMS_RULES])
    return DF.diff_fields(stored, wanted, "phone_number", SMS_RULES, sms=True)


def _sms_cond(name: str, kind: str) -> str:
    o, n = f"o.{name}", f"n.{name}"
    zero = "FALSE" if kind == DF.DATE else f"({n} = 0 AND {o} IS NULL)"
    if kind == DF.INT:
        diff = f"ceil(try_cast({o} AS double)) <> ceil(cast({n} AS double))"
    elif kind == DF.YESNO:
        diff = (f"(({o} IN ('1', 'Yes') AND ({n} IS NULL OR {n} = 0)) "
                f"OR (({o} IS NULL OR {o} IN ('0', 'No', '')) AND {n} = 1))")
    elif kind == DF.DATE:
        diff = f"try_cast({o} AS date) <> {n}"
    else:
        diff = f"try_cast({o} AS double) <> cast({n} AS double)"
    return (f"(NOT {zero} AND (({_blank(o)} AND {n} IS NOT NULL) "
            f"OR ({o} IS NOT NULL AND {o} <> '' AND {n} IS NULL) OR {diff}))")


_LIVE = [r for r in SMS_RULES if r.kind != DF.IGNORE]
_CU = f"TIMESTAMP '{CUT}'"
FIELD_DIFF_SMS_SQL = f"""
WITH u AS (
  SELECT user_id,
    round(avg(value) FILTER (WHERE event_type = 'view' AND ts >= {_CU}), 1) AS view,
    CASE count(*) FILTER (WHERE event_type = 'signup' AND ts >= {_CU}) WHEN 0 THEN 0 WHEN 1 THEN 1 END AS signup,
    CASE WHEN count(*) FILTER (WHERE event_type = 'error' AND ts >= {_CU}) = 0 THEN NULL
         ELSE count(*) FILTER (WHERE event_type = 'error' AND ts >= {_CU}) - 1 END AS error,
    cast(max(ts) FILTER (WHERE event_type = 'click' AND ts >= {_CU}) AS date) AS click,
    count(*) FILTER (WHERE event_type = 'purchase' AND ts >= {_CU}) AS purchase,
    cast(round(avg(value) FILTER (WHERE event_type = 'view' AND ts < {_CU}), 1) AS varchar) AS o_view,
    CASE count(*) FILTER (WHERE event_type = 'signup' AND ts < {_CU}) WHEN 0 THEN NULL WHEN 1 THEN 'Yes'
         WHEN 2 THEN 'No' WHEN 3 THEN '' ELSE '1' END AS o_signup,
    CASE count(*) FILTER (WHERE event_type = 'error' AND ts < {_CU}) WHEN 0 THEN NULL WHEN 1 THEN ''
         ELSE cast(count(*) FILTER (WHERE event_type = 'error' AND ts < {_CU}) - 1 AS varchar) END AS o_error,
    strftime(CASE WHEN user_id % 2 = 0 THEN max(ts) FILTER (WHERE event_type = 'click')
                  ELSE max(ts) FILTER (WHERE event_type = 'click' AND ts < {_CU}) END, '%Y-%m-%d') AS o_click
  FROM events GROUP BY user_id),
k AS (SELECT *, cast(2000000000 + user_id * 7919 AS varchar) AS phone_number FROM u),
n AS (SELECT phone_number, view, signup, error, click, purchase FROM k),
o AS (SELECT phone_number, o_view AS view, o_signup AS signup, o_error AS error, o_click AS click FROM k)
SELECT DISTINCT n.phone_number, cast(n.view AS varchar) AS view, cast(n.signup AS varchar) AS signup,
       cast(n.error AS varchar) AS error, strftime(n.click, '%Y-%m-%d') AS click,
       cast(n.purchase AS varchar) AS purchase
  FROM n JOIN o USING (phone_number)
 WHERE ({" OR ".join(_sms_cond(r.name, r.kind) for r in _LIVE)})
   AND ({" OR ".join(f"n.{r.name} IS NOT NULL" for r in _LIVE)})
"""


# ------------------------------------------------------------ groups
GROUPS_AS_OF = "2024-01-20 00:00:00"
EARLY_TYPES = ["signup", "purchase"]


def time_buckets(spark: SparkSession, base: str) -> DataFrame:
    """upcoming 7-day / 3-day groups, 3-day x listed types, per-type
    upcoming groups and upper-cased past-by-type groups."""
    ev = Tables(spark, base).events
    as_of = F.lit(GROUPS_AS_OF).cast("timestamp")
    up = F.col("ts") >= as_of
    in7 = up & (F.col("ts") < as_of + F.expr("INTERVAL 7 DAYS"))
    in3 = up & (F.col("ts") < as_of + F.expr("INTERVAL 3 DAYS"))
    names = [(in7, F.lit("next7")), (in3, F.lit("next3")),
             (in3 & F.col("event_type").isin(EARLY_TYPES), F.concat(F.lit("next3_"), F.col("event_type"))),
             (up, F.concat(F.lit("evt_"), F.col("event_type"))),
             (~up, F.concat(F.lit("past_"), F.upper("event_type")))]
    return G.time_buckets(ev, "ts", GROUPS_AS_OF, names).select("event_id", "group_name")


_AO = f"TIMESTAMP '{GROUPS_AS_OF}'"
TIME_BUCKETS_SQL = f"""
SELECT event_id, 'next7' AS group_name FROM events WHERE ts >= {_AO} AND ts < {_AO} + INTERVAL 7 DAY
UNION ALL SELECT event_id, 'next3' FROM events WHERE ts >= {_AO} AND ts < {_AO} + INTERVAL 3 DAY
UNION ALL SELECT event_id, 'next3_' || event_type FROM events
  WHERE ts >= {_AO} AND ts < {_AO} + INTERVAL 3 DAY AND event_type IN ('signup', 'purchase')
UNION ALL SELECT event_id, 'evt_' || event_type FROM events WHERE ts >= {_AO}
UNION ALL SELECT event_id, 'past_' || upper(event_type) FROM events WHERE ts < {_AO}
"""


def group_members(spark: SparkSession, base: str) -> DataFrame:
    """Members per (event-type group, target), ids from the identity match."""
    ev = Tables(spark, base).events
    groups = ev.select("user_id", F.concat(F.lit("evt_"), F.col("event_type")).alias("group_name")).distinct()
    return G.group_members(groups.join(identity_match(spark, base), "user_id"), "group_name", "target", "member_id")


GROUP_MEMBERS_SQL = f"""
WITH ids AS ({IDENTITY_MATCH_SQL})
SELECT DISTINCT 'evt_' || e.event_type AS group_name, ids.target, ids.member_id
  FROM events e JOIN ids USING (user_id)
"""

OLD_BEFORE = "1999-01-01"
NEW_FROM = "1998-01-01"


def _old_new(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    o = Tables(spark, base).orders.select(F.col("o_orderpriority").alias("group_name"),
                                          F.col("o_custkey").alias("member_id"), "o_orderdate")
    return (o.filter(F.col("o_orderdate") < F.lit(OLD_BEFORE).cast("timestamp")),
            o.filter(F.col("o_orderdate") >= F.lit(NEW_FROM).cast("timestamp")))


def membership_delta(spark: SparkSession, base: str) -> DataFrame:
    """Members to add / remove between two snapshots of order groups."""
    old, new = _old_new(spark, base)
    return G.membership_delta(old, new, ["group_name", "member_id"])


MEMBERSHIP_DELTA_SQL = f"""
WITH o AS (SELECT DISTINCT o_orderpriority AS group_name, o_custkey AS member_id FROM orders
             WHERE o_orderdate < TIMESTAMP '{OLD_BEFORE}'),
n AS (SELECT DISTINCT o_orderpriority AS group_name, o_custkey AS member_id FROM orders
        WHERE o_orderdate >= TIMESTAMP '{NEW_FROM}')
SELECT coalesce(o.group_name, n.group_name) AS group_name, coalesce(o.member_id, n.member_id) AS member_id,
       CASE WHEN n.member_id IS NULL THEN 'remove' ELSE 'add' END AS change
  FROM o FULL OUTER JOIN n ON o.group_name = n.group_name AND o.member_id = n.member_id
 WHERE o.member_id IS NULL OR n.member_id IS NULL
"""


def new_groups(spark: SparkSession, base: str) -> DataFrame:
    """Groups (priority x year) not seen in the earlier snapshot."""
    old, new = _old_new(spark, base)

    def name(df):
        return df.select(F.concat(F.lit("prio-"), F.col("group_name"), F.lit("-"),
                                  F.year("o_orderdate").cast("string")).alias("group_name"))
    return G.new_groups(name(new), name(old), "group_name", "orders")


NEW_GROUPS_SQL = f"""
WITH c AS (SELECT DISTINCT 'prio-' || o_orderpriority || '-' || cast(year(o_orderdate) AS varchar) AS group_name
             FROM orders WHERE o_orderdate >= TIMESTAMP '{NEW_FROM}'),
e AS (SELECT DISTINCT 'prio-' || o_orderpriority || '-' || cast(year(o_orderdate) AS varchar) AS group_name
        FROM orders WHERE o_orderdate < TIMESTAMP '{OLD_BEFORE}')
SELECT group_name, 'orders:' || group_name AS group_id FROM c WHERE group_name NOT IN (SELECT group_name FROM e)
"""


# ------------------------------------------------------------ caps / batches / counts
CAP_PER_TYPE = 100
BATCH_SIZE = 100


def cap_per_type(spark: SparkSession, base: str, cap: int = CAP_PER_TYPE) -> DataFrame:
    """W8 (CRM form): at most N accepted exports per type, counting only
    eligible rows. A top-k per group: Catalyst keeps at most N rows per group
    per task before the shuffle (WindowGroupLimit)."""
    c = Tables(spark, base).customer.filter(F.col("c_acctbal") > 0)
    rn = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.col("c_custkey").asc()))
    return (c.withColumn("rank_in_type", rn.cast("long")).filter(F.col("rank_in_type") <= cap)
            .select("c_custkey", "c_mktsegment", "rank_in_type"))


CAP_PER_TYPE_SQL = f"""
SELECT c_custkey, c_mktsegment, rank_in_type FROM (
  SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS rank_in_type
    FROM customer WHERE c_acctbal > 0) WHERE rank_in_type <= {CAP_PER_TYPE}
"""


def batches(spark: SparkSession, base: str) -> DataFrame:
    """SNK6: numbered batches of 100 per segment, in key order, without a
    one-task window per segment."""
    c = Tables(spark, base).customer.select("c_custkey", "c_mktsegment", "c_name")
    return S.batches(c, BATCH_SIZE, ["c_custkey"], ["c_mktsegment"])


BATCHES_SQL = f"""
SELECT c_custkey, c_mktsegment, c_name,
       cast(floor((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) / {BATCH_SIZE}) AS bigint) AS batch
  FROM customer
"""


def counts_by(spark: SparkSession, base: str) -> DataFrame:
    """Rows and rejected rows (negative balance) per segment."""
    c = Tables(spark, base).customer
    return A.counts_by(c, "c_mktsegment", F.col("c_acctbal") < 0)


COUNTS_BY_SQL = """
SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS n_rejected FROM customer GROUP BY 1
"""
