"""Event, donor, time and text jobs bound to the driver tables
(A13, W7, X10, X13-X17, X19, F14, F17, ST4, ST8, AR4, AR7-AR9, X1, X2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions import text as X
from canvass.functions import timefmt as T
from canvass.operators import donors as DN
from canvass.operators import nested as N
from canvass.plans import derive as d
from canvass.sources.tables import Tables

DONOR_SALT = "salt"
BINDING_DEBATE_DAYS = DN.debate_days_for_years(range(1995, 2002))
_DEBATE_SQL = ", ".join(f"'{x}'" for x in BINDING_DEBATE_DAYS)
_ORDER_EMAIL_SQL = "('customer.' || lpad(cast(o_custkey AS varchar), 9, '0') || '@example.com')"


def _donation_events(spark: SparkSession, base: str) -> DataFrame:
    o = Tables(spark, base).orders
    return o.select(
        F.col("o_orderkey").alias("arrival"),
        F.concat(F.lit("customer."), F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
                 F.lit("@example.com")).alias("email"),
        F.col("o_orderdate").alias("paid_at"),
        F.to_date("o_orderdate").alias("paid_day"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_recurring"),
        F.col("o_orderstatus").alias("status"))


def donor_rollup(spark: SparkSession, base: str) -> DataFrame:
    """A13 + W7 + X13-X15: per-donor totals, last donation, badges, id."""
    r = DN.donor_rollup(_donation_events(spark, base), "email", "arrival", "paid_at", "paid_day",
                        "amount", "is_recurring", ["status"], DONOR_SALT, BINDING_DEBATE_DAYS)
    return r.select("email", "donor_id", F.round("total_donation_amount", 2).alias("total_donation_amount"),
                    "last_donation_amount",
                    F.date_format("last_donation_ts", "yyyy-MM-dd HH:mm:ss").alias("last_donation_ts"),
                    "last_donation_dt", "status", F.array_join("badges", ",").alias("badges"), "n_donations")


_DONOR_CTE = f"""
ev AS (SELECT o_orderkey AS arrival, {_ORDER_EMAIL_SQL} AS email, o_orderdate AS paid_at,
              o_totalprice AS amount, o_orderpriority = '1-URGENT' AS is_recurring, o_orderstatus AS status
         FROM orders),
pr AS (SELECT *, max(paid_at) OVER (PARTITION BY email ORDER BY arrival
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM ev),
acc AS (SELECT *, prior IS NULL OR paid_at > prior AS accepted FROM pr)"""

DONOR_ROLLUP_SQL = f"""
WITH {_DONOR_CTE},
ok AS (SELECT * FROM acc WHERE accepted AND email IS NOT NULL AND email <> ''),
b AS (
  SELECT email, 'eom' AS badge FROM ok WHERE day(paid_at) >= 26 AND month(paid_at) % 3 <> 0
  UNION SELECT email, 'eoq' FROM ok WHERE day(paid_at) >= 26 AND month(paid_at) % 3 = 0
  UNION SELECT email, 'debate' FROM ok WHERE strftime(paid_at, '%Y-%m-%d') IN ({_DEBATE_SQL})
  UNION SELECT email, 'recurring' FROM ok WHERE is_recurring),
bs AS (SELECT email, string_agg(badge, ',' ORDER BY badge) AS badges FROM b GROUP BY email),
g AS (SELECT email, round(sum(amount), 2) AS total_donation_amount, arg_max(amount, arrival) AS last_donation_amount,
             arg_max(paid_at, arrival) AS last_ts, arg_max(status, arrival) AS status, count(*) AS n_donations
        FROM ok GROUP BY email)
SELECT g.email, substring(translate(base64(from_hex(md5('{DONOR_SALT}' || g.email))), '+/', '-_'), 1, 12) AS donor_id,
       g.total_donation_amount, g.last_donation_amount,
       strftime(g.last_ts, '%Y-%m-%d %H:%M:%S') AS last_donation_ts,
       strftime(timezone('America/New_York', timezone('UTC', g.last_ts)), '%Y-%m-%d') AS last_donation_dt,
       g.status, coalesce(bs.badges, '') AS badges, g.n_donations
  FROM g LEFT JOIN bs USING (email)
"""


def drop_stale(spark: SparkSession, base: str) -> DataFrame:
    """W7 on its own: every donation event with its accepted flag."""
    r = DN.drop_stale(_donation_events(spark, base), "email", "arrival", "paid_at")
    return r.select("arrival", "email", "accepted")


DROP_STALE_SQL = f"WITH {_DONOR_CTE} SELECT arrival, email, accepted FROM acc"


# ------------------------------------------------------------------ time gates
AS_OF = "2024-01-31 12:00:00"
RECENT_DAYS = 7
LAG_THRESHOLD_SECONDS = 300
LAG_SECONDS_PER_VALUE = 10


def recent_nyc(spark: SparkSession, base: str) -> DataFrame:
    """events within 7 New York calendar days of ``AS_OF``."""
    ev = Tables(spark, base).events
    return ev.filter(T.recent("ts", AS_OF, RECENT_DAYS)).select(
        "event_id", F.date_format(T.local_date("ts"), "yyyy-MM-dd").alias("ny_day"))


_NY = "timezone('America/New_York', timezone('UTC', {x}))"
RECENT_NYC_SQL = f"""
SELECT event_id, strftime(cast({_NY.format(x='ts')} AS date), '%Y-%m-%d') AS ny_day FROM events
 WHERE date_diff('day', cast({_NY.format(x='ts')} AS date),
                 cast({_NY.format(x=f"TIMESTAMP '{AS_OF}'")} AS date)) <= {RECENT_DAYS}
"""


def send_hours(spark: SparkSession, base: str) -> DataFrame:
    """both sending-hour gates per event."""
    ev = Tables(spark, base).events
    return ev.select("event_id", T.batch_send_ok("ts").alias("batch_ok"), T.event_send_ok("ts").alias("event_ok"))


SEND_HOURS_SQL = """
SELECT event_id, hour(ts) >= 15 AS batch_ok, hour(ts) >= 13 OR hour(ts) < 1 AS event_ok FROM events
"""


def _received(ev: DataFrame) -> DataFrame:
    recv = F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("value") * (LAG_SECONDS_PER_VALUE * 1e6)).cast("long"))
    return ev.withColumn("received", recv)


def lag_gate(spark: SparkSession, base: str) -> DataFrame:
    """ST4 + X19: lag between payment (ts) and receipt; with more than 300 s
    of lag, send only inside the event sending hours (of the receipt)."""
    ev = _received(Tables(spark, base).events)
    lag = T.lag_seconds("ts", "received")
    send = (lag <= LAG_THRESHOLD_SECONDS) | T.event_send_ok("received")
    return ev.select("event_id", lag.alias("lag_seconds"), send.alias("send"))


_RECV_SQL = f"make_timestamp(epoch_us(ts) + cast(round(value * {LAG_SECONDS_PER_VALUE * 1e6}) AS bigint))"
LAG_GATE_SQL = f"""
WITH e AS (SELECT event_id, ts, {_RECV_SQL} AS received FROM events)
SELECT event_id, date_diff('second', ts, received) AS lag_seconds,
       date_diff('second', ts, received) <= {LAG_THRESHOLD_SECONDS} OR hour(received) >= 13 OR hour(received) < 1 AS send
  FROM e
"""

ZONES = ["America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles"]


def local_time(spark: SparkSession, base: str) -> DataFrame:
    """Event start shown in the event's own zone."""
    ev = Tables(spark, base).events
    tz = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("user_id") % len(ZONES) + 1).cast("int"))
    return ev.select("event_id", tz.alias("tz"),
                     T.local_event_time(F.unix_seconds("ts"), tz).alias("local_time"))


LOCAL_TIME_SQL = f"""
WITH e AS (SELECT event_id, ts, ({ZONES!r})[user_id % {len(ZONES)} + 1] AS tz FROM events)
SELECT event_id, tz, strftime(timezone(tz, timezone('UTC', ts)), '%a, %b %-d at %-I:%M %p') AS local_time FROM e
"""


# ------------------------------------------------------------------ key/value
def latest_kv(spark: SparkSession, base: str) -> DataFrame:
    """ST8 (batch): keyed upsert, last write wins; creation time kept."""
    ev = Tables(spark, base).events
    r = N.latest_kv(ev.select(F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"),
                              F.col("event_id").alias("arrival"), "ts"), "key", "value", "arrival", "ts")
    return r.select("key", "value", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"),
                    F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"))


LATEST_KV_SQL = """
SELECT cast(user_id AS varchar) AS key, arg_max(props, event_id) AS value,
       strftime(arg_min(ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS created_at,
       strftime(arg_max(ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS updated_at
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id
"""


# ------------------------------------------------------------------ text / nested
def extract_contacts(spark: SparkSession, base: str) -> DataFrame:
    """X1 + X2 over whole document texts."""
    docs = Tables(spark, base).documents
    return docs.select("doc_id", C.extract_phone("text").alias("phone"),
                       C.extract_postal_code("text").alias("postal_code"))


_P = C.PHONE_IN_TEXT.replace("'", "''")
EXTRACT_CONTACTS_SQL = f"""
SELECT doc_id,
       CASE WHEN regexp_extract(text, '{_P}', 3) <> ''
            THEN '1' || regexp_extract(text, '{_P}', 3) || regexp_extract(text, '{_P}', 4)
                     || regexp_extract(text, '{_P}', 5) END AS phone,
       nullif(regexp_extract(text, '{C.FIVE_DIGITS}', 0), '') AS postal_code
  FROM documents
"""


def inbound_text(spark: SparkSession, base: str) -> DataFrame:
    """AR7: inbound (customer) messages per conversation."""
    cv = Tables(spark, base).conversations
    return N.inbound_text(cv, "conv_id", "turn", "role", "text", inbound_role="user")


INBOUND_TEXT_SQL = "SELECT conv_id, turn AS thread_id, text FROM conversations WHERE role = 'user'"

REQUIRED_PROPS = ["k", "j"]


def json_props(spark: SparkSession, base: str) -> DataFrame:
    """AR4 + AR9: nested get with default (falsy -> -1) and the missing fields."""
    ev = Tables(spark, base).events
    parsed = ev.select("event_id", F.from_json("props", "k int, j int").alias("p"))
    return parsed.select("event_id", N.get_or_default(F.col("p.k"), F.lit(-1)).alias("k"),
                         F.array_join(N.missing_fields(F.col("p"), REQUIRED_PROPS), ",").alias("missing"))


JSON_PROPS_SQL = """
WITH p AS (SELECT event_id, try_cast(props->>'k' AS integer) AS k, try_cast(props->>'j' AS integer) AS j FROM events)
SELECT event_id, CASE WHEN k IS NULL OR k = 0 THEN -1 ELSE k END AS k,
       concat_ws(',', CASE WHEN k IS NULL THEN 'k' END, CASE WHEN j IS NULL THEN 'j' END) AS missing
  FROM p
"""

UTM_SOURCE = "sms list/2019"


def utm_links(spark: SparkSession, base: str) -> DataFrame:
    """Add ``?utm_source=`` unless the URL already has a query."""
    pages = Tables(spark, base).pages
    return pages.select("page_id", X.add_utm_source(F.col("url"), UTM_SOURCE).alias("url"))


UTM_LINKS_SQL = f"""
SELECT page_id, CASE WHEN url LIKE '%?%' THEN url
                     ELSE url || '?utm_source=' || replace(url_encode('{UTM_SOURCE}'), '%2F', '/') END AS url
  FROM pages
"""

REFCODE = "email-v1"
SHIFT_TIMES = ["5:00pm", "6:00pm", "7:30pm"]


def invite_buttons(spark: SparkSession, base: str) -> DataFrame:
    """AR8: per site, '|'-lists of shift URLs and start labels zipped by
    position; 6:00pm shifts skipped; Sunday colour; link numbered by the
    original 1-based position."""
    s = d.supplier_sites(Tables(spark, base).supplier)
    urls = F.concat_ws("|", *[F.concat(F.lit("https://example.org/t/"), F.col("s_suppkey").cast("string"),
                                       F.lit(f"/{i}?x=1")) for i in range(3)])
    times = F.array(*[F.lit(t) for t in SHIFT_TIMES])
    labels = F.concat_ws("|", *[F.concat(F.date_format(F.date_add("start_date", i), "EEEE"), F.lit(" "),
                                         F.element_at(times, ((F.col("s_suppkey") + i) % 3 + 1).cast("int")))
                                for i in range(3)])
    rows = s.select("s_suppkey", urls.alias("urls"), labels.alias("labels"))
    r = N.render_invites(rows, "urls", "labels", REFCODE)
    return r.select("s_suppkey", "shift_index", "start_time", "button_color", "link")


INVITE_BUTTONS_SQL = f"""
WITH s AS (SELECT s_suppkey, {d.SITE_START_SQL} AS start_date FROM supplier),
x AS (SELECT s_suppkey, i,
             'https://example.org/t/' || s_suppkey || '/' || (i - 1) || '?x=1' AS url,
             strftime(start_date + (i - 1), '%A') || ' ' || ({SHIFT_TIMES!r})[(s_suppkey + i - 1) % 3 + 1] AS start_time
        FROM s, (SELECT unnest([1, 2, 3]) AS i))
SELECT s_suppkey, i AS shift_index, start_time,
       CASE WHEN start_time LIKE '%Sunday%' THEN '#B7E4CF' ELSE '#232444' END AS button_color,
       url || '&utm_source={REFCODE}-bt' || i AS link
  FROM x WHERE start_time NOT LIKE '%6:00pm%'
"""


def debt_relief(spark: SparkSession, base: str) -> DataFrame:
    """Relief by income (order total), capped by debt (10x |balance|)."""
    t = Tables(spark, base)
    x = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("o_totalprice").alias("income"), (F.abs("c_acctbal") * 10).alias("debt"))
    r = X.debt_relief(F.col("income"), F.col("debt"))
    return x.select("o_orderkey", r["relief"].alias("relief"), F.round(r["cancelled"], 2).alias("cancelled"),
                    r["remaining"].alias("remaining"))


DEBT_RELIEF_SQL = """
WITH x AS (SELECT o_orderkey, o_totalprice AS income, abs(c_acctbal) * 10 AS debt
             FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT *, CASE WHEN income >= 250000 THEN 0 WHEN income <= 100000 THEN 50000
                     ELSE cast(round_even(50000 - (income - 100000) / 3, 0) AS bigint) END AS relief FROM x)
SELECT o_orderkey, relief, round(least(relief, debt), 2) AS cancelled,
       cast(round_even(greatest(debt - least(relief, debt), 0), 0) AS bigint) AS remaining
  FROM r
"""


# ------------------------------------------------------------------ result report
def report_brands(n: int = 13) -> list[str]:
    """Binding's main-candidate list: the first ``n`` brands by name (rule-built)."""
    return sorted(f"Brand#{a}{b}" for a in range(1, 6) for b in range(1, 6))[:n]


def order_results(spark: SparkSession, base: str) -> DataFrame:
    """Orders as result events: one result per line (brand, quantity, line
    number, tie partner, won when returned). Lines per order are few, so the
    per-order array is small; it is sorted to make the input order stable."""
    t = Tables(spark, base)
    li = t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    entry = F.struct(F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"),
                     F.col("l_extendedprice").alias("px"),
                     F.struct(F.col("p_brand").alias("name"), F.col("l_quantity").cast("long").alias("caucusers"),
                              F.col("l_linenumber").cast("long").alias("delegates"),
                              F.array(F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 5 + 1).cast("string"),
                                               F.lit("1"))).alias("ties"),
                              F.when(F.col("l_returnflag") == "R", F.lit("won")).alias("tieStatus")).alias("r"))
    per_order = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(entry)).alias("_rs"))
    o = t.orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("precinct_id"),
        d.customer_phone(F.col("o_custkey")).alias("phone_number"),
        F.when(F.col("o_orderstatus") == "F", "alignment").when(F.col("o_orderstatus") == "O", "realignment")
         .otherwise("final").alias("event_type"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderpriority").alias("notes"),
        F.lit(None).cast("string").alias("media_url"),
        F.when(F.col("o_orderstatus") != "P", F.size(F.coalesce("_rs", F.array()))).alias("attendee_count"),
        F.transform("_rs", lambda x: x["r"]).alias("results"))


def result_report(spark: SparkSession, base: str) -> DataFrame:
    """AR1 + O2 + O3 + X11 over orders; one 59-cell row per order."""
    from canvass.operators.report import result_report as rr
    r = rr(order_results(spark, base), main=report_brands())
    return r.select("id", *[F.col("cells")[i].alias(f"c{i + 1:02d}") for i in range(59)])


# ------------------------------------------------------------------ dialogue
# State codes used to build the scripted conversations (a rule over the list
# of codes, not data from the reference).
_SCRIPT_STATES = sorted(set(C.STATE_TO_CODE.values()))


def customer_dialogues(spark: SparkSession, base: str) -> DataFrame:
    """One scripted referral conversation per customer, derived from its row:
    keyword, reason, own name, zip, friend's name, friend's phone (another
    customer's), friend's city and state. Every fifth customer answers the
    zip question with no digits, so that flow stalls without a referral."""
    c = Tables(spark, base).customer
    k = F.col("c_custkey")
    codes = F.array(*[F.lit(x) for x in _SCRIPT_STATES])
    zip_text = F.when(k % 5 == 0, F.lit("no idea")).otherwise(F.lpad(((k * 37) % 99999).cast("string"), 5, "0"))
    msgs = F.array(
        F.lit(""),
        F.concat(F.lit("Because "), F.lower("c_mktsegment"), F.lit(" matters to me")),
        F.concat(F.lit("Pat Doe"), k.cast("string")),
        zip_text,
        F.concat(F.lit("Sam Friend"), (k % 7).cast("string")),
        F.concat(F.lit("call "), d.customer_phone(k + 1)),
        F.concat(F.lit("Springfield "), F.element_at(codes, (k % len(_SCRIPT_STATES) + 1).cast("int"))))
    return c.select(k.alias("conv_id"), F.posexplode(msgs).alias("turn", "text")).withColumn(
        "turn", F.col("turn").cast("long"))


def referrals(spark: SparkSession, base: str) -> DataFrame:
    """ST7 + ST9: scripted customer conversations through the dialogue, then
    referral records (get-or-create on referee phone x referrer)."""
    from canvass.operators.dialogue import dialogue_replay as replay
    from canvass.operators.dialogue import referrals as refs
    # half of the senders have an e-mail in their profile
    known = Tables(spark, base).customer.where(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").alias("conv_id"), d.customer_email().alias("email"))
    return refs(replay(customer_dialogues(spark, base), "conv_id", "turn", "text", known))


# The script's expected outcome, stated independently of the state machine:
# a customer ends with one referral when the zip answer has digits and the
# friend's number is a valid NANP number (exchange starts with 2-9).
REFERRALS_SQL = f"""
SELECT c_custkey AS referrer,
       '1' || cast(2000000000 + (c_custkey + 1) * 7919 AS varchar) AS referee_phone,
       'Sam Friend' || cast(c_custkey % 7 AS varchar) AS referee_full, 'Sam' AS referee_first,
       'Friend' || cast(c_custkey % 7 AS varchar) AS referee_last, 'Springfield' AS referee_city,
       ({_SCRIPT_STATES!r})[c_custkey % {len(_SCRIPT_STATES)} + 1] AS referee_state,
       'Pat Doe' || cast(c_custkey AS varchar) AS referrer_full, 'Pat' AS referrer_first,
       'Doe' || cast(c_custkey AS varchar) AS referrer_last,
       CASE WHEN c_custkey % 2 = 0 THEN {d.CUSTOMER_EMAIL_SQL} END AS referrer_email,
       lpad(cast((c_custkey * 37) % 99999 AS varchar), 5, '0') AS referrer_postal_code,
       cast(6 AS bigint) AS first_turn, cast(6 AS bigint) AS last_turn
  FROM customer
 WHERE c_custkey % 5 <> 0
   AND regexp_full_match(cast(2000000000 + (c_custkey + 1) * 7919 AS varchar), '[2-9][0-9]{{2}}[2-9][0-9]{{6}}')
"""


def _report_sql() -> str:
    mains = report_brands()
    mains_sql = "[" + ", ".join(f"'{m}'" for m in mains) + "]"
    cells = [
        "id", "precinct_id", "phone_number", "event_type",
        "strftime(timezone('America/Chicago', timezone('UTC', created_at)), '%m/%d/%Y %H:%M:%S')",
        "notes", "NULL", "coalesce(attendee_count, 0)"]
    for m in mains:
        hit = f"list_filter(rs, lambda x: x.name = '{m}')[-1]"
        for f in ("caucusers", "delegates"):
            cells.append(f"CASE WHEN {hit} IS NOT NULL THEN {hit}.{f} "
                         f"WHEN event_type IN ('alignment', 'realignment') THEN 0 END")
    for k in range(1, 6):
        cells += [f"top[{k}].name", f"top[{k}].c", f"top[{k}].d"]
    cells += [
        "CASE WHEN len(over) > 0 THEN array_to_string(list_transform(over, lambda x: "
        "x.name || ': ' || cast(x.c AS varchar) || ' -> ' || cast(x.d AS varchar)), '; ') END",
        "CASE WHEN len(over) > 0 THEN list_sum(list_transform(over, lambda x: x.c)) END",
        "CASE WHEN len(over) > 0 THEN list_sum(list_transform(over, lambda x: x.d)) END"]
    for k in range(1, 4):
        cells += [f"ties[{k}].k", f"ties[{k}].v"]
    cells.append("CASE WHEN len(ties) > 3 THEN array_to_string(list_transform(list_slice(ties, 4, len(ties)), "
                 "lambda t: t.k || ': ' || t.v), '; ') END")
    select = ",\n       ".join(f"coalesce(cast({c} AS varchar), '') AS c{i + 1:02d}" for i, c in enumerate(cells))
    return f"""
WITH li AS (
  SELECT l.l_orderkey, l.l_linenumber AS ln, l.l_partkey AS pk, l.l_extendedprice AS px,
         {{'name': p.p_brand, 'caucusers': cast(l.l_quantity AS bigint),
          'delegates': cast(l.l_linenumber AS bigint),
          'ties': ['Brand#' || cast(l.l_suppkey % 5 + 1 AS varchar) || '1'],
          'tieStatus': CASE WHEN l.l_returnflag = 'R' THEN 'won' END}} AS r
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
per AS (SELECT l_orderkey, list(r ORDER BY ln, pk, px) AS rs FROM li GROUP BY l_orderkey),
ev AS (
  SELECT cast(o.o_orderkey AS varchar) AS id, cast(o.o_custkey AS varchar) AS precinct_id,
         cast(2000000000 + o.o_custkey * 7919 AS varchar) AS phone_number,
         CASE o.o_orderstatus WHEN 'F' THEN 'alignment' WHEN 'O' THEN 'realignment' ELSE 'final' END AS event_type,
         o.o_orderdate AS created_at, o.o_orderpriority AS notes,
         CASE WHEN o.o_orderstatus <> 'P' THEN coalesce(len(per.rs), 0) END AS attendee_count, per.rs
    FROM orders o LEFT JOIN per ON per.l_orderkey = o.o_orderkey),
w AS (
  SELECT ev.*,
         list_filter(list_transform(rs, lambda x, i: {{'name': x.name, 'c': x.caucusers, 'd': x.delegates, 'i': i}}),
                     lambda x: NOT list_contains({mains_sql}, x.name)) AS wi,
         list_transform(list_filter(rs, lambda x: x.tieStatus = 'won'),
                        lambda x: {{'k': array_to_string(list_sort(list_concat([x.name], x.ties)), ' '),
                                   'n': x.name}}) AS keyed
    FROM ev),
r AS (
  SELECT w.*,
         list_transform(list_sort(list_transform(wi, lambda x: {{'nc': -x.c, 'i': x.i, 'name': x.name,
                                                                 'c': x.c, 'd': x.d}})),
                        lambda x, j: {{'name': x.name, 'c': x.c, 'd': x.d, 'j': j}}) AS ranked
    FROM w),
t AS (
  SELECT r.*,
         list_sort(list_transform(list_slice(ranked, 1, 5), lambda x: {{'name': x.name, 'j': x.j,
                                                                       'c': x.c, 'd': x.d}})) AS top,
         list_slice(ranked, 6, 1000000) AS over,
         list_sort(list_transform(list_distinct(list_transform(keyed, lambda x: x.k)),
                   lambda k: {{'k': k, 'v': array_to_string(list_sort(list_distinct(list_transform(
                       list_filter(keyed, lambda y: y.k = k), lambda y: y.n))), ' ')}})) AS ties
    FROM r)
SELECT id,
       {select}
  FROM t
"""


RESULT_REPORT_SQL = _report_sql()
