"""Small jobs, one per operator that no larger job reaches, each with its SQL twin.

Writers write under the shared checkpoint folder and the job returns what is
read back, so source and sink are checked together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.functions import contacts as C
from canvass.functions import filters as FL
from canvass.functions import geo
from canvass.operators import groups as G
from canvass.operators import joins as J
from canvass.operators import nested as N
from canvass.operators import phases as P
from canvass.operators import report as R
from canvass.operators import suppression as SU
from canvass.plans import derive as d
from canvass.plans.stream_jobs import scratch_folder
from canvass.sources import files as SF
from canvass.sources import sinks as SK
from canvass.sources.stored import StoredTable
from canvass.sources.tables import Tables
from canvass.streaming import donations as SD


# ------------------------------------------------------------ payloads
def _typed_fields(spark: SparkSession, base: str) -> DataFrame:
    k = F.col("c_custkey")
    return Tables(spark, base).customer.select(
        "c_custkey", F.when(k % 3 == 0, F.col("c_mktsegment")).when(k % 3 == 1, F.lit("0")).otherwise(F.lit("")).alias("seg"),
        (k % 4).cast("double").alias("gifts"), F.when(k % 5 != 0, (k % 7).cast("double") / 2).alias("half"),
        F.when(k % 6 < 3, F.element_at(F.array(F.lit("Yes"), F.lit("No"), F.lit("1")), (k % 3 + 1).cast("int"))).alias("sms"))


def field_xml(spark: SparkSession, base: str) -> DataFrame:
    """SNK8: the values of each record's update XML, in field order; '-' where the field is cleared."""
    x = _typed_fields(spark, base).select("c_custkey", SK.field_xml(F.col("c_custkey"), ["seg", "gifts", "half", "sms"], {
        "seg": 1, "gifts": 2, "half": 3, "sms": 4}).alias("xml"))
    parts = F.slice(F.split("xml", "<cons_field "), 2, 4)
    return x.select("c_custkey", F.array_join(F.transform(parts, lambda p: F.when(
        p.contains("<value>"), F.regexp_extract(p, "<value>([^<]*)</value>", 1)).otherwise(F.lit("-"))), ",").alias("field_values"))


_TYPED_SQL = """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN '0' ELSE '' END AS seg,
       cast(c_custkey % 4 AS double) AS gifts, CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 7) / 2.0 END AS half,
       CASE WHEN c_custkey % 6 < 3 THEN (['Yes', 'No', '1'])[c_custkey % 3 + 1] END AS sms
  FROM customer"""

FIELD_XML_SQL = f"""
WITH t AS ({_TYPED_SQL})
SELECT c_custkey, CASE WHEN seg = '' THEN '-' ELSE seg END || ',' ||
       CASE WHEN gifts = 0 THEN '-' ELSE cast(cast(gifts AS bigint) AS varchar) END || ',' ||
       CASE WHEN half IS NULL OR half = 0 THEN '-' WHEN half = floor(half) THEN cast(cast(half AS bigint) AS varchar)
            ELSE cast(half AS varchar) END || ',' || coalesce(sms, '-') AS field_values
  FROM t
"""


def profile_payload(spark: SparkSession, base: str) -> DataFrame:
    """SNK9: SMS profile JSON per customer."""
    return _typed_fields(spark, base).select("c_custkey", SK.profile_payload(
        d.customer_phone(), ["seg", "gifts", "sms"], ["gifts"], ["sms"]).alias("payload"))


PROFILE_PAYLOAD_SQL = f"""
WITH t AS ({_TYPED_SQL})
SELECT c_custkey, '{{"phone_number":"1' || cast(2000000000 + c_custkey * 7919 AS varchar) || '"' ||
       CASE WHEN seg <> '' THEN ',"seg":"' || seg || '"' ELSE '' END ||
       ',"gifts":' || cast(cast(gifts AS bigint) AS varchar) ||
       CASE WHEN sms IS NULL THEN '' ELSE ',"sms":"' || CASE sms WHEN '1' THEN 'Yes' ELSE sms END || '"' END || '}}' AS payload
  FROM t
"""


def nested_default(spark: SparkSession, base: str) -> DataFrame:
    """AR4: defaults for null, '', 0 and false, but not for the texts '0' and 'false'."""
    t = _typed_fields(spark, base).withColumn("flag", F.col("c_custkey") % 2 == 0)
    return t.select("c_custkey", N.get_or_default(F.col("seg"), F.lit("none")).alias("seg"),
                    N.get_or_default(F.col("gifts"), F.lit(-1.0)).alias("gifts"),
                    N.get_or_default(F.col("half"), F.lit(-1.0)).alias("half"),
                    N.get_or_default(F.col("flag").cast("string"), F.lit("x")).alias("flag_text"))


NESTED_DEFAULT_SQL = f"""
WITH t AS ({_TYPED_SQL})
SELECT c_custkey, CASE WHEN seg = '' THEN 'none' ELSE seg END AS seg, CASE WHEN gifts = 0 THEN -1 ELSE gifts END AS gifts,
       CASE WHEN half IS NULL OR half = 0 THEN -1 ELSE half END AS half,
       CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS flag_text
  FROM t
"""


def constituent_record(spark: SparkSession, base: str) -> DataFrame:
    """SNK7: record XML with empty fields left out, flags, group ids and source."""
    t = _typed_fields(spark, base)
    xml = t.select("c_custkey", SK.constituent_xml(t, ["seg", "sms"], [7, 9], "feed", {"is_active": "1"}).alias("xml"))
    return xml.select("c_custkey", F.nullif(F.regexp_extract("xml", "<seg>([^<]*)</seg>", 1), F.lit("")).alias("seg"),
                      F.nullif(F.regexp_extract("xml", "<sms>([^<]*)</sms>", 1), F.lit("")).alias("sms"),
                      F.array_join(F.regexp_extract_all("xml", F.lit('<cons_group id="([0-9]+)"'), 1), ",").alias("group_ids"),
                      F.regexp_extract("xml", "<source>([^<]*)</source>", 1).alias("source"))


CONSTITUENT_RECORD_SQL = f"""
WITH t AS ({_TYPED_SQL})
SELECT c_custkey, nullif(seg, '') AS seg, sms, '7,9' AS group_ids, 'feed' AS source FROM t
"""


def merge_row(spark: SparkSession, base: str) -> DataFrame:
    """SNK10: bulk mail-merge requests over all customers, fifty recipients each, with default values; and the
    URL-quoted form of the batch number."""
    c = Tables(spark, base).customer.select("c_custkey", "c_mktsegment", d.customer_email().alias("address"))
    made = SK.merge_requests(c, "address", ["c_custkey", "c_mktsegment"], ["c_custkey"], {"c_mktsegment": "none"})
    return made.select("batch", "n", "request", SK.triggered_form(["batch"]).alias("form"))


MERGE_ROW_SQL = f"""
WITH c AS (SELECT c_custkey, c_mktsegment, {d.CUSTOMER_EMAIL_SQL} AS e, (row_number() OVER (ORDER BY c_custkey) - 1) // 50 AS batch FROM customer),
r AS (SELECT batch, c_custkey, '{{"Destination":{{"ToAddresses":["' || e || '"]}},"ReplacementTemplateData":"{{\\"email\\":\\"' || e ||
             '\\",\\"c_custkey\\":' || c_custkey || ',\\"c_mktsegment\\":\\"' || c_mktsegment || '\\"}}"}}' AS d FROM c)
SELECT cast(batch AS bigint) AS batch, count(*) AS n,
       '{{"Destinations":[' || string_agg(d, ',' ORDER BY c_custkey) || '],"DefaultTemplateData":"{{\\"c_mktsegment\\":\\"none\\"}}"}}' AS request,
       '%7B%22batch%22%3A' || cast(batch AS bigint) || '%7D' AS form
  FROM r GROUP BY batch
"""


# ------------------------------------------------------------ files
def written_and_read(spark: SparkSession, base: str) -> DataFrame:
    """SNK2, SNK3, SNK5, SNK11: log appended twice, table replaced twice, CSV and snapshot; rows read back."""
    root = scratch_folder(spark, "sinks")
    c = Tables(spark, base).customer.select("c_custkey", "c_mktsegment")
    even = c.where("c_custkey % 2 = 0")
    SK.append_log(c, f"{root}/log")
    SK.append_log(even, f"{root}/log")
    SK.replace_table(c, f"{root}/table")
    SK.replace_table(even, f"{root}/table")
    SK.replace_table(even.where("false"), f"{root}/table")        # an empty frame replaces nothing
    SK.replace_table(c, f"{root}/table", dry_run=True)
    SK.write_csv(c, f"{root}/csv", ["c_mktsegment", "c_custkey"])
    day = SK.snapshot(even, f"{root}/snap", "2024-02-03")
    kinds = {"log": spark.read.parquet(f"{root}/log"), "table": spark.read.parquet(f"{root}/table"),
             "dry_run": spark.read.parquet(f"{root}/table_dry_run"), "snapshot": spark.read.parquet(day),
             "csv": spark.read.option("header", True).schema("c_mktsegment string, c_custkey long").csv(f"{root}/csv")}
    out = None
    for kind, df in kinds.items():
        rows = df.select(F.lit(kind).alias("kind"), "c_mktsegment", "c_custkey")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("kind", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("key_sum"))


WRITTEN_AND_READ_SQL = """
WITH r AS (
  SELECT 'log' AS kind, * FROM customer UNION ALL SELECT 'log', * FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT 'table', * FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'dry_run', * FROM customer
  UNION ALL SELECT 'snapshot', * FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'csv', * FROM customer)
SELECT kind, c_mktsegment, count(*) AS n, cast(sum(c_custkey) AS bigint) AS key_sum FROM r GROUP BY 1, 2
"""


def sheets_and_tags(spark: SparkSession, base: str) -> DataFrame:
    """SRC4 + SRC5: tag CSV and a folder of sheets with two header rows, written from events and read back."""
    root = scratch_folder(spark, "sheets")
    ev = Tables(spark, base).events
    tags = ev.select(F.col("event_id").cast("string").alias("conversation_id"), F.concat(
        F.col("event_type"), F.lit("||"), F.when(F.col("event_id") % 2 == 0, F.lit("even")).otherwise(F.lit(""))).alias("tags"))
    tags.write.option("header", True).csv(f"{root}/tags")
    # each sheet: a line of names, a line of labels, the rows
    sheet = ev.select((F.col("event_id") % 3).alias("part"), F.concat_ws(",", "event_id", "event_type").alias("value"), F.lit(2).alias("o"))
    heads = spark.range(3).select(F.col("id").alias("part"), F.explode(F.array(
        F.struct(F.lit("id,kind").alias("value"), F.lit(0).alias("o")), F.struct(F.lit("The id,Its kind").alias("value"), F.lit(1).alias("o")))).alias("h"))
    rows = sheet.unionByName(heads.select("part", "h.value", "h.o"))
    rows.repartition(3, "part").sortWithinPartitions("part", "o").select("part", "value").write.partitionBy("part").text(f"{root}/sheets")
    read = SF.read_sheet(spark, f"{root}/sheets/*", ["kind", "id", "absent"], header_rows=2)
    return (SF.read_tags(spark, f"{root}/tags").select(F.lit("tag").alias("source"), F.col("conversation_id").alias("id"), F.col("tag").alias("value"))
            .unionByName(read.select(F.lit("sheet").alias("source"), F.col("id").cast("string").alias("id"), F.col("kind").alias("value"))))


SHEETS_AND_TAGS_SQL = """
WITH e AS (SELECT * FROM events)
SELECT 'tag' AS source, cast(event_id AS varchar) AS id, event_type AS value FROM e
UNION ALL SELECT 'tag', cast(event_id AS varchar), 'even' FROM e WHERE event_id % 2 = 0
UNION ALL SELECT 'sheet', cast(event_id AS varchar), event_type FROM e
"""


def upserted(spark: SparkSession, base: str) -> DataFrame:
    """SNK4: stored rows replaced by key, new ones added."""
    c = Tables(spark, base).customer
    stored = c.select("c_custkey", F.col("c_acctbal").cast("double").alias("balance"))
    # every customer in debt comes again: some under the same key, some under a new one
    fresh = c.where("c_acctbal < 0").select(
        F.when(F.col("c_nationkey") < 12, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("c_custkey"), F.lit(1.0).alias("balance"))
    return G.upsert(stored, fresh, ["c_custkey"])


UPSERTED_SQL = """
SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_nationkey < 12 THEN 1.0 ELSE cast(c_acctbal AS double) END AS balance FROM customer
UNION ALL SELECT -c_custkey, 1.0 FROM customer WHERE c_acctbal < 0 AND c_nationkey >= 12
"""


def stored_tables(spark: SparkSession, base: str) -> DataFrame:
    """SNK3 + SNK4 on a stored table: replaced by the orders, an empty frame ignored, corrections of open orders and
    new keys upserted by bucket; rows read back, summed by status."""
    t = Tables(spark, base)
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("price"))
    table = StoredTable(spark, scratch_folder(spark, "stored") + "/orders", ("o_orderkey",))
    table.replace(rows)
    table.replace(rows.where("false"))
    fixed = rows.where("o_orderstatus = 'O'").select(
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).otherwise(-F.col("o_orderkey")).alias("o_orderkey"),
        F.lit("fixed").alias("o_orderstatus"), F.lit(1.0).alias("price"))
    table.upsert(fixed)
    return table.read().groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("key_sum"), F.max("price").alias("top_price"))


STORED_TABLES_SQL = """
WITH r AS (
  SELECT o_orderkey AS k, o_orderstatus, cast(o_totalprice AS double) AS price FROM orders
   WHERE o_orderstatus <> 'O' OR o_orderkey % 2 <> 0
  UNION ALL SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -o_orderkey END, 'fixed', 1.0 FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderstatus, count(*) AS n, cast(sum(k) AS bigint) AS key_sum, max(price) AS top_price FROM r GROUP BY 1
"""


# ------------------------------------------------------------ phases
def asof_large(spark: SparkSession, base: str) -> DataFrame:
    """J13 by the scan for long boundary lists: latest ship day of another order before each order day."""
    t = Tables(spark, base)
    keys = t.orders.select(F.to_date("o_orderdate").alias("day"))
    bounds = t.events.select(F.date_sub(F.to_date("ts"), (F.col("event_id") % 9000).cast("int")).alias("boundary"))
    return P.asof_bound(keys, "day", bounds, "boundary", "bound", bounds_small=False)


ASOF_LARGE_SQL = """
WITH k AS (SELECT DISTINCT cast(o_orderdate AS date) AS day FROM orders),
b AS (SELECT DISTINCT cast(ts AS date) - cast(event_id % 9000 AS integer) AS boundary FROM events)
SELECT k.day, b.boundary AS bound FROM k ASOF LEFT JOIN b ON k.day >= b.boundary
"""


def sites_in_phase(spark: SparkSession, base: str) -> DataFrame:
    """Sites in phases that overlap."""
    t = Tables(spark, base)
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("n_nationkey") * 71).cast("int"))
    phases = t.nation.select(start.alias("timeframe_start"), F.date_add(start, (F.col("n_nationkey") % 5 * 60).cast("int")).alias("timeframe_end"))
    return P.sites_by_phase(d.supplier_sites(t.supplier), phases).select("s_suppkey", "start_date", "timeframe_start", "timeframe_end")


SITES_IN_PHASE_SQL = f"""
WITH p AS (SELECT date '1995-01-01' + cast(n_nationkey * 71 AS integer) AS a,
                  date '1995-01-01' + cast(n_nationkey * 71 + n_nationkey % 5 * 60 AS integer) AS b FROM nation),
s AS (SELECT s_suppkey, {d.SITE_START_SQL} AS start_date, {d.SITE_END_SQL} AS end_date FROM supplier)
SELECT s_suppkey, start_date, a AS timeframe_start, b AS timeframe_end FROM s JOIN p
    ON start_date BETWEEN a AND b AND end_date >= a
"""


# ------------------------------------------------------------ suppression against long lists
SUPPRESSED_FLAGS = ["A", "N"]


def suppress_large(spark: SparkSession, base: str) -> DataFrame:
    """J6 + J8 at size: order lines whose order is on no list of their return flag, only possible hits shuffled."""
    t = Tables(spark, base)
    listed = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "P")).select(
        F.col("o_orderkey").alias("l_orderkey"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return SU.anti_split(lines, J.tag_lists(listed, SUPPRESSED_FLAGS, "l_returnflag"), ["l_returnflag", "l_orderkey"])


SUPPRESS_LARGE_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem l
 WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o_orderpriority = '1-URGENT'
                     AND o_orderstatus <> 'P' AND l.l_returnflag IN ('A', 'N'))
"""


# ------------------------------------------------------------ predicates and joins
def predicates(spark: SparkSession, base: str) -> DataFrame:
    """F9, F13, F18, X12, X20, X22 over orders."""
    o = FL.whitelist(FL.whitelist(Tables(spark, base).orders, "o_orderstatus", ["F", "O"]), "o_orderpriority", None)
    o = o.where(FL.not_like_suffix("o_orderpriority", "GENT"))
    ratio = F.when(F.col("o_custkey") % 5 == 0, F.lit(float("nan"))).when(F.col("o_custkey") % 5 != 1, F.lit(0.0))
    return o.select("o_orderkey", FL.null_when(F.col("o_orderstatus") == "F", "o_custkey").alias("open_custkey"),
                    C.has_value(ratio).alias("has_ratio"), C.postal_text((F.col("o_custkey") % 99999).cast("double")).alias("zip"),
                    R.event_id(F.lit("1555"), F.col("o_custkey").cast("string"), F.col("o_orderdate")).alias("event_id"))


PREDICATES_SQL = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS open_custkey,
       o_custkey % 5 NOT IN (0, 1) AS has_ratio, lpad(cast(o_custkey % 99999 AS varchar), 5, '0') AS zip,
       '1555|' || o_custkey || '|' || epoch_ms(o_orderdate) AS event_id
  FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT LIKE '%GENT'
"""


def outer_predicates(spark: SparkSession, base: str) -> DataFrame:
    """J4 + J5: predicates of the right side, one of them an OR, applied before the left join."""
    t = Tables(spark, base)
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_totalprice")
    pred = (F.col("o_orderstatus") == "P") | (F.col("o_totalprice") > 350000)
    return J.left_join_where(t.customer.select("c_custkey"), o, ["c_custkey"], pred).select("c_custkey", "o_orderkey")


OUTER_PREDICATES_SQL = """
SELECT c.c_custkey, o.o_orderkey FROM customer c
  LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND (o.o_orderstatus = 'P' OR o.o_totalprice > 350000)
"""


def push_queue(spark: SparkSession, base: str) -> DataFrame:
    """F21 + O1 + X21: changed rows since a start, in push order, at most so many per status (job argument)."""
    limits = dict(FL.parse_pairs("F,5,O,7"))
    rows = FL.push_order(Tables(spark, base).orders.select("o_orderkey", "o_orderstatus", "o_orderdate"), "o_orderdate",
                         "1997-06-01", [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()])
    rn = F.row_number().over(Window.partitionBy("o_orderstatus").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").asc()))
    cap = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in limits.items()])
    # the largest limit, a literal, cuts every partition before the shuffle
    first = rows.withColumn("_rn", rn).where(F.col("_rn") <= max(limits.values()))
    return first.where(F.col("_rn") <= cap).select("o_orderkey", "o_orderstatus", F.col("_rn").cast("long").alias("rn"))


PUSH_QUEUE_SQL = """
SELECT o_orderkey, o_orderstatus, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) AS rn
    FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01')
 WHERE rn <= CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'O' THEN 7 END
"""


def first_groups(spark: SparkSession, base: str) -> DataFrame:
    """The first three groups by name (the limit is the feature)."""
    return G.first_groups(Tables(spark, base).customer, "c_mktsegment", 3)


FIRST_GROUPS_SQL = "SELECT DISTINCT c_mktsegment FROM customer ORDER BY 1 LIMIT 3"


def distance_function(spark: SparkSession, base: str) -> DataFrame:
    """The SQL function over each supplier and the customer with its number."""
    geo.register_distance_function(spark)
    t = Tables(spark, base)
    return d.customer_geo(t.customer).join(d.supplier_geo(t.supplier), F.col("c_custkey") == F.col("s_suppkey")).select(
        "c_custkey", "s_suppkey", F.expr("round(compute_distance_between_points(c_lat, c_lng, s_lat, s_lng), 4)").alias("miles"))


DISTANCE_FUNCTION_SQL = f"""
SELECT c_custkey, s_suppkey,
       round({geo.cosine_miles_sql(d.CUSTOMER_LAT_SQL, d.CUSTOMER_LNG_SQL, d.SUPPLIER_LAT_SQL, d.SUPPLIER_LNG_SQL)}, 4) AS miles
  FROM customer JOIN supplier ON c_custkey = s_suppkey
"""

# names by key: (as written, first, last) - invented
_NAMES = (("ANA O'BRIEN", "Ana", "O'Brien"), ("joe mcallen", "Joe", "McAllen"), ("Public, Jane", "Jane", "Public"),
          ("john smith jr", "John", "Smith"), ("jane van der berg", "Jane", "van der Berg"), ("Li Na", "Li", "Na"),
          ("mary-ann LEE", "mary-ann", "LEE"), ("EVA LIND-HOLM", "Eva", "Lind-Holm"))


def name_parts(spark: SparkSession, base: str) -> DataFrame:
    """X3 + X4: names in several shapes, split and re-cased."""
    written = F.array(*[F.lit(n) for n, _, _ in _NAMES])
    c = Tables(spark, base).customer.select("c_custkey", F.element_at(written, (F.col("c_custkey") % len(_NAMES) + 1).cast("int")).alias("n"))
    parts = C.split_name(F.col("n"))
    return c.select("c_custkey", parts["first"].alias("first"), parts["last"].alias("last"))


def _sql_list(i: int) -> str:
    return "[" + ", ".join("'" + n[i].replace("'", "''") + "'" for n in _NAMES) + "]"


NAME_PARTS_SQL = f"""
SELECT c_custkey, ({_sql_list(1)})[c_custkey % {len(_NAMES)} + 1] AS first, ({_sql_list(2)})[c_custkey % {len(_NAMES)} + 1] AS last
  FROM customer
"""


# ------------------------------------------------------------ saved replies
def reply_classes(spark: SparkSession, base: str) -> DataFrame:
    """AR11: saved replies (XML text): new record, error, known e-mails."""
    c = Tables(spark, base).customer.select("c_custkey", F.concat(
        F.lit('<api><cons is_new="'), (F.col("c_custkey") % 2).cast("string"), F.lit('" id="'), F.col("c_custkey").cast("string"),
        F.lit('"></cons>'), F.when(F.col("c_custkey") % 3 == 0, F.lit("<error><code>9</code></error>")).otherwise(F.lit("")),
        F.lit("</api>")).alias("body"))
    return N.classify_replies(c).select("c_custkey", "is_new")


REPLY_CLASSES_SQL = "SELECT c_custkey, c_custkey % 2 = 1 AS is_new FROM customer"


def archive_keys(spark: SparkSession, base: str) -> DataFrame:
    """SNK1 + ST6: events archived by a stream and read back with their keys."""
    root = scratch_folder(spark, "archive")
    t = Tables(spark, base).events.select(
        F.col("ts").alias("paid_at"), (F.col("ts") + F.make_interval(secs=F.lit(61))).alias("received_at"),
        F.col("event_id").cast("string").alias("order_number"))
    t.write.parquet(f"{root}/in")
    events = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 16).parquet(f"{root}/in")
    SD.archive(events, f"{root}/out", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    back = spark.read.schema("archive_key string, order_number string, event_date date").json(f"{root}/out")
    return back.select("order_number", "archive_key", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"))


ARCHIVE_KEYS_SQL = """
SELECT cast(event_id AS varchar) AS order_number,
       'donations/' || strftime(ts + to_seconds(61), '%Y-%m-%d_%H:%M:%S') || '_' ||
       strftime(ts, '%Y-%m-%d_%H:%M:%S') || '_' || event_id || '.json' AS archive_key,
       strftime(ts + to_seconds(61), '%Y-%m-%d') AS event_date
  FROM events
"""

PROFILES_PER_PAGE = 20_000   # some 16 MB


def profiles_flat(spark: SparkSession, base: str) -> DataFrame:
    """SRC3 + AR2 + O4: profile pages written as XML from customers, read and flattened; messages newest first."""
    root = scratch_folder(spark, "profiles")
    k = F.col("c_custkey")
    text = k.cast("string")

    def message(i: int):
        return F.struct(F.concat(text, F.lit(f"-{i}")).alias("id"),
                        F.concat(F.lit("2024-01-0"), ((k + i * 3) % 7 + 1).cast("string")).alias("when"))

    def campaign(c):
        return F.struct(c.cast("string").alias("campaign_id"))

    pages = Tables(spark, base).customer.select(
        text.alias("id"), d.customer_phone().alias("phone_number"), F.lit("Pat").alias("first_name"),
        F.when(k % 2 == 0, F.struct(F.array(F.struct(F.lit("seg").alias("name"), F.col("c_mktsegment").alias("value")))
                                    .alias("custom_column"))).alias("custom_columns"),
        F.when(k % 3 != 0, F.struct(F.array(campaign(k % 9), campaign(F.lit(4))).alias("subscription"))).alias("subscriptions"),
        F.struct(F.array(message(0), message(1), message(2)).alias("message")).alias("messages"))
    # a page of XML is read whole by one task: pages hold a bounded number of profiles, as downloaded ones do
    (pages.write.format("xml").option("rootTag", "profiles").option("rowTag", "profile")
     .option("maxRecordsPerFile", PROFILES_PER_PAGE).save(f"{root}/pages"))
    flat = N.flatten_profiles(SF.read_profiles_xml(spark, f"{root}/pages"))
    return flat.select(F.col("id").cast("long").alias("id"), "phone_number", F.array_join("campaign_ids", ",").alias("campaigns"),
                       F.try_element_at("custom_columns", F.lit("seg")).alias("seg"), F.col("last_message.id").alias("last_message"),
                       F.size("messages").alias("n_messages"))


PROFILES_FLAT_SQL = f"""
WITH c AS (SELECT *, [c_custkey % 7, (c_custkey + 3) % 7, (c_custkey + 6) % 7] AS w FROM customer)
SELECT c_custkey AS id, {d.CUSTOMER_PHONE_SQL} AS phone_number,
       CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 9 = 4 THEN '4'
            ELSE cast(least(c_custkey % 9, 4) AS varchar) || ',' || cast(greatest(c_custkey % 9, 4) AS varchar) END AS campaigns,
       CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS seg,
       cast(c_custkey AS varchar) || '-' || cast(list_position(w, list_max(w)) - 1 AS varchar) AS last_message, 3 AS n_messages
  FROM c
"""


def address_flat(spark: SparkSession, base: str) -> DataFrame:
    """AR3 + P15: geocoder answers to flat address columns."""
    def part(kind: str, value):
        return F.struct(F.array(F.lit(kind), F.lit("political")).alias("types"), value.cast("string").alias("short_name"))

    k = F.col("c_custkey")
    parts = F.filter(F.array(
        part("street_number", k), part("locality", F.col("c_mktsegment")), part("administrative_area_level_1", F.lit("IA")),
        part("postal_code", F.lpad((k % 99999).cast("string"), 5, "0")),
        F.when(k % 4 == 0, part("postal_code_suffix", F.lit("0042")))), lambda p: p.isNotNull())
    c = Tables(spark, base).customer.select("c_custkey", F.struct(
        parts.alias("address_components"), F.concat(F.lit("p"), k.cast("string")).alias("place_id"),
        F.struct(F.struct(F.lit(1.5).alias("lat"), F.lit(-2.5).alias("lng")).alias("location")).alias("geometry")).alias("result"))
    return N.flatten_address(c, "result").drop("result")


ADDRESS_FLAT_SQL = """
SELECT c_custkey, cast(c_custkey AS varchar) AS street_number, cast(NULL AS varchar) AS route, c_mktsegment AS city, 'IA' AS state,
       lpad(cast(c_custkey % 99999 AS varchar), 5, '0') AS zip5,
       lpad(cast(c_custkey % 99999 AS varchar), 5, '0') || CASE WHEN c_custkey % 4 = 0 THEN '-0042' ELSE '' END AS zip9,
       'p' || c_custkey AS place_id, 1.5::DOUBLE AS lat, (-2.5)::DOUBLE AS lng
  FROM customer
"""


def events_formatted(spark: SparkSession, base: str) -> DataFrame:
    """AR6 + X16: saved search responses, one per user, to one row per event; a sponsor whitelist."""
    e = Tables(spark, base).events.where("user_id is not null")
    item = F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("title"), F.col("event_type"), F.lit("America/Chicago").alias("timezone"),
        F.concat(F.lit("https://events.example.org/e/"), F.col("event_id").cast("string")).alias("browser_url"),
        F.array(F.struct(F.lit(1).alias("id"), F.lit(False).alias("is_full"), F.unix_timestamp("ts").alias("start_date"),
                         (F.unix_timestamp("ts") + 3600).alias("end_date"))).alias("timeslots"),
        F.struct((F.col("event_id") % 5).cast("int").alias("id")).alias("sponsor"),
        F.struct(F.lit("Ames").alias("locality"), F.lit("IA").alias("region"), F.lit("50010").alias("postal_code")).alias("location"))
    # a response holds one user's events of one day: bounded by what a page shows
    replies = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_list(item).alias("data"))
    out = N.format_events(replies, utm_source="mail", sponsor_whitelist=[1, 3])
    return out.select("id", "count", "url", "city", F.size("timeslots").alias("n_slots"))


EVENTS_FORMATTED_SQL = """
SELECT event_id AS id, cast(count(*) OVER (PARTITION BY user_id, cast(ts AS date)) AS integer) AS count,
       'https://events.example.org/e/' || event_id || '?utm_source=mail' AS url, 'Ames' AS city, 1 AS n_slots
  FROM events WHERE user_id IS NOT NULL QUALIFY event_id % 5 IN (1, 3)
"""

MORE = {
    "profiles_flat": (profiles_flat, PROFILES_FLAT_SQL), "address_flat": (address_flat, ADDRESS_FLAT_SQL),
    "events_formatted": (events_formatted, EVENTS_FORMATTED_SQL),
    "field_xml": (field_xml, FIELD_XML_SQL), "profile_payload": (profile_payload, PROFILE_PAYLOAD_SQL),
    "nested_default": (nested_default, NESTED_DEFAULT_SQL), "constituent_record": (constituent_record, CONSTITUENT_RECORD_SQL),
    "merge_row": (merge_row, MERGE_ROW_SQL), "written_and_read": (written_and_read, WRITTEN_AND_READ_SQL),
    "sheets_and_tags": (sheets_and_tags, SHEETS_AND_TAGS_SQL), "upserted": (upserted, UPSERTED_SQL),
    "stored_tables": (stored_tables, STORED_TABLES_SQL),
    "asof_large": (asof_large, ASOF_LARGE_SQL), "sites_in_phase": (sites_in_phase, SITES_IN_PHASE_SQL),
    "suppress_large": (suppress_large, SUPPRESS_LARGE_SQL),
    "predicates": (predicates, PREDICATES_SQL), "outer_predicates": (outer_predicates, OUTER_PREDICATES_SQL),
    "push_queue": (push_queue, PUSH_QUEUE_SQL), "first_groups": (first_groups, FIRST_GROUPS_SQL),
    "distance_function": (distance_function, DISTANCE_FUNCTION_SQL), "name_parts": (name_parts, NAME_PARTS_SQL),
    "reply_classes": (reply_classes, REPLY_CLASSES_SQL), "archive_keys": (archive_keys, ARCHIVE_KEYS_SQL),
}
