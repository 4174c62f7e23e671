"""P4 and P5 to the payload, and diffs by range digests: what changed, in order, as
the requests that the targets take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.operators import diff as DF
from canvass.operators import digests as DG
from canvass.operators.scan import numbered
from canvass.plans.contact_jobs import EVENT_TYPES
from canvass.plans.sync_jobs import FIELD_DIFF_CRM_SQL, FIELD_DIFF_SMS_SQL, _crm_sides, field_diff_sms
from canvass.sources import sinks as SK
from canvass.sources.tables import Tables

FIELD_IDS = {t: 100 + i for i, t in enumerate(EVENT_TYPES)}
WIDTH = 256          # keys in a range


def changed_members(spark: SparkSession, base: str) -> DataFrame:
    """S4 by digests: order lists by priority; the orders of one thousand keys in fifty move to another list."""
    o = Tables(spark, base).orders
    moved = F.floor(F.col("o_orderkey") / 1000) % 50 == 7
    old = o.select(F.col("o_orderpriority").alias("group_name"), "o_orderkey")
    new = o.select(F.when(moved, F.lit("moved")).otherwise(F.col("o_orderpriority")).alias("group_name"), "o_orderkey")
    return DG.membership_delta(old, new, ["group_name", "o_orderkey"], DG.key_range("o_orderkey", WIDTH))


CHANGED_MEMBERS_SQL = """
SELECT o_orderpriority AS group_name, o_orderkey, 'remove' AS change FROM orders WHERE (o_orderkey // 1000) % 50 = 7
UNION ALL SELECT 'moved', o_orderkey, 'add' FROM orders WHERE (o_orderkey // 1000) % 50 = 7
"""


def field_push_crm(spark: SparkSession, base: str) -> DataFrame:
    """Stored fields pivoted, diffed against wanted ones (by digests), batched in order of the id and rendered;
    the requests are read back."""
    stored, wanted = _crm_sides(spark, base)
    changed = DG.diff_fields(stored, wanted, "user_id", [DF.FieldRule(t) for t in EVENT_TYPES], DG.key_range("user_id", WIDTH))
    r = SK.field_requests(changed, "user_id", EVENT_TYPES, FIELD_IDS).withColumn("xml", F.regexp_replace("request", r"^<\?[^>]*>", ""))
    return r.select("batch", "n", F.array_join(F.xpath("xml", F.lit("/api/cons/@id")), ",").alias("ids"),
                    F.array_join(F.xpath("xml", F.lit("/api/cons/cons_field[value]/@id")), ",").alias("set_fields"),
                    F.array_join(F.xpath("xml", F.lit("/api/cons/cons_field/value/text()")), ",").alias("set_values"),
                    F.xpath_int("xml", F.lit("count(/api/cons/cons_field[not(value)])")).cast("bigint").alias("n_cleared"))


_ALL = " UNION ALL ".join(f"SELECT user_id, {i} AS f, {t} AS v FROM changed" for t, i in FIELD_IDS.items())
FIELD_PUSH_CRM_SQL = f"""
WITH changed AS ({FIELD_DIFF_CRM_SQL}),
b AS (SELECT user_id, (row_number() OVER (ORDER BY user_id) - 1) // {SK.FIELD_GROUP} AS batch FROM changed),
ids AS (SELECT batch, count(*) AS n, string_agg(user_id, ',' ORDER BY user_id) AS ids FROM b GROUP BY 1),
x AS (SELECT batch, user_id, f, v FROM ({_ALL}) JOIN b USING (user_id))
SELECT cast(batch AS bigint) AS batch, any_value(n) AS n, any_value(ids) AS ids,
       coalesce(string_agg(f, ',' ORDER BY user_id, f) FILTER (WHERE v IS NOT NULL), '') AS set_fields,
       coalesce(string_agg(v, ',' ORDER BY user_id, f) FILTER (WHERE v IS NOT NULL), '') AS set_values,
       count(*) FILTER (WHERE v IS NULL) AS n_cleared
  FROM x JOIN ids USING (batch) GROUP BY batch
"""


def field_push_sms(spark: SparkSession, base: str) -> DataFrame:
    """P5 + O1: changed profiles, newest click first, as the payload of each; ``place`` is the order of sending."""
    changed = field_diff_sms(spark, base).withColumn("_age", F.datediff(F.lit("2100-01-01").cast("date"), F.coalesce(
        F.col("click").cast("date"), F.lit("1900-01-01").cast("date"))))
    payload = SK.profile_payload(F.col("phone_number"), ["view", "signup", "error", "click"], ["view"], ["signup"])
    return numbered(changed, [], ["_age", "phone_number"], out="place").select("place", "phone_number", payload.alias("payload"))


FIELD_PUSH_SMS_SQL = f"""
WITH changed AS ({FIELD_DIFF_SMS_SQL})
SELECT row_number() OVER (ORDER BY click DESC NULLS LAST, phone_number) AS place, phone_number,
       '{{"phone_number":"1' || right(phone_number, 10) || '"' ||
       CASE WHEN view IS NULL THEN '' ELSE ',"view":' || cast(cast(round_even(cast(view AS double), 0) AS bigint) AS varchar) END ||
       CASE WHEN signup IS NULL THEN '' ELSE ',"signup":"' || CASE signup WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' ELSE signup END || '"' END ||
       CASE WHEN error IS NULL THEN '' ELSE ',"error":"' || error || '"' END ||
       CASE WHEN click IS NULL THEN '' ELSE ',"click":"' || click || '"' END || '}}' AS payload
  FROM changed
"""

PUSH = {
    "changed_members": (changed_members, CHANGED_MEMBERS_SQL),
    "field_push_crm": (field_push_crm, FIELD_PUSH_CRM_SQL),
    "field_push_sms": (field_push_sms, FIELD_PUSH_SMS_SQL),
}
