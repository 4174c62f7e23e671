"""Event finder formatting, reply classification, small sinks and group helpers."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from canvass.functions import filters as FL
from canvass.operators import groups as G
from canvass.operators import nested as N
from canvass.sources import files as SF
from canvass.sources import sinks as SK

RESP_SCHEMA = ("count int, data array<struct<id:long, title:string, event_type:string, timezone:string, "
               "browser_url:string, timeslots:array<struct<id:long, is_full:boolean, start_date:long, end_date:long>>, "
               "sponsor:struct<id:long, name:string>, location:struct<locality:string, region:string, "
               "postal_code:string>>>")


def test_format_events(spark):
    resp = {"count": 2, "data": [
        {"id": 1, "title": "Watch party", "event_type": "DEBATE_WATCH_PARTY", "timezone": "America/Los_Angeles",
         "browser_url": "https://example.org/e/1/", "sponsor": {"id": 7, "name": "x"},
         "timeslots": [{"id": 11, "is_full": False, "start_date": 1564531200, "end_date": 1564538400}],
         "location": {"locality": "Richmond", "region": "CA", "postal_code": "94801"}},
        {"id": 2, "title": "Other", "event_type": "CANVASS", "timezone": "America/New_York",
         "browser_url": "https://example.org/e/2/?a=b", "sponsor": {"id": 8, "name": "y"}, "timeslots": None,
         "location": None}]}
    df = spark.createDataFrame([(json.dumps(resp),), (json.dumps({"count": 0, "data": None}),)], "j string")
    df = df.select(F.from_json("j", RESP_SCHEMA).alias("r")).select("r.*")
    out = {r["id"]: r for r in N.format_events(df, utm_source="sms list/2019").collect()}
    assert out[1]["timeslots"][0]["start"] == "Tue, Jul 30 at 5:00 PM"
    assert out[1]["url"] == "https://example.org/e/1/?utm_source=sms%20list/2019"
    assert out[2]["url"] == "https://example.org/e/2/?a=b" and out[2]["timeslots"] == []
    only7 = N.format_events(df, sponsor_whitelist=[7]).collect()
    assert [r["id"] for r in only7] == [1]


def test_classify_replies(spark):
    one = '<api><cons is_new="1" id="5"><email>a@example.org</email></cons></api>'
    many = ('<api><cons is_new="0" id="6"><email>b@example.org</email></cons>'
            '<cons is_new="0" id="7"><email>c@example.org</email></cons></api>')
    err = '<api><error><code>409</code><description>bad</description></error></api>'
    df = spark.createDataFrame([(1, one), (2, many), (3, err)], "k int, body string")
    got = {r["k"]: r for r in N.classify_replies(df).collect()}
    assert got[1]["is_new"] and got[1]["emails"] == ["a@example.org"]
    assert not got[2]["is_new"] and got[2]["emails"] == ["b@example.org", "c@example.org"]
    assert got[3]["has_error"] and got[3]["emails"] == []


def test_replace_table_skips_empty_and_dry_run(spark):
    d = tempfile.mkdtemp(prefix="canvass-sink-")
    empty = spark.createDataFrame([], "a int")
    assert SK.replace_table(empty, os.path.join(d, "t")) is False
    full = spark.createDataFrame([(1,)], "a int")
    assert SK.replace_table(full, os.path.join(d, "t"), dry_run=True) is True
    assert os.path.isdir(os.path.join(d, "t_dry_run")) and not os.path.exists(os.path.join(d, "t"))


def test_upsert_delta_and_new_groups(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(G.upsert(old, new, ["k"]).collect()) == sorted([(1, "a"), (2, "B"), (3, "c")])
    m_old = spark.createDataFrame([("g", 1), ("g", 2), ("h", 5)], "grp string, m int")
    m_new = spark.createDataFrame([("g", 2), ("g", 3), ("i", 9)], "grp string, m int")
    c = {r["grp"]: (r["old_count"], r["new_count"], r["to_add"], r["to_remove"])
         for r in G.delta_counts(m_old, m_new, "grp", "m").collect()}
    assert c == {"g": (2, 2, 1, 1), "h": (1, 0, 0, 1), "i": (0, 1, 1, 0)}
    ng = G.new_groups(m_new, m_old, "grp", "evt").collect()
    assert [(r["grp"], r["group_id"]) for r in ng] == [("i", "evt:i")]
    assert [r["grp"] for r in G.first_groups(m_new.unionByName(m_old), "grp", 2).collect()] == ["g", "h"]


def test_members_keep_empty_groups_for_sms_only(spark):
    mem = spark.createDataFrame([("g1", "crm", 1), ("g1", "sms", 1)], "grp string, target string, member long")
    groups = spark.createDataFrame([("g1",), ("g2",)], "grp string")
    got = sorted(G.group_members(mem, "grp", "target", "member", ["sms"], groups).collect(),
                 key=lambda r: (r[0], r[1]))
    assert [(r["grp"], r["target"], r["member"]) for r in got] == [("g1", "crm", 1), ("g1", "sms", 1),
                                                                   ("g2", "sms", None)]


def test_filters_and_pairs(spark):
    df = spark.createDataFrame([("Attended", None, 1, "a@x.api"), (None, None, None, "b@x.com"),
                                ("No Show", 5, 0, "c@x.com")], "status string, deleted int, att int, e string")
    r = df.select(FL.exclude_status("status", ["No Show"]).alias("s"), FL.not_deleted("deleted").alias("d"),
                  FL.attended_or_unknown("att").alias("a"), FL.not_like_suffix("e", ".api").alias("n")).collect()
    assert [tuple(x) for x in r] == [(True, True, True, False), (None, True, True, True), (False, False, False, True)]
    assert FL.parse_pairs("a,1, b ,2") == [("a", 1), ("b", 2)]
    assert FL.whitelist(df, "status", []).count() == 3


def test_read_sheet_keeps_listed_columns(spark):
    d = tempfile.mkdtemp(prefix="canvass-sheet-")
    with open(os.path.join(d, "s.csv"), "w") as fh:
        fh.write("name,zip,extra\nPat,94801,x\n")
    got = SF.read_sheet(spark, d, ["zip", "name", "missing"]).collect()
    assert [tuple(r) for r in got] == [("94801", "Pat")]


def test_no_cross_join_in_nearest_plans(spark):
    import __spark_entry__ as E
    for k in ("nearest_poi", "radius_events"):
        plan = E.queries()[k](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, k


def test_sql_distance_function_and_event_id(spark):
    import datetime as dt

    from canvass.functions import geo
    from canvass.operators.report import event_id
    geo.register_distance_function(spark)
    r = spark.sql("SELECT compute_distance_between_points(41.0, -93.0, 41.5, -93.5) AS d").first()["d"]
    df = spark.createDataFrame([(41.0, -93.0, 41.5, -93.5)], "a double, b double, c double, e double")
    assert abs(r - df.select(geo.cosine_miles("a", "b", "c", "e")).first()[0]) < 1e-9
    same = spark.sql("SELECT compute_distance_between_points(41.0, -93.0, 41.0, -93.0) AS d").first()["d"]
    assert same == 0.0                      # clamped acos, never NaN
    ev = spark.createDataFrame([("5550100", "p7", dt.datetime(2020, 2, 3, 12, 0, 0))], "ph string, p string, t timestamp")
    assert ev.select(event_id(F.col("ph"), F.col("p"), F.col("t"))).first()[0] == "5550100|p7|1580731200000"


def test_push_order_and_snapshot(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 7)], "k int, t int")
    assert [r["k"] for r in FL.push_order(df, "t", 5, [F.col("t").desc()]).collect()] == [2, 3]
    d = tempfile.mkdtemp(prefix="canvass-snap-")
    out = SK.snapshot(df, d, "2020-02-03")
    assert out.endswith("ds=2020-02-03") and spark.read.parquet(out).count() == 3


def test_append_log_and_csv(spark):
    d = tempfile.mkdtemp(prefix="canvass-log-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    SK.append_log(df, os.path.join(d, "log"))
    SK.append_log(df, os.path.join(d, "log"))
    assert spark.read.parquet(os.path.join(d, "log")).count() == 4
    SK.write_csv(df, os.path.join(d, "csv"), ["v"])
    got = spark.read.option("header", True).csv(os.path.join(d, "csv")).collect()
    assert sorted(r["v"] for r in got) == ["a", "b"] and got[0].asDict().keys() == {"v"}


def test_sms_export_faithful_quirk(spark):
    from canvass.plans import outreach_exports as OX
    base = "/root/testdata/sf0.001"
    plain = {r["phone_number"] for r in OX.sms_optin_export(spark, base).collect()}
    faithful = {r["phone_number"] for r in OX.sms_optin_export(spark, base, faithful=True).collect()}
    # faithful mode never suppresses the 11-digit signup numbers, so it keeps at least as many
    assert plain <= faithful


def test_diff_whitelist(spark):
    from canvass.operators import diff as DF
    stored = spark.createDataFrame([("p1", "1"), ("p2", "1")], "k string, a string")
    wanted = spark.createDataFrame([("p1", 2.0), ("p2", 3.0)], "k string, a double")
    got = [r["k"] for r in DF.diff_fields(stored, wanted, "k", [DF.FieldRule("a")], sms=True,
                                          key_whitelist=["p2"]).collect()]
    assert got == ["p2"]
