"""Profile / address flatteners, file sources and payload renderers."""

import json
import os
import re
import tempfile

from pyspark.sql import functions as F

from canvass.operators import nested as N
from canvass.sources import files as SF
from canvass.sources import sinks as SK

PROFILE_ONE = """<response><profile id="x">
<id>101</id><first_name>Pat</first_name><last_name>Doe</last_name><phone_number>15105550100</phone_number>
<opted_out_at></opted_out_at>
<custom_columns><custom_column><name>team</name><value>blue</value></custom_column>
<custom_column><name>level</name></custom_column></custom_columns>
<subscriptions><subscription><campaign_id>189358</campaign_id></subscription>
<subscription><campaign_id>189358</campaign_id></subscription></subscriptions>
<messages><message><id>m1</id><when>2019-06-01 10:00:00 UTC</when><body>hi</body></message></messages>
</profile></response>"""
PROFILE_MANY = """<response><profile id="y">
<id>102</id><first_name>Sam</first_name>
<messages>
<message><id>m2</id><when>2019-06-01 10:00:00 UTC</when></message>
<message><id>m3</id><when>2019-07-01 10:00:00 UTC</when></message>
<message><id>m4</id><when>2019-05-01 10:00:00 UTC</when></message>
</messages></profile></response>"""
PROFILE_NONE = """<response><profile><id>103</id></profile></response>"""


def test_profiles_xml_one_or_many_children(spark):
    d = tempfile.mkdtemp(prefix="canvass-xml-")
    for i, body in enumerate((PROFILE_ONE, PROFILE_MANY, PROFILE_NONE)):
        with open(os.path.join(d, f"p{i}.xml"), "w") as fh:
            fh.write(body)
    flat = N.flatten_profiles(SF.read_profiles_xml(spark, d))
    got = {r["id"]: r for r in flat.collect()}
    assert got["101"]["campaign_ids"] == [189358]
    assert got["101"]["custom_columns"] == {"team": "blue", "level": None}
    assert [m["id"] for m in got["101"]["messages"]] == ["m1"]
    assert [m["id"] for m in got["102"]["messages"]] == ["m3", "m2", "m4"]
    assert got["102"]["last_message"]["id"] == "m3"
    assert got["103"]["messages"] == [] and got["103"]["campaign_ids"] == []


def test_flatten_address(spark):
    res = {"address_components": [
        {"long_name": "20", "short_name": "20", "types": ["street_number"]},
        {"long_name": "Main Street", "short_name": "Main St", "types": ["route"]},
        {"long_name": "Richmond", "short_name": "Richmond", "types": ["locality", "political"]},
        {"long_name": "California", "short_name": "CA", "types": ["administrative_area_level_1", "political"]},
        {"long_name": "94801", "short_name": "94801", "types": ["postal_code"]},
        {"long_name": "1234", "short_name": "1234", "types": ["postal_code_suffix"]}],
        "place_id": "abc", "geometry": {"location": {"lat": 37.9, "lng": -122.3}}}
    schema = ("struct<address_components:array<struct<long_name:string,short_name:string,types:array<string>>>,"
              "place_id:string,geometry:struct<location:struct<lat:double,lng:double>>>")
    df = spark.createDataFrame([(json.dumps(res),), (json.dumps({"address_components": []}),)], "j string")
    df = df.select(F.from_json("j", schema).alias("r"))
    rows = N.flatten_address(df, "r").collect()
    a, b = rows
    assert (a["route"], a["city"], a["state"], a["zip5"], a["zip9"]) == ("Main St", "Richmond", "CA", "94801", "94801-1234")
    assert (a["lat"], a["lng"], a["place_id"]) == (37.9, -122.3, "abc")
    assert b["zip5"] is None and b["zip9"] is None


def test_read_tags(spark):
    d = tempfile.mkdtemp(prefix="canvass-tags-")
    with open(os.path.join(d, "t.csv"), "w") as fh:
        fh.write("conversation_id,tags\n1,a|b\n2,\n3,c\n")
    got = sorted((r["conversation_id"], r["tag"]) for r in SF.read_tags(spark, d).collect())
    assert got == [("1", "a"), ("1", "b"), ("3", "c")]


def test_renderers(spark):
    df = spark.createDataFrame([("Pat", "", "94801", 3.0, 2.5, 1, "x@example.org")],
                               "first string, last string, zip string, total double, gifts double, sms int, email string")
    r = df.select(
        SK.constituent_xml(df, ["first", "last", "zip"], [3814], "export", {"is_banned": "0"}).alias("cons"),
        SK.profile_payload(F.lit("5105550100"), ["total", "gifts", "sms", "last"], ["gifts"], ["sms"]).alias("p"),
        SK.triggered_form(["first", "zip"]).alias("t")).first()
    assert "<first>Pat</first>" in r["cons"] and "<last>" not in r["cons"] and "<source>export</source>" in r["cons"]
    p = json.loads(r["p"])
    assert p == {"phone_number": "15105550100", "total": "3.0", "gifts": 2, "sms": "Yes"}
    assert r["t"] == "%7B%22first%22%3A%22Pat%22%2C%22zip%22%3A%2294801%22%7D"


def test_field_xml_values(spark):
    df = spark.createDataFrame([("3.0", "2.5", None)], "total string, gifts string, missing string")
    x = df.select(SK.field_xml(F.lit(9), ["total", "gifts", "missing"],
                               {"total": 1, "gifts": 2, "missing": 3}).alias("x")).first()["x"]
    assert "<value>3</value>" in x and "<value>2.5</value>" in x
    assert x.count("<value>") == 2


def test_payload_values_by_type(spark):
    df = spark.createDataFrame([("abc", "0", 0.0, 24.0, 1.5, "Yes", "No", 1, 0, "maybe", None, True)],
                               "a string, b string, c double, d double, e double, f string, g string, h int, i int, j string, k string, l boolean")
    names = list("abcdejkl")
    x = df.select(SK.field_xml(F.lit(9), names, {n: i for i, n in enumerate(names)}).alias("x")).first()["x"]
    got = dict(re.findall(r'cons_field id="(\d)"/?>\s*(?:<value>([^<]*)</value>)?', x))
    assert got == {"0": "abc", "1": "0", "2": "", "3": "24", "4": "1.5", "5": "maybe", "6": "", "7": "True"}
    p = json.loads(df.select(SK.profile_payload(F.lit("15105550100"), list("abdfghijk"), ["d"], list("fghij")).alias("p")).first()["p"])
    assert p == {"phone_number": "15105550100", "a": "abc", "b": "0", "d": 24, "f": "Yes", "g": "No", "h": "Yes", "i": "No", "j": "maybe"}
    r = df.select(*[N.get_or_default(F.col(c), F.lit(v)).alias(c) for c, v in
                    (("a", "z"), ("b", "z"), ("c", -1.0), ("d", -1.0), ("i", -1), ("h", -1), ("k", "z"))]).first()
    assert tuple(r) == ("abc", "0", -1.0, 24.0, -1, 1, "z")


def test_merge_requests_hold_fifty_recipients(spark):
    import json
    df = spark.range(120).selectExpr("id", "case when id % 10 != 3 then concat('p', id, '@example.org') end address", "if(id = 4, 'say \"hi\"', null) note")
    rows = sorted(SK.merge_requests(df, "address", ["note"], ["id"], {"note": "none"}).collect(), key=lambda r: r["batch"])
    assert [(r["batch"], r["n"]) for r in rows] == [(0, 50), (1, 50), (2, 8)]
    first = json.loads(rows[0]["request"])
    assert json.loads(first["DefaultTemplateData"]) == {"note": "none"}
    assert [d["Destination"]["ToAddresses"] for d in first["Destinations"][:4]] == [["p0@example.org"], ["p1@example.org"], ["p2@example.org"], ["p4@example.org"]]
    assert json.loads(first["Destinations"][3]["ReplacementTemplateData"]) == {"email": "p4@example.org", "note": 'say "hi"'}
    assert SK.merge_requests(df.where("address is null"), "address", ["note"], ["id"]).count() == 0
