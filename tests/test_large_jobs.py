"""Jobs that must spread over tasks and read or search no more than they need; the tests build their own rows."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from canvass.operators import radius
from canvass.operators import upload as U
from canvass.plans import email_upload as EU
from canvass.plans import export_jobs as XJ
from canvass.plans import geo_jobs as GJ
from canvass.plans import more_jobs as MJ


def _customers(spark, path, n):
    rows = [(i, f"Customer#{i:09d}", i % 3, float(i), "BUILDING") for i in range(n)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(
        1).write.parquet(f"{path}/customer.parquet")


def test_profile_pages_are_of_bounded_size(spark, tmp_path, monkeypatch):
    _customers(spark, str(tmp_path), 105)
    monkeypatch.setattr(MJ, "PROFILES_PER_PAGE", 20)
    paths, read = [], MJ.SF.read_profiles_xml
    monkeypatch.setattr(MJ.SF, "read_profiles_xml", lambda s, p: paths.append(p) or read(s, p))
    got = MJ.profiles_flat(spark, str(tmp_path))
    assert sorted(r["id"] for r in got.select("id").collect()) == list(range(105))
    sizes = [open(f).read().count("<profile>") for f in glob.glob(f"{paths[0].removeprefix('file:')}/part-*")]
    assert sum(sizes) == 105 and max(sizes) <= 20


def test_a_record_is_parsed_twice_at_most(spark, monkeypatch):
    odd = ["Ann", " ", "a  b ", "<&>'\"", "", "Zoë 😀", "x\ty", None]
    base = dict.fromkeys(U.LAYOUT)
    rows = [tuple({**base, "email": f"p{i}@x.org", "addr1": v, "source": v, "ext_id": str(i), "phone_number": v,
                   "ext_type": ["shop", "sms"][i % 2]}.values()) for i, v in enumerate(odd)]
    schema = ", ".join(f"{c} {'double' if c == 'action_epoch' else 'string'}" for c in U.LAYOUT)
    seen = spark.createDataFrame(rows, schema).withColumn("outcome", F.lit("create"))
    monkeypatch.setattr(EU, "seen", lambda *a: seen)
    out = EU.email_upload_records(spark, "")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("xpath") <= 2
    got = {r["ext_id"]: r for r in out.collect()}
    for i, v in enumerate(odd):
        r = got[str(i)]
        assert (r["addr1"], r["source"], r["phone"], r["phone_type"]) == (v or "", v or "", v or "", "home" if v else "")
        assert (r["xml_email"], r["zip"], r["country"], r["kind"]) == (f"p{i}@x.org", "", "US", ["shop", "sms"][i % 2])
        assert r["groups"] == ("11,12,23" if i % 2 == 0 else "11,12")


def test_origins_of_one_file_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(radius, "FEW_POINTS", 0)
    plans, with_xyz = [], radius._with_xyz
    monkeypatch.setattr(radius, "_with_xyz", lambda df, *a: plans.append((a[-1], df._jdf.queryExecution().optimizedPlan().toString()))
                        or with_xyz(df, *a))
    o = spark.createDataFrame([(i, 10.0, 20.0 + i / 100) for i in range(50)], "o long, la double, ln double").coalesce(1)
    p = spark.createDataFrame([(i, 10.0, 20.0 + i / 100) for i in range(0, 50, 7)], "p long, pa double, pn double")
    got = radius.first_k_within(o, p, "o", "p", "la", "ln", "pa", "pn", 0.1, 3)
    assert sorted((r["o"], r["p"]) for r in got.collect()) == [(i, i) for i in range(0, 50, 7)]
    assert "RepartitionByExpression [o#" in dict(plans)["_o"]


def test_invites_search_only_phases_still_to_come(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    _customers(spark, base, 30)
    spark.createDataFrame([(i, f"Supplier#{i}", i % 3, 1.0) for i in range(150)],
                          "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{base}/supplier.parquet")
    days = [dt.datetime(1995, 1, 1) + dt.timedelta(31 * i) for i in range(80)]
    spark.createDataFrame([(20 * i + 1, i % 30, "F", 1000.0 + i, d, "5-LOW") for i, d in enumerate(days)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
                          " o_orderpriority string").write.parquet(f"{base}/orders.parquet")
    whole = GJ.nearest_sites(spark, base)
    phones = XJ.best_phone(XJ._phones(spark.read.parquet(f"{base}/orders.parquet")))
    want = sorted((r["c_custkey"], r["phone"], str(r["start_date"])) for r in whole.join(
        phones, F.col("vanid") == F.col("c_custkey")).where(f"date_sub(start_date, 1) > date '{XJ.INVITE_AS_OF}'").collect())
    met, search = [], GJ.nn.nearest_with_tolerance
    monkeypatch.setattr(GJ.nn, "nearest_with_tolerance", lambda o, *a, **k: met.append(o) or search(o, *a, **k))
    got = sorted((r["Custom ID"], r["phone"], r["start_date"]) for r in XJ.invite_export(spark, base).collect())
    assert got == want and len(got) > 100
    ends = [r[0] for r in met[0].select("timeframe_end").distinct().collect()]
    assert min(ends) > dt.date.fromisoformat(XJ.INVITE_AS_OF) and len(ends) > 5
