"""P3 rules on hand-written rows: limits, rejects, replies, logs and records."""

from pyspark.sql import functions as F

from canvass.operators import upload as U

SCHEMA = ", ".join(f"{c} {'double' if c == 'action_epoch' else 'string'}" for c in U.LAYOUT) + ", is_resubscribe boolean, unsub_epoch double"


def _rows(spark, *rows):
    base = dict.fromkeys(U.LAYOUT)
    full = [tuple({**base, "is_resubscribe": False, "unsub_epoch": None, **r}.values()) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def _people(spark):
    return _rows(spark,
                 {"email": "a@x.org", "ext_type": "t", "ext_id": "1"}, {"email": "b@bad.org", "ext_type": "t", "ext_id": "2"},
                 {"email": "c@x.org", "ext_type": "t", "ext_id": "3", "is_resubscribe": True}, {"email": "d@@x.org", "ext_type": "t", "ext_id": "4"},
                 {"email": "e@X.org", "ext_type": "t", "ext_id": "5"}, {"email": "f@x.org", "ext_type": "u", "ext_id": "6"})


def _process(spark, **kw):
    domains = spark.createDataFrame([("x.org",), (None,), ("x.org",)], "name string")
    existing = spark.createDataFrame([(" A@X.org ",), (None,)], "email string")
    return U.process(_people(spark), domains, existing, **kw)


def _by_id(df, *cols):
    return {r["ext_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_outcomes_and_replies(spark):
    replies = spark.createDataFrame([("A@x.org", True, False), ("c@x.org", True, False), ("e@x.org", False, True)],
                                    "email string, was_new boolean, was_error boolean")
    got = _by_id(_process(spark, replies=replies), "outcome", "did_exist", "was_new", "was_error")
    assert got == {"1": ("create", True, True, False), "2": ("rejected", None, None, None), "3": ("resubscribe", False, None, None),
                   "4": ("rejected", None, None, None), "5": ("create", False, False, True), "6": ("create", False, None, None)}


def test_limit_counts_accepted_rows_only(spark):
    assert set(_by_id(_process(spark, limit=2, dry_run=True), "outcome")) == {"1", "2", "3", "6"}
    assert set(_by_id(_process(spark, limit=1, dry_run=True), "outcome")) == {"1", "6"}
    dry = _process(spark, limit=3, dry_run=True)
    assert _by_id(dry, "was_new") == {"1": (False,), "2": (None,), "3": (True,), "4": (None,), "5": (True,), "6": (True,)}
    counts = {r["ext_type"]: tuple(r)[1:] for r in U.run_counts(dry).collect()}
    assert counts == {"t": (5, 2, 2, 1, 2), "u": (1, 1, 1, 0, 0)}


def test_logs_and_reject_table(spark, tmp_path):
    path = str(tmp_path)
    for _ in range(2):
        U.write_run(_process(spark), path, "2024-01-01 00:00:00")
    assert spark.read.parquet(f"{path}/detailed_log").count() == 8
    assert spark.read.parquet(f"{path}/rejected").count() == 2
    assert spark.read.parquet(f"{path}/counts").count() == 4
    clean = _process(spark).where("outcome <> 'rejected'")
    U.write_run(clean, path, "2024-01-02 00:00:00", dry_run=True)
    assert spark.read.parquet(f"{path}/rejected").count() == 2 and spark.read.parquet(f"{path}/counts").count() == 4
    assert spark.read.parquet(f"{path}/detailed_log").where("dry_run").count() == 4


def test_record_leaves_empty_parts_out(spark):
    rows = _rows(spark, {"email": "a&b@x.org", "ext_type": "t", "ext_id": "1", "first_name": "ANN", "last_name": "O'NEIL", "postal_code": ""},
                 {"email": "c@x.org", "ext_type": "u", "ext_id": "2", "addr1": "1 <A> St", "phone_number": "2025550123"})
    out = U.records(rows.withColumn("outcome", F.lit("create")), [1, 2], {"t": 9}, 5)
    one, two = [r["record"] for r in out.orderBy("ext_id").collect()]
    assert "<firstname>Ann</firstname>" in one and "<lastname>O'Neil</lastname>" in one.replace("&apos;", "'")
    assert "a&amp;b@x.org" in one and "zip" not in one and "cons_phone" not in one and "<country>US</country>" in one
    assert [f'id="{g}"' in one for g in (1, 2, 9, 5)] == [True] * 4
    assert "firstname" not in two and "1 &lt;A> St" in two.replace("&gt;", ">") and "<phone>2025550123</phone>" in two and 'id="9"' not in two


def test_empty_tables(spark):
    none = _people(spark).limit(0)
    domains, existing = spark.createDataFrame([], "d string"), spark.createDataFrame([], "email string")
    seen = U.process(none, domains, existing, limit=5)
    assert seen.count() == 0 and U.run_counts(seen).count() == 0 and U.records(seen, [], {}, 5).count() == 0
