"""Donor id, badges, stale-event rule and rollup (batch form of the stream)."""

import base64
import datetime as dt
import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from canvass.operators import donors as DN
from canvass.operators.scan import prior_max


def py_donor_id(email, salt):
    return base64.urlsafe_b64encode(hashlib.md5((salt + email).encode()).digest()).decode()[:12]


def test_donor_id_matches_python(spark):
    emails = ["someone@example.org", "x+y@example.net", "Ünïcode@example.com"]
    df = spark.createDataFrame([(e,) for e in emails], "e string")
    got = [r[0] for r in df.select(DN.donor_id(F.col("e"), "salt")).collect()]
    assert got == [py_donor_id(e, "salt") for e in emails]


def _events(spark, rows):
    return spark.createDataFrame(rows, "arrival long, email string, paid_at timestamp, paid_day date, "
                                       "amount double, is_recurring boolean, city string")


def test_rollup_sequence(spark):
    # first 50 on 06-07, same event again, 75 on 06-26 (debate + eoq), 5 recurring on 07-26 (eom)
    t = dt.datetime
    rows = [
        (1, "a@example.org", t(2019, 6, 7, 19, 49, 39), dt.date(2019, 6, 7), 50.0, False, "Here"),
        (2, "a@example.org", t(2019, 6, 7, 19, 49, 39), dt.date(2019, 6, 7), 50.0, False, "Here"),
        (3, "a@example.org", t(2019, 6, 26, 12, 0, 0), dt.date(2019, 6, 26), 75.0, False, "There"),
        (4, "a@example.org", t(2019, 7, 26, 12, 0, 0), dt.date(2019, 7, 26), 5.0, True, "There"),
        (5, "a@example.org", t(2019, 7, 1, 12, 0, 0), dt.date(2019, 7, 1), 99.0, False, "Late"),
        (6, "", t(2019, 7, 1, 12, 0, 0), dt.date(2019, 7, 1), 1.0, False, "Nobody"),
    ]
    r = DN.donor_rollup(_events(spark, rows), "email", "arrival", "paid_at", "paid_day", "amount",
                        "is_recurring", ["city"], "salt").collect()
    assert len(r) == 1
    r = r[0]
    assert r["total_donation_amount"] == 130.0
    assert r["badges"] == ["debate", "eom", "eoq", "recurring"]
    assert r["last_donation_amount"] == 5.0 and r["city"] == "There"
    assert r["n_donations"] == 3
    assert r["donor_id"] == py_donor_id("a@example.org", "salt")


def test_eastern_date_of_utc_payment(spark):
    t = dt.datetime
    rows = [(1, "b@example.org", t(2019, 6, 7, 2, 0, 0), dt.date(2019, 6, 6), 1.0, False, "X")]
    r = DN.donor_rollup(_events(spark, rows), "email", "arrival", "paid_at", "paid_day", "amount",
                        "is_recurring", ["city"], "salt").first()
    assert r["last_donation_dt"] == "2019-06-06"


def test_prior_max_equals_window_across_buckets(spark):
    import random
    rnd = random.Random(7)
    rows = [(k, a, rnd.randint(0, 50)) for k in ("hot", "a", "b") for a in rnd.sample(range(1000), 120)]
    df = spark.createDataFrame(rows, "k string, arrival long, v long")
    got = prior_max(df, ["k"], "arrival", "v", "p", bucket_width=16)
    w = Window.partitionBy("k").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("p", F.max("v").over(w))
    assert sorted(got.collect()) == sorted(want.collect())
