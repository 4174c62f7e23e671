"""Donor stream: multi-batch state, re-delivery, corrupt bodies, gate, archive keys."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from canvass.streaming import donations as SD


def _event(arrival, email, paid, amount, recurring=False, order="AB1"):
    return {"donor": {"firstname": "Pat", "lastname": "Doe", "city": "Town", "email": email, "phone": "5105550123"},
            "contribution": {"orderNumber": order, "isRecurring": recurring},
            "lineitems": [{"sequence": 1, "amount": str(amount), "paidAt": paid}],
            "received_at": "2019-06-07T20:32:24Z", "arrival": arrival}


def test_stream_state_over_three_batches(spark):
    root = tempfile.mkdtemp(prefix="canvass-stream-test-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    batches = [
        [_event(1, "a@example.org", "2019-06-07T15:49:39-04:00", 50.0)],
        [_event(2, "a@example.org", "2019-06-07T15:49:39-04:00", 50.0),      # same event again
         _event(3, "a@example.org", "2019-06-26T10:00:00-04:00", 75.0)],
        [_event(4, "a@example.org", "2019-07-26T10:00:00-04:00", 5.0, recurring=True),
         _event(5, "b@example.org", "2019-06-10T10:00:00-04:00", 20.0)],
    ]
    for i, b in enumerate(batches):
        with open(os.path.join(src, f"part-{i}.json"), "w") as fh:
            for e in b:
                fh.write(json.dumps(e) + "\n")
            if i == 1:
                fh.write("{not json\n")
        os.utime(os.path.join(src, f"part-{i}.json"), (1_000_000 + i, 1_000_000 + i))
    good, bad = SD.read_donations(spark, src, streaming=True, max_files_per_trigger=1)
    donors = SD.donor_table(spark, os.path.join(root, "donors"))
    SD.donor_stream(SD.flatten_donation(good), donors, os.path.join(root, "ck")).trigger(availableNow=True).start().awaitTermination()
    got = {r["email"]: r for r in SD.donor_rows(donors.latest(), "salt").collect()}
    a = got["a@example.org"]
    assert a["total_donation_amount"] == 130.0 and a["n_donations"] == 3
    assert a["badges"] == "debate,eom,eoq,recurring"
    assert a["last_donation_dt"] == "2019-07-26"
    assert got["b@example.org"]["total_donation_amount"] == 20.0
    # three micro-batches -> donor a has versions 1..3 in the log
    assert sorted(r["version"] for r in donors.log().where("email = 'a@example.org'").collect()) == [1, 2, 3]
    # the broken body is routed to the reject side in batch mode
    _, bad_b = SD.read_donations(spark, src, streaming=False)
    assert len(bad_b.collect()) == 1


def test_gate_and_archive_key(spark):
    rows = [(dt.datetime(2023, 2, 11, 18, 5, 3), dt.datetime(2023, 2, 11, 18, 41, 50), "ORD-17"),
            (dt.datetime(2023, 2, 11, 19, 0, 0), dt.datetime(2023, 2, 12, 1, 32, 0), "X"),
            (dt.datetime(2023, 2, 12, 4, 0, 0), dt.datetime(2023, 2, 12, 4, 1, 0), "Y")]
    df = spark.createDataFrame(rows, "paid_at timestamp, received_at timestamp, order_number string")
    lag = SD.with_lag(df)
    r = lag.select(SD.gate(F.col("lag_seconds"), F.col("received_at")).alias("send"),
                   SD.archive_key("donations", F.col("received_at"), F.col("paid_at"), F.col("order_number"))
                   .alias("key")).collect()
    assert [x["send"] for x in r] == [True, False, True]
    assert r[0]["key"] == "donations/2023-02-11_18:41:50_2023-02-11_18:05:03_ORD-17.json"


def _write_events(root, events):
    src = os.path.join(root, "in")
    os.makedirs(src, exist_ok=True)
    with open(os.path.join(src, "part-0.json"), "w") as fh:
        for e in events:
            fh.write(json.dumps(e) + "\n")
    return src


def _with_received(e, received):
    e = dict(e)
    e["received_at"] = received
    return e


def test_opt_in_lag_metrics_and_archive_streams(spark):
    root = tempfile.mkdtemp(prefix="canvass-streams-")
    evs = [
        _with_received(_event(1, "a@example.org", "2019-06-07T15:49:39-04:00", 50.0, order="A1"),
                       "2019-06-07T20:32:24Z"),                                  # 43 min lag, 20:32 UTC: send
        _with_received(_event(2, "b@example.org", "2019-06-07T15:00:00-04:00", 10.0, order="A2"),
                       "2019-06-08T01:32:00Z"),                                  # 6.5 h lag, 01:32 UTC: hold
        _with_received(_event(3, "c@example.org", "2019-06-08T00:00:00-04:00", 10.0, order="A3"),
                       "2019-06-08T04:01:00Z"),                                  # 1 min lag: send
    ]
    evs[2]["donor"]["phone"] = "(415) 555-0199"
    src = _write_events(root, evs)
    profiles = spark.createDataFrame([("15105550123",)], "phone_number string")   # a@ and b@ share this phone
    good, _ = SD.read_donations(spark, src, streaming=True)
    flat = SD.flatten_donation(good)

    q = (SD.opt_in(flat, profiles).select("order_number", "phone11").writeStream.format("parquet")
         .option("path", os.path.join(root, "optin")).option("checkpointLocation", os.path.join(root, "ck1"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = [(r["order_number"], r["phone11"]) for r in spark.read.parquet(os.path.join(root, "optin")).collect()]
    assert got == [("A3", "14155550199")]

    q = (SD.lag_metrics(flat).select(F.col("w.start").alias("start"), "avg_lag_seconds", "max_lag_seconds", "events")
         .writeStream.format("parquet").outputMode("append").option("path", os.path.join(root, "lag"))
         .option("checkpointLocation", os.path.join(root, "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    q2 = SD.archive(good.select("donor", "contribution", "lineitems", "received_at", "arrival")
                    .transform(SD.flatten_donation), os.path.join(root, "arch"), os.path.join(root, "ck3")) \
        .trigger(availableNow=True).start()
    q2.awaitTermination()
    keys = sorted(r["archive_key"] for r in spark.read.json(os.path.join(root, "arch")).collect())
    assert keys[0] == "donations/2019-06-07_20:32:24_2019-06-07_19:49:39_A1.json"
    assert len(keys) == 3


def _flat(spark, rows):
    """(arrival, email, phone, paid minute, received minute, amount) as flattened donations; minutes from midday."""
    noon = dt.datetime(2020, 2, 3, 12)
    return spark.createDataFrame(
        [(a, noon + dt.timedelta(minutes=r), e, p, "Pat", "Doe", "Town", f"N{a}", False, m, noon + dt.timedelta(minutes=paid), "2020-02-03")
         for a, e, p, paid, r, m in rows],
        "arrival long, received_at timestamp, email string, phone string, firstname string, lastname string, city string, order_number string, "
        "is_recurring boolean, amount double, paid_at timestamp, paid_local_day string")


def test_repeated_batch_changes_nothing_and_wholes_are_kept(spark):
    root = tempfile.mkdtemp(prefix="canvass-keyed-")
    donors = SD.donor_table(spark, root)
    donors.full_every = 2
    batches = [[(1, "a", None, 5, 6, 10.0), (2, "a", None, 4, 6, 99.0), (3, "a", None, 6, 7, None)],
               [(4, "a", None, 6, 8, 99.0), (5, "b", None, 1, 2, 7.0), (6, "", None, 1, 2, 7.0), (7, None, None, 1, 2, 7.0)],
               [(8, "a", None, 9, 9, 1.5), (9, "b", None, 1, 9, 50.0)], [], [(10, "b", None, 20, 20, 2.0)]]

    def state():
        return sorted((r["email"], r["total"], r["n"], r["version"]) for r in donors.latest().collect())

    for i, rows in enumerate(batches):
        SD.merge_donors(_flat(spark, rows) if rows else _flat(spark, batches[0]).limit(0), i, donors)
        once = state()
        for again in {i, max(0, i - 1)} - ({i - 1} if i % 2 == 0 else set()):    # the batch that failed last may run again
            SD.merge_donors(_flat(spark, batches[again]) if batches[again] else _flat(spark, batches[0]).limit(0), again, donors)
            assert state() == once
    assert state() == [("a", 11.5, 3, 2), ("b", 9.0, 2, 2)]
    assert spark.read.parquet(root).where("kind = 'full'").select("batch").distinct().count() == 2


def test_a_donor_with_most_events_is_cut_into_ranges(spark):
    n = 200_000
    rows = spark.range(n).select(
        F.col("id").alias("arrival"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("d"), F.col("id").cast("string"))).otherwise("hot").alias("email"),
        F.timestamp_micros(F.pmod(F.col("id") * 7919, F.lit(n)) * 1_000_000).alias("paid_at"), F.lit("2020-02-03").alias("paid_local_day"),
        F.lit(1.0).alias("amount"), F.lit(False).alias("is_recurring"), *[F.lit("x").alias(c) for c in ("firstname", "lastname", "city")])
    donors = SD.donor_table(spark, tempfile.mkdtemp(prefix="canvass-hot-"))
    for batch, half in enumerate((rows.where(f"arrival < {n // 2}"), rows.where(f"arrival >= {n // 2}"))):
        SD.merge_donors(half, batch, donors)
    top, count = -1, 0
    for i in range(n):
        if i % 3 and i * 7919 % n > top:
            top, count = i * 7919 % n, count + 1
    hot = donors.latest().where("email = 'hot'").first()
    assert (hot["n"], hot["total"], hot["last_paid_us"]) == (count, float(count), top * 1_000_000)


def test_every_phone_is_sent_once(spark):
    root = tempfile.mkdtemp(prefix="canvass-subscribers-")
    known = spark.createDataFrame([("4155550100",)], "phone_number string")
    sent = SD.subscriber_table(spark, os.path.join(root, "sent"))
    deliveries = [[(1, "a", "5155550101", 0, 1, 1.0), (2, "b", "(515) 555-0101", 1, 2, 1.0), (3, "c", "415 555 0100", 1, 2, 1.0)],
                  [(4, "d", "1 515 555 0101", 3, 4, 1.0), (5, "e", "5155550102", -900, 800, 1.0), (6, "f", None, 1, 2, 1.0), (7, "g", "none", 1, 2, 1.0)],
                  [(8, "h", "5155550102", 5, 6, 1.0), (9, "i", "5155550103", 5, 6, 1.0), (10, "i", "5155550103", 5, 6, 1.0)]]
    for rows in deliveries:     # the stream starts anew each time, from its checkpoint
        df = _flat(spark, rows)
        df.write.mode("append").parquet(os.path.join(root, "in"))
        stream = spark.readStream.schema(df.schema).parquet(os.path.join(root, "in"))
        SD.subscriber_stream(stream, sent, known, os.path.join(root, "ck")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r["phone11"], r["arrival"], r["batch"]) for r in sent.log().collect())
    # the second phone was too late at night at first: 0102 comes with its next event
    assert got == [("15155550101", 1, 0), ("15155550102", 8, 2), ("15155550103", 9, 2)]


def test_late_events_are_a_side_output(spark):
    root = tempfile.mkdtemp(prefix="canvass-lag-")
    windows, out = SD.lag_table(spark, os.path.join(root, "w")), os.path.join(root, "out")
    batches = [[(1, "a", None, 0, 1, 1.0), (2, "a", None, 0, 3, 1.0), (3, "a", None, 10, 12, 1.0)],
               [(4, "a", None, 0, 4, 1.0), (5, "a", None, 20, 21, 1.0)],       # minute 4: its window ended, the mark is 12 - 10 = 2
               [(6, "a", None, 0, 2, 1.0), (7, "a", None, 11, 13, 1.0)]]       # the mark is 11: minute 2 is late, minute 13 is not
    for i, rows in enumerate(batches):
        for _ in range(2):                                                     # a repeated batch changes nothing
            SD.merge_lag(_flat(spark, rows), i, windows, out)
    noon = dt.datetime(2020, 2, 3, 12)

    def minute(r):
        return int((r["window_start"] - noon).total_seconds() // 60)

    closed = sorted((minute(r), r["avg_lag_seconds"], r["max_lag_seconds"], r["events"]) for r in spark.read.parquet(f"{out}/closed").collect())
    assert closed == [(0, 160.0, 240.0, 3)]
    assert [(r["arrival"], minute(r)) for r in spark.read.parquet(f"{out}/late").collect()] == [(6, 0)]
    still = sorted((minute(r), r["events"]) for r in windows.latest().where("open and events > 0").collect())
    assert still == [(10, 2), (20, 1)]
