"""Donation event streams (SRC2, ST1-ST6, SNK1).

* ``read_donations``: JSON events with a fixed schema; bodies that do not
  parse land in ``bad`` (the corrupt-record column), the rest in ``good``.
* ``donor_stream``: per-email state in a ``KeyedTable``. An event whose paid time
  is not later than the key's high-water mark is dropped (a per-key rule — a
  global watermark would drop other donors' events).
* ``lag_stream`` (ST3, re-aimed as tumbling windows with a watermark; late events
  are a side output), ``gate`` (ST4), ``opt_in`` and ``subscriber_stream`` (ST5:
  every phone once), ``archive`` and ``archive_cancellations`` (ST6, SNK1 keys).

The streams with memory are ``foreachBatch`` jobs over a ``KeyedTable``: every
step is a DataFrame job, no key's rows are one task's, and a repeated micro-batch
changes nothing. ``lag_metrics`` is the same windows by Spark's own watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canvass.functions import contacts as C
from canvass.functions import timefmt as TF
from canvass.operators.donors import DEBATE_DAYS, badges, donor_id
from canvass.operators.scan import prior_max
from canvass.streaming.keyed import KeyedTable, write_batch

_S, _B, _I, _L, _D = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


DONATION_SCHEMA = _st(
    ("donor", _st(("firstname", _S), ("lastname", _S), ("addr1", _S), ("city", _S), ("state", _S),
                  ("zip", _S), ("country", _S), ("isEligibleForExpressLane", _B),
                  ("employerData", _st(("employer", _S), ("occupation", _S), ("employerAddr1", _S),
                                       ("employerCity", _S), ("employerState", _S), ("employerCountry", _S))),
                  ("email", _S), ("phone", _S))),
    ("contribution", _st(("createdAt", _S), ("orderNumber", _S), ("contributionForm", _S), ("refcode", _S),
                         ("refcode2", _S), ("creditCardExpiration", _S), ("recurringPeriod", _S),
                         ("recurringDuration", _I), ("abTestName", _S), ("abTestVariation", _S),
                         ("isRecurring", _B), ("isPaypal", _B), ("isMobile", _B), ("isExpress", _B),
                         ("withExpressLane", _B), ("expressSignup", _B), ("uniqueIdentifier", _S),
                         ("status", _S), ("thanksUrl", _S), ("cancelledAt", _S), ("recurringType", _S),
                         ("recurCompleted", _I), ("recurPledged", _I))),
    ("lineitems", T.ArrayType(_st(("sequence", _I), ("entityId", _I), ("fecId", _S), ("committeeName", _S),
                                  ("amount", _S), ("paidAt", _S), ("lineitemId", _L)))),
    ("received_at", T.TimestampType()),
    ("arrival", _L),
)
CORRUPT = "_corrupt_record"


def read_donations(spark: SparkSession, path: str, streaming: bool = True,
                   max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC2: (good, bad) donation events from JSON files under ``path``."""
    schema = T.StructType(DONATION_SCHEMA.fields + [T.StructField(CORRUPT, _S, True)])
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.json(path)
    # Rejects keep their raw text plus context columns (a scan may not read
    # the corrupt-record column alone).
    bad = raw.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, "arrival", "received_at")
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def flatten_donation(events: DataFrame) -> DataFrame:
    """One row per event: last line item's amount and paid time; the paid
    time's own calendar date (offset-local, from the text) for badges."""
    last = F.try_element_at(F.col("lineitems"), F.lit(-1))
    paid_txt = last["paidAt"]
    return events.select(
        "arrival", "received_at",
        F.col("donor.email").alias("email"), F.col("donor.phone").alias("phone"),
        F.col("donor.firstname").alias("firstname"), F.col("donor.lastname").alias("lastname"),
        F.col("donor.city").alias("city"), F.col("donor.state").alias("state"), F.col("donor.zip").alias("zip"),
        F.col("contribution.orderNumber").alias("order_number"),
        F.coalesce(F.col("contribution.isRecurring"), F.lit(False)).alias("is_recurring"),
        last["amount"].try_cast("double").alias("amount"),
        F.try_to_timestamp(paid_txt).alias("paid_at"),
        F.substring(paid_txt, 1, 10).alias("paid_local_day"))


# ---------------------------------------------------------------- ST1 / ST2
DONOR_STATE = _st(("email", _S), ("last_paid_us", _L), ("total", _D), ("last_amount", _D), ("firstname", _S),
                  ("lastname", _S), ("city", _S), ("badges", T.ArrayType(_S)), ("n", _L), ("version", _L))


def donor_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, DONOR_STATE, ["email"])


def merge_donors(flat: DataFrame, batch: int, donors: KeyedTable, debate_days: list[str] = DEBATE_DAYS) -> None:
    """ST1 + ST2: one micro-batch of events into the donors' state.

    An event counts if it was paid later than every event of its donor that
    arrived before, in this batch (a scan over ranges of arrivals, so a donor
    with very many events is spread over tasks) or in earlier ones (the state).
    Counted events are added up in the JVM, partially before the shuffle.
    """
    day = F.to_date(F.col("paid_local_day"))
    amount = F.coalesce(F.nanvl("amount", F.lit(0.0)), F.lit(0.0))
    events = (flat.filter(F.col("email").isNotNull() & (F.col("email") != "") & F.col("paid_at").isNotNull())
              .select("email", "arrival", F.unix_micros("paid_at").alias("paid_us"), amount.alias("amount"),
                      "firstname", "lastname", "city", badges(day, F.col("is_recurring"), debate_days).alias("badges")))
    before = donors.before(batch)
    placed = prior_max(events, ["email"], "arrival", "paid_us", "_earlier").join(
        before.select("email", F.col("last_paid_us").alias("_floor")), "email", "left")
    latest = F.greatest("_earlier", "_floor")
    counted = placed.where(latest.isNull() | (F.col("paid_us") > latest))
    new = counted.groupBy("email").agg(
        F.sum("amount").alias("_sum"), F.count(F.lit(1)).alias("_n"), F.max("paid_us").alias("_last"),
        F.max_by(F.struct("amount", "firstname", "lastname", "city"), "paid_us").alias("_event"),
        F.collect_set("badges").alias("_badges"))     # a few kinds of badges: few sets of them
    merged = new.join(before.select("email", "total", "n", "version", "badges"), "email", "left")
    none = F.array().cast("array<string>")
    donors.put(merged.select(
        "email", F.col("_last").alias("last_paid_us"), (F.coalesce("total", F.lit(0.0)) + F.col("_sum")).alias("total"),
        F.col("_event.amount").alias("last_amount"), "_event.firstname", "_event.lastname", "_event.city",
        F.array_sort(F.array_union(F.coalesce("badges", none), F.flatten("_badges"))).alias("badges"),
        (F.coalesce("n", F.lit(0)) + F.col("_n")).alias("n"), (F.coalesce("version", F.lit(0)) + 1).cast("bigint").alias("version")), batch)


def donor_stream(flat: DataFrame, donors: KeyedTable, checkpoint: str, debate_days: list[str] = DEBATE_DAYS):
    """ST1 + ST2 as a running stream: a writer that keeps ``donors``, keyed by the e-mail exactly as received."""
    return _each_batch(flat, checkpoint, lambda rows, batch: merge_donors(rows, batch, donors, debate_days))


def donor_rows(state: DataFrame, salt: str) -> DataFrame:
    """Donors as users see them, from rows of their state."""
    ts = F.timestamp_micros("last_paid_us")
    return state.select("email", donor_id(F.col("email"), salt).alias("donor_id"), F.col("total").alias("total_donation_amount"),
                        F.col("last_amount").alias("last_donation_amount"), ts.alias("last_donation_ts"),
                        TF.eastern_date(ts).alias("last_donation_dt"), "firstname", "lastname", "city",
                        F.array_join("badges", ",").alias("badges"), F.col("n").alias("n_donations"), "version")


def _each_batch(stream: DataFrame, checkpoint: str, work):
    """A writer that gives every micro-batch, held for as long as it is read, to ``work(rows, batch)``."""
    def run(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        try:
            work(rows, batch)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


# ---------------------------------------------------------------- ST3-ST6
LAG_THRESHOLD_SECONDS = 300


def with_lag(flat: DataFrame, faithful: bool = False) -> DataFrame:
    return flat.withColumn("lag_seconds", TF.lag_seconds(F.col("paid_at"), F.col("received_at"), faithful))


def lag_metrics(flat: DataFrame, window: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """ST3 (re-aimed): average and maximum lag per tumbling window of receipt time."""
    return (with_lag(flat).withWatermark("received_at", watermark)
            .groupBy(F.window("received_at", window).alias("w"))
            .agg(F.avg("lag_seconds").alias("avg_lag_seconds"), F.max("lag_seconds").alias("max_lag_seconds"),
                 F.count(F.lit(1)).alias("events")))


# A window's sums while it is open; one row without a window keeps the latest receipt.
LAG_STATE = _st(("window_start", T.TimestampType()), ("latest", T.TimestampType()), ("lag_sum", _D), ("lag_max", _D), ("events", _L), ("open", _B))
_CLOCK = "1970-01-01 00:00:00"


def merge_lag(flat: DataFrame, batch: int, windows: KeyedTable, out: str, window: str = "5 minutes", delay: str = "10 minutes") -> None:
    """ST3: one micro-batch of events into the open windows.

    The watermark is the latest receipt of earlier batches less ``delay``. Events
    of windows that ended by then are written to ``out``/late, not dropped; the
    others join their window. Windows that end by the new watermark are written
    to ``out``/closed and leave the open ones.
    """
    end = F.col("window_start") + F.expr(f"interval {window}")
    clock = F.lit(_CLOCK).cast("timestamp")
    before = windows.before(batch)
    seen = before.where(F.col("window_start") == clock).agg(F.max("latest").alias("latest")).first()["latest"]
    x = with_lag(flat).where("received_at is not null").withColumn("window_start", F.window("received_at", window)["start"])
    mark = F.lit(seen).cast("timestamp") - F.expr(f"interval {delay}")
    late = F.coalesce(end <= mark, F.lit(False))
    write_batch(x.where(late), f"{out}/late", batch)
    new = x.where(~late).groupBy("window_start").agg(
        F.max("received_at").alias("_latest"), F.sum("lag_seconds").cast("double").alias("_sum"),
        F.max("lag_seconds").cast("double").alias("_max"), F.count(F.lit(1)).alias("_n"))
    was = before.where("open and events > 0")
    both = was.join(new, "window_start", "full").select(
        "window_start", F.greatest("latest", "_latest").alias("latest"),
        (F.coalesce("lag_sum", F.lit(0.0)) + F.coalesce("_sum", F.lit(0.0))).alias("lag_sum"), F.greatest("lag_max", "_max").alias("lag_max"),
        (F.coalesce("events", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("events"))
    latest = x.agg(F.max("received_at").alias("latest")).first()["latest"]
    latest = max((t for t in (seen, latest) if t is not None), default=None)
    both = both.withColumn("open", ~F.coalesce(end <= F.lit(latest).cast("timestamp") - F.expr(f"interval {delay}"), F.lit(False)))
    tick = flat.sparkSession.range(1).select(
        clock.alias("window_start"), F.lit(latest).cast("timestamp").alias("latest"), F.lit(0.0).alias("lag_sum"),
        F.lit(None).cast("double").alias("lag_max"), F.lit(0).cast("bigint").alias("events"), F.lit(True).alias("open"))
    windows.put(both.unionByName(tick), batch)
    write_batch(both.where("not open").select("window_start", (F.col("lag_sum") / F.col("events")).alias("avg_lag_seconds"),
                                              F.col("lag_max").alias("max_lag_seconds"), "events"), f"{out}/closed", batch)


def lag_stream(flat: DataFrame, windows: KeyedTable, out: str, checkpoint: str, window: str = "5 minutes", delay: str = "10 minutes"):
    """ST3 as a running stream with late events as a side output."""
    return _each_batch(flat, checkpoint, lambda rows, batch: merge_lag(rows, batch, windows, out, window, delay))


def lag_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, LAG_STATE, ["window_start"])


def gate(lag: Column, received: Column) -> Column:
    """ST4: with more than 300 s of lag, only inside sending hours (UTC hour
    >= 13 or < 1); otherwise always. Exactly 300 s is not "lots of lag"."""
    return (lag <= LAG_THRESHOLD_SECONDS) | TF.event_send_ok(received)


def opt_in(flat: DataFrame, profiles: DataFrame, phone_col: str = "phone_number",
           whitelist: list[str] | None = None) -> DataFrame:
    """ST5: new SMS subscribers: a valid phone, not already a profile (any
    status), passing the lag gate, optionally on a whitelist."""
    x = with_lag(flat).withColumn("phone11", C.extract_phone(F.col("phone")))
    x = x.filter(F.col("phone11").isNotNull() & gate(F.col("lag_seconds"), F.col("received_at")))
    if whitelist:
        x = x.filter(F.col("phone11").isin(whitelist))
    known = profiles.select(C.phone10(F.col(phone_col)).alias("_p10")).distinct()
    return x.join(known, C.phone10(F.col("phone11")) == F.col("_p10"), "left_anti")


SUBSCRIBER = _st(("phone11", _S), ("arrival", _L), ("email", _S), ("firstname", _S), ("lastname", _S), ("order_number", _S))


def subscriber_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, SUBSCRIBER, ["phone11"])


def merge_subscribers(flat: DataFrame, batch: int, sent: KeyedTable, profiles: DataFrame, **how) -> None:
    """ST5: of one micro-batch, the first event of every phone that ``opt_in`` lets through and that was not sent before."""
    first = opt_in(flat, profiles, **how).groupBy("phone11").agg(
        F.min_by(F.struct("arrival", "email", "firstname", "lastname", "order_number"), "arrival").alias("_e"))
    first = first.select("phone11", "_e.*")
    sent.put(first.join(sent.before(batch).select("phone11"), "phone11", "left_anti"), batch)


def subscriber_stream(flat: DataFrame, sent: KeyedTable, profiles: DataFrame, checkpoint: str, **how):
    """ST5 as a running stream: every new phone is sent once, in whichever batch it first comes."""
    return _each_batch(flat, checkpoint, lambda rows, batch: merge_subscribers(rows, batch, sent, profiles, **how))


def archive_key(prefix: str, as_of: Column, event_ts: Column, order: Column) -> Column:
    """SNK1: ``prefix/<now>_<event time>_<order>.json``, times in UTC as
    ``yyyy-MM-dd_HH:mm:ss``."""
    return F.concat(F.lit(prefix + "/"), F.date_format(as_of, TF.ARCHIVE_TIME_FORMAT), F.lit("_"),
                    F.date_format(event_ts, TF.ARCHIVE_TIME_FORMAT), F.lit("_"), order, F.lit(".json"))


def archive(events: DataFrame, out_path: str, checkpoint: str, prefix: str = "donations"):
    """ST6: archive every event as received, keyed per SNK1 and partitioned
    by receipt date; one streaming query (exactly-once file sink)."""
    keyed = events.withColumn("archive_key", archive_key(prefix, F.col("received_at"), F.col("paid_at"),
                                                         F.col("order_number"))) \
                  .withColumn("event_date", F.to_date("received_at"))
    return (keyed.writeStream.format("json").option("path", out_path).option("checkpointLocation", checkpoint)
            .partitionBy("event_date").outputMode("append"))


def archive_cancellations(events: DataFrame, out_path: str, checkpoint: str):
    """ST6: the second archive stream: cancelled donations, keyed by the time they were cancelled at."""
    cancelled = events.select(
        "*", F.try_to_timestamp(F.col("contribution.cancelledAt")).alias("paid_at"), F.col("contribution.orderNumber").alias("order_number"))
    return archive(cancelled.where("paid_at is not null"), out_path, checkpoint, "cancellations")
