"""Donation rollup (A13, W7, X13, X14, X15) — the batch twin of the donor stream.

Per donor key: drop events whose paid time is not strictly later than every
earlier-arrived event of the same key (late or repeated notifications), then
sum amounts, keep the latest profile and collect badges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.arrays import present
from canvass.functions.timefmt import eastern_date
from canvass.operators.scan import prior_max

DONOR_ID_LENGTH = 12

# Debate days that earn the debate badge.
DEBATE_DAYS = [
    "2019-06-26", "2019-06-27", "2019-07-30", "2019-07-31", "2019-09-12", "2019-09-13",
    "2019-10-15", "2019-10-16", "2019-11-20", "2019-11-21", "2019-12-19", "2019-12-20",
]
# Badge ids.
BADGE_EOM, BADGE_EOQ, BADGE_DEBATE, BADGE_RECURRING = "eom", "eoq", "debate", "recurring"


def debate_days_for_years(years: range) -> list[str]:
    """The debate month/day pattern repeated over other years (for bindings)."""
    md = sorted({d[5:] for d in DEBATE_DAYS})
    return [f"{y}-{m}" for y in years for m in md]


def donor_id(email: Column, salt: str) -> Column:
    """First 12 characters of url-safe base64 of md5(salt || email)."""
    b64 = F.base64(F.unhex(F.md5(F.concat(F.lit(salt), email))))
    return F.substring(F.translate(b64, "+/", "-_"), 1, DONOR_ID_LENGTH)


def badges(paid_local_date: Column, recurring: Column, debate_days: list[str]) -> Column:
    """Badges earned by one donation, from its offset-local date."""
    day, month = F.dayofmonth(paid_local_date), F.month(paid_local_date)
    debate = F.date_format(paid_local_date, "yyyy-MM-dd").isin(debate_days)
    return present(
        F.when((day >= 26) & (month % 3 != 0), F.lit(BADGE_EOM)),
        F.when((day >= 26) & (month % 3 == 0), F.lit(BADGE_EOQ)),
        F.when(debate, F.lit(BADGE_DEBATE)),
        F.when(recurring, F.lit(BADGE_RECURRING)))


def drop_stale(events: DataFrame, key: str, arrival: str, paid_at: str) -> DataFrame:
    """``accepted`` = paid time strictly later than every earlier arrival's
    (skew-safe running max, see ``scan.prior_max``). Arrival must be
    integral and unique per key."""
    x = prior_max(events, [key], arrival, paid_at, "_prior")
    return x.withColumn("accepted", F.col("_prior").isNull() | (F.col(paid_at) > F.col("_prior"))).drop("_prior")


def donor_rollup(events: DataFrame, key: str, arrival: str, paid_at: str, paid_local_date: str,
                 amount: str, recurring: str, profile: list[str], salt: str,
                 debate_days: list[str] = DEBATE_DAYS) -> DataFrame:
    """One row per donor key over accepted events. Empty keys are skipped.

    Everything is a map-side-combinable aggregate (sum, max_by, set of at most
    four badges), so a donor with a third of all events costs no more than
    one partial row per task.
    """
    ev = events.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    ok = drop_stale(ev, key, arrival, paid_at).filter("accepted")
    ok = ok.withColumn("_badges", badges(F.col(paid_local_date), F.col(recurring), debate_days))
    last = F.struct(*[F.col(c) for c in [paid_at, amount, *profile]])
    agg = ok.groupBy(key).agg(
        F.sum(amount).alias("total_donation_amount"),
        F.max_by(last, F.col(arrival)).alias("_last"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("_badges")))).alias("badges"),
        F.count(F.lit(1)).alias("n_donations"))
    return agg.select(
        key, donor_id(F.col(key), salt).alias("donor_id"),
        "total_donation_amount",
        F.col("_last")[amount].alias("last_donation_amount"),
        F.col("_last")[paid_at].alias("last_donation_ts"),
        eastern_date(F.col("_last")[paid_at]).alias("last_donation_dt"),
        *[F.col("_last")[c].alias(c) for c in profile],
        "badges", "n_donations")
