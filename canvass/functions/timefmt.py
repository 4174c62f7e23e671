"""Time helpers.

Every "now" is an ``as_of`` argument. The session time zone is UTC; local
calendars are reached with ``from_utc_timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
CHICAGO = "America/Chicago"
EVENT_TIME_FORMAT = "EEE, MMM d 'at' h:mm a"      # X10: "Tue, Jul 30 at 5:00 PM"
REPORT_TIME_FORMAT = "MM/dd/yyyy HH:mm:ss"         # X11
ARCHIVE_TIME_FORMAT = "yyyy-MM-dd_HH:mm:ss"        # SNK1


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def epoch_seconds(ts) -> Column:
    """Timestamp -> epoch seconds as double (microsecond precision)."""
    return F.unix_micros(_c(ts)) / F.lit(1_000_000.0)


def from_epoch(sec) -> Column:
    """Epoch seconds (double; NaN means null) -> timestamp."""
    s = _c(sec)
    return F.when(~F.isnan(s), F.timestamp_micros(F.round(s * 1_000_000).cast("long")))


def from_epoch_millis(ms) -> Column:
    return F.timestamp_millis(_c(ms).cast("long"))


def local_date(ts, tz: str = NEW_YORK) -> Column:
    return F.to_date(F.from_utc_timestamp(_c(ts), tz))


def recent(ts, as_of: str, days: int, tz: str = NEW_YORK) -> Column:
    """at most ``days`` calendar days before ``as_of`` in zone ``tz``.

    The extra UTC lower bound (``days + 2`` days before ``as_of``, wider than
    any zone offset or DST shift) changes nothing but can be pushed to the scan.
    """
    t = _c(ts)
    as_of_ts = F.lit(as_of).cast("timestamp")
    lower = as_of_ts - F.make_dt_interval(F.lit(days + 2))
    return (t >= lower) & (F.datediff(local_date(as_of_ts, tz), local_date(t, tz)) <= days)


def before_ds(ts, ds: str, tz: str = NEW_YORK) -> Column:
    """local time strictly before the run date."""
    return F.from_utc_timestamp(_c(ts), tz) < F.lit(ds).cast("timestamp")


def batch_send_ok(ts) -> Column:
    """F17 (batch export): UTC hour in [15, 24)."""
    return F.hour(_c(ts)) >= 15


def event_send_ok(ts) -> Column:
    """F17 (donation events): UTC hour >= 13 or < 1."""
    h = F.hour(_c(ts))
    return (h >= 13) | (h < 1)


def lag_seconds(paid, received, faithful: bool = False) -> Column:
    """Seconds from payment to receipt. ``faithful`` wraps every 24 h
    like the reference's ``timedelta.seconds``."""
    s = F.unix_seconds(_c(received)) - F.unix_seconds(_c(paid))
    return F.pmod(s, F.lit(86400)) if faithful else s


def local_event_time(epoch_sec, tz_col) -> Column:
    """Epoch seconds shown in a per-row zone as ``Tue, Jul 30 at 5:00 PM``."""
    ts = F.timestamp_seconds(_c(epoch_sec))
    return F.date_format(F.from_utc_timestamp(ts, _c(tz_col)), EVENT_TIME_FORMAT)


def report_time(ts, tz: str = CHICAGO) -> Column:
    """X11: report time ``MM/dd/yyyy HH:mm:ss`` in US/Central."""
    return F.date_format(F.from_utc_timestamp(_c(ts), tz), REPORT_TIME_FORMAT)


def eastern_date(ts) -> Column:
    """Calendar date in US/Eastern, as text."""
    return F.date_format(F.from_utc_timestamp(_c(ts), NEW_YORK), "yyyy-MM-dd")
