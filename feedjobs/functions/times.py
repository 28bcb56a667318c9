"""Time functions. All timestamps are UTC without a zone; a business day is the one at +08:00."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _later(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds to UTC (the session's zone must be UTC)."""
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def parse_time(text: Column, fallback: Column) -> Column:
    """ISO with Z or an offset, ``EEE MMM dd HH:mm:ss Z yyyy`` or RFC 822, converted to UTC; else ``fallback``.

    The weekday is dropped first, as Spark's parser takes none.
    """
    bare = F.regexp_replace(text, r"^[A-Za-z]{3},? ", "")
    tried = [F.try_to_timestamp(bare, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss[.SSS]XX", "yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX", "MMM dd HH:mm:ss Z yyyy", "dd MMM yyyy HH:mm:ss Z", "dd MMM yyyy HH:mm:ss z")]
    return F.coalesce(*[t.cast("timestamp_ntz") for t in tried], fallback)


def business_day(ts: Column) -> Column:
    return F.to_date(_later(ts, 8))


def in_business_day(ts: Column, day: str) -> Column:
    """Half open: from the day's midnight at +08:00 up to the next."""
    start = F.lit(day).cast("timestamp_ntz")
    return (ts >= _later(start, -8)) & (ts < _later(start, 16))


def within(ts: Column, as_of: str, hours: int) -> Column:
    return ts >= _later(F.lit(as_of).cast("timestamp_ntz"), -hours)


def show_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm 'UTC'")


def show_local(ts: Column, missing: str = "—") -> Column:
    return F.coalesce(F.date_format(_later(ts, 8), "yyyy-MM-dd HH:mm 'CST'"), F.lit(missing))
