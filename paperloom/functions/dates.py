"""Date strings: year extraction, feed dates, request windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from paperloom.functions.text import _col

# The two stored date formats and the feed date format.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATE_FORMAT = "yyyy-MM-dd"
FEED_FORMAT = "d MMM yyyy HH:mm:ss Z"
# Zone names of the feed date format.
ZONES = {
    "GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
WINDOW_DAYS = 2
_FRACTION = r"(:\d\d)\.\d+"


def year_of(c: Column | str, formats: tuple[str, ...] = (TIMESTAMP_FORMAT,)) -> Column:
    """Year of a date string; text in none of ``formats`` gives null."""
    parsed = [F.try_to_timestamp(_col(c), F.lit(fmt)) for fmt in formats]
    return F.year(F.coalesce(*parsed))


def format_utc(ts: Column | str) -> Column:
    """A timestamp as stored text, in UTC whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(_col(ts), F.current_timezone()), TIMESTAMP_FORMAT)


def feed_date(c: Column | str) -> Column:
    """Stored text of a feed date such as ``Mon, 01 Jan 2024 00:00:00 -0500``.

    The weekday and fractions of a second are dropped before parsing, absent seconds are
    0, and zone names are written as offsets; text that is no date gives null.
    """
    text = F.regexp_replace(_col(c), r"^\s*[A-Za-z]{3},\s*", "")
    text = F.regexp_replace(F.btrim(text), _FRACTION, "$1")
    text = F.regexp_replace(text, r"^(\S+ \S+ \S+ \d\d:\d\d)(?=\s)", "$1:00")
    for name, offset in ZONES.items():
        text = F.regexp_replace(text, rf"\b{name}$", offset)
    iso = F.regexp_replace(F.regexp_replace(F.btrim(_col(c)), _FRACTION, "$1"), r"Z$", "+0000")
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit(FEED_FORMAT)),
        F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ssZ")),
        F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
    )
    return format_utc(parsed)


def request_window(
    until: dt.date, days: int = WINDOW_DAYS, start: dt.date | None = None
) -> tuple[dt.date, dt.date]:
    """Inclusive (from, until) of an incremental request; ``until`` is usually today."""
    return (start or until - dt.timedelta(days=days), until)


def year_request(year: int, today: dt.date) -> tuple[dt.date, dt.date]:
    """Inclusive (from, until) of a whole-year request, cut at ``today`` in the current year."""
    end = today if year == today.year else dt.date(year, 12, 31)
    return (dt.date(year, 1, 1), end)


def within(c: Column | str, window: tuple[dt.date, dt.date], kind: str = "string") -> Column:
    """Whether a day lies in an inclusive window, as two bounds a Parquet scan can push down.

    ``kind`` is the column's type: ``string`` (both stored formats sort by day),
    ``date``, or ``timestamp`` without zone.
    """
    start, after = window[0], window[1] + dt.timedelta(days=1)
    if kind == "string":
        low, high = F.lit(start.isoformat()), F.lit(after.isoformat())
    elif kind == "date":
        low, high = F.lit(start), F.lit(after)
    elif kind == "timestamp":
        low = F.lit(start.isoformat()).cast("timestamp_ntz")
        high = F.lit(after.isoformat()).cast("timestamp_ntz")
    else:
        raise ValueError(f"unknown kind: {kind}")
    return (_col(c) >= low) & (_col(c) < high)
