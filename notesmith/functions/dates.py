"""Date expressions (O-D1..D4). Bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notesmith.functions.common import WS, col, py_strip

RFC_PATTERN = "d MMM yyyy HH:mm:ss Z"

# Zone names of RFC 822 dates and their offsets.
RFC_ZONES = (("GMT", "+0000"), ("UTC", "+0000"), ("UT", "+0000"), ("Z", "+0000"), ("EST", "-0500"),
             ("EDT", "-0400"), ("CST", "-0600"), ("CDT", "-0500"), ("MST", "-0700"), ("MDT", "-0600"),
             ("PST", "-0800"), ("PDT", "-0700"))


def rfc_normalized(c) -> Column:
    """Weekday and trailing comment dropped, seconds and century filled in, a zone name replaced by its numeric offset."""
    s = F.regexp_replace(py_strip(col(c)), f"^[A-Za-z]{{3}},{WS}*|{WS}*\\([^()]*\\)$", "")
    s = F.regexp_replace(s, f"{WS}+", " ")
    s = F.regexp_replace(s, "^(\\d{1,2} [A-Za-z]{3}) ([0-4]\\d) ", "$1 20$2 ")
    s = F.regexp_replace(s, "^(\\d{1,2} [A-Za-z]{3}) ([5-9]\\d) ", "$1 19$2 ")
    s = F.regexp_replace(s, "^(\\d{1,2} [A-Za-z]{3} \\d{4} \\d{2}:\\d{2}) ", "$1:00 ")
    for name, off in RFC_ZONES:
        s = F.regexp_replace(s, f" {name}$", f" {off}")
    return s


def rfc2822_to_timestamp(c) -> Column:
    """O-D1 / O-D3: 'Tue, 5 May 2026 04:15:00 +0000' or '... GMT' (weekday optional) -> timestamp, else null."""
    return F.try_to_timestamp(rfc_normalized(c), F.lit(RFC_PATTERN))


def iso_to_timestamp(c) -> Column:
    """O-D2: ISO-8601 with 'Z' or an offset -> timestamp, else null."""
    return F.try_to_timestamp(col(c))


def feed_timestamp(c) -> Column:
    """A feed entry's date in either of the two usual forms."""
    return F.coalesce(rfc2822_to_timestamp(c), iso_to_timestamp(c))


def epoch_seconds(ts) -> Column:
    return F.unix_timestamp(col(ts)).cast("bigint")


def utc_date_label(ts) -> Column:
    """O-D4: 'yyyy-MM-dd' of the UTC day, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_timestamp(col(ts)) / 86400).cast("int")).cast("string")


def as_of_label(as_of: str) -> Column:
    """O-D4 for the run date (a fixed parameter, not the wall clock)."""
    return F.date_format(F.to_date(F.lit(as_of)), "yyyy-MM-dd")
