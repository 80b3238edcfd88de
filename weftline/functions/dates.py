"""Dates as they come in mail headers, commit logs and API records."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone names of RFC 822 and their offsets.
ZONE_OFFSETS = {
    "UT": "+0000",
    "UTC": "+0000",
    "GMT": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}

_CLOCK = r"(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4}|\d{2})\s+(\d{2}:\d{2}(?::\d{2})?)"
_MAIL = _CLOCK + r"(?:\s+([+-]\d{4}|[A-Z]{1,3}))?"
_COMMIT = r"^[A-Z][a-z]{2} ([A-Z][a-z]{2}) +(\d{1,2}) (\d{2}:\d{2}:\d{2}) (\d{4}) ([+-]\d{4})$"


def _clock_instant(c: Column, pattern: str, zone: Column) -> Column:
    def part(i: int) -> Column:
        return F.regexp_extract(c, pattern, i)

    # A year of two digits is 1950 to 2049; a clock may leave out the seconds.
    century = F.when(F.length(part(3)) > 2, "").when(part(3) < "50", "20").otherwise("19")
    seconds = F.when(F.length(part(4)) > 5, "").otherwise(":00")
    text = F.concat_ws(" ", part(1), F.initcap(part(2)), F.concat(century, part(3)), F.concat(part(4), seconds), zone)
    return F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss Z"))


def mail_instant(c: Column) -> Column:
    """A mail ``Date`` header as an instant; no zone counts as UTC, no date gives null.

    The weekday is skipped: Spark does not parse weekday names.
    """
    zone = F.regexp_extract(c, _MAIL, 5)
    names = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])
    offset = F.when(zone == "", "+0000").when(zone.rlike(r"^[+-]"), zone).otherwise(
        F.coalesce(F.try_element_at(names, zone), F.lit("+0000"))
    )
    return _clock_instant(c, _MAIL, offset)


def received_instant(c: Column) -> Column:
    """The first clock in a ``Received`` header, taken as UTC."""
    return _clock_instant(c, _CLOCK, F.lit("+0000"))


def message_instant(date_header: Column, received: Column) -> Column:
    return F.coalesce(mail_instant(date_header), received_instant(received))


def _commit_part(c: Column, i: int) -> Column:
    return F.regexp_extract(c, _COMMIT, i)


def commit_day(c: Column) -> Column:
    """The calendar day of a commit in its author's own zone."""
    text = F.concat_ws(" ", *[_commit_part(c, i) for i in (1, 2, 4)])
    return F.try_to_timestamp(text, F.lit("MMM d yyyy")).cast("date")


def commit_instant(c: Column) -> Column:
    text = F.concat_ws(" ", *[_commit_part(c, i) for i in (1, 2, 3, 4, 5)])
    return F.try_to_timestamp(text, F.lit("MMM d HH:mm:ss yyyy Z"))


def iso_date(c: Column) -> Column:
    return c.try_cast("date")


def from_epoch(c: Column) -> Column:
    return F.timestamp_seconds(c)


def checked_date(text: str) -> date:
    """A ``yyyy-mm-dd`` job parameter; anything else is refused."""
    return date.fromisoformat(text)


def day_before(run_date: str) -> Column:
    return F.date_sub(F.lit(checked_date(run_date)), 1)
