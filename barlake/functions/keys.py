"""Identifiers and instants."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings.
CANONICAL = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
HEX_32 = "^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$"
DASHED = "$1-$2-$3-$4-$5"
ISO_INSTANT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)
# The other spellings: basic forms, week dates, any separator, a comma, hours alone, offsets
# with seconds. Groups: year, month, day, year, week, weekday, time, offset.
ISO_ANY = (
    r"^(?:(\d{4})(?:-(?=\d\d-)|(?!\d{2}-))(\d{2})-?(\d{2})|(\d{4})-?W(\d{2})(?:-?([1-7]))?)"
    r"(?:[^0-9](\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)?)"
    r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?)?$"
)


def key_uuid(*parts: Column) -> Column:
    """A UUID-shaped id computed from a row's natural key.

    ``uuid()`` draws a new value whenever a lost task is run again; this does not.
    """
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.regexp_replace(digest, HEX_32, DASHED)


def parse_uuid(text: Column) -> Column:
    """The canonical form of a UUID in any usual spelling, else NULL."""
    digits = F.regexp_replace(F.lower(text), r"urn:|uuid:|[{}-]", "")
    return F.when(text.rlike(CANONICAL), text).when(
        digits.rlike(HEX_32), F.regexp_replace(digits, HEX_32, DASHED)
    )


def parse_instant(text: Column) -> Column:
    """ISO text to TIMESTAMP: explicit offsets kept, none means the session zone (UTC). The
    common spelling takes one test; the others are put together from their parts."""
    return F.when(text.rlike(ISO_INSTANT), F.try_to_timestamp(text)).when(text.rlike(ISO_ANY), _from_parts(text))


def _from_parts(text: Column) -> Column:
    part = [F.regexp_extract(text, ISO_ANY, n) for n in range(9)]
    plain = F.try_to_date(F.concat_ws("-", part[1], part[2], part[3]))
    # The fourth of January lies in the first week of its year.
    first = F.trunc(F.try_to_date(F.concat(part[4], F.lit("-01-04"))), "week")
    weekday = F.coalesce(F.nullif(part[6], F.lit("")), F.lit("1")).try_cast("int")
    week = part[5].try_cast("int")
    by_week = F.when(week.between(1, 53), F.date_add(first, (week - 1) * 7 + weekday - 1))
    # Week 53 exists only if its Thursday lies in the year.
    by_week = F.when(F.year(F.date_add(first, (week - 1) * 7 + 3)) == part[4].try_cast("int"), by_week)
    date = F.when(part[4] != "", by_week).otherwise(plain)
    digits = F.regexp_replace(F.regexp_replace(part[7], "[.,].*", ""), ":", "")
    fraction = F.substring(F.regexp_extract(part[7], r"[.,](\d+)", 1), 1, 6)
    clock = F.rpad(digits, 6, "0")
    at = F.concat(
        date.cast("string"), F.lit(" "), F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2), F.lit(":"),
        F.substring(clock, 5, 2), F.lit("."), F.rpad(fraction, 6, "0"),
    )
    shift = F.rpad(F.regexp_replace(F.regexp_replace(part[8], r"\..*", ""), "[Z:+-]", ""), 6, "0")
    seconds = (
        F.substring(shift, 1, 2).try_cast("int") * 3600
        + F.substring(shift, 3, 2).try_cast("int") * 60
        + F.substring(shift, 5, 2).try_cast("int")
    )
    behind = F.when(F.startswith(part[8], F.lit("-")), -seconds).otherwise(seconds)
    micros = F.unix_micros(F.try_to_timestamp(at)) - behind.cast("long") * 1_000_000
    return F.when(seconds < 86_400, F.timestamp_micros(micros))


def instant(value: dt.datetime) -> Column:
    """A literal instant; without a zone it means UTC, not the zone of this machine."""
    return F.lit(value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc))


def iso_text(instant: Column) -> Column:
    """ISO text without offset; the fraction is left out when it is zero."""
    return F.regexp_replace(
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", ""
    )
