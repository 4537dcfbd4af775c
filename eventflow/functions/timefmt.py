"""Column helpers for event times: lenient parsing, features, display forms.

Instants are UTC (the session time zone is pinned by ``session.configure``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

ZONE_SUFFIX = r"(?i)(Z|[+-]\d{2}:?\d{2})$"


def parse_start(c) -> Column:
    """Lenient parse of date / datetime / offset text to a UTC timestamp.

    Each row is parsed on its own; anything unparsable becomes null.
    """
    s = col_of(c)
    return F.try_to_timestamp(s.cast("string"))


def wall_clock(c) -> Column:
    """Local wall-clock time of ISO text: the text parsed without its offset."""
    s = F.regexp_replace(F.trim(col_of(c).cast("string")), ZONE_SUFFIX, "")
    return F.try_to_timestamp(s)


def hour_or_missing(ts) -> Column:
    """UTC hour, -1 when the time is missing."""
    return F.coalesce(F.hour(col_of(ts)), F.lit(-1))


def is_weekend(ts) -> Column:
    """1 on Saturday or Sunday (weekday 5..6 with Monday = 0), else 0."""
    return F.coalesce(F.weekday(col_of(ts)).isin(5, 6).cast("int"), F.lit(0))


def display_datetime(ts) -> Column:
    """``%b %d, %Y %I:%M %p`` display form, ``N/A`` when missing."""
    return F.coalesce(F.date_format(col_of(ts), "MMM dd, yyyy hh:mm a"), F.lit("N/A"))


def percent_1(c) -> Column:
    """``{x:.1%}`` display form."""
    return F.concat(F.format_string("%.1f", col_of(c) * 100), F.lit("%"))


def calendar_fields_from(instant, wall, which: str) -> dict:
    """K1 fields from a parsed instant and wall clock: epoch seconds of the
    instant, then date, 12-hour hour, minute and lower-case am/pm of the
    wall clock; all null when the time is missing."""
    ok = instant.isNotNull()
    return {
        f"evcal_{which[0]}row": F.when(ok, F.unix_timestamp(instant).cast("string")),
        f"evcal_{which}_date": F.when(ok, F.date_format(wall, "yyyy-MM-dd")),
        f"evcal_{which}_time_hour": F.when(ok, F.date_format(wall, "hh")),
        f"evcal_{which}_time_min": F.when(ok, F.date_format(wall, "mm")),
        f"evcal_{which}_time_ampm": F.when(ok, F.lower(F.date_format(wall, "a"))),
    }


def calendar_fields(text, which: str) -> dict:
    """K1: the five calendar fields of one ISO time text (naive text counts
    as UTC; zoned text shows its own wall clock)."""
    return calendar_fields_from(parse_start(text), wall_clock(text), which)
