"""Column helpers for iCalendar text (RFC 5545 subset the scraper reads).

Unfolding, component split and property lookup are regexes over the file
text, so a calendar file is parsed inside the JVM with no per-row Python.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# Possessive loops (see html.py): constant stack and one pass, whatever the length.
# A block that is not closed before the next one begins is no event.
VEVENT_BLOCK = r"BEGIN:VEVENT\r?\n((?:[^BE]++|B(?!EGIN:VEVENT)|E(?!ND:VEVENT))*+)END:VEVENT"
SUBCOMPONENT = r"(?s)BEGIN:([A-Za-z-]+)\r?\n.*?END:\1\r?\n?"
_ESC = "\u0000"


def unfold(content) -> Column:
    """Join folded lines: a line break followed by one space or tab."""
    return F.regexp_replace(col_of(content), r"\r?\n[ \t]", "")


def vevent_blocks(content) -> Column:
    """Bodies of all VEVENT components of a calendar, in file order."""
    return F.regexp_extract_all(unfold(content), F.lit(VEVENT_BLOCK), 1)


def own_properties(block) -> Column:
    """A VEVENT body without nested components (VALARM etc.)."""
    return F.regexp_replace(col_of(block), SUBCOMPONENT, "")


# one content line: name, parameters (values may be quoted), value
CONTENT_LINE = r"""^([A-Za-z0-9-]++)((?:;[A-Za-z0-9-]++=(?:"[^"]*+"|[^";:]++)*+)*+):(.*)$"""


def content_lines(block) -> Column:
    """Lines of a component as structs (upper-case name, parameters, value),
    each line taken apart once."""
    rows = F.split(col_of(block), r"\r\n|\n|\r")
    parsed = F.transform(rows, lambda x: F.struct(F.upper(F.regexp_extract(x, CONTENT_LINE, 1)).alias("name"),
                                                  F.regexp_extract(x, CONTENT_LINE, 2).alias("params"), F.regexp_extract(x, CONTENT_LINE, 3).alias("value")))
    return F.filter(parsed, lambda x: x["name"] != "")


def first_lines(lines) -> Column:
    """Map of a name to its first line."""
    names = F.array_distinct(F.transform(lines, lambda x: x["name"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n, F.element_at(F.filter(lines, lambda x: x["name"] == n), 1))))


def line_param(params, param: str) -> Column:
    """One parameter's value without quotes ('' if absent)."""
    p = col_of(params)
    v = F.regexp_extract(p, rf"""(?i)^(?:;(?!{param}=)[A-Za-z0-9-]++=(?:"[^"]*+"|[^";:]++)*+)*+;{param}=("[^"]*+"|[^";:]*+)""", 1)
    return F.when(F.upper(p).contains(f"{param.upper()}="), F.replace(v, F.lit('"'), F.lit(""))).otherwise(F.lit(""))


def unescape_text(c) -> Column:
    """TEXT value unescaping: ``\\,`` ``\\;`` ``\\n`` ``\\N`` ``\\\\``."""
    s = F.replace(col_of(c), F.lit("\\\\"), F.lit(_ESC))
    s = F.replace(s, F.lit("\\,"), F.lit(","))
    s = F.replace(s, F.lit("\\;"), F.lit(";"))
    s = F.replace(s, F.lit("\\n"), F.lit("\n"))
    s = F.replace(s, F.lit("\\N"), F.lit("\n"))
    return F.replace(s, F.lit(_ESC), F.lit("\\"))


def split_categories(raw) -> Column:
    """C11: the values of all CATEGORIES lines (an array), split on unescaped
    commas, items unescaped; null without such a line."""
    r = col_of(raw)
    items = F.flatten(F.transform(r, lambda v: F.split(v, r"(?<!\\),")))
    return F.when(F.size(r) > 0, F.transform(items, unescape_text))


@lru_cache(maxsize=1)
def known_zones() -> tuple:
    """IANA zone names (from the interpreter's tz database); a TZID outside
    it is treated as a floating time instead of failing the row."""
    import zoneinfo
    return tuple(sorted(zoneinfo.available_timezones()))


@lru_cache(maxsize=1)
def _zone_text() -> str:
    return "|" + "|".join(known_zones()) + "|"


def valid_zone(tzid) -> Column:
    """The TZID if it names a known zone, else '' (floating time).

    The zone list is one delimited string literal (a single expression node,
    cheap to analyse) instead of hundreds of ``isin`` literals."""
    t = col_of(tzid)
    ok = ((t != "") & ~t.contains("|")
          & F.lit(_zone_text()).contains(F.concat(F.lit("|"), t, F.lit("|"))))
    return F.when(ok, t).otherwise(F.lit(""))


def _fmt_offset(seconds: Column) -> Column:
    sign = F.when(seconds < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(seconds)
    return F.concat(sign, F.lpad((a / 3600).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(((a % 3600) / 60).cast("int").cast("string"), 2, "0"))


def ics_datetime_to_iso(value, tzid=None) -> Column:
    """DATE -> ``YYYY-MM-DD``; DATE-TIME -> ISO text (``tzid`` must be a
    known zone or '', see ``valid_zone``).

    Floating times stay naive; a trailing ``Z`` becomes ``+00:00``; a TZID
    parameter gives the zone's offset at that wall-clock time.
    """
    v = F.trim(col_of(value))
    tz = col_of(tzid) if tzid is not None else F.lit("")
    timed = v.rlike(r"^\d{8}T\d{6}Z?$")
    d, t = F.substring(v, 1, 8), F.substring(v, 10, 6)
    iso_date = lambda s: F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    iso_time = F.concat_ws(":", F.substring(t, 1, 2), F.substring(t, 3, 2), F.substring(t, 5, 2))
    local = F.concat(iso_date(d), F.lit("T"), iso_time)
    wall = F.try_to_timestamp(F.concat(iso_date(d), F.lit(" "), iso_time))
    zone_ok = tz != ""
    safe_tz = F.when(zone_ok, tz).otherwise(F.lit("UTC"))
    offset = (F.unix_timestamp(wall) - F.unix_timestamp(F.to_utc_timestamp(wall, safe_tz)))
    return (F.when(v.isNull() | (v == ""), F.lit(None).cast("string"))
            .when(v.rlike(r"^\d{8}$"), iso_date(v))
            .when(~timed, v)
            .when(v.endswith("Z"), F.concat(local, F.lit("+00:00")))
            .when(zone_ok & wall.isNotNull(), F.concat(local, _fmt_offset(offset)))
            .otherwise(local))
