"""Column helpers for links in HTML pages (regex over the page text).

Parsing a DOM per row would need Python; anchors are regular enough that Java
regexes inside ``regexp_extract(_all)`` find them with attributes in any order
and either quote style.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# What a parser does not see as markup: comments, scripts and styles.
HIDDEN = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script\s*>|$)|<style\b.*?(?:</style\s*>|$)"
# The loops below are possessive: Java runs such a loop without recursion and
# never goes back into it, so a tag, a caption or stray prose of any length takes
# one pass and constant stack.
# One attribute: a name and perhaps a value; a ``>`` in a quoted value ends nothing.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_ATTRIBUTE = r"[^\s>/][^\s=>/]*+(?:\s*+=\s*+" + _VALUE + r")?+"
_TAG = r"<a(?=[\s/>])(?:[\s/]++|" + _ATTRIBUTE + r")*+"
# an <a> tag with what it holds, up to its end or to the next anchor
ANCHOR = r"(?is)" + _TAG + r"(?:>(?:[^<]++|<(?!/?a[\s/>]))*+(?:</a\s*+>)?+)?+"
# its first ``href`` with a value, quotes included
HREF = r"(?is)^<a(?:[\s/]++|(?!href\s*+=)" + _ATTRIBUTE + r")*+href\s*+=\s*+(" + _VALUE + r")"
# an anchor whose whole text is the calendar-link caption, with or without tags around it
CAPTION = (r"(?is)^" + _TAG + r">\s*+(?:<(?!/a[\s>])[^>]*+>\s*+)*+[^<]*?Add to Calendar\s*-\s*iCal[^<]*+"
           r"(?:<(?!/a[\s>])[^>]*+>\s*+)*+</a\s*+>$")
# path part of a URL (urlparse(...).path)
URL_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
# scheme://host of a URL
URL_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
# ---------------------------------------------------------------------------
# Fixed values of the scraper: detail-page marker and calendar-file path.
DETAIL_NEEDLE = "/events/details"
DETAIL_SLUG = r"/events/details/([^/]+)"
ICS_PATH_TEMPLATE = ("/events/ical/", ".ics")
# ---------------------------------------------------------------------------


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_quotes(c) -> Column:
    """Attribute value without the quotes around it."""
    return _let(col_of(c), lambda v: F.when(F.substring(v, 1, 1).isin('"', "'"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v))


@lru_cache(maxsize=1)
def _named_references() -> str:
    """Named character references from the standard table, as one delimited text:
    a single literal, quick to analyse, that constant folding turns into a map."""
    from html.entities import html5
    return "\u0001".join(f"{k[:-1]}\u0002{v}" for k, v in sorted(html5.items()) if k.endswith(";"))


def unescape_entities(c) -> Column:
    """Decode the character references of an attribute value: named ones that
    end in a semicolon, decimal and hexadecimal ones. Values without ``&`` are
    left alone; the others are taken apart once, so nothing is decoded twice."""
    names = F.str_to_map(F.lit(_named_references()), F.lit("\u0001"), F.lit("\u0002"))

    def char(point):  # code point -> character
        return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")

    def number(digits, base):  # out of range or no character: the replacement sign
        def known(n):
            bad = n.isNull() | (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF) | (F.length(digits) > 12)
            return F.when(bad, F.lit("\uFFFD")).otherwise(char(n))

        return _let(F.conv(F.substring(digits, 1, 12), base, 10).cast("long"), known)

    def piece(p):  # "name;rest" after an ampersand
        def read(body):
            named = F.try_element_at(names, body)
            return (F.when(body.rlike("^#[xX][0-9A-Fa-f]+$"), number(F.substring(body, 3, 1 << 30), 16))
                    .when(body.rlike("^#[0-9]+$"), number(F.substring(body, 2, 1 << 30), 10))
                    .otherwise(F.coalesce(named, F.concat(F.lit("&"), body, F.lit(";")))))

        body = F.substring_index(p, ";", 1)
        return F.when(~p.contains(";"), F.concat(F.lit("&"), p)).otherwise(
            F.concat(_let(body, read), F.substr(p, F.length(body) + 2)))

    def decoded(parts):
        return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""))

    return _let(col_of(c), lambda s: F.when(s.contains("&"), _let(F.split(s, "&"), decoded)).otherwise(s))


def visible(html) -> Column:
    """Page text without comments, scripts and styles."""
    return F.regexp_replace(col_of(html), HIDDEN, "")


def remove_dots(path) -> Column:
    """Path without ``.`` and ``..`` segments (a leading ``..`` goes nowhere)."""
    def cut(p):
        kept = F.aggregate(F.split(p, "/"), F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc)
                           .when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
                           .otherwise(F.concat(acc, F.array(x))))
        # a path that ends in a dot segment names a folder
        end = F.when(p.endswith("/.") | p.endswith("/..") | p.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
        return F.when(p.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), end)).otherwise(p)

    return _let(col_of(path), cut)


def url_origin(url) -> Column:
    return F.regexp_extract(col_of(url), URL_ORIGIN, 1)


def url_path(url) -> Column:
    return F.regexp_extract(col_of(url), URL_PATH, 1)


def url_join(base, href) -> Column:
    """Resolve ``href`` against ``base`` (an origin or a page URL).

    absolute kept; ``//host`` gets the base scheme; ``/path`` goes on the base
    origin; ``?q``/``#f`` go on the base; other relative paths go after the
    base directory; dot segments are resolved.
    """
    h = col_of(href)

    def absolute(b):
        page = F.substring_index(b, "#", 1)
        folder = F.regexp_replace(url_path(b), r"[^/]*$", "")

        def on(origin):
            root = F.when((folder == "") & (origin != ""), F.lit("/")).otherwise(folder)
            ref = F.when(h.startswith("/"), h).otherwise(F.concat(root, h))
            # dot segments go from the path, not from a query or fragment
            path = F.substring_index(F.substring_index(ref, "#", 1), "?", 1)
            return (F.when(h.startswith("//"), F.concat(F.substring_index(origin, ":", 1), F.lit(":"), h))
                    .when(h.startswith("?"), F.concat(F.substring_index(page, "?", 1), h))
                    .when(h.startswith("#"), F.concat(page, h))
                    .when(h.startswith("/") | (origin != ""), _let(F.struct(ref.alias("r"), path.alias("p")), lambda x: F.concat(
                        origin, remove_dots(x["p"]), F.substr(x["r"], F.length(x["p"]) + 1))))
                    .otherwise(ref))

        return _let(url_origin(b), on)

    return (F.when(h.isNull(), F.lit(None).cast("string"))
            .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(h == "", base if isinstance(base, Column) else F.lit(base))
            .otherwise(_let(base if isinstance(base, Column) else F.lit(base), absolute)))


def anchors(html) -> Column:
    """All anchors of a page in document order, as structs: ``href`` (references
    decoded, '' without one) and ``caption`` (its text is the calendar-link caption).

    The page is scanned once; everything else is read from the structs, so keep
    them in a column (``staging.stage``) when they are used more than once."""
    return F.transform(F.regexp_extract_all(visible(html), F.lit(ANCHOR), F.lit(0)), lambda a: F.struct(
        unescape_entities(strip_quotes(F.regexp_extract(a, HREF, 1))).alias("href"), a.rlike(CAPTION).alias("caption")))


def anchor_hrefs(found) -> Column:
    """The hrefs of ``anchors``, document order."""
    return F.filter(F.transform(col_of(found), lambda a: a["href"]), lambda h: h != "")


def _nz(c: Column) -> Column:
    return F.when(c != "", c)


def ics_link_by_caption(found) -> Column:
    """C4: href of the first of ``anchors`` captioned 'Add to Calendar - iCal'."""
    return _nz(F.get(F.filter(col_of(found), lambda a: a["caption"]), F.lit(0))["href"])


def ics_link_generic(found) -> Column:
    """Href of the first of ``anchors`` whose href ends in ``.ics``."""
    return F.get(F.filter(col_of(found), lambda a: a["href"].endswith(".ics")), F.lit(0))["href"]


def ics_link_from_slug(url, slug_pattern: str = DETAIL_SLUG) -> Column:
    """``/events/ical/<slug>.ics`` from a detail-page path, else null."""
    slug = _nz(F.regexp_extract(url_path(url), slug_pattern, 1))
    pre, suf = ICS_PATH_TEMPLATE
    return F.concat(F.lit(pre), slug, F.lit(suf))
