"""Extraction of links, calendar files and events from stored pages.

Per-page work (anchor scan, link resolution, de-dup inside a page) is array
expressions on the row, so it needs no shuffle; only the cross-page de-dup of
calendar URLs (C8) groups, with partial aggregation.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions import ics as I
from ..functions.timefmt import parse_start
from .staging import stage


def _base_col(base, url_col):
    return F.lit(base) if base is not None else H.url_origin(F.col(url_col))


def extract_event_links(pages: DataFrame, base: str | None = None,
                        needle: str = H.DETAIL_NEEDLE, page_key: str = "page_id",
                        url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Absolute links of all anchors whose href contains ``needle``,
    first occurrence per page kept, document order as ``pos`` (0-based).
    Links resolve against ``base``, by default each page's own origin."""
    base = _base_col(base, url_col)
    # base and hrefs as columns first: each is referenced many times by url_join
    found = stage(pages.select(page_key, base.alias("_b"), F.col(html_col).alias("_t")), {"_a": H.anchors("_t")}, keep=[page_key, "_b"])
    staged = stage(found, {"_h": F.filter(H.anchor_hrefs("_a"), lambda h: h.contains(needle))}, keep=[page_key, "_b"])
    links = F.array_distinct(F.transform(F.col("_h"), lambda h: H.url_join(F.col("_b"), h)))
    return staged.select(page_key, F.posexplode(links).alias("pos", "link"))


def resolve_ics_url(pages: DataFrame, base: str | None = None,
                    slug_pattern: str = H.DETAIL_SLUG, url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """Calendar-file URL of each detail page: the captioned link, else
    the first ``.ics`` link, else one built from the page slug, else null.
    Links resolve against ``base``, by default each page's own origin."""
    cols = [c for c in pages.columns if c not in ("ics_url", "ics_method")]
    # staged behind a generator: the page is scanned once, and a later filter on
    # ics_url (C8, C12) is not pushed down to the scan, where it would scan again
    found = stage(pages, {"_b": _base_col(base, url_col), "_a": H.anchors(F.col(html_col))}, keep=cols)
    named = stage(found, {"_b": F.col("_b"), "_cap": H.ics_link_by_caption("_a"), "_gen": H.ics_link_generic("_a"),
                          "_slug": H.ics_link_from_slug(F.col(url_col), slug_pattern)}, keep=cols)
    cap, gen, slug = (F.col(c) for c in ("_cap", "_gen", "_slug"))
    chosen = stage(named, {"_b": F.col("_b"), "_h": F.coalesce(cap, gen, slug),
                           "ics_method": F.when(cap.isNotNull(), "caption").when(gen.isNotNull(), "suffix").when(slug.isNotNull(), "slug")},
                   keep=cols)
    return stage(chosen, {"ics_url": H.url_join(F.col("_b"), F.col("_h")), "ics_method": F.col("ics_method")}, keep=cols)


def dedupe_ics(resolved: DataFrame, order_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Each calendar URL once; the first page (by ``order_col``) keeps provenance."""
    return (resolved.where(F.col("ics_url").isNotNull()).groupBy("ics_url")
            .agg(F.min_by(F.struct(F.col(order_col).alias("first_page"), F.col(url_col).alias("source_page")),
                          F.col(order_col)).alias("_p"))
            .select("ics_url", "_p.first_page", "_p.source_page"))


def extraction_errors(resolved: DataFrame, url_col: str = "url", order_col: str = "page_id",
                      k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(count of pages without a calendar URL, first ``k`` messages)."""
    bad = resolved.where(F.col("ics_url").isNull())
    msgs = bad.select(order_col, F.concat(F.lit("no calendar file for page "), F.col(url_col)).alias("message"))
    return bad.agg(F.count(F.lit(1)).alias("n_errors")), msgs.orderBy(order_col).limit(k)


def parse_vevents(ics: DataFrame, content: str = "content", source_ics: str = "source_ics",
                  source_page: str = "source_page") -> DataFrame:
    """One event row per VEVENT (none for a calendar without one), in
    the event schema, provenance carried along (B9)."""
    keep = [c for c in (source_ics, source_page) if c in ics.columns]
    blocks = ics.select(*keep, F.posexplode(I.vevent_blocks(F.col(content))).alias("vevent_pos", "_b"))
    # each line is taken apart once; properties are then looked up by name
    lined = stage(blocks, {"_l": I.content_lines(I.own_properties(F.col("_b")))}, keep=[*keep, "vevent_pos"])
    mapped = stage(lined, {"_m": I.first_lines(F.col("_l")), "_cats": F.transform(F.filter("_l", lambda x: x["name"] == "CATEGORIES"), lambda x: x["value"])},
                   keep=[*keep, "vevent_pos"])
    props = ["SUMMARY", "DESCRIPTION", "LOCATION", "DTSTART", "DTEND", "URL", "UID", "LAST-MODIFIED", "CREATED"]
    own = mapped.select(*keep, "vevent_pos", "_cats", *[F.try_element_at("_m", F.lit(p)).alias(f"_s_{p}") for p in props])
    raw = own.select(*keep, "vevent_pos", "_cats", *[F.col(f"`_s_{p}`")["value"].alias(f"_{p}") for p in props],
                     *[I.valid_zone(I.line_param(F.coalesce(F.col(f"`_s_{p}`")["params"], F.lit("")), "TZID")).alias(f"_tz_{p}")
                       for p in ("DTSTART", "DTEND", "LAST-MODIFIED", "CREATED")])

    def text(name):
        return I.unescape_text(F.col(f"_{name}"))

    def when(name):
        return I.ics_datetime_to_iso(F.col(f"_{name}"), F.col(f"_tz_{name}"))

    out = raw.select(
        text("SUMMARY").alias("title"), text("DESCRIPTION").alias("description"),
        text("LOCATION").alias("location"), when("DTSTART").alias("start"), when("DTEND").alias("end"),
        F.col("_URL").alias("url"), text("UID").alias("uid"),
        I.split_categories(F.col("_cats")).alias("category"),
        when("LAST-MODIFIED").alias("last_modified"), when("CREATED").alias("created"),
        *[F.col(c) for c in keep], "vevent_pos")
    for c in ("source_ics", "source_page"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out


def month_frame(year: int, month: int, n: int = 2, roll_year: bool = False) -> list[tuple[int, int]]:
    """The months scraped in one run: ``month`` and the next ``n-1``,
    clipped at December of the same year (Δ12: ``roll_year`` continues)."""
    out = []
    for i in range(n):
        m = month + i
        if m > 12:
            if not roll_year:
                break
            out.append((year + (m - 1) // 12, (m - 1) % 12 + 1))
        else:
            out.append((year, m))
    return out


def month_window(df: DataFrame, ts: str, year: int, month: int, n: int = 2,
                 roll_year: bool = False) -> DataFrame:
    """Rows of each month of the frame, tagged ``frame_month``. One scan:
    the months are an OR of range predicates on the raw column (pushed to the
    parquet scan); a row lies in exactly one month, so this equals appending
    the months one after another without de-dup (C14)."""
    dtype = df.schema[ts].dataType
    native = isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))
    t = F.col(ts) if native else parse_start(F.col(ts))
    lit_type = dtype if native else T.TimestampType()
    cond = None
    for y, m in month_frame(year, month, n, roll_year):
        lo = _dt.datetime(y, m, 1)
        hi = _dt.datetime(y + (m == 12), m % 12 + 1, 1)
        part = (t >= F.lit(lo.isoformat(" ")).cast(lit_type)) & (t < F.lit(hi.isoformat(" ")).cast(lit_type))
        cond = part if cond is None else cond | part
    if cond is None:
        return df.limit(0).withColumn("frame_month", F.lit(None).cast("string"))
    return df.where(cond).withColumn("frame_month", F.date_format(t, "yyyy-MM"))


def union_months(frames: list[DataFrame]) -> DataFrame:
    """C14: append frames by column name; no de-dup."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
