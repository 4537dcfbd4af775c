"""Monitoring on tables (L1-L4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Calendar markup markers and the default upcoming threshold.
CALENDAR_MARKERS = ["ajde_evcal", "evo-calendar", "evo_event", "evcal_list", "evo_cal", "eventon"]
MIN_UPCOMING = 5
LATEST_K = 100
# ---------------------------------------------------------------------------


def latest_published(posts: DataFrame, id_col: str = "id", k: int = LATEST_K) -> DataFrame:
    """L1: published posts, newest ids first, ``k`` of them (bounded top-k)."""
    return posts.where(F.col("status") == "publish").orderBy(F.desc(id_col)).limit(k)


def start_epoch(srow) -> F.Column:
    """Start epoch of a post: integer text, anything else counts as 0."""
    s = srow.cast("string")
    return F.coalesce(F.when(s.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(s).try_cast("bigint")), F.lit(0))


def count_upcoming(posts: DataFrame, now_epoch, srow: str = "evcal_srow") -> DataFrame:
    """L2: published posts whose start epoch is at or after ``now_epoch``, all
    of them (a frame without ``status`` is taken to hold published posts)."""
    if "status" in posts.columns:
        posts = posts.where(F.col("status") == "publish")
    return posts.agg(F.count_if(start_epoch(F.col(srow)) >= now_epoch).alias("upcoming"))


def markup_detected(pages: DataFrame, html: str = "html", markers=None, out: str = "markup_detected") -> DataFrame:
    """L3: the lower-cased page contains any marker."""
    low = F.lower(F.col(html))
    cond = F.lit(False)
    for m in (markers or CALENDAR_MARKERS):
        cond = cond | low.contains(m.lower())
    return pages.withColumn(out, cond)


def health_verdict(upcoming: DataFrame, page_ok: DataFrame, api_ok: bool = True, fetch_ok: bool = True,
                   threshold: int = MIN_UPCOMING, require_page: bool = False) -> DataFrame:
    """L4: overall health from one-row inputs (``upcoming`` count and
    ``page_ok`` flag), combined as scalar subqueries (no cross join)."""
    n = upcoming.select("upcoming").scalar()
    ok_page = page_ok.select("page_ok").scalar()
    verdict = F.lit(api_ok) & F.lit(fetch_ok) & (n >= threshold) & (ok_page | F.lit(not require_page))
    return upcoming.sparkSession.range(1).select(n.alias("upcoming"), ok_page.alias("page_ok"),
                                                   verdict.alias("healthy"))
