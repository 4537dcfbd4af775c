"""Calendar payloads, location dimension upkeep, cleanup and post metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import calendar_fields_from, parse_start, wall_clock
from .numbering import dense_index

# ---------------------------------------------------------------------------
# Fixed values of the calendar plugin: registered single-valued string keys.
META_KEYS = [
    "evcal_srow", "evcal_erow", "evcal_start_date", "evcal_end_date",
    "evcal_start_time_hour", "evcal_start_time_min", "evcal_start_time_ampm",
    "evcal_end_time_hour", "evcal_end_time_min", "evcal_end_time_ampm",
    "evcal_allday", "evo_hide_endtime", "evo_year_long", "_evcal_exlink_option",
    "evcal_lmlink", "evcal_location_name", "evcal_location", "event_location",
    "evcal_organizer", "event_organizer",
    "evcal_subtitle", "evo_evcrd_field_org", "_featured", "_completed", "_cancel",
]
META_PREFIXES = ["evcal_", "evo_", "event_", "_evcal_"]
META_EXACT = ["_featured", "_completed", "_cancel"]
POST_TYPE = "ajde_events"
DEFAULT_TITLE = "Untitled Event"
# ---------------------------------------------------------------------------


def _entries(pairs: dict):
    """map of the non-null values of ``pairs`` (absent keys when null);
    ``array_compact`` + ``map_from_entries`` needs no lambda, so it stays in
    generated code."""
    items = [F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")))
             for k, v in pairs.items()]
    return F.map_from_entries(F.array_compact(F.array(*items)))


def calendar_meta(df: DataFrame, start: str = "start", end: str = "end", url: str = "url",
                  location_id: str | None = None, out: str = "meta") -> DataFrame:
    """K1: post metadata map: start/end calendar fields when present, the
    location id as text (Δ14) and the link."""
    # parse each time once (instant and wall clock as columns); the five
    # fields then read plain columns
    staged = df
    pairs = {}
    for col, which in ((start, "start"), (end, "end")):
        if col in df.columns:
            staged = staged.withColumns({f"_{which}_i": parse_start(F.col(col)), f"_{which}_w": wall_clock(F.col(col))})
            pairs.update(calendar_fields_from(F.col(f"_{which}_i"), F.col(f"_{which}_w"), which))
    if location_id and location_id in df.columns:
        pairs["event_location"] = F.col(location_id).cast("string")
    if url in df.columns:
        pairs["evcal_lmlink"] = F.col(url).cast("string")
    return staged.withColumn(out, _entries(pairs)).drop("_start_i", "_start_w", "_end_i", "_end_w")


def calendar_post(df: DataFrame, title: str = "title", description: str = "description",
                  meta: str = "meta") -> DataFrame:
    """K2: the post payload: title (default only when the column is absent),
    content '' for missing descriptions, draft status, post type, metadata."""
    t = F.col(title) if title in df.columns else F.lit(DEFAULT_TITLE)
    d = F.coalesce(F.col(description).cast("string"), F.lit("")) if description in df.columns else F.lit("")
    return df.withColumn("post", F.struct(t.alias("title"), d.alias("content"), F.lit("draft").alias("status"),
                                          F.lit(POST_TYPE).alias("type"), F.col(meta).alias("meta")))


def upsert_locations(events: DataFrame, dim: DataFrame, loc: str = "location",
                     out: str = "location_id") -> tuple[DataFrame, DataFrame]:
    """K3: exact name lookup in the location dimension; unknown names are
    created with ids after the current maximum (dense, by name); null or empty
    names get no id. Returns (events with ids, updated dimension)."""
    names = (events.select(F.col(loc).alias("name"))
             .where(F.col("name").isNotNull() & (F.col("name") != "")).distinct())
    new = names.join(dim.select("name"), "name", "left_anti")
    top = F.coalesce(dim.agg(F.max("id")).scalar(), F.lit(0))
    created = dense_index(new, [F.col("name")], out="_k").select(
        (top + F.col("_k")).cast(dim.schema["id"].dataType).alias("id"), "name")
    updated = dim.select("id", "name").unionByName(created)
    with_ids = events.join(updated.withColumnRenamed("name", loc).withColumnRenamed("id", out), loc, "left")
    return with_ids, updated


def publish(posts: DataFrame, created_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """K4: created drafts become published; others are untouched."""
    hit = created_ids.select(F.col(id_col)).distinct().withColumn("_hit", F.lit(True))
    j = posts.join(hit, id_col, "left")
    return j.withColumn("status", F.when(F.col("_hit"), F.lit("publish")).otherwise(F.col("status"))).drop("_hit")


def upload_plan(df: DataFrame, title: str = "title", start: str = "start") -> DataFrame:
    """K5 (dry run): one review line per row: ``title (start)``."""
    t = F.col(title).cast("string") if title in df.columns else F.lit("Untitled")
    s = F.col(start).cast("string") if start in df.columns else F.lit("No date")
    return df.withColumn("plan_line", F.concat(F.coalesce(t, F.lit("nan")), F.lit(" ("),
                                               F.coalesce(s, F.lit("nan")), F.lit(")")))


def upload_outcome(rows: DataFrame, created_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """K5 (real run): one row ``created`` of ``total`` (rows whose post was
    created, by a semi-join with the created ids)."""
    created = rows.join(created_ids.select(id_col).distinct(), id_col, "left_semi")
    total = rows.agg(F.count(F.lit(1))).scalar()
    return created.agg(F.count(F.lit(1)).alias("created")).select("created", total.alias("total"))


def delete_range(posts: DataFrame, lo: int, hi: int, id_col: str = "id",
                 failed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """K6: remove ids in ``[lo, hi]``; outcome row: deleted, failed, attempted
    (``hi-lo+1``). Ids in the range that do not exist are skipped silently;
    posts whose id is in ``failed`` (ids that could not be deleted) stay."""
    inside = F.coalesce(F.col(id_col).between(lo, hi), F.lit(False))
    if failed is None:
        marked = posts.withColumn("_kept", F.lit(False))
    else:
        ids = failed.select(F.col(id_col).alias("_failed")).distinct()
        marked = posts.join(ids, F.col(id_col) == F.col("_failed"), "left").withColumn("_kept", F.col("_failed").isNotNull()).drop("_failed")
    remaining = marked.where(~inside | F.col("_kept")).drop("_kept")
    outcome = marked.agg(F.count_if(inside & ~F.col("_kept")).alias("deleted"), F.count_if(inside & F.col("_kept")).alias("failed")).select(
        "deleted", "failed", F.lit(hi - lo + 1).cast("long").alias("attempted"))
    return remaining, outcome


def filter_meta(m):
    """K7: keys of the calendar plugin only."""
    def keep(k, v):
        cond = F.lit(False)
        for p in META_PREFIXES:
            cond = cond | k.startswith(p)
        return cond | k.isin(*META_EXACT)
    return F.map_filter(m, keep)


def sanitize_text(v):
    """K8: plain-text clean-up of one value: script/style blocks and tags
    removed, percent-encoded octets removed, line breaks, tabs and runs of
    blanks collapsed to one space, trimmed."""
    s = F.regexp_replace(v, r"(?is)<script[^>]*?>.*?</script>", "")
    s = F.regexp_replace(s, r"(?is)<style[^>]*?>.*?</style>", "")
    s = F.regexp_replace(s, r"(?s)<[^>]*>", "")
    s = F.regexp_replace(s, r"%[a-fA-F0-9]{2}", "")
    s = F.regexp_replace(s, r"[\r\n\t ]+", " ")
    return F.trim(s)


def sanitize_meta(m):
    """K8 over a metadata map."""
    return F.transform_values(m, lambda k, v: sanitize_text(v))


def meta_columns(df: DataFrame, meta: str = "meta", keep: list | None = None) -> DataFrame:
    """K9: the registered keys as string columns."""
    m = F.col(meta)
    return df.select(*(keep or []), *[m.getItem(k).cast("string").alias(k) for k in META_KEYS])


def meta_entries(df: DataFrame, id_col: str, meta: str = "meta", seq=None) -> DataFrame:
    """Map rows as ``(id, key, value[, seq])`` entry rows."""
    cols = [id_col, F.explode(F.col(meta)).alias("key", "value")]
    out = df.select(*cols, *([seq.alias("seq")] if seq is not None else []))
    return out


def upsert_meta(old: DataFrame, new: DataFrame, id_col: str = "id", meta: str = "meta",
                seq: str | None = None, post_type: str | None = "type") -> DataFrame:
    """Write new metadata over old, key by key: last value per (post,
    key) wins, only plugin keys (K7), values cleaned (K8), only posts of the
    calendar type; empty new metadata changes nothing. Updates with equal
    ``seq``, or without one, tie: the larger value wins.

    Entry rows are aggregated with ``max_by`` (partial aggregation), so a post
    with many updates never gathers in one buffer beyond its keys.
    """
    src = new
    if post_type and post_type in new.columns:
        src = src.where(F.col(post_type) == POST_TYPE)
    order = F.col(seq) if seq else F.lit(1)
    upd = meta_entries(src.withColumn("_m", sanitize_meta(filter_meta(F.col(meta)))), id_col, "_m", order)
    base = meta_entries(old, id_col, meta, F.lit(0))
    both = base.unionByName(upd)
    return (both.groupBy(id_col, "key").agg(F.max_by("value", F.struct("seq", "value")).alias("value")))
