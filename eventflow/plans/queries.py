"""Operators bound to the driver tables: one query per operator family.

Every query reads whole tables (no id subsets, no row caps); a ``limit``
appears only where it is the operator (top-k reports, previews). The
bindings give the operators inputs with every edge they handle (labels as
int, float text and padded text; nulls; ties; conflicting series).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import flatten_category, four_field_text, norm_str, norm_url, parse_label, \
    title_desc_text, venue_flags, weak_label_expr
from ..operators import extract as C
from ..operators import features as I
from ..operators import merge as G
from ..operators import monitor as L
from ..operators import propagate as P
from ..operators import publish as K
from ..operators import report as R
from ..operators import rules as D
from ..operators import shaping as B
from ..operators.numbering import dense_index
from ..session import configure
from ..sources import readers as A

# Parameters of the bindings (documented in the README).
PART_POS, PART_NEG = "ring|widget", "small"
PART_VENUES = {"venue_library": r"\bring\b", "venue_park": r"\bwidget\b",
               "venue_church": r"\bbolt\b", "venue_museum": r"\bgear\b|gizmo"}
PAGE_SLUG = r"^/[a-z]{2}/([^/]+)"
PAGE_MARKERS = ["track(1", "<table"]
RANGE_LO, RANGE_HI = 767, 924
NOW_TEXT = "1998-01-01 00:00:00"
SPLIT_SEED = "42"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c):
    return F.round(c, 6)


# --------------------------------------------------------------------- helpers
def events_series(spark, sf_dir) -> DataFrame:
    """events as labelled rows: series = user and day."""
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "event_type", "value", "user_id", "props",
                     F.concat_ws("|", F.col("user_id").cast("string"),
                                 F.to_date("ts").cast("string")).alias("series_id"))


def docs_labelled(spark, sf_dir) -> DataFrame:
    """documents with their quality label (null when unlabelled), series
    lang|source, first line as title."""
    docs = load(spark, sf_dir, "documents")
    lab = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return (docs.join(lab, "doc_id", "left")
            .select("doc_id", "lang", "source", "n_chars", "text", "label",
                    F.concat_ws("|", "lang", "source").alias("series_id"),
                    F.substring_index("text", "\n", 1).alias("title")))


def event_confidence(ev: DataFrame) -> DataFrame:
    conf = F.col("value") - F.floor("value")
    return ev.withColumns({
        "confidence": conf,
        "is_community_event": F.col("event_type").isin("purchase", "signup", "view").cast("int"),
        "needs_review": conf < 0.75,
    })


def event_start_text(ev: DataFrame) -> DataFrame:
    t = F.col("ts")
    return ev.withColumn("start", F.when(F.col("event_type") == "purchase", t.cast("string"))
                         .when(F.col("event_type") == "error",
                               F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00")))
                         .when(F.col("event_type") == "view", F.date_format(t, "yyyy-MM-dd"))
                         .when(F.col("event_type") == "click", F.lit("not a date")))


# --------------------------------------------------------------------- B
def q_flatten_category(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    cat = F.array(F.col("p_brand"), F.when(F.col("p_size") > 25, F.lit("")).otherwise(F.col("p_type")),
                  F.lit(None).cast("string"))
    return part.select("p_partkey", flatten_category(cat).alias("category_text"))


def q_canonicalize(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    src = docs.select(F.col("doc_id").cast("string").alias("id"),
                      F.substring_index("text", "\n", 1).alias("name"),
                      F.col("text").alias("summary"), F.col("lang").alias("venue"), "source")
    return B.ensure_event_id(B.canonicalize(src))


def q_ensure_event_id(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    src = pages.select(F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
                       F.col("url").alias("source_page"))
    return B.ensure_event_id(B.canonicalize(src)).select("event_id", "title", "url", "source")


def q_labelset(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    src = docs.select(F.col("doc_id").cast("string").alias("id"),
                      F.substring_index("text", "\n", 1).alias("name"),
                      F.col("text").alias("summary"), F.col("lang").alias("venue"))
    return B.labelset_projection(B.canonicalize(src)).select("event_id", "weak_label", "label")


def q_four_field_text(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    et = F.col("event_type")
    loc = F.when(et == "view", F.lit(None)).otherwise(F.concat(F.lit("user "), F.col("user_id").cast("string")))
    cat = (F.when(et == "click", F.lit(None)).when(et == "error", F.lit(""))
           .otherwise(F.concat(F.lit("cat"), F.col("user_id").cast("string"))))
    return ev.select("event_id", four_field_text(et, F.col("props"), loc, cat).alias("text"))


def _review_input(spark, sf_dir):
    ev = event_confidence(load(spark, sf_dir, "events"))
    loc = F.when(F.col("event_type") == "view", F.lit(None)).otherwise(
        F.concat(F.lit("user "), F.col("user_id").cast("string")))
    return ev.select("event_id", F.col("event_type").alias("title"), F.col("ts").cast("string").alias("start"),
                     loc.alias("location"), "confidence", "needs_review")


def q_review_rows(spark, sf_dir):
    return B.review_rows(_review_input(spark, sf_dir), keep=["event_id"])


def q_published_rows(spark, sf_dir):
    return B.published_rows(_review_input(spark, sf_dir).drop("confidence"), keep=["event_id"])


# --------------------------------------------------------------------- D / E
def q_weak_label(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    text = title_desc_text("p_name", "p_type", lower=True)
    return part.select("p_partkey", weak_label_expr(text, PART_POS, PART_NEG).alias("weak_label"))


def q_parse_label(spark, sf_dir):
    lab = load(spark, sf_dir, "labels")
    q = F.col("quality").cast("string")
    m = F.col("doc_id") % 4
    raw = (F.when(m == 0, F.concat(q, F.lit(".0"))).when(m == 1, q)
           .when(m == 2, F.concat(F.lit(" "), q)).otherwise(F.lit("x")))
    src = lab.select("doc_id", raw.alias("label_raw"))
    return src.select("doc_id", "label_raw",
                      *[parse_label("label_raw", v).alias(f"label_{v}") for v in ("fill", "mask", "all_dot0", "strict")])


def _pages_keys(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    pid = F.col("page_id")
    return pages.select(
        "page_id",
        F.when(pid % 3 == 0, pid.cast("string")).alias("uid"),
        F.when(pid % 5 == 0, F.lit("")).otherwise(F.col("url")).alias("url"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("location"))


def q_norm_url_series(spark, sf_dir):
    src = _pages_keys(spark, sf_dir)
    return B.make_series_id(src).select("page_id", norm_url("url").alias("url_norm"),
                                        norm_str("title").alias("title_norm"), "series_id")


def q_extract_series_id(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select("page_id", F.col("url").alias("uid"))
    return B.extract_series_id(pages, "uid", pattern=r"page=(\d+)").select("page_id", "series_id")


def q_venue_flags(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", *[c.alias(n) for n, c in venue_flags(F.col("p_name"), PART_VENUES).items()])


def q_margin_confidence(spark, sf_dir):
    from ..operators.models import margin_confidence_expr
    ev = load(spark, sf_dir, "events")
    score = (F.col("value") - 20.0) / 10.0
    src = ev.select("event_id", (score > 0).cast("int").alias("predicted_label"),
                    margin_confidence_expr(score).alias("confidence"))
    out = D.auto_accept(D.needs_review_margin(src))
    return out.select("event_id", "predicted_label", r6(F.col("confidence")).alias("confidence"),
                      "needs_review", "label")


def q_flagged(spark, sf_dir):
    ev = event_confidence(load(spark, sf_dir, "events"))
    src = ev.select("event_id", F.col("event_type").alias("title"), "confidence", "needs_review",
                    F.col("is_community_event").alias("predicted_label"))
    out = D.flagged(src, cols=("event_id", "title", "predicted_label", "confidence"), order="event_id")
    return out.withColumn("confidence", r6(F.col("confidence")))


def q_labeled_only(spark, sf_dir):
    d = docs_labelled(spark, sf_dir)
    return D.labeled_only(d).select("doc_id", "label")


def q_unlabeled_only(spark, sf_dir):
    d = docs_labelled(spark, sf_dir)
    return D.unlabeled_only(d).select("doc_id", "series_id")


# --------------------------------------------------------------------- F
def _events_text_labels(spark, sf_dir):
    ev = events_series(spark, sf_dir)
    et = F.col("event_type")
    lab = (F.when(et == "purchase", "1").when(et == "signup", "1.0").when(et == "error", "0")
           .otherwise(F.lit(None).cast("string")))
    return ev.select("event_id", "series_id", lab.alias("label"))


def _events_int_labels(spark, sf_dir):
    ev = events_series(spark, sf_dir)
    et = F.col("event_type")
    lab = F.when(et.isin("purchase", "signup"), 1).when(et == "error", 0).otherwise(F.lit(None).cast("int"))
    src = F.when(et == "purchase", F.lit(P.SOURCE_MANUAL)).otherwise(F.lit(None).cast("string"))
    return ev.select("event_id", "series_id", lab.alias("label"), src.alias("label_source"))


def q_propagate_unanimous(spark, sf_dir):
    return P.propagate_unanimous(_events_text_labels(spark, sf_dir))


def q_propagate_unanimous_strict(spark, sf_dir):
    return P.propagate_unanimous_strict(_events_text_labels(spark, sf_dir))


def q_propagate_majority_overwrite(spark, sf_dir):
    return P.propagate_majority_overwrite(_events_int_labels(spark, sf_dir)).select("event_id", "label", "label_source")


def q_propagate_majority_fill(spark, sf_dir):
    return P.propagate_majority_fill(_events_int_labels(spark, sf_dir)).select("event_id", "label")


def q_coverage(spark, sf_dir):
    d = docs_labelled(spark, sf_dir).select("doc_id", "series_id", "label")
    filled = P.propagate_majority_fill(d.withColumn("before", F.col("label")))
    return P.coverage(filled, "before", "label")


# --------------------------------------------------------------------- G
def q_merge_manual_predicted(spark, sf_dir):
    d = docs_labelled(spark, sf_dir).withColumn("predicted_label", (F.col("n_chars") > 1000).cast("int"))
    return G.merge_manual_predicted(d).select("doc_id", "final_label")


def _overlapping_sets(spark, sf_dir):
    d = docs_labelled(spark, sf_dir).withColumn(
        "uid", F.when(F.substring_index("text", " ", 1) != "", F.substring_index("text", " ", 1)))
    existing = d.where(F.col("lang").isin("en", "de")).select("doc_id", "uid", "label")
    new = d.where(F.col("lang").isin("en", "fr", "es")).select(
        "doc_id", "uid", (F.col("n_chars") > 1000).cast("int").alias("label"),
        F.when(F.col("n_chars") > 5000, F.lit(P.SOURCE_SERIES)).otherwise(F.lit(P.SOURCE_MODEL)).alias("label_source"))
    return existing, new


def q_merge_by_priority(spark, sf_dir):
    existing, new = _overlapping_sets(spark, sf_dir)
    return G.merge_by_priority(existing, new, uid="uid", order_col="doc_id").select(
        "doc_id", "uid", "label", "label_source")


def q_merge_first_wins(spark, sf_dir):
    existing, new = _overlapping_sets(spark, sf_dir)
    ex = existing.select("doc_id", "uid", F.lit("existing").alias("origin"))
    nw = new.select("doc_id", "uid", F.lit("new").alias("origin"))
    return G.merge_first_wins(ex, nw, uid="uid", order_col="doc_id")


def q_collapse_series(spark, sf_dir):
    d = docs_labelled(spark, sf_dir).select("doc_id", "series_id", F.col("text").alias("description"))
    out = G.collapse_series(d, order_col="doc_id")
    return out.select("series_id", "doc_id", F.length("description").alias("desc_len"))


def q_distinct_series_sample(spark, sf_dir):
    d = docs_labelled(spark, sf_dir)
    return G.distinct_series_sample(d, order_col="doc_id")


# --------------------------------------------------------------------- H
def q_valid_series_head(spark, sf_dir):
    """Rows with a series, the first 25 by id; the empty series is one language's."""
    d = docs_labelled(spark, sf_dir).withColumn("series_id", F.when(F.col("lang") == "de", F.lit("")).when(F.col("lang") != "fr", F.col("series_id")))
    return R.head(D.valid_series(d).select("doc_id", "series_id", "label"), 25, "doc_id")


def q_value_counts(spark, sf_dir):
    return R.value_counts(docs_labelled(spark, sf_dir), "label")


def q_series_summary(spark, sf_dir):
    return R.series_summary(docs_labelled(spark, sf_dir), order_col="doc_id")


def q_unlabeled_series(spark, sf_dir):
    return R.unlabeled_series(docs_labelled(spark, sf_dir), order_col="doc_id")


def q_batch_stats(spark, sf_dir):
    return R.batch_stats(event_confidence(load(spark, sf_dir, "events")))


def q_prediction_counts(spark, sf_dir):
    ev = event_confidence(load(spark, sf_dir, "events"))
    return R.prediction_counts(ev, pred="is_community_event")


def q_confidence_breakdown(spark, sf_dir):
    return R.confidence_breakdown(event_confidence(load(spark, sf_dir, "events")), threshold=0.55)


def q_train_guards(spark, sf_dir):
    return R.train_guards(docs_labelled(spark, sf_dir))


def q_class_balance(spark, sf_dir):
    lab = load(spark, sf_dir, "labels").withColumnRenamed("quality", "label")
    return R.class_balance(lab)


def _scored_labels(spark, sf_dir):
    lab = load(spark, sf_dir, "labels")
    return lab.select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))


def q_confusion_matrix(spark, sf_dir):
    return R.confusion_matrix(_scored_labels(spark, sf_dir))


def q_classification_report(spark, sf_dir):
    rep = R.classification_report(_scored_labels(spark, sf_dir))
    return rep.select("cls", r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"),
                      r6(F.col("f1")).alias("f1"), "support")


def q_accuracy(spark, sf_dir):
    return R.accuracy(_scored_labels(spark, sf_dir)).select(r6(F.col("accuracy")).alias("accuracy"))


# --------------------------------------------------------------------- I
def q_time_features(spark, sf_dir):
    ev = event_start_text(load(spark, sf_dir, "events"))
    return I.time_features(ev, "start").select("event_id", "hour", "is_weekend")


def q_tfidf_topk(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    w = I.tfidf_topk(docs, "doc_id", "text", k=500)
    return w.select("doc_id", "term", "tf", r6(F.col("weight")).alias("weight"))


def q_tfidf_pruned(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    w = I.tfidf_pruned(docs, "doc_id", "text", min_df=2, max_df=0.9)
    return w.select("doc_id", "term", "tf", r6(F.col("weight")).alias("weight"))


def q_scale_no_mean(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("event_id", "value", F.col("user_id").cast("double").alias("user_id"))
    out = I.scale_no_mean(ev, ["value", "user_id"])
    return out.select("event_id", r6(F.col("value_scaled")).alias("value_scaled"),
                      r6(F.col("user_id_scaled")).alias("user_id_scaled"))


# --------------------------------------------------------------------- J (splits)
def q_group_split(spark, sf_dir):
    from ..operators.models import group_split
    d = docs_labelled(spark, sf_dir)
    s = group_split(d, "series_id", test_size=0.2, seed=SPLIT_SEED)
    return s.groupBy("split").agg(F.count_distinct("series_id").alias("n_series"),
                                  F.count(F.lit(1)).alias("n_rows"))


def q_stratified_split(spark, sf_dir):
    from ..operators.models import stratified_split
    lab = load(spark, sf_dir, "labels").withColumnRenamed("quality", "label")
    s = stratified_split(lab, "label", key="doc_id", test_size=0.2, seed=SPLIT_SEED)
    return s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------- C
def q_extract_links(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    return C.extract_event_links(pages, base=None, needle="/")


def _resolved(spark, sf_dir):
    """Pages in four kinds by id: captioned link, file link, page name only, nothing."""
    configure(spark)
    pages = A.scan_pages(spark, f"{sf_dir}/pages.parquet")
    kind, i = F.pmod("page_id", F.lit(4)), F.col("page_id").cast("string")
    caption = F.concat(F.lit('<!-- <a href="/old.ics">Add to Calendar - iCal</a> --><a class="x" title="a > b" href="/files/&#x63;al'), i,
                       F.lit('"><b> Add to Calendar - iCal </b></a>'))
    link = F.concat(F.lit("<script>'<a href=/s.ics>'</script><a href='cal/../f"), i, F.lit(".ics'>file</a>"))
    pages = pages.withColumns({
        "html": F.concat(F.when(kind == 0, caption).when(kind == 1, link).otherwise(F.lit("")), F.coalesce("html", F.lit(""))),
        "url": F.when(kind == 3, F.concat(F.regexp_extract("url", "^[a-z]+://[^/?#]+", 0), F.lit("/none"))).otherwise(F.col("url"))})
    return C.resolve_ics_url(pages, base=None, slug_pattern=PAGE_SLUG)


def q_resolve_ics(spark, sf_dir):
    return _resolved(spark, sf_dir).select("page_id", "ics_url", "ics_method")


def q_dedupe_ics(spark, sf_dir):
    return C.dedupe_ics(_resolved(spark, sf_dir))


def q_extraction_errors(spark, sf_dir):
    n, messages = C.extraction_errors(_resolved(spark, sf_dir))
    count = n.select("n_errors").scalar()
    return messages.withColumn("n_errors", count)


def orders_ics(spark, sf_dir) -> DataFrame:
    """One iCalendar file per order: two events for finished orders (the
    second with a nested alarm), one for open orders, none for pending ones;
    escaped commas and semicolons, a folded description, DATE and UTC
    DATE-TIME values."""
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey").cast("string")
    crlf = F.lit("\r\n")
    d = F.col("o_orderdate")

    def line(*parts):
        return F.concat(*parts, crlf)

    desc = F.concat(F.lit("Total "), F.format_string("%.2f", F.col("o_totalprice")), F.lit("\\; customer "),
                    F.col("o_custkey").cast("string"), F.lit("\\, priority "), F.col("o_orderpriority"),
                    F.lit("\\nstatus "), F.col("o_orderstatus"), F.lit(" of a long order description line"))
    folded = F.regexp_replace(F.concat(F.lit("DESCRIPTION:"), desc), "(.{74})", "$1\r\n ")
    start = F.when(F.col("o_orderstatus") == "O",
                   line(F.lit("DTSTART;VALUE=DATE:"), F.date_format(d, "yyyyMMdd"))) \
        .otherwise(line(F.lit("DTSTART:"), F.date_format(d, "yyyyMMdd'T'HHmmss"), F.lit("Z")))

    def vevent(uid_suffix, alarm):
        return F.concat(
            line(F.lit("BEGIN:VEVENT")),
            line(F.lit("UID:order-"), k, F.lit(uid_suffix), F.lit("@shop")),
            line(F.lit("SUMMARY:Order "), k, F.lit("\\, "), F.col("o_orderpriority")),
            F.concat(folded, crlf),
            line(F.lit("LOCATION:Customer "), F.col("o_custkey").cast("string")),
            start,
            line(F.lit("DTEND:"), F.date_format(d + F.expr("INTERVAL 1 DAY"), "yyyyMMdd'T'HHmmss")),
            line(F.lit("URL:https://shop.example.com/orders/"), k),
            line(F.lit("CATEGORIES:"), F.col("o_orderstatus"), F.lit(","), F.col("o_orderpriority")),
            F.concat(line(F.lit("BEGIN:VALARM")), line(F.lit("DESCRIPTION:reminder")), line(F.lit("END:VALARM")))
            if alarm else F.lit(""),
            line(F.lit("END:VEVENT")))

    body = (F.when(F.col("o_orderstatus") == "F", F.concat(vevent("", False), vevent("-ship", True)))
            .when(F.col("o_orderstatus") == "O", vevent("", False)).otherwise(F.lit("")))
    content = F.concat(line(F.lit("BEGIN:VCALENDAR")), line(F.lit("VERSION:2.0")), body, line(F.lit("END:VCALENDAR")))
    return o.select(F.concat(F.lit("orders/"), k, F.lit(".ics")).alias("source_ics"),
                    F.lit(None).cast("string").alias("source_page"), content.alias("content"))


def q_parse_vevents(spark, sf_dir):
    ev = C.parse_vevents(orders_ics(spark, sf_dir))
    return ev.select("uid", "title", "description", "location", "start", "end", "url",
                     F.array_join("category", ";").alias("category_text"), "source_ics", "vevent_pos")


def q_calendar_quarantine(spark, sf_dir):
    """Calendars of orders in six kinds by id: whole, bytes that are no text, no
    calendar, unreadable, an event without an end before a whole one and after."""
    o = load(spark, sf_dir, "orders")
    kind, i = F.pmod("o_orderkey", F.lit(6)), F.col("o_orderkey").cast("string")
    whole = F.concat(F.lit("BEGIN:VEVENT\r\nUID:"), i, F.lit("\r\nEND:VEVENT\r\n"))
    cut = F.concat(F.lit("BEGIN:VEVENT\r\nUID:cut"), i, F.lit("\r\n"))
    body = F.when(kind == 4, F.concat(cut, cut, whole)).when(kind == 5, F.concat(whole, whole, cut)).otherwise(whole)
    cal = F.concat(F.lit("BEGIN:VCALENDAR\r\n"), body, F.lit("END:VCALENDAR\r\n")).cast("binary")
    files = o.select(i.alias("source_ics"), F.when(kind == 1, F.concat(cal, F.unhex(F.lit("FFFE")))).when(kind == 2, F.lit("<html>").cast("binary"))
                     .when(kind != 3, cal).alias("content"))
    good, errors = A.quarantine(files)
    events = C.parse_vevents(good).groupBy("source_ics").agg(F.count(F.lit(1)).alias("n_events"))
    return (files.select("source_ics").join(events, "source_ics", "left").join(errors, "source_ics", "left")
            .select("source_ics", F.coalesce("n_events", F.lit(0)).alias("n_events"), "error", "n_broken"))


def q_month_window(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    frames = [C.month_window(o, "o_orderdate", 1998, 12), C.month_window(o, "o_orderdate", 1997, 5)]
    return C.union_months(frames).select("o_orderkey", "frame_month")


# --------------------------------------------------------------------- K
def _event_posts(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    et = F.col("event_type")
    t = F.col("ts")
    full = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    start = F.when(et == "error", F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))) \
        .otherwise(F.date_format(t, full))
    end = F.when(et.isin("purchase", "error"), F.date_format(t + F.expr("INTERVAL 90 MINUTES"), full))
    url = F.when(et == "signup", F.concat(F.lit("https://cal.example.com/e/"), F.col("event_id").cast("string")))
    desc = F.when(et == "view", F.lit(None).cast("string")).otherwise(F.col("props"))
    return ev.select("event_id", et.alias("title"), desc.alias("description"), start.alias("start"),
                     end.alias("end"), url.alias("url"))


def q_calendar_meta(spark, sf_dir):
    return K.meta_columns(K.calendar_meta(_event_posts(spark, sf_dir)), keep=["event_id"])


def q_calendar_post(spark, sf_dir):
    p = K.calendar_post(K.calendar_meta(_event_posts(spark, sf_dir)))
    return p.select("event_id", "post.title", "post.content", "post.status", F.col("post.type").alias("post_type"),
                    F.col("post.meta").getItem("evcal_lmlink").alias("link"),
                    F.size("post.meta").cast("long").alias("n_meta"))


def q_upload_plan(spark, sf_dir):
    return K.upload_plan(_event_posts(spark, sf_dir)).select("event_id", "plan_line")


def q_upsert_locations(spark, sf_dir):
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # the existing dimension: brands of the first two families, over the whole table
    names = part.where(F.col("p_brand").rlike("^Brand#[12]")).select(F.col("p_brand").alias("name")).distinct()
    dim = dense_index(names, [F.col("name")], out="id")
    with_ids, _ = K.upsert_locations(part, dim, loc="p_brand")
    return with_ids.select("p_partkey", "p_brand", "location_id")


def _order_posts(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.lit("draft").alias("status"))


def q_publish(spark, sf_dir):
    posts = _order_posts(spark, sf_dir)
    created = posts.where(F.col("id").between(RANGE_LO, RANGE_HI)).select("id")
    out = K.publish(posts, created)
    return out.agg(F.count_if(F.col("status") == "publish").alias("published"),
                   F.count_if(F.col("status") == "draft").alias("drafts"))


def q_delete_range(spark, sf_dir):
    posts = _order_posts(spark, sf_dir)
    failed = posts.where(F.col("id") % 7 == 0).select("id")  # a rule over the whole table
    remaining, outcome = K.delete_range(posts, RANGE_LO, RANGE_HI, failed=failed)
    left = remaining.agg(F.count(F.lit(1)).alias("remaining")).select("remaining").scalar()
    return outcome.withColumn("remaining", left)


def _event_meta(ev: DataFrame) -> DataFrame:
    et = F.col("event_type")
    pairs = {
        "evcal_srow": F.unix_timestamp("ts").cast("string"),
        "evo_hide_endtime": F.lit("no"),
        "event_type": et,
        "user_id": F.col("user_id").cast("string"),
        "_featured": F.when(F.col("value") > 40, F.lit("yes")).otherwise(F.lit("no")),
        "_evcal_exlink_option": F.lit("1"),
        "props": F.col("props"),
        "evcal_subtitle": F.concat(F.lit("<b>"), et, F.lit("</b>\n  "), F.col("props"), F.lit(" %41\tend")),
    }
    return ev.withColumn("meta", F.map_from_arrays(F.array(*[F.lit(k) for k in pairs]), F.array(*pairs.values())))


def q_filter_meta(spark, sf_dir):
    ev = _event_meta(load(spark, sf_dir, "events"))
    clean = ev.withColumn("meta", K.sanitize_meta(K.filter_meta(F.col("meta"))))
    return K.meta_entries(clean, "event_id")


def q_upsert_meta(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    et = F.col("event_type")
    old = ev.select("event_id", F.create_map(F.lit("evcal_srow"), F.unix_timestamp("ts").cast("string"),
                                             F.lit("evcal_lmlink"), F.lit("old")).alias("meta"))
    new_meta = F.when(et == "purchase", F.create_map(
        F.lit("evcal_lmlink"), F.concat(F.lit("https://x.example/"), F.col("event_id").cast("string")),
        F.lit("evo_year_long"), F.lit("no"), F.lit("random_key"), F.lit("x"))) \
        .otherwise(F.create_map().cast("map<string,string>"))
    new = ev.select("event_id", new_meta.alias("meta"),
                    F.when(et == "view", F.lit("post")).otherwise(F.lit(K.POST_TYPE)).alias("type"))
    return K.upsert_meta(old, new, id_col="event_id")


# --------------------------------------------------------------------- L
def _published_orders(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    F.when(F.col("o_orderstatus") == "F", "publish").otherwise("draft").alias("status"),
                    F.unix_timestamp("o_orderdate").cast("string").alias("evcal_srow"))


def _now_epoch():
    return F.unix_timestamp(F.lit(NOW_TEXT))


def q_latest_published(spark, sf_dir):
    return L.latest_published(_published_orders(spark, sf_dir)).select(F.col("id").alias("o_orderkey"))


def q_count_upcoming(spark, sf_dir):
    return L.count_upcoming(_published_orders(spark, sf_dir), _now_epoch())


def q_markup_detected(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    return L.markup_detected(pages, markers=PAGE_MARKERS).select("page_id", "markup_detected")


def q_health_verdict(spark, sf_dir):
    up = L.count_upcoming(_published_orders(spark, sf_dir), _now_epoch())
    pages = L.markup_detected(load(spark, sf_dir, "pages"), markers=PAGE_MARKERS)
    ok = pages.agg(F.coalesce(F.bool_or("markup_detected"), F.lit(False)).alias("page_ok"))
    return L.health_verdict(up, ok, threshold=L.MIN_UPCOMING, require_page=True)


# --------------------------------------------------------------------- more B / D / G
def q_accepted_review(spark, sf_dir):
    ev = event_confidence(load(spark, sf_dir, "events")).drop("needs_review")
    out = D.accepted(D.needs_review_prob(ev, threshold=0.75))
    return out.select("event_id", r6(F.col("confidence")).alias("confidence"), "needs_review")


def q_promote_label(spark, sf_dir):
    d = docs_labelled(spark, sf_dir).withColumn("predicted_label", (F.col("n_chars") > 1000).cast("int"))
    return B.promote_label(G.merge_manual_predicted(d)).select("doc_id", "label")


def q_concat_sets(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    latin = F.col("lang").isin("fr", "es")
    a = docs.where(~F.coalesce(latin, F.lit(False))).select("doc_id", "lang")
    b = docs.where(latin).select("doc_id", "source")
    return G.concat(a, b)


def q_ensure_columns(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select("page_id", F.col("url").alias("title"))
    return B.ensure_columns(pages, ["title", "description", "start", "location"]).select(
        "page_id", "title", "description", "start", "location")


def q_title_desc_text(spark, sf_dir):
    d = docs_labelled(spark, sf_dir)
    return d.select("doc_id", F.md5(title_desc_text("title", "text", lower=True)).alias("text_md5"),
                    F.length(title_desc_text("title", "text")).alias("text_len"))


# --------------------------------------------------------------------- J (models; rows-only)
def _model_docs(spark, sf_dir):
    d = docs_labelled(spark, sf_dir)
    return d.select("doc_id", F.col("doc_id").cast("string").alias("uid"), "series_id", "title",
                    F.col("text").alias("description"), F.col("lang").alias("location"),
                    F.col("source").alias("category"), F.lit(None).cast("string").alias("start"), "label")


def q_svm_train_eval(spark, sf_dir):
    from ..operators.models import fit_svm_balanced, predict
    d = _model_docs(spark, sf_dir).where(F.col("label").isNotNull())
    from ..operators.models import group_split
    s = group_split(d, "series_id", test_size=0.2, seed=SPLIT_SEED)
    model = fit_svm_balanced(s.where(F.col("split") == "train"))
    scored = predict(s.where(F.col("split") == "test"), model, out="prediction")
    rep = R.classification_report(scored)
    return rep.select("cls", r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"),
                      r6(F.col("f1")).alias("f1"), "support")


def q_classify(spark, sf_dir):
    from ..operators.models import classify, fit_svm_prob
    d = _model_docs(spark, sf_dir)
    model = fit_svm_prob(d.where(F.col("label").isNotNull()), key="doc_id")
    out = classify(d.drop("label"), model)
    return out.select("doc_id", "is_community_event", r6(F.col("confidence")).alias("confidence"), "needs_review")


def q_tag(spark, sf_dir):
    from ..operators.models import fit_svm_balanced, tag
    d = _model_docs(spark, sf_dir)
    model = fit_svm_balanced(d.where(F.col("label").isNotNull()))
    out = tag(d.drop("label"), model, confidence=True)
    return out.select("doc_id", "predicted_label",
                      r6(F.col("prediction_confidence")).alias("prediction_confidence"))


def q_smart_label(spark, sf_dir):
    from ..operators.models import fit_svm_balanced, smart_label
    d = _model_docs(spark, sf_dir)
    model = fit_svm_balanced(d.where(F.col("label").isNotNull()))
    out = smart_label(d.drop("label"), model, auto=True)
    return out.select("doc_id", "predicted_label", r6(F.col("confidence")).alias("confidence"),
                      "needs_review", "label")


def q_self_train(spark, sf_dir):
    from ..operators.models import self_train
    d = _model_docs(spark, sf_dir)
    existing = d.where(F.col("label").isNotNull())
    new = d.drop("label")
    # the query's result is the merged set; the final refit is exercised by the job tests
    merged = self_train(existing, new, uid="uid", series="series_id", key="doc_id", order_col="doc_id",
                        fit_final=False).merged
    return merged.select("doc_id", "label", "label_source")


# --------------------------------------------------------------------- J (a given model)
GIVEN_NUMERIC = {"hour": (0.2, 0.3), "is_weekend": (2.0, -0.25), "venue_library": (1.0, 0.5),
                 "venue_park": (1.0, -0.4), "venue_museum": (1.0, 0.7)}
GIVEN_INTERCEPT = -2.0
GIVEN_PLATT = (1.3, -0.2)


def _given_docs(spark, sf_dir):
    """Documents as events: start and place follow the id, every sixth has no start."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 5003)
    place = F.when(F.col("doc_id") % 5 == 0, "City Library").when(F.col("doc_id") % 5 == 1, "Central Park").when(
        F.col("doc_id") % 5 == 2, "Art Gallery").otherwise(F.col("location"))
    return _model_docs(spark, sf_dir).withColumns({
        "start": F.when(F.col("doc_id") % 6 != 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss")), "location": place})


def _given_model(docs):
    """The trainer's features (I5, I7) of all documents with coefficients by rule in place of a fit."""
    from ..operators import models as J
    from ..session import written_table
    spec = J.FeatureSpec(kind="trainer")
    counts = I.corpus_terms(spec.prepare(docs).select("doc_id", "_text"), "doc_id", "_text")
    n = docs.agg(F.count(F.lit(1))).scalar()
    vocab = I.pruned(counts, n, spec.min_df, spec.max_df)
    coef = ((F.ascii("term") * 31 + F.length("term")) % 21 - 10) / F.lit(10.0)
    terms = written_table(vocab.select("term", I.smooth_idf(n).alias("idf"), coef.alias("coef")))
    return J.TextModel(spec, terms, terms.count(), GIVEN_NUMERIC, GIVEN_INTERCEPT, platt=GIVEN_PLATT)


def q_linear_scores(spark, sf_dir):
    from ..operators.models import margin_confidence_expr, predict
    docs = _given_docs(spark, sf_dir)
    out = predict(docs, _given_model(docs))
    return out.select("doc_id", r6(F.col("score")).alias("score"), "predicted_label",
                      r6(margin_confidence_expr(F.col("score"))).alias("prediction_confidence"))


def q_classify_given(spark, sf_dir):
    from ..operators.models import classify
    docs = _given_docs(spark, sf_dir)
    out = classify(docs, _given_model(docs))
    return out.select("doc_id", "is_community_event", r6(F.col("confidence")).alias("confidence"), "needs_review")


def q_smart_label_given(spark, sf_dir):
    from ..operators.models import smart_label
    docs = _given_docs(spark, sf_dir)
    existing = docs.where(F.col("label").isNotNull()).select("doc_id", "uid", "label")
    out = smart_label(docs.drop("label"), _given_model(docs), auto=True, existing=existing, order_col="doc_id",
                      columns=["doc_id", "uid"])
    return out.select("doc_id", "label", "predicted_label", r6(F.col("confidence")).alias("confidence"), "needs_review")


def q_self_train_given(spark, sf_dir):
    from ..operators.models import self_train
    docs = _given_docs(spark, sf_dir)
    merged = self_train(docs.where(F.col("label").isNotNull()), docs.drop("label"), order_col="doc_id",
                        fit_final=False, first=_given_model(docs)).merged
    return merged.select("doc_id", "label", "label_source")


def q_platt_calibration(spark, sf_dir):
    from ..operators.models import platt_newton
    lab = load(spark, sf_dir, "labels").where("quality in (0, 1)")
    margins = load(spark, sf_dir, "documents").join(lab, "doc_id").select(
        ((F.col("n_chars") % 1000 - 500) / F.lit(250.0) + (F.col("quality") - 0.5)).alias("_s"), F.col("quality").alias("label"))
    found = platt_newton(margins)
    return spark.createDataFrame([(round(found["a"], 6), round(found["b"], 6), found["converged"])], "a double, b double, converged boolean")


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
