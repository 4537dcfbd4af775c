"""End-to-end jobs composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import propagate as P
from ..operators import report as R
from ..session import written_table
from .queries import docs_labelled


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents + labels -> series key (lang|source) -> majority fill -> label counts."""
    d = docs_labelled(spark, sf_dir).select("doc_id", "series_id", "label")
    filled = P.propagate_majority_fill(d)
    return R.value_counts(filled, "label").select(F.col("label"), F.col("n"))


def scrape_frame(month_pages: DataFrame, detail_pages: DataFrame, ics_files: DataFrame,
                 base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """§3.1 extraction on stored inputs: month pages -> detail links
    -> calendar URL per detail page (C4-C7) -> each calendar once (C8) ->
    events (C9-C11). ``detail_pages(url, html)``, ``ics_files(ics_url,
    content)``. Links resolve against ``base``, by default each page's own
    origin. Returns (events, pages without a calendar URL)."""
    from ..operators import extract as C
    b = base
    links = C.extract_event_links(month_pages, base=b)
    pages = (links.join(detail_pages, links.link == detail_pages.url, "left")
             .select("page_id", F.col("pos").alias("link_pos"), F.col("link").alias("url"), "html"))
    resolved = C.resolve_ics_url(pages.withColumn("html", F.coalesce("html", F.lit(""))), base=b)
    firsts = C.dedupe_ics(resolved.withColumn("_order", F.struct("page_id", "link_pos")), order_col="_order")
    cal = firsts.join(ics_files, "ics_url").select(F.col("ics_url").alias("source_ics"), "source_page", "content")
    errors = resolved.where(F.col("ics_url").isNull()).select("url")
    return C.parse_vevents(cal), errors


def calendar_scan_job(spark: SparkSession, path: str, out: str, page_map: DataFrame | None = None) -> dict:
    """Stored calendar files to events (A6, C9), with the files and blocks that
    were skipped and why: ``out``/events and ``out``/skipped are Parquet tables.
    Returns the number of events and, per reason, of skipped files."""
    from ..operators import extract as C
    from ..sources import readers as A
    files, errors = A.scan_ics(spark, path, page_map=page_map)
    C.parse_vevents(files).write.mode("overwrite").parquet(f"{out}/events")
    errors.write.mode("overwrite").parquet(f"{out}/skipped")
    skipped = spark.read.parquet(f"{out}/skipped").groupBy("error").agg(F.count(F.lit(1)).alias("n"))
    return {"events": spark.read.parquet(f"{out}/events").count(),
            "skipped": {r.error: r.n for r in skipped.collect()}}  # four reasons at most


def periodic_run(events: DataFrame, model, out_base: str, run_ts: str | None = None,
                 export_fmt: str = "csv") -> dict:
    """§3.1 after extraction: snapshot (A9), classify (J9), accept (D5),
    export (A10), review statistics and rows (H4, B10), calendar payloads
    (K1, K2). The classified frame is written once, in the shared folder."""
    from ..operators import models as J
    from ..operators import publish as K
    from ..operators import rules as D
    from ..operators import shaping as B
    from ..sources import writers as W
    ts = W.write_run_snapshot(events, f"{out_base}/scraped", run_ts)
    classified = written_table(J.classify(events, model))  # scored once; everything below reads the table
    community = D.accepted(classified)
    return {"run_ts": ts, "export": W.export_for_calendar(community, f"{out_base}/calendar_upload", ts, export_fmt),
            "stats": R.batch_stats(classified).first().asDict(), "review": B.review_rows(community),
            "posts": K.calendar_post(K.calendar_meta(community)), "community": community}


def train_job(spark: SparkSession, path: str, model_path: str, propagate: bool = False,
              collapse: bool = False, columns: dict | None = None) -> dict:
    """§3.2 trainer: load (A4) -> ensure columns (B3) -> series key (E3) ->
    optional strict propagation (F2) -> labelled rows (D3) -> optional
    collapse (G5) -> group split (J6) + balanced SVM (J2) -> holdout report
    (H9, H10) -> save (A14) -> class balance (H8)."""
    from ..operators import merge as G
    from ..operators import models as J
    from ..operators import rules as D
    from ..operators import shaping as B
    from ..sources.readers import load_any
    cols = {"id": "uid", "url": "url", "title": "title", "desc": "description", "start": "start",
            "loc": "location", "label": "label"}
    cols.update(columns or {})
    df = B.ensure_columns(load_any(spark, path), [cols["title"], cols["desc"], cols["start"], cols["loc"]])
    if "series_id" not in df.columns:
        df = B.make_series_id(df, cols["id"], cols["url"], cols["title"], cols["loc"])
    if propagate and cols["label"] in df.columns:
        df = P.propagate_unanimous_strict(df, "series_id", cols["label"])
    lab = D.labeled_only(df, cols["label"]).withColumn(
        "label", F.regexp_replace(F.col(cols["label"]).cast("string"), r"\.0", "").cast("int"))
    if collapse:
        lab = G.collapse_series(lab, "series_id", cols["desc"])
    spec = J.FeatureSpec(kind="trainer", title=cols["title"], desc=cols["desc"], start=cols["start"], loc=cols["loc"])
    guards = R.train_guards(lab).first()
    report, matrix = None, None
    if guards["can_group_split"]:
        s = J.group_split(lab, "series_id")
        model = J.fit_svm_balanced(s.where(F.col("split") == "train"), spec)
        scored = J.predict(s.where(F.col("split") == "test"), model, out="prediction")
        scored = written_table(scored.select("label", "prediction"))
        report = R.classification_report(scored).collect()
        matrix = R.confusion_matrix(scored).collect()
    else:
        model = J.fit_svm_balanced(lab, spec)
    model.columns = cols
    model.save(model_path)
    balance = R.class_balance(lab).first().asDict()
    return {"report": report, "confusion_matrix": matrix, "balance": balance, "fit": model.fit}


def tag_job(spark: SparkSession, model_path: str, path: str, out: str | None = None,
            confidence: bool = False) -> dict:
    """§3.2 tagger: load model (A14) and events (A4), tag (J10), counts (H5),
    write (A11, default ``<stem>_tagged.csv``)."""
    from ..operators import models as J
    from ..sources.readers import load_any
    from ..sources.writers import default_output, write_tagged
    model = J.TextModel.load(spark, model_path)
    tagged = J.tag(load_any(spark, path), model, confidence=confidence)
    counts = R.prediction_counts(tagged).first().asDict()
    target = out or default_output(path, "tagged")
    write_tagged(tagged, target)
    return dict(counts, output=target)


def self_train_job(spark: SparkSession, existing_path: str, new_path: str, out: str, model_path: str) -> dict:
    """§3.3: self-training (J8) over two event files; merged rows written, model saved."""
    from ..operators import models as J
    from ..operators import shaping as B
    from ..sources.readers import load_any
    existing = load_any(spark, existing_path)
    existing = existing.withColumn("label", F.col("label").cast("string").try_cast("double").cast("int"))
    new = B.ensure_columns(load_any(spark, new_path), ["label"], default=None)
    new = new.withColumn("label", F.col("label").cast("string").try_cast("double").cast("int"))
    existing = B.extract_series_id(existing) if "uid" in existing.columns else existing
    new = B.extract_series_id(new) if "uid" in new.columns else new
    done = J.self_train(existing, new, uid="uid", series="series_id")
    done.merged.write.mode("overwrite").parquet(out)
    if done.model is not None:
        done.model.save(model_path)
    counts = done.merged.agg(F.count("label").alias("labeled"), F.count(F.lit(1)).alias("total")).first().asDict()
    return dict(counts, unlabeled=counts["total"] - counts["labeled"], first_accuracy=done.first_accuracy,
                report=done.report.collect() if done.report is not None else None)


def labelset_job(spark: SparkSession, path: str, out_base: str) -> tuple[str, str]:
    """Label-set builder: load (A4, JSON of a known shape only) -> canonical columns (B1) -> event ids
    (B2) -> hand-labelling set with weak labels (B4, D1) -> both written (A13)."""
    from ..operators import shaping as B
    from ..sources.readers import load_any
    from ..sources.writers import write_labelset
    canonical = B.ensure_event_id(B.canonicalize(load_any(spark, path, strict=True)))
    return write_labelset(canonical, B.labelset_projection(canonical), out_base)


def fill_job(spark: SparkSession, path: str, out: str | None = None, label: str = "label",
             columns: dict | None = None) -> dict:
    """Unanimous series fill: load -> series key if absent (E3) -> F1 ->
    coverage (F5), filled-series summary (H2), remaining sample (G6) ->
    write (A11, default ``<stem>_filled``)."""
    from ..functions.text import parse_label
    from ..operators import merge as G
    from ..operators import shaping as B
    from ..sources.readers import load_any
    from ..sources.writers import default_output, write_tagged
    cols = {"id": "uid", "url": "url", "title": "title", "loc": "location"}
    cols.update(columns or {})
    df = load_any(spark, path).withColumn("_ord", F.monotonically_increasing_id())
    if "series_id" not in df.columns:
        df = B.make_series_id(df, cols["id"], cols["url"], cols["title"], cols["loc"])
    df = B.ensure_columns(df, [label], default=None)
    filled = P.propagate_unanimous(df.withColumn("_before", F.col(label)), "series_id", label)
    cov = P.coverage(filled, "_before", label, variant="mask").first().asDict()
    summary = R.series_summary(filled, label=label, title=cols["title"], order_col="_ord").collect()
    remaining = G.distinct_series_sample(filled.where(parse_label(label, "mask").isNull()),
                                         title=cols["title"], order_col="_ord").collect()
    target = out or default_output(path, "filled")
    write_tagged(filled.drop("_before", "_ord"), target)
    return {"coverage": cov, "summary": summary, "remaining": remaining, "output": target}


def merge_propagate_job(spark: SparkSession, path: str, out: str) -> dict:
    """Merge and propagate: manual label else prediction (G1) -> majority
    fill in valid series (F4, D9) -> promote (B8) -> write -> label counts
    (H1, nulls kept) and unlabelled series (H3)."""
    from ..operators import merge as G
    from ..operators import shaping as B
    from ..sources.readers import load_any
    df = load_any(spark, path).withColumn("_ord", F.monotonically_increasing_id())
    for c in ("label", "predicted_label"):
        df = df.withColumn(c, F.col(c).cast("string").try_cast("double"))
    merged = G.merge_manual_predicted(df)
    filled = B.promote_label(P.propagate_majority_fill(merged, "series_id", "final_label"))
    filled.drop("_ord").write.mode("overwrite").parquet(out)
    return {"counts": R.value_counts(filled, "label").collect(),
            "unlabeled": R.unlabeled_series(filled, order_col="_ord").collect()}


def smart_label_job(spark: SparkSession, model_path: str, new_path: str, out: str | None = None,
                    existing_path: str | None = None, threshold: float = 0.55, auto: bool = False) -> dict:
    """Smart labelling: tag with margin confidence and review flags (J11),
    optional auto-accept, merged after existing rows by uid (G4); counts
    (H6, H1) and the flagged preview (D10)."""
    from ..operators import models as J
    from ..operators import rules as D
    from ..sources.readers import load_any
    from ..sources.writers import default_output, write_tagged
    model = J.TextModel.load(spark, model_path)
    existing = load_any(spark, existing_path) if existing_path else None
    out_df = J.smart_label(load_any(spark, new_path), model, threshold, auto, existing)
    write_tagged(out_df, out or default_output(new_path, "smart_labeled"))
    return {"confidence": R.confidence_breakdown(out_df, threshold=threshold).first().asDict(),
            "labels": R.value_counts(out_df, "predicted_label", dropna=True).collect(),
            "flagged": D.flagged(out_df).collect()}


def upload_job(spark: SparkSession, export_base: str, dim_locations: DataFrame | None = None,
               dry_run: bool = True) -> dict:
    """Uploader: newest export (A12) -> dry run review lines (K5), or
    location ids (K3) -> metadata (K1) -> post payloads (K2)."""
    from ..operators import publish as K
    from ..sources.readers import read_latest_export
    rows = read_latest_export(spark, export_base)
    if dry_run:
        return {"plan": K.upload_plan(rows).select("plan_line")}
    dim = dim_locations if dim_locations is not None else spark.createDataFrame([], "id bigint, name string")
    with_ids, updated_dim = K.upsert_locations(rows, dim)
    posts = K.calendar_post(K.calendar_meta(with_ids, location_id="location_id"))
    return {"posts": posts, "locations": updated_dim}


#: Columns of the calendar's post table.
POSTS = "id bigint, uid string, status string, title string, content string, type string, meta map<string,string>"


def upload_key(rows: DataFrame):
    """What makes an event the same post: its uid, else a hash of title and start."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("title", "start")]
    return F.coalesce(F.col("uid").cast("string"), F.concat(F.lit("row "), F.xxhash64(*text).cast("string")))


def upload_publish_job(events: DataFrame, posts: DataFrame, dim_locations: DataFrame,
                       failed: DataFrame | None = None) -> dict:
    """Upload, then publish: accepted events that ``posts`` (columns ``POSTS``)
    does not hold yet are created as drafts with location ids (K3), metadata
    (K1) and payload (K2), then published (K4). An event is uploaded once,
    whatever run brings it again; copies within a run count once; events whose
    key is in ``failed`` (uid) are not created.

    Returns the new post table and location dimension, the upload outcome (K5:
    created of total), how many were published, and the summary's rows (B11)."""
    from ..operators import merge as G
    from ..operators import publish as K
    from ..operators import shaping as B
    from ..operators.numbering import dense_index
    ready = B.ensure_columns(events, ["uid", "title", "description", "start", "end", "location", "url"], default=None)
    keyed = ready.withColumn("uid", upload_key(ready)).join(posts.select("uid"), "uid", "left_anti")
    once = written_table(G.keep_first(keyed, "uid", F.xxhash64(*[F.col(f"`{c}`") for c in keyed.columns])))
    created = once if failed is None else once.join(failed.select("uid"), "uid", "left_anti")
    with_ids, locations = K.upsert_locations(created, dim_locations)
    top = F.coalesce(posts.agg(F.max("id")).scalar(), F.lit(0))
    drafts = K.calendar_post(K.calendar_meta(with_ids, location_id="location_id"))
    numbered = dense_index(drafts, [F.col("uid")], out="_n").withColumn("id", (top + F.col("_n")).cast("bigint"))
    new = written_table(numbered.select("id", "uid", F.col("post.status").alias("status"), F.col("post.title").alias("title"),
                                        F.col("post.content").alias("content"), F.col("post.type").alias("type"),
                                        F.col("post.meta").alias("meta")))
    published = K.publish(new, new.select("id"))
    outcome = K.upload_outcome(once, new, "uid").first().asDict()
    outcome["published"] = published.where(F.col("status") == "publish").count()
    return {"posts": posts.unionByName(published), "new_posts": published, "locations": locations, "outcome": outcome,
            "summary": B.published_rows(created, keep=["uid"])}


def calendar_job(month_pages: DataFrame, detail_pages: DataFrame, ics_files: DataFrame, model, out_base: str,
                 posts: DataFrame, dim_locations: DataFrame, run_ts: str | None = None, base: str | None = None) -> dict:
    """One run from stored pages to the published summary (§3.1): extraction,
    classification and export (``periodic_run``), upload and publication. The
    result joins both parts' results (the new post table as ``posts_table``) and
    the pages without a calendar URL."""
    events, errors = scrape_frame(month_pages, detail_pages, ics_files, base)
    run = periodic_run(written_table(events), model, out_base, run_ts)
    done = upload_publish_job(run["community"], posts, dim_locations)
    return {**run, **done, "posts": run["posts"], "posts_table": done["posts"], "errors": errors}


def health_job(posts: DataFrame, pages: DataFrame, now_epoch: int, threshold: int = 5,
               require_page: bool = False, api_ok: bool = True) -> dict:
    """Monitor: upcoming count over all published posts (L2), calendar
    markup on the public page(s) (L3) -> verdict (L4)."""
    from ..operators import monitor as L
    up = L.count_upcoming(posts, F.lit(now_epoch))
    ok = L.markup_detected(pages).agg(F.coalesce(F.bool_or("markup_detected"), F.lit(False)).alias("page_ok"))
    return L.health_verdict(up, ok, api_ok=api_ok, threshold=threshold, require_page=require_page).first().asDict()


def delete_job(posts: DataFrame, lo: int, hi: int) -> tuple[DataFrame, dict]:
    """Cleanup: remove posts with ids in [lo, hi] (K6); outcome counts."""
    from ..operators import publish as K
    remaining, outcome = K.delete_range(posts, lo, hi)
    return remaining, outcome.first().asDict()
