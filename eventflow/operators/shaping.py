"""Projections and schema shaping (B1-B11) and key building."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_text, norm_str, norm_url, py_strip, title_desc_text, weak_label_expr
from ..functions.timefmt import display_datetime, parse_start, percent_1

# ---------------------------------------------------------------------------
# Canonical column -> source aliases, first present wins.
CANONICAL_ALIASES = {
    "event_id": ["uid", "event_id", "id", "url"],
    "title": ["title", "name"],
    "description": ["description", "summary", "details"],
    "url": ["url", "source_page"],
    "location": ["location", "venue", "place", "address"],
    "start_time": ["start", "start_time", "startDate"],
    "end_time": ["end", "end_time", "endDate"],
    "cost_text": ["cost_text", "price", "fee"],
    "tags": ["category", "tags", "categories"],
    "source": ["source", "source_page"],
}
LABELSET_COLUMNS = ["event_id", "title", "description", "start_time", "location", "url"]
CSV_COLUMNS = ["title", "start", "end", "location", "url", "description", "uid", "category"]
NO_SERIES = "|"
# ---------------------------------------------------------------------------

EVENT_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("category", T.ArrayType(T.StringType())),
    T.StructField("last_modified", T.StringType()),
    T.StructField("created", T.StringType()),
    T.StructField("source_ics", T.StringType()),
    T.StructField("source_page", T.StringType()),
])


def canonicalize(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """B1: per target column the first alias present in the schema, else ''."""
    present = set(df.columns)
    cols = []
    for target, aliases in (mapping or CANONICAL_ALIASES).items():
        hit = next((a for a in aliases if a in present), None)
        cols.append((F.col(f"`{hit}`") if hit else F.lit("")).alias(target))
    return df.select(*cols)


def ensure_event_id(df: DataFrame) -> DataFrame:
    """B2: only when every event_id is '' use url (if any url is non-empty),
    else a stable hash of ``title|start_time`` (Δ5).

    The two frame-wide flags come from one aggregate used as scalar
    subqueries, so the plan stays lazy and needs no cross join.
    """
    flags = df.agg(F.bool_and(F.coalesce(F.col("event_id").cast("string") == "", F.lit(False))).alias("all_empty"),
                   F.bool_or(F.coalesce(F.col("url") != "", F.lit(False))).alias("any_url"))
    all_empty = flags.select("all_empty").scalar()
    any_url = flags.select("any_url").scalar()
    code = F.xxhash64(as_text("title"), F.lit("|"), as_text("start_time")).cast("string")
    return df.withColumn(
        "event_id",
        F.when(~F.coalesce(all_empty, F.lit(True)), F.col("event_id"))
        .when(any_url, F.col("url")).otherwise(code))


def ensure_columns(df: DataFrame, cols, default="") -> DataFrame:
    """Add absent columns with a default (None -> null string)."""
    missing = {c: F.lit(default).cast("string") for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def labelset_projection(df: DataFrame, pos: str | None = None, neg: str | None = None) -> DataFrame:
    """B4 + D1: six canonical columns, weak label over lower(title+desc), blank label."""
    text = title_desc_text("title", "description", lower=True)
    rules = {} if pos is None else {"pos": pos}
    if neg is not None:
        rules["neg"] = neg
    return df.select(*LABELSET_COLUMNS, weak_label_expr(text, **rules).alias("weak_label"),
                     F.lit("").alias("label"))


def promote_label(df: DataFrame, final: str = "final_label", label: str = "label") -> DataFrame:
    """Label := final_label, helper dropped."""
    return df.withColumn(label, F.col(final)).drop(final)


def review_rows(df: DataFrame, title="title", start="start", location="location",
                confidence="confidence", needs_review="needs_review", threshold: float = 0.75,
                keep=()) -> DataFrame:
    """Rows of the review summary, formatted as the reviewer sees them."""
    conf = F.col(confidence)
    flag = F.col(needs_review)
    return df.select(
        *keep, F.col(title).alias("title"),
        display_datetime(parse_start(start)).alias("start_text"),
        F.coalesce(F.col(location).cast("string"), F.lit("N/A")).alias("location_text"),
        percent_1(conf).alias("confidence_text"),
        F.when(flag, "Review Needed").otherwise("High Confidence").alias("status"),
        F.when(conf >= threshold, "high-confidence").otherwise("low-confidence").alias("confidence_class"),
        F.when(flag, "review-needed").otherwise("").alias("row_class"))


def published_rows(df: DataFrame, title="title", start="start", location="location",
                   confidence="confidence", keep=()) -> DataFrame:
    """Rows of the publication summary; confidence 0 when the column is absent."""
    conf = F.col(confidence) if confidence in df.columns else F.lit(0.0)
    return df.select(
        *keep, F.col(title).alias("title"),
        display_datetime(parse_start(start)).alias("start_text"),
        F.coalesce(F.col(location).cast("string"), F.lit("N/A")).alias("location_text"),
        percent_1(conf).alias("confidence_text"))


def make_series_id(df: DataFrame, id_col="uid", url_col="url", title_col="title",
                   loc_col="location", out="series_id") -> DataFrame:
    """Trimmed uid, else normalised url, else ``norm(title)|norm(loc)``.

    Absent columns act as ''. A null uid counts as empty (Δ3).
    """
    def get(c):
        return F.col(c) if c in df.columns else F.lit("")
    uid = py_strip(as_text(get(id_col)))
    url = norm_url(get(url_col))
    key = (F.when(uid != "", uid).when(url != "", url)
           .otherwise(F.concat(norm_str(get(title_col)), F.lit("|"), norm_str(get(loc_col)))))
    return df.withColumn(out, key)


def extract_series_id(df: DataFrame, uid="uid", out="series_id",
                      pattern: str = r"series_id=(\d+)") -> DataFrame:
    """Digits after ``series_id=`` as a number; only when ``out`` is absent
    or wholly null (checked lazily with a scalar subquery)."""
    num = F.regexp_extract(F.col(uid).cast("string"), pattern, 1)
    extracted = F.when(num != "", num.try_cast("bigint"))
    if out not in df.columns:
        return df.withColumn(out, extracted)
    has_any = df.agg(F.count(out).alias("n")).select((F.col("n") > 0).alias("b")).scalar()
    return df.withColumn(out, F.when(has_any, F.col(out).cast("bigint")).otherwise(extracted))
