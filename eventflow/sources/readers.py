"""Scans (A1-A6, A12): event files, pages, calendar files, latest export.

Multi-line CSV/JSON and whole calendar files are not splittable; at scale
read them once and keep them as parquet (``to_parquet``), which every later
plan scans with column pruning and filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ics import vevent_blocks
from ..operators.staging import stage

# ---------------------------------------------------------------------------
# Text markers pandas' CSV reader turns into missing values.
PANDAS_NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# ---------------------------------------------------------------------------


def read_events_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    pandas_na: bool = True) -> DataFrame:
    """A1: CSV with a header; descriptions may hold line breaks and quotes.

    All columns are read as text (labels are parsed later by ``parse_label``);
    the usual missing-value markers become null.
    """
    r = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
         .option("mode", "PERMISSIVE"))
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", False).csv(path)
    if not pandas_na:
        return df
    return df.select(*[
        F.when(F.col(f"`{f.name}`").isin(*PANDAS_NA), F.lit(None)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """A3: nested objects become dotted columns; arrays stay arrays."""
    def walk(dtype, path, name):
        if isinstance(dtype, T.StructType):
            out = []
            for f in dtype.fields:
                out += walk(f.dataType, path + [f.name], f"{name}{sep}{f.name}" if name else f.name)
            return out
        ref = F.col(".".join(f"`{p}`" for p in path))
        return [ref.alias(name)]
    cols = []
    for f in df.schema.fields:
        cols += walk(f.dataType, [f.name], f.name)
    return df.select(*cols)


def read_events_json(spark: SparkSession, path: str, strict: bool = False,
                     schema: T.StructType | None = None) -> DataFrame:
    """A2: a JSON array of events, or an object whose ``events`` key holds
    the array; nested objects flattened (A3).

    ``strict=True`` (the label-set builder) rejects any other shape.
    """
    r = spark.read.option("multiLine", True)
    if strict:
        # the first sign of each file tells a list from an object
        heads = (spark.read.option("wholetext", True).text(path)
                 .select(F.substring(F.regexp_replace("value", r"^[\uFEFF\s]+", ""), 1, 1).alias("head"),
                         F.col("value").rlike(r'"events"\s*:\s*\[').alias("wrapped")))
        if heads.where((F.col("head") != "[") & ~((F.col("head") == "{") & F.col("wrapped"))).limit(1).count():
            raise ValueError("JSON must be a list or an object with 'events'")
    raw = r.schema(schema).json(path) if schema is not None else r.json(path)
    if "events" in raw.columns and isinstance(raw.schema["events"].dataType, T.ArrayType):
        elem = raw.schema["events"].dataType.elementType
        if not isinstance(elem, T.StructType):
            raise ValueError("JSON 'events' must be a list of objects")
        raw = raw.select(F.explode("events").alias("_e")).select("_e.*")
    elif strict and "_corrupt_record" in raw.columns:
        raise ValueError("JSON must be a list or an object with 'events'")
    return flatten_structs(raw)


def load_any(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """A4: dispatch on the file suffix (.csv, .json, .parquet)."""
    low = path.lower().rstrip("/")
    if low.endswith(".csv"):
        return read_events_csv(spark, path)
    if low.endswith(".json"):
        return read_events_json(spark, path, strict=strict)
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError("Input must be .csv, .json or .parquet")


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """A5: stored pages ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def quarantine(files: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """Calendar files as (readable files with their text, error rows).

    ``content`` is bytes or text, null for a file that could not be read. An
    error row holds the other columns, ``error`` and ``n_broken``:

    * ``unreadable``, ``not valid UTF-8``, ``no calendar`` (no BEGIN:VCALENDAR):
      the file is left out, ``n_broken`` is null;
    * ``event without an end``: ``n_broken`` events are begun but not closed
      before the next one or the end; the file's whole events stay.

    One bad file or block ends neither the job nor the rest of its file.
    """
    keep = [F.col(f"`{c}`") for c in files.columns if c != content]
    text = F.col(f"`{content}`").cast("string")
    lost = (F.when(text.isNull(), F.lit("unreadable")).when(~F.is_valid_utf8(text), F.lit("not valid UTF-8"))
            .when(~text.rlike(r"(?i)^[\uFEFF\s]*BEGIN:VCALENDAR"), F.lit("no calendar")))
    judged = stage(files, {"_lost": lost})
    good = judged.where(F.col("_lost").isNull()).select(*keep, text.alias("content"))
    begun = F.regexp_count(text, F.lit(r"(?m)^BEGIN:VEVENT\r?$"))
    counted = stage(judged, {"_broken": F.when(F.col("_lost").isNull(), begun - F.size(vevent_blocks(text)))})
    errors = (counted.where(F.col("_lost").isNotNull() | (F.col("_broken") > 0))
              .select(*keep, F.coalesce("_lost", F.lit("event without an end")).alias("error"),
                      F.col("_broken").cast("int").alias("n_broken")))
    return good, errors


def scan_ics(spark: SparkSession, path: str, glob: str = "*.ics",
             page_map: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Calendar files as (one row per readable file: ``source_ics``,
    ``source_page``, ``content``; error rows, see :func:`quarantine`).
    ``page_map(source_ics, source_page)`` attaches provenance when known.

    Files of no bytes are not in Spark's listing; they are no rows and no errors.
    Files that Spark cannot read are found by comparing the listing, which
    reads no content, with the files that were read."""
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
           .option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).load(path))
    read = raw.select(F.col("path").alias("source_ics"), "content")
    good, errors = quarantine(read)
    listed = raw.select(F.col("path").alias("source_ics"))
    unread = listed.join(read.where(F.length("content") >= 0).select("source_ics"), "source_ics", "left_anti")
    errors = errors.unionByName(unread.select("source_ics", F.lit("unreadable").alias("error"), F.lit(None).cast("int").alias("n_broken")))
    if page_map is not None:
        return good.join(page_map, "source_ics", "left").select("source_ics", "source_page", "content"), errors
    return good.select("source_ics", F.lit(None).cast("string").alias("source_page"), "content"), errors


def read_latest_export(spark: SparkSession, base: str, fmt: str = "csv") -> DataFrame:
    """Rows of the most recent export under ``base``: the export folder
    holding the most recently modified file (all its part files), or, for files
    directly under ``base``, that file alone.

    The newest folder comes from file metadata (no content is read), and only
    that folder is read, with its own header.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{fmt}").load(base)
             .select("path", "modificationTime"))
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first().path  # one row
    if newest is None:
        raise FileNotFoundError(f"no .{fmt} export under {base}")
    folder = newest.rsplit("/", 1)[0]
    if folder.split(":", 1)[-1].rstrip("/").lstrip("/") == base.split(":", 1)[-1].rstrip("/").lstrip("/"):
        folder = newest
    return read_events_csv(spark, folder) if fmt == "csv" else read_events_json(spark, folder)
