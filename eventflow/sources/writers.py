"""Sinks (A7-A11, A13, A14): event files, run snapshots, calendar exports."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import flatten_category
from ..operators.shaping import CSV_COLUMNS, LABELSET_COLUMNS

RUN_TS_FORMAT = "%Y%m%d_%H%M%S"


def run_timestamp(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now()).strftime(RUN_TS_FORMAT)


def write_events_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All event fields, UTF-8, as JSON Lines part files (Δ9)."""
    df.write.mode(mode).option("encoding", "UTF-8").json(path)


def csv_projection(df: DataFrame) -> DataFrame:
    """The 8-column CSV form with the category list joined by ``;``."""
    cols = []
    for c in CSV_COLUMNS:
        if c not in df.columns:
            cols.append(F.lit(None).cast("string").alias(c))
        elif c == "category" and isinstance(df.schema[c].dataType, T.ArrayType):
            cols.append(flatten_category(F.col(c)).alias(c))
        else:
            cols.append(F.col(c).cast("string").alias(c))
    return df.select(*cols)


def write_events_csv(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Header + 8 columns; an empty input writes nothing (returns False)."""
    if df.isEmpty():
        return False
    csv_projection(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return True


def write_run_snapshot(df: DataFrame, base: str, run_ts: str | None = None) -> str:
    """Raw scrape appended under ``run_ts=<%Y%m%d_%H%M%S>``."""
    ts = run_ts or run_timestamp()
    df.withColumn("run_ts", F.lit(ts)).write.mode("append").partitionBy("run_ts").parquet(base)
    return ts


def export_for_calendar(df: DataFrame, base: str, run_ts: str | None = None, fmt: str = "csv") -> str | None:
    """A10: accepted rows as csv or json under ``run_ts=...``; any other
    format writes nothing (the reference's iCal export is a TODO)."""
    ts = run_ts or run_timestamp()
    path = f"{base}/run_ts={ts}"
    if fmt == "csv":
        csv_safe(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        return path
    if fmt == "json":
        df.write.mode("overwrite").json(path)
        return path
    return None


def default_output(path: str, suffix: str) -> str:
    """Default output name next to the input: ``<stem>_<suffix>.csv`` (A11;
    CSV whatever the input format, as the reference names it)."""
    p = path.rstrip("/")
    head, _, tail = p.rpartition("/")
    stem = tail.rsplit(".", 1)[0] if "." in tail else tail
    name = f"{stem}_{suffix}.csv"
    return f"{head}/{name}" if head else name


def csv_safe(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text (CSV holds flat values only)."""
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def write_tagged(df: DataFrame, path: str) -> str:
    """``.json`` -> JSON records, anything else -> CSV with header."""
    if path.lower().endswith(".json"):
        df.write.mode("overwrite").json(path)
    else:
        csv_safe(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_labelset(canonical: DataFrame, labelset: DataFrame, base: str) -> tuple[str, str]:
    """The canonical events and the hand-labelling set."""
    raw, lbl = f"{base}/events_latest", f"{base}/labelset"
    canonical.write.mode("overwrite").option("header", True).option("escape", '"').csv(raw)
    labelset.select(*LABELSET_COLUMNS, "weak_label", "label").write.mode("overwrite") \
        .option("header", True).option("escape", '"').csv(lbl)
    return raw, lbl
