"""Grouped label propagation within recurrence series.

Plan shape for all variants: one aggregate per series (partial aggregation
on the map side, so a series holding a third of all rows costs one small
buffer per task), then a left join of that aggregate back onto the rows. AQE
turns the join into a broadcast when the aggregate is small at run time and
splits skewed partitions otherwise. No window: a window would sort every row
of a hot series inside one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_label
from .shaping import NO_SERIES

SOURCE_MANUAL = "manual_or_previous"
SOURCE_MODEL = "model_prediction"
SOURCE_SERIES = "series_propagation"


def _keyed(df: DataFrame, series: str, drop_empty: bool = False) -> DataFrame:
    s = F.col(series)
    cond = s.isNotNull() & (s.cast("string") != NO_SERIES)
    if drop_empty:
        cond = cond & (s.cast("string") != "")
    return df.where(cond)


def _same_type(value, like: str, df: DataFrame):
    return value.cast(df.schema[like].dataType)


def _join_series(df: DataFrame, agg: DataFrame, series: str, drop_empty: bool = False) -> DataFrame:
    """Rows with their series' aggregate. Rows without a series find nothing,
    however many they are: a salt from the row itself spreads them over all
    tasks, while rows of a series and the aggregates share salt 0."""
    s = F.col(series)
    none = s.isNull() | (s.cast("string") == NO_SERIES)
    if drop_empty:
        none = none | (s.cast("string") == "")
    salted = df.withColumn("_salt", F.when(none, F.monotonically_increasing_id()).otherwise(F.lit(0)))
    one = agg.withColumn("_salt", F.lit(0).cast("long")).withColumnRenamed(series, "_series")
    return salted.join(one, (salted[series] == one["_series"]) & (salted["_salt"] == one["_salt"]), "left").drop(salted["_salt"], one["_salt"], "_series")


def propagate_unanimous(df: DataFrame, series: str = "series_id", label: str = "label",
                        strict: bool = False) -> DataFrame:
    """F1 (F2 with ``strict=True``): a series with exactly one distinct valid
    label gives it to each of its rows whose label is not valid; series in
    conflict are untouched; rows without a series keep their label (Δ4)."""
    valid = parse_label(label, "strict" if strict else "fill")
    mask = parse_label(label, "strict" if strict else "mask")
    agg = (_keyed(df, series).where(valid.isNotNull())
           .groupBy(series).agg(F.min(valid).alias("_mn"), F.max(valid).alias("_mx")))
    j = _join_series(df, agg, series)
    fill = (F.col("_mn") == F.col("_mx")) & mask.isNull()
    return j.withColumn(label, F.when(fill, _same_type(F.col("_mn"), label, df)).otherwise(F.col(label))) \
            .select(*df.columns)


def propagate_unanimous_strict(df: DataFrame, series: str = "series_id", label: str = "label") -> DataFrame:
    """only the exact strings ``0``/``1`` count."""
    return propagate_unanimous(df, series, label, strict=True)


def majority(df: DataFrame, series: str, label: str, drop_empty: bool = False) -> DataFrame:
    """Most common non-null label per series, ties to the smaller value."""
    return (_keyed(df, series, drop_empty).where(F.col(label).isNotNull())
            .groupBy(series).agg(F.mode(label, True).alias("_maj")))


def propagate_majority_overwrite(df: DataFrame, series: str = "series_id", label: str = "label",
                                 source: str = "label_source", protect_manual: bool = False) -> DataFrame:
    """the series majority overwrites *every* row of the series, manual
    ones included (Δ11: ``protect_manual=True`` keeps manual labels), and
    marks them ``series_propagation``; series without labels are untouched."""
    if source not in df.columns:
        df = df.withColumn(source, F.lit(None).cast("string"))
    j = _join_series(df, majority(df, series, label), series)
    hit = F.col("_maj").isNotNull()
    if protect_manual:
        hit = hit & ~F.coalesce(F.col(source) == SOURCE_MANUAL, F.lit(False))
    return (j.withColumn(label, F.when(hit, _same_type(F.col("_maj"), label, df)).otherwise(F.col(label)))
             .withColumn(source, F.when(hit, F.lit(SOURCE_SERIES)).otherwise(F.col(source)))
             .select(*df.columns))


def propagate_majority_fill(df: DataFrame, series: str = "series_id", label: str = "label") -> DataFrame:
    """the series majority fills null labels only; valid series only."""
    j = _join_series(df, majority(df, series, label, drop_empty=True), series, drop_empty=True)
    return j.withColumn(label, F.coalesce(F.col(label), _same_type(F.col("_maj"), label, df))) \
            .select(*df.columns)


def coverage(df: DataFrame, before: str, after: str, variant: str | None = None) -> DataFrame:
    """labelled before/after, newly filled and remaining, in one pass.

    ``variant=None`` counts non-null values; otherwise a ``parse_label``
    variant decides what counts as labelled.
    """
    def lab(c):
        return F.col(c).isNotNull() if variant is None else parse_label(c, variant).isNotNull()
    row = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(lab(before)).alias("labeled_before"),
                 F.count_if(lab(after)).alias("labeled_after"))
    return row.select("total", "labeled_before", "labeled_after",
                      (F.col("labeled_after") - F.col("labeled_before")).alias("filled"),
                      (F.col("total") - F.col("labeled_after")).alias("remaining"))
