"""Aggregations, reports, evaluation and top-k.

Counts are single aggregates with ``count_if`` (one pass, partial
aggregation); top-k reports are ``orderBy().limit(k)`` which plans as a
bounded TakeOrderedAndProject, never a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_label


def value_counts(df: DataFrame, col: str, dropna: bool = False, out: str = "n") -> DataFrame:
    """H1: rows per value, descending (ties by value)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return (src.groupBy(col).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.desc(out), F.asc_nulls_last(col)))


def series_summary(df: DataFrame, series: str = "series_id", label: str = "label",
                   title: str = "title", order_col: str = "_ord", k: int = 15,
                   variant: str = "mask") -> DataFrame:
    """H2: per series its labelled count and first title; series with labels
    only, most labelled first (ties by series id), top ``k``."""
    t = F.col(title)
    return (df.groupBy(series)
            .agg(F.count_if(parse_label(label, variant).isNotNull()).alias("labeled_count"),
                 F.min_by(t, F.when(t.isNotNull(), F.col(order_col))).alias("title"))
            .where(F.col("labeled_count") > 0)
            .orderBy(F.desc("labeled_count"), F.asc(series)).limit(k))


def unlabeled_series(df: DataFrame, series: str = "series_id", title: str = "title",
                     label: str = "label", order_col: str = "_ord", k: int = 10) -> DataFrame:
    """H3: first non-null title of each series that still has unlabelled rows,
    first ``k`` series in key order."""
    t = F.col(title)
    return (df.where(F.col(label).isNull()).where(F.col(series).isNotNull())
            .groupBy(series).agg(F.min_by(t, F.when(t.isNotNull(), F.col(order_col))).alias("title"))
            .orderBy(series).limit(k))


def batch_stats(df: DataFrame, pred: str = "is_community_event", flag: str = "needs_review") -> DataFrame:
    """H4: total, accepted, rejected, and needs_review among accepted only."""
    acc = F.col(pred) == 1
    return df.agg(F.count(F.lit(1)).alias("total_events"),
                  F.count_if(acc).alias("community_events"),
                  F.count_if(~acc | F.col(pred).isNull()).alias("non_community_events"),
                  F.count_if(acc & F.col(flag)).alias("needs_review"))


def prediction_counts(df: DataFrame, pred: str = "predicted_label") -> DataFrame:
    """H5: positives and negatives."""
    return df.agg(F.count_if(F.col(pred) == 1).alias("positives"),
                  F.count_if(F.col(pred) == 0).alias("negatives"))


def confidence_breakdown(df: DataFrame, confidence: str = "confidence", threshold: float = 0.55) -> DataFrame:
    """H6: rows at or above / below the threshold."""
    c = F.col(confidence)
    return df.agg(F.count_if(~(c < threshold)).alias("high_confidence"),
                  F.count_if(c < threshold).alias("needs_review"))


def train_guards(df: DataFrame, series: str = "series_id", label: str = "label") -> DataFrame:
    """H7: the thresholds that decide how the trainers split and fit."""
    row = df.where(F.col(label).isNotNull()).agg(
        F.count(F.lit(1)).alias("labeled"),
        F.count_distinct(series).alias("n_series"),
        F.count_distinct(label).alias("n_classes"))
    return row.select("*",
                      ((F.col("n_series") >= 3) & (F.col("n_classes") >= 2)).alias("can_group_split"),
                      (F.col("labeled") >= 5).alias("can_first_model"),
                      (F.col("labeled") >= 10).alias("can_final_model"),
                      (F.col("labeled") >= 20).alias("can_holdout"))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """H8: labelled rows, positives, negatives."""
    lab = parse_label(label, "all_dot0")
    return (df.where(lab.isNotNull())
            .agg(F.count(F.lit(1)).alias("labeled"), F.count_if(lab == 1).alias("positives"))
            .select("labeled", "positives", (F.col("labeled") - F.col("positives")).alias("negatives")))


def confusion_matrix(df: DataFrame, truth: str = "label", pred: str = "prediction",
                     classes=(0, 1)) -> DataFrame:
    """H9: truth x prediction counts, one row per true class."""
    counted = df.groupBy(F.col(truth).cast("int").alias("truth")).pivot(pred, list(classes)).count()
    cols = [F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(f"pred_{c}") for c in classes]
    return counted.where(F.col("truth").isin(*classes)).select("truth", *cols)


def classification_report(df: DataFrame, truth: str = "label", pred: str = "prediction",
                          classes=(0, 1)) -> DataFrame:
    """Per class precision, recall, F1 and support (0 on zero division),
    then accuracy, macro and weighted averages.

    One aggregate over the scored rows (``len(classes)`` counts each); the
    remaining arithmetic runs on that single row.
    """
    t, p = F.col(truth).cast("int"), F.col(pred).cast("int")
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(t == p).alias("correct")]
    for c in classes:
        aggs += [F.count_if((t == c) & (p == c)).alias(f"tp{c}"),
                 F.count_if(t == c).alias(f"sup{c}"), F.count_if(p == c).alias(f"pp{c}")]
    row = df.agg(*aggs)

    def div(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    per = []
    for c in classes:
        prec = div(F.col(f"tp{c}").cast("double"), F.col(f"pp{c}"))
        rec = div(F.col(f"tp{c}").cast("double"), F.col(f"sup{c}"))
        f1 = div(2 * prec * rec, prec + rec)
        per.append((str(c), prec, rec, f1, F.col(f"sup{c}")))
    k = len(classes)
    macro = [sum((x[i] for x in per), F.lit(0.0)) / k for i in (1, 2, 3)]
    weighted = [div(sum((x[i] * x[4] for x in per), F.lit(0.0)), F.col("n")) for i in (1, 2, 3)]
    acc = div(F.col("correct").cast("double"), F.col("n"))
    rows = [F.struct(F.lit(c).alias("cls"), pr.alias("precision"), rc.alias("recall"),
                     f.alias("f1"), s.cast("long").alias("support")) for c, pr, rc, f, s in per]
    rows.append(F.struct(F.lit("accuracy").alias("cls"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), acc.alias("f1"),
                         F.col("n").cast("long").alias("support")))
    rows.append(F.struct(F.lit("macro avg").alias("cls"), macro[0].alias("precision"), macro[1].alias("recall"),
                         macro[2].alias("f1"), F.col("n").cast("long").alias("support")))
    rows.append(F.struct(F.lit("weighted avg").alias("cls"), weighted[0].alias("precision"),
                         weighted[1].alias("recall"), weighted[2].alias("f1"),
                         F.col("n").cast("long").alias("support")))
    return row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def accuracy(df: DataFrame, truth: str = "label", pred: str = "prediction") -> DataFrame:
    """Share of correct predictions."""
    return df.agg(F.avg((F.col(truth).cast("int") == F.col(pred).cast("int")).cast("double")).alias("accuracy"))


def head(df: DataFrame, k: int, *order) -> DataFrame:
    """Preview of ``k`` rows in a stated order (bounded top-k)."""
    return df.orderBy(*order).limit(k) if order else df.limit(k)
