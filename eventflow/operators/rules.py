"""Filters, predicates and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (COMMUNITY_KEYWORDS, NON_COMMUNITY_KEYWORDS, col_of,
                              parse_label, weak_label_expr)


def weak_label(df: DataFrame, text, pos: str = COMMUNITY_KEYWORDS,
               neg: str = NON_COMMUNITY_KEYWORDS, out: str = "weak_label") -> DataFrame:
    """Keyword rules, the negative list wins."""
    return df.withColumn(out, weak_label_expr(col_of(text), pos, neg))


def labeled_only(df: DataFrame, label: str = "label", variant: str | None = "all_dot0") -> DataFrame:
    """D3: rows with a label; ``variant=None`` means any non-null value."""
    cond = F.col(label).isNotNull() if variant is None else parse_label(label, variant).isNotNull()
    return df.where(cond)


def unlabeled_only(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows without a label."""
    return df.where(F.col(label).isNull())


def accepted(df: DataFrame, pred: str = "is_community_event") -> DataFrame:
    """Rows predicted as community events."""
    return df.where(F.col(pred) == 1)


def needs_review_prob(df: DataFrame, confidence: str = "confidence", threshold: float = 0.75,
                      out: str = "needs_review") -> DataFrame:
    """Calibrated confidence below the threshold."""
    return df.withColumn(out, F.col(confidence) < threshold)


def needs_review_margin(df: DataFrame, confidence: str = "confidence", threshold: float = 0.55,
                        out: str = "needs_review") -> DataFrame:
    """Margin confidence ``1/(1+|score|)`` below the threshold.

    Note (Δ2): that flags rows *far* from the decision boundary; use
    ``margin_confidence(mode="distance")`` for the intended reading.
    """
    return df.withColumn(out, F.col(confidence) < threshold)


def auto_accept(df: DataFrame, pred: str = "predicted_label", flag: str = "needs_review",
                out: str = "label") -> DataFrame:
    """label = prediction where not flagged, else null."""
    return df.withColumn(out, F.when(~F.col(flag), F.col(pred)))


def valid_series(df: DataFrame, series: str = "series_id") -> DataFrame:
    """Series id neither null nor empty."""
    return df.where(F.col(series).isNotNull() & (F.col(series).cast("string") != ""))


def flagged(df: DataFrame, flag: str = "needs_review", cols=("title", "predicted_label", "confidence", "label"),
            k: int = 20, order: str | None = None) -> DataFrame:
    """Rows flagged for review with their display columns, first ``k``."""
    keep = [c for c in cols if c in df.columns]
    out = df.where(F.col(flag) == True)  # noqa: E712
    if order:
        out = out.orderBy(order)
    return out.select(*keep).limit(k)
