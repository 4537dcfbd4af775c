"""Compute expensive per-row expressions once.

Catalyst pushes a filter through a projection by substituting the projected
expression into the predicate. For cheap columns that is what we want; for a
regex over a whole page it means the regex runs twice (once in the pushed
filter at the scan, once in the projection). Producing such columns through
a one-element ``inline(array(struct(...)))`` keeps later filters above them:
a predicate on a generator's output cannot move below the generator, and no
size filter is inferred for a literal array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage(df: DataFrame, exprs: dict[str, Column], keep=None) -> DataFrame:
    """``keep`` columns (default all) plus ``exprs`` computed once per row."""
    base = [F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]
    packed = F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))
    return df.select(*base, F.inline(packed))
