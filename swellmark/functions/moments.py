"""Aggregate column expressions with pandas-like treatment of missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swellmark.functions.scalars import without_nan


def paired(x: Column | str, y: Column | str) -> tuple[Column, Column]:
    """Both values, or two nulls when either is null or NaN."""
    a, b = without_nan(x), without_nan(y)
    return F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson r over complete pairs; null when undefined (constant input, under two pairs)."""
    a, b = paired(x, y)
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
