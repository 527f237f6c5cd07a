"""Scalar expressions shared by the plans; all compile to built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Upper age in days of each cohort band (fixed values).
COHORT_BANDS = (("D7", 7), ("D14", 14), ("D30", 30), ("D90", 90))


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_else(first: ColumnOrName, second: ColumnOrName) -> Column:
    """`first`, or `second` where `first` is NULL."""
    return F.coalesce(_col(first), _col(second))


def or_zero(c: ColumnOrName) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def null_when_zero(c: ColumnOrName) -> Column:
    return F.nullif(_col(c), F.lit(0))


def ratio_or_null(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Float division that is NULL, not an error, on a zero denominator."""
    return _col(numerator) / null_when_zero(denominator)


def round3(c: ColumnOrName) -> Column:
    return F.round(_col(c), 3)


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole elapsed minutes, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Signed number of days from `start` to `end`."""
    return F.datediff(_col(end), _col(start))


def as_flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def as_truth(condition: Column) -> Column:
    """TRUE where the condition holds, FALSE where it is false or NULL."""
    return F.coalesce(condition, F.lit(False))


def cohort_label(days: ColumnOrName) -> Column:
    """Band of a cohort's age; a negative age is in the first, one over the last is NULL."""
    label = None
    for name, upper in COHORT_BANDS:
        young = _col(days) <= upper
        label = F.when(young, F.lit(name)) if label is None else label.when(young, F.lit(name))
    return label
