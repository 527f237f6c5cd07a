from matchledger.functions.scalars import (
    as_flag,
    as_truth,
    cohort_label,
    days_between,
    minutes_between,
    null_when_zero,
    or_else,
    or_zero,
    ratio_or_null,
    round3,
)

__all__ = [
    "as_flag",
    "as_truth",
    "cohort_label",
    "days_between",
    "minutes_between",
    "null_when_zero",
    "or_else",
    "or_zero",
    "ratio_or_null",
    "round3",
]
