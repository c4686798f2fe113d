"""Buckets and two-decimal ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket labels with inclusive bounds (None = open end).
# Visit length in seconds; a length of 0 falls in no bucket.
VISIT_LENGTH_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
# Step length in pages.
STEP_LENGTH_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]


def inside(value: Column, low, high) -> Column:
    return value >= low if high is None else value.between(low, high)


def bucket(value: Column, buckets) -> Column:
    """Label of the bucket holding `value`, NULL when none does."""
    label = F.lit(None).cast("string")
    for name, low, high in reversed(buckets):
        label = F.when(inside(value, low, high), F.lit(name)).otherwise(label)
    return label


def ratio(part: Column, whole: Column) -> Column:
    """part/whole rounded half-up to two places, in integers so that 29/200 is 0.15 everywhere.

    NULL when `whole` is zero or missing.
    """
    doubled = F.nullif(F.lit(2) * whole, F.lit(0).cast("bigint"))
    hundredths = F.call_function("div", F.lit(200) * part + whole, doubled)
    return hundredths.cast("double") / F.lit(100.0)
