"""Optional predicates: a missing parameter passes every row.

A missing field gives NULL, which no filter passes. The comparisons stay bare so that Spark can
hand them to the file scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_range(field: Column, low, high) -> Column:
    """Inclusive range; passes everything unless both bounds are given."""
    if low is None or high is None:
        return F.lit(True)
    return field.between(low, high)


def one_of(field: Column, wanted: Sequence | None) -> Column:
    """A single-valued field equals any wanted value."""
    if wanted is None:
        return F.lit(True)
    return field.isin(list(wanted))


def any_listed(field: Column, wanted: Sequence | None) -> Column:
    """A comma list shares at least one value with the wanted ones."""
    if wanted is None:
        return F.lit(True)
    if not wanted:
        return F.lit(False)
    texts = [str(v) for v in wanted]
    overlap = F.arrays_overlap(F.split(field, ","), F.array(*[F.lit(t) for t in texts]))
    # Most fields hold a single value, which needs no splitting.
    return F.when(F.contains(field, F.lit(",")), overlap).otherwise(field.isin(texts))


def equal_to(field: Column, wanted) -> Column:
    if wanted is None:
        return F.lit(True)
    return field == F.lit(wanted)
