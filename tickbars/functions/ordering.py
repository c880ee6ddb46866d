"""Order keys for first/last-by-time and latest-version aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def digit_order(*parts: tuple[Column, int]) -> Column:
    """One DECIMAL(38,0) that sorts like the tuple of bigints, each with the number of digits it may take.

    All but the first must be >= 0, and the widths add up to 38 at most. `min_by` over a struct keeps
    a variable-length buffer, which forces a sort-based aggregate. A decimal buffer is fixed-width,
    so the same aggregate runs hash-based.
    """
    order, width = None, 0
    for column, digits in reversed(parts):
        term = column.cast("decimal(19,0)")
        if width:
            term = term * F.lit(Decimal(10) ** width)
        order = term if order is None else term + order
        width += digits
    return order


def pair_order(major: Column, minor: Column) -> Column:
    return digit_order((major, 19), (minor, 19))


def latest_by_key(rows: DataFrame, key: Sequence[str], order: Column) -> DataFrame:
    """One row per key: the one with the largest `order`. Partially aggregated before the shuffle."""
    values = [c for c in rows.columns if c not in key]
    picks = [F.max_by(c, "_order").alias(c) for c in values]
    return rows.withColumn("_order", order).groupBy(*key).agg(*picks).select(*rows.columns)
