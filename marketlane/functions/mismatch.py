"""Comparisons of an expected and an actual value; True means they disagree.

A *required* comparison treats a NULL on either side as a disagreement. A
*nullable* one accepts NULL on both sides. With ``sql_null_logic`` a NULL on one
side only gives NULL, which a filter drops: that is what plain three-valued
logic says, and it hides a real difference, so it is off by default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(left: Column, right: Column) -> Column:
    return left.isNull() | right.isNull() | (left != right)


def nullable_exact(left: Column, right: Column, sql_null_logic: bool = False) -> Column:
    if sql_null_logic:
        return ~((left.isNull() & right.isNull()) | (left == right))
    return ~left.eqNullSafe(right)


def within(left: Column, right: Column, tolerance: float) -> Column:
    return left.isNull() | right.isNull() | _apart(left, right, tolerance)


def nullable_within(
    left: Column, right: Column, tolerance: float, sql_null_logic: bool = False
) -> Column:
    both_null = left.isNull() & right.isNull()
    close = ~_apart(left, right, tolerance)
    if sql_null_logic:
        return ~(both_null | close)
    return ~(both_null | F.coalesce(close, F.lit(False)))


def _apart(left: Column, right: Column, tolerance: float) -> Column:
    return F.abs(left.cast("double") - right.cast("double")) > F.lit(tolerance)
