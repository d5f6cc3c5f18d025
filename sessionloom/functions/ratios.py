"""Ratios kept to two decimals."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, functions as F

# Odd j for which the double nearest to j/200 lies below j/200: there the exact
# half is not reached, so half-up rounding of the double goes down.
BELOW_HALF = [j for j in range(1, 200, 2) if Fraction(j / 200) < Fraction(j, 200)]


def ratio2(part: Column, whole: Column) -> Column:
    """part / whole as a double, then rounded half-up to 2 places on its exact binary value.

    Needs 0 <= part <= whole; NULL when ``whole`` is zero. Integer arithmetic, since
    decimal rounding of the printed double would turn 57/200 into 0.29 instead of 0.28.
    """
    k, n = part.cast("bigint"), whole.cast("bigint")
    scaled = k * 200
    half_is_low = (scaled % n == 0) & F.call_function("div", scaled, n).isin(BELOW_HALF)
    cents = F.call_function("div", scaled + n, n * 2) - F.when(half_is_low, 1).otherwise(0)
    return F.when(n != 0, cents / F.lit(100.0))
