"""Column expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAD_TO_SD = 1.4826
IQR_TO_SD = 0.7413


def r6(c) -> Column:
    return F.round(c, 6)


def r6_off_ties(c, by: float = 1e-9) -> Column:
    """Round averages of short decimals, whose seventh digit is often an exact 5: moved off the tie first, by more than the order of the rows changes them."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(by), 6)


def mean_above(c, limit: float) -> Column:
    """A mean (or correlation) above `limit`. Sums of decimals differ in their last bits with the order of the rows; a mean that misses the limit by no more is equal to it."""
    c = F.col(c) if isinstance(c, str) else c
    return c - F.lit(float(limit)) > F.lit(1e-9 * max(1.0, abs(limit)))


def finite(c) -> Column:
    """NaN and infinities to NULL, so that aggregates skip them."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def clip01(c: Column) -> Column:
    return F.greatest(F.lit(0e0), F.least(F.lit(1e0), c))


def to_int(c: Column) -> Column:
    """Truncate towards zero."""
    return c.cast("bigint")


def half_even(c: Column) -> Column:
    return F.bround(c.cast("double"), 0).cast("bigint")


def matlab_quantile(sorted_array: Column, q: float) -> Column:
    """Quantile of a bounded sorted array at the sample-population position."""
    n = F.size(sorted_array)
    adjusted = F.when(n > 1, (F.lit(q) - 0.5) * n / (n - 1) + 0.5).otherwise(F.lit(q))
    pos = (n - 1) * clip01(adjusted)
    lo = F.get(sorted_array, F.floor(pos).cast("int"))
    hi = F.get(sorted_array, F.ceil(pos).cast("int"))
    return lo + (hi - lo) * (pos - F.floor(pos))


def normalized(c: Column) -> Column:
    """Matching form of a typed name: trimmed, lower case, `_` as `-`, no blanks."""
    return F.regexp_replace(F.translate(F.lower(F.trim(c)), "_", "-"), " ", "")


def slug(c: Column) -> Column:
    """File-system-safe name: other characters become `_`; `.`, `_`, `-` trimmed at the ends."""
    safe = F.regexp_replace(F.trim(c), r"[^A-Za-z0-9_.-]+", "_")
    return F.regexp_replace(safe, r"^[._-]+|[._-]+$", "")
