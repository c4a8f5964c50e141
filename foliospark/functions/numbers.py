"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.settings import DEFAULT_RATING, WILSON_Z


def whole(col: Column) -> Column:
    """Nearest whole number, halves away from zero (a plain cast would truncate)."""
    return F.round(col).cast("bigint")


def log_step(col: Column, shift: int = 1) -> Column:
    """``ln(x + shift)`` rounded to a whole number."""
    return whole(F.ln(col.cast("double") + F.lit(shift)))


def share(part: Column, total: Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def steady_avg(col: Column) -> Column:
    """Mean that no order of the rows changes: whole parts and 2**-62ths are summed as integers, only what is smaller as doubles.

    Values from 2**62 on, infinite ones and NaN are summed as they are, like ``F.avg``; nulls are left out.
    """
    v, unit = col.cast("double"), F.lit(2.0**62)
    fits = F.abs(v) < unit
    whole = F.when(fits, v.cast("bigint")).otherwise(F.lit(0))
    part = F.when(fits, (v - whole) * unit).otherwise(F.lit(0.0))
    units = part.cast("bigint")
    rest = F.when(fits, (part - units) / unit).otherwise(v)
    exact = lambda c: F.sum(c.cast("decimal(19,0)")).cast("double")
    return share(exact(whole) + (exact(units) / unit + F.sum(rest)), F.count(v))


def percent_change(base: Column, new: Column) -> Column:
    """How much lower ``new`` is than ``base``, in percent of the base; 0 when the base is not positive."""
    return F.when(base > 0, (base - new) / base * 100).otherwise(F.lit(0.0))


def wilson_rating(avg_rating: Column, votes: Column) -> Column:
    """Wilson lower bound of a 1..5 mean rating, on the 1..5 scale; unrated items get the neutral rating."""
    n = votes.cast("double")
    p = (F.coalesce(avg_rating, F.lit(DEFAULT_RATING)) - 1.0) / 4.0
    z2 = WILSON_Z**2
    spread = (p * (1.0 - p) + z2 / (4.0 * n)) / n
    margin = WILSON_Z * F.sqrt(F.greatest(spread, F.lit(0.0)))
    bound = (p + z2 / (2.0 * n) - margin) / (1.0 + z2 / n)
    return F.when(F.coalesce(votes, F.lit(0)) == 0, F.lit(DEFAULT_RATING)).otherwise(1.0 + 4.0 * bound)


def split_bucket(key: Column, buckets: int = 100) -> Column:
    """Stable bucket of a key: the same key lands in the same bucket on every run and engine."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets
