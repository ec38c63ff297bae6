"""Exact money arithmetic on integer units.

``round(avg(double), 2)`` depends on the order in which partial sums are
combined, so two engines (or two runs with different partitioning) can round a
half-cent differently. Everything here works on integer units (cents for money,
millionths for ratings, which keeps their digits): sums are exact, and averages / ratios are
rounded HALF_UP from an exact integer numerator and denominator. Results stay
``double`` at the boundary so output schemas match the reference.

Numerators are widened to ``decimal(38,0)`` before scaling so that sums over
very large tables cannot overflow ``bigint``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = 100
MILLIONTHS = 1_000_000


def units(c: Column | str, scale: int = CENTS) -> Column:
    """Integer units of a decimal-valued double column (NULL stays NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(float(scale))).cast("bigint")


def units_to_double(u: Column, scale: int = CENTS) -> Column:
    """Integer units back to a double with the given scale."""
    return u.cast("double") / F.lit(scale)


def _wide(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def half_up_ratio(num: Column, den: Column, digits: int = 2,
                  num_scale: int = 1, factor: int = 1) -> Column:
    """``round(factor * num / (num_scale * den), digits)`` HALF_UP, exactly.

    ``num`` and ``den`` are integer columns; NULL when ``den`` is 0 or NULL
    (the ANSI-safe equivalent of ``try_divide``).
    """
    p = 10 ** digits
    n = _wide(num)
    d = F.abs(_wide(den)) * F.lit(num_scale)
    x = F.abs(n) * F.lit(2 * factor * p) + d
    y = d * F.lit(2)
    # floor(x / y) without going through a rounded decimal quotient
    q = ((x - F.pmod(x, y)) / y).cast("decimal(38,0)")
    negative = (n < 0) != (_wide(den) < 0)
    signed = F.when(negative, -q).otherwise(q)
    return F.when(den != 0, signed.cast("double") / F.lit(p))


def sum_money(c: Column | str, scale: int = CENTS) -> Column:
    """``round(sum(x), 2)`` computed exactly: aggregate expression."""
    return units_to_double(F.sum(units(c, scale)), scale)


def avg_money(c: Column | str, digits: int = 2, scale: int = CENTS) -> Column:
    """``round(avg(x), digits)`` HALF_UP from exact unit sum and count."""
    return half_up_ratio(F.sum(units(c, scale)), F.count(c if not isinstance(c, str) else F.col(c)),
                         digits=digits, num_scale=scale)


def avg_int(c: Column | str, digits: int = 2) -> Column:
    """``round(avg(int_col), digits)`` HALF_UP, exactly."""
    c = F.col(c) if isinstance(c, str) else c
    return half_up_ratio(F.sum(c.cast("long")), F.count(c), digits=digits)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``round(part * 100 / whole, digits)`` on integer counts; NULL on 0."""
    return half_up_ratio(part, whole, digits=digits, factor=100)
