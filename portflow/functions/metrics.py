"""Ratios, growth and rounding with the NULL / zero guards the marts need.

All percentages are computed in DOUBLE from exact DECIMAL sums, then
rounded with SQL ROUND (half away from zero).  Under ANSI mode ``x / 0``
throws, so every division is guarded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c) -> Column:
    return _col(c).cast("double")


def safe_div(a, b) -> Column:
    """a / b in double; NULL when b is NULL or 0."""
    b = dbl(b)
    return F.when(b != 0, dbl(a) / b)


def growth_pct(cur, prev, digits: int | None = 2) -> Column:
    """(cur - prev) / prev * 100; NULL when prev is 0 or NULL."""
    p = dbl(prev)
    g = F.when(p != 0, (dbl(cur) - p) / p * 100)
    return F.round(g, digits) if digits is not None else g


def pct_of(part, total, digits: int | None = 2) -> Column:
    t = dbl(total)
    v = F.when(t != 0, dbl(part) / t * 100)
    return F.round(v, digits) if digits is not None else v


def scaled(c, scale: float, digits: int) -> Column:
    """Unit scaling (e.g. USD -> billions) rounded: ``round(c / scale, n)``."""
    return F.round(dbl(c) / F.lit(float(scale)), digits)


def truthy(c) -> Column:
    """Python-style truthiness of a number: not NULL and not 0."""
    c = _col(c)
    return c.isNotNull() & (c != 0)


def cents(c) -> Column:
    """decimal(*,2) -> exact integer hundredths."""
    return (_col(c) * 100).cast("long")


def int_div(a, b) -> Column:
    """Exact integral division of longs (SQL ``a div b``)."""
    return F.call_function("div", _col(a).cast("long"), _col(b).cast("long"))


def mean_half_up(sum_cents, n) -> Column:
    """Exact mean of non-negative 2-decimal values, rounded half up to 2 decimals.

    ``sum_cents`` is the integer sum of hundredths, ``n`` the count.  Integer
    arithmetic only, so it is exact at any scale and equals SQL
    ``ROUND(AVG(numeric), 2)``; it never rounds a binary double twice.
    NULL when ``n`` is 0.
    """
    s, k = _col(sum_cents).cast("long"), _col(n).cast("long")
    q = F.when(k > 0, int_div(s * 2 + k, k * 2))
    return (q.cast("decimal(20,0)") / 100).cast("decimal(18,2)")
