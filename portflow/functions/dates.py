"""Calendar keys.

The model keys days by an ``int yyyymmdd``; monthly facts point at day 1.
Arithmetic is done on ``date`` values, the int is only a key.  Filters on a
year are written as key ranges so they reach the Parquet scan as pushed
filters (``year(date) = Y`` is an expression and is not pushed).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """date -> yyyymmdd int."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(d) -> Column:
    """date/timestamp -> yyyymm01 int of its month."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + 1).cast("int")


def key_to_date(k) -> Column:
    """yyyymmdd int -> date (NULL on a malformed key)."""
    return F.try_to_date(_col(k).cast("string"), "yyyyMMdd")


def key_year(k) -> Column:
    return F.floor(_col(k) / 10000).cast("int")


def key_month(k) -> Column:
    return F.pmod(F.floor(_col(k) / 100), F.lit(100)).cast("int")


def shift_month_key(k, months: int | Column) -> Column:
    """Monthly key shifted by N months (day fixed to 1)."""
    return month_key(F.add_months(key_to_date(k), months if isinstance(months, Column) else F.lit(months)))


def year_range(year: int) -> tuple[int, int]:
    """Inclusive key range of a calendar year: use with ``between``."""
    return year * 10000 + 101, year * 10000 + 1231


def year_month_str(d) -> Column:
    return F.date_format(_col(d), "yyyy-MM")


def key_to_year_month(k) -> Column:
    return F.date_format(key_to_date(k), "yyyy-MM")


def key_to_iso(k) -> Column:
    return F.date_format(key_to_date(k), "yyyy-MM-dd")


def iso_dow(d) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return (F.weekday(_col(d)) + 1).cast("int")


def iso_week(d) -> Column:
    return F.weekofyear(_col(d)).cast("int")


def month_name(d) -> Column:
    return F.date_format(_col(d), "MMMM")


def day_name(d) -> Column:
    return F.date_format(_col(d), "EEEE")


def parse_month_year(c) -> Column:
    """'Mar 2024' -> first day of that month; unparseable -> NULL (no error)."""
    return F.try_to_date(_col(c), "MMM yyyy")


def parse_iso_timestamp(c) -> Column:
    """ISO-8601 text -> timestamp; unparseable -> NULL (no error)."""
    return F.try_to_timestamp(_col(c))
