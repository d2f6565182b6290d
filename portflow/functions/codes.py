"""Code parsing and code/label mapping as JVM-side column expressions."""

from __future__ import annotations

from itertools import chain
from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from portflow import catalogs


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_port_code(depe) -> Column:
    """Port code text -> int.

    ``dddd`` -> the number; ``ddXX`` in any case -> ``dd * 100 + 99`` (the
    residual member of the district); anything else (empty, junk, NULL) -> NULL.
    """
    s = _col(depe)
    return (F.when(s.rlike(r"^[0-9]{4}$"), s.try_cast("int"))
             .when(s.rlike(r"(?i)^[0-9]{2}XX$"), F.substring(s, 1, 2).try_cast("int") * 100 + 99)
             .otherwise(F.lit(None).cast("int")))


def is_residual_code(depe) -> Column:
    return _col(depe).rlike(r"(?i)^[0-9]{2}XX$")


def map_values(c, mapping: Mapping, default=None) -> Column:
    """Look ``c`` up in a small literal map; misses -> ``default`` (NULL if None).

    The map is a ``create_map`` literal: it is evaluated inside generated code,
    no join and no shuffle.  Use it only for code books (a few dozen entries).
    """
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    out = m[_col(c)]
    return out if default is None else F.coalesce(out, F.lit(default))


def normalize_text(c) -> Column:
    """lower -> every run of non ``[a-z0-9]`` becomes one space -> trim."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), r"[^a-z0-9]+", " "))


def district_of(code) -> Column:
    """Customs district of a 4-digit port code (``code div 100``)."""
    return F.floor(_col(code) / 100).cast("int")


def state_of_district(district) -> Column:
    return map_values(district, catalogs.DISTRICT_TO_STATE, catalogs.DEFAULT_STATE)


def synthetic_port_name(code) -> Column:
    """Name of a member discovered only in fact data.

    Residual codes (``dd99``) -> ``District dd XX residual`` zero padded;
    other numeric codes -> ``District d aggregate (code)``.
    """
    c = _col(code).cast("int")
    d = F.floor(c / 100).cast("int")
    return (F.when(F.pmod(c, F.lit(100)) == 99, F.format_string("District %02dXX residual", d))
             .otherwise(F.format_string("District %d aggregate (%d)", d, c)))


def is_digits(c) -> Column:
    return _col(c).rlike(r"^[0-9]+$")
