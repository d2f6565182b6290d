"""Joins of the star model.

Dimensions are joined with a *checked* broadcast: ``bounded_broadcast``
counts at most ``max_rows + 1`` rows of the dimension (a cheap, limited
job) and only then adds the broadcast hint.  Above the bound the join is
left to the planner (sort-merge / shuffled hash, AQE may still convert it
at run time from real sizes), so a dimension that grows with the data never
ends up replicated to every executor.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Upper bound for an explicitly broadcast dimension.  Dimension rows here are
# a few dozen bytes, so this stays far below executor memory.
DEFAULT_BROADCAST_ROWS = 200_000


_DECISIONS: dict[tuple, bool] = {}


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, cache_key: tuple | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1).

    ``cache_key`` (e.g. the source paths) memoizes the answer for the session
    so a dimension is measured once, not once per query.
    """
    if cache_key is not None:
        key = (df.sparkSession.sparkContext.applicationId, max_rows) + tuple(cache_key)
        if key not in _DECISIONS:
            _DECISIONS[key] = df.limit(max_rows + 1).count() <= max_rows
        return _DECISIONS[key]
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      known_small: bool = False, cache_key: tuple | None = None) -> DataFrame:
    """Broadcast hint only behind a proven size bound.

    ``known_small`` is for literal catalogs whose size is fixed by code.
    """
    if known_small or fits(df, max_rows, cache_key):
        return F.broadcast(df)
    return df


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
                how: str = "left", dim_small: bool | None = None) -> DataFrame:
    """Code -> surrogate id lookup.  ``left`` keeps misses as NULL ids so the
    reject split can count them; ``inner`` drops them."""
    d = F.broadcast(dim) if dim_small else (dim if dim_small is False else bounded_broadcast(dim))
    return fact.join(d, on, how)


def star_join(fact: DataFrame, dims: Iterable[tuple[DataFrame, str | Sequence[str], bool | None]]) -> DataFrame:
    """Inner join a fact with 1..n dimensions, each (dim, key, known_small)."""
    out = fact
    for dim, key, small in dims:
        out = out.join(F.broadcast(dim) if small else bounded_broadcast(dim), key, "inner")
    return out


def anti_orphans(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (NOT EXISTS)."""
    return left.join(right, on, "left_anti")


def semi_match(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with a match in ``right`` (EXISTS), no duplication."""
    return left.join(right, on, "left_semi")


def full_outer_series(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer combine of two keyed series; rows where every measure is NULL
    cannot occur (each side only has present keys)."""
    return a.join(b, key, "full_outer")


def ratio_to_reference(df: DataFrame, key: str, value: str, ref_key_value,
                       out: str = "ratio_to_ref", digits: int = 1,
                       partition: Sequence[str] = ()) -> DataFrame:
    """value of the reference row divided by each row's value.

    The reference value is picked with a window ``max(when(key == ref))``; the
    reference row itself and rows with value 0 get NULL.
    """
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    ref = F.max(F.when(F.col(key) == F.lit(ref_key_value), F.col(value))).over(w)
    v = F.col(value).cast("double")
    return df.withColumn(out, F.when((F.col(key) != F.lit(ref_key_value)) & (v != 0),
                                     F.round(ref.cast("double") / v, digits)))


def cross_scalars(*one_row_frames: DataFrame) -> DataFrame:
    """Side-by-side combine of global aggregates (each exactly one row).

    The frames are stacked with ``unionByName`` (each row fills only its own
    columns) and folded with ``max`` per column: one tiny aggregate and no
    join at all, so no cross product can ever be planned."""
    u = one_row_frames[0]
    for f in one_row_frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])
