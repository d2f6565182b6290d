"""Rule compiler: the constraints of a star schema as Spark aggregates.

A table's NOT NULL, length and CHECK rules and its foreign keys become *one*
aggregate over one scan: every rule is a conditional count, and a dimension
that is proven small is broadcast as a key set whose miss is one more
condition.  A foreign key to a larger dimension, and every UNIQUE rule, is
answered from keys reduced by a partial aggregate before any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.operators.joins import DEFAULT_BROADCAST_ROWS, fits

KINDS = ("not_null", "max_len", "check", "foreign", "unique")


@dataclass(frozen=True)
class TableRules:
    """Constraints of one table; ``checks`` maps a name to a SQL predicate, ``foreign`` a column to (table, key)."""
    not_null: Sequence[str] = ()
    max_len: Mapping[str, int] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()

    def names(self, kind: str) -> list[str]:
        own = {"not_null": self.not_null, "max_len": self.max_len, "check": self.checks, "foreign": self.foreign, "unique": [",".join(u) for u in self.unique]}
        return list(own[kind])


def _row_rules(rules: TableRules, kinds: Iterable[str]) -> dict[tuple[str, str], Column]:
    """(kind, rule) -> condition of a violating row; as in SQL, a CHECK that is NULL passes."""
    out: dict[tuple[str, str], Column] = {}
    if "not_null" in kinds:
        out |= {("not_null", c): F.col(c).isNull() for c in rules.not_null}
    if "max_len" in kinds:
        out |= {("max_len", c): F.length(c) > n for c, n in rules.max_len.items()}
    if "check" in kinds:
        out |= {("check", name): ~F.expr(sql) for name, sql in rules.checks.items()}
    return out


def _long(one_row: DataFrame, table: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """One wide row of counts -> (table, kind, rule, violations)."""
    arms = ", ".join(f"'{kind}', '{rule}', `{k}`" for k, (kind, rule) in enumerate(rules))
    return one_row.selectExpr(f"stack({len(rules)}, {arms}) AS (kind, rule, violations)").select(F.lit(table).alias("table"), "kind", "rule", "violations")


def violations(table: str, rules: TableRules, frames: Mapping[str, DataFrame], kinds: Sequence[str] = KINDS,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """(table, kind, rule, violations): one row per rule of ``table``; ``frames`` has it and the dimensions by name.

    ``violations`` counts rows; for UNIQUE the rows of keys that occur more
    than once.  NULL keys satisfy a foreign key and a UNIQUE rule.
    """
    df, parts = frames[table], []
    found = _row_rules(rules, kinds)
    scan = df
    for k, (column, (dim, key)) in enumerate(rules.foreign.items() if "foreign" in kinds else ()):
        keys = frames[dim].select(F.col(key).alias(f"_k{k}")).where(F.col(f"_k{k}").isNotNull()).distinct()
        if fits(keys, max_broadcast_rows):
            scan = scan.join(F.broadcast(keys), F.col(column) == F.col(f"_k{k}"), "left")
            found["foreign", column] = F.col(column).isNotNull() & F.col(f"_k{k}").isNull()
        else:
            reduced = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(f"_k{k}")).agg(F.count("*").alias("n"))
            parts.append(_long(reduced.join(keys, f"_k{k}", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("0")), table, [("foreign", column)]))
    if found:
        parts.insert(0, _long(scan.agg(*[F.count_if(c).alias(str(k)) for k, c in enumerate(found.values())]), table, list(found)))
    for key in rules.unique if "unique" in kinds else ():
        groups = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in key)).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(_long(groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("0")), table, [("unique", ",".join(key))]))
    if not parts:
        raise ValueError(f"{table} has no rule of {kinds}")
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def schema_violations(schema: Mapping[str, TableRules], frames: Mapping[str, DataFrame], kinds: Sequence[str] = KINDS,
                      max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``violations`` of every table that has rules of these kinds."""
    parts = [violations(t, r, frames, kinds, max_broadcast_rows) for t, r in schema.items() if any(r.names(k) for k in kinds)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


class ConstraintError(RuntimeError):
    """A load wrote rows that break the schema."""


def assert_clean(found: DataFrame) -> None:
    """Abort with the broken rules, if any (one row per rule reaches the driver)."""
    broken = [f"{r['table']}.{r['rule']} ({r['kind']}): {r['violations']}" for r in found.where("violations > 0").collect()]
    if broken:
        raise ConstraintError("; ".join(sorted(broken)))
