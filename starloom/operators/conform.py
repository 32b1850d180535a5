"""Conform a frame to a declared table schema (C1, C4): column order, casts,
NOT NULL and maximum text length.

``validate="eager"`` counts every rule violation in one aggregate pass and
raises ``ConstraintError`` with the counts; before a write,
``plans.tables.write_table(schema=...)`` counts them in the pass that writes.
``validate="lazy"`` adds no pass: each checked column raises inside the same plan
when a bad value reaches it, without a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import Col, TableSchema


class ConstraintError(Exception):
    """A declared NOT NULL or length rule does not hold. ``violations`` lists
    (column, rule, rows) where they were counted."""

    def __init__(self, table: str, violations: Sequence[tuple[str, str, int]] | str):
        self.violations = [] if isinstance(violations, str) else sorted(violations)
        detail = violations if isinstance(violations, str) else ", ".join(f"{c} {r}: {n} rows" for c, r, n in self.violations)
        super().__init__(f"{table}: {detail}")


def _rules(c: Col, value: Column) -> list[tuple[str, Column]]:
    rules = []
    if not c.nullable:
        rules.append(("not_null", value.isNull()))
    if c.max_len is not None and isinstance(c.dtype, T.StringType):
        rules.append((f"max_length_{c.max_len}", F.char_length(value) > c.max_len))
    return rules


def rule_counts(schema: TableSchema) -> list[tuple[str, str, Column]]:
    """``(column, rule, count of violations)`` of a declared schema, as aggregates over
    a frame that is cast to it."""
    return [
        (c.name, rule, F.count(F.when(cond, 1))) for c in schema.columns for rule, cond in _rules(c, F.col(c.name))
    ]


def violation_report(df: DataFrame, schema: TableSchema) -> DataFrame:
    """One row per rule: (column_name, rule, violations), from a single pass."""
    cast = _cast(df, schema)
    checks = rule_counts(schema)
    if not checks:
        return cast.sparkSession.createDataFrame([], "column_name string, rule string, violations long")
    agg = cast.agg(*[count.alias(f"_v{i}") for i, (_, _, count) in enumerate(checks)])
    stack = ", ".join(f"'{n}', '{r}', `_v{i}`" for i, (n, r, _) in enumerate(checks))
    return agg.selectExpr(f"stack({len(checks)}, {stack}) as (column_name, rule, violations)")


def _cast(df: DataFrame, schema: TableSchema, keep: Sequence[str] = ()) -> DataFrame:
    missing = [n for n in schema.names if n not in df.columns]
    if missing:
        raise ConstraintError(schema.name, f"missing columns {missing}")
    more = [c for c in keep if c not in schema.names]
    return df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in schema.columns], *more)


def conform(df: DataFrame, schema: TableSchema, validate: str = "lazy", keep: Sequence[str] = ()) -> DataFrame:
    """The frame cast to the declared columns, and those of ``keep`` as they are."""
    if validate not in ("lazy", "eager", "none"):
        raise ValueError(f"validate must be lazy, eager or none, got {validate!r}")
    out = _cast(df, schema, keep)
    if validate == "eager":
        bad = [r for r in violation_report(out, schema).collect() if r["violations"] > 0]
        if bad:
            raise ConstraintError(schema.name, [tuple(r) for r in bad])
        return out
    if validate == "lazy":
        cols = []
        for c in schema.columns:
            value = F.col(c.name)
            for rule, cond in _rules(c, value):
                msg = F.lit(f"ConstraintError: {schema.name}.{c.name} violates {rule}")
                value = F.when(cond, F.raise_error(msg)).otherwise(value)
            cols.append(value.alias(c.name))
        out = out.select(*cols, *[c for c in keep if c not in schema.names])
    return out
