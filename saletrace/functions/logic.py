"""Flags, labels and small column helpers with SQL NULL semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(c: Column) -> Column:
    """``COALESCE(c, FALSE)``: NULL counts as false."""
    return F.coalesce(c, F.lit(False))


def flag01(cond: Column) -> Column:
    """1 when ``cond`` is true, 0 when false or NULL."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def contains_any(c: Column, parts: Sequence[str]) -> Column:
    """``c LIKE '%p1%' OR c LIKE '%p2%' ...`` (false for an empty list)."""
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def decision_list(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Searched CASE: the label of the first rule whose condition is true."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def ordinal(c: Column, values: Sequence[str], start: int = 1) -> Column:
    """Position of ``c`` in ``values`` (``CASE c WHEN v1 THEN 1 ...``), NULL
    when absent."""
    expr = None
    for i, v in enumerate(values, start):
        expr = F.when(c == v, F.lit(i)) if expr is None else expr.when(c == v, F.lit(i))
    return expr if expr is not None else F.lit(None).cast("int")


def sorted_join(values: Column, sep: str = ", ") -> Column:
    """``ARRAY_JOIN(ARRAY_SORT(values), sep)``: ``''`` for an empty array."""
    return F.array_join(F.array_sort(values), sep)
