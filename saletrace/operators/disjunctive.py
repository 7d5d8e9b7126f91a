"""Joins on ``A OR B OR ...`` without a nested loop.

Spark plans a disjunctive join condition as a nested loop, and cannot plan a
correlated ``EXISTS`` in it at all.  Here every alternative is an equi join of
its own, and a pair is emitted only by the first alternative that holds for
it.  So each pair appears once for each left and right row that form it, as in
SQL: no DISTINCT is needed, repeated rows keep their weight, and any aggregate
over the pairs is right.

An alternative that needs columns of the pair only is tested on later pairs as
an expression.  One that goes through a third table (``EXISTS``) is an equi
join over the distinct key pairs of that table, and is tested on later pairs by
an anti join on the same keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saletrace.functions.logic import is_true
from saletrace.operators.skew import HOT_ROWS, sliced_join


@dataclass(frozen=True)
class Alternative:
    """One member of the ``OR``.

    ``on``: column pairs (left, right) that are equal.  With ``through``, pairs
    (left, column of ``through``), and ``to`` the pairs (column of ``through``,
    right): it holds if some row of ``through`` agrees with both sides.
    ``left`` and ``right``: SQL predicates on the rows of one side.
    """

    on: Sequence[tuple[str, str]]
    left: str | None = None
    right: str | None = None
    through: DataFrame | None = None
    to: Sequence[tuple[str, str]] = ()


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _sides(a: Alternative) -> Column:
    return _all([is_true(F.expr(p)) for p in (a.left, a.right) if p])


def _bridge(a: Alternative, tag: str) -> tuple[DataFrame, list, list]:
    """Distinct key pairs of ``through`` under names of their own."""
    near = [(l, f"_{tag}l{i}") for i, (l, _) in enumerate(a.on)]
    far = [(f"_{tag}r{i}", r) for i, (_, r) in enumerate(a.to)]
    named = ([F.col(b).alias(n) for (_, b), (_, n) in zip(a.on, near)]
             + [F.col(b).alias(n) for (b, _), (n, _) in zip(a.to, far)])
    return a.through.select(*named).dropna().distinct(), near, far


def _one_side(df: DataFrame, predicate: str | None) -> DataFrame:
    return df.where(F.expr(predicate)) if predicate else df


def disjunctive_join(left: DataFrame, right: DataFrame, alternatives: Sequence[Alternative],
                     how: str = "inner", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``left JOIN right ON a1 OR a2 OR ...`` (``how`` "inner" or "left").  All
    columns of both sides are returned, so their names must differ.  A NULL
    comparison is not true, as in SQL.  Hot keys of the left side are sliced
    (``operators.skew``)."""
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r}: left or inner")
    clash = set(left.columns) & set(right.columns)
    if clash or not alternatives:
        raise ValueError(f"columns of both sides: {sorted(clash)}" if clash else "no alternative")
    # those that an expression can test come first: they cost no anti join
    ordered = sorted(alternatives, key=lambda a: a.through is not None)
    columns, parts, earlier = [*left.columns, *right.columns], [], F.lit(True)
    for n, a in enumerate(ordered):
        mine, theirs = _one_side(left, a.left), _one_side(right, a.right)
        if a.through is None:
            pairs = sliced_join(mine, theirs, list(a.on), "inner", hot_rows)
        else:
            bridge, near, far = _bridge(a, f"b{n}")
            reached = bridge.join(theirs, _all([F.col(x) == F.col(y) for x, y in far]))
            pairs = sliced_join(mine, reached, near, "inner", hot_rows)
        pairs = pairs.where(earlier).select(*columns)
        for m, e in enumerate(ordered[:n]):
            if e.through is not None:
                bridge, near, far = _bridge(e, f"e{m}")
                met = _all([F.col(x) == F.col(y) for x, y in [*near, *far]]) & _sides(e)
                pairs = pairs.join(bridge, met, "left_anti")
        if a.through is None:
            holds = _all([is_true(F.col(x) == F.col(y)) for x, y in a.on]) & _sides(a)
            earlier = earlier & ~holds
        parts.append(pairs)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if how == "inner":
        return out
    alone = left
    for n, a in enumerate(ordered):
        theirs = _one_side(right, a.right)
        if a.through is None:
            keys, on = theirs.select(*[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(a.on)]), [
                (l, f"_k{i}") for i, (l, _) in enumerate(a.on)]
        else:
            bridge, on, far = _bridge(a, f"k{n}")
            keys = bridge.join(theirs, _all([F.col(x) == F.col(y) for x, y in far]), "left_semi")
        met = _all([F.col(x) == F.col(y) for x, y in on])
        if a.left:
            met = met & is_true(F.expr(a.left))
        alone = alone.join(keys, met, "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return out.unionByName(alone.select("*", *empty))
