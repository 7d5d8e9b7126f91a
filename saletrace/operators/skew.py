"""Equi joins that keep a hot key out of a single task.

The frequent keys of the left side are found by ``approx_top_k``, a mergeable
frequent-items sketch that is partially aggregated like any other aggregate.
Its result is one row of at most ``MAX_HOT`` entries and enters the plan as a
scalar subquery: nothing is collected, and no job runs while the plan is
built.  The left rows of a frequent key are dealt by a hash of the row over as
many slices as bring each under ``hot_rows``; the right rows of that key are
repeated once per slice, so every pair of rows still meets exactly once.

NULL keys match nothing.  They would all hash to one task of an outer join,
so they are dealt over ``NULL_SLICES`` slices; that needs no sketch.

Which key counts as frequent changes the plan only, never the rows.  The
sketch tracks ``TRACKED`` keys; a key it misses is not sliced.  Rows that are
equal in every column go to the same slice.  The sketch reads the left side's
keys once more: give it a table that is written, or scanned cheaply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT, TRACKED, NULL_SLICES = 256, 10_000, 4096
HOT_ROWS = 1_000_000


def _any_null(columns: Sequence[Column]) -> Column:
    out = columns[0].isNull()
    for c in columns[1:]:
        out = out | c.isNull()
    return out


def hot_slices(df: DataFrame, keys: Sequence[str], hot_rows: int) -> Column:
    """A scalar subquery: the map from the hash of a frequent key of ``df``
    to its number of slices (empty where no key has over ``hot_rows`` rows)."""
    known = df.where(~_any_null([F.col(k) for k in keys]))
    top = known.select(F.xxhash64(*keys).alias("_h")).agg(
        F.expr(f"approx_top_k(_h, {MAX_HOT}, {TRACKED})").alias("_top"))
    hot = F.filter("_top", lambda x: x["count"] > hot_rows)
    return top.select(F.map_from_entries(F.transform(hot, lambda x: F.struct(
        x["item"], F.ceil(x["count"] / F.lit(hot_rows)).cast("int")))).alias("_m")).scalar()


def only_copy(keys: Sequence[str]) -> Column:
    """Zero, the copy number of a row with one copy; no constant to the optimizer."""
    return F.pmod(F.xxhash64(*keys), F.lit(1))


def sliced_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                how: str = "left", hot_rows: int | None = HOT_ROWS,
                spread: Column | None = None, deal_by: Sequence[str] | None = None) -> DataFrame:
    """``left.join(right, l1 = r1 AND l2 = r2 ..., how)`` for ``how`` "left"
    or "inner"; ``on`` names the column pairs.  All columns of both sides are
    returned, so their names must differ.  Right rows with a NULL key are
    dropped first (they match nothing).  ``hot_rows`` None spreads NULL keys
    only; a right side grouped by ``only_copy`` of its keys, as a column
    ``_copy``, and by them is then not shuffled again, and left rows for which
    ``spread`` holds are spread as NULL keys are: they match nothing.  Rows are
    dealt by a hash of ``deal_by``, all columns if not named: columns that only
    the hash reads are shuffled up to the join."""
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r}: left or inner")
    ls, rs = [l for l, _ in on], [r for _, r in on]
    lcols, rcols = [F.col(c) for c in ls], [F.col(c) for c in rs]
    # a map column cannot be hashed
    whole = [F.col(f"`{f.name}`") for f in left.schema.fields
             if "map<" not in f.dataType.simpleString() and (deal_by is None or f.name in deal_by)]
    dealt, null_slice = F.xxhash64(*whole, F.lit(1)), F.lit(NULL_SLICES)
    if hot_rows is None:
        apart = _any_null(lcols) if spread is None else _any_null(lcols) | spread
        a = left.withColumn("_slice", F.when(apart, F.pmod(dealt, null_slice) + 1)
                            .otherwise(only_copy(ls)))
        b = right.where(~_any_null(rcols))
        b = b if "_copy" in b.columns else b.withColumn("_copy", only_copy(rs))
    else:
        hot = hot_slices(left, ls, hot_rows)
        n_left = F.coalesce(F.try_element_at("_hot", F.xxhash64(*lcols)), F.lit(1))
        a = left.withColumn("_hot", hot).withColumn(
            "_slice", F.when(_any_null(lcols), F.pmod(dealt, null_slice))
            .otherwise(F.pmod(dealt, n_left)).cast("int")).drop("_hot")
        n_right = F.coalesce(F.try_element_at("_hot", F.xxhash64(*rcols)), F.lit(1))
        b = (right.where(~_any_null(rcols)).withColumn("_hot", hot)
             .withColumn("_copy", F.explode(F.sequence(F.lit(0), n_right - 1))).drop("_hot"))
    cond = a["_slice"] == b["_copy"]
    for l, r in on:
        cond = cond & (a[l] == b[r])
    return a.join(b, cond, how).drop("_slice", "_copy")
