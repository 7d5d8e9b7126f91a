"""Numbered report order without a single-task sort."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_position(df: DataFrame, order: Sequence[Column],
                  materialize_with: Callable[[DataFrame], DataFrame] | None = None,
                  name: str = "pos") -> DataFrame:
    """``df`` with ``name``: each row's place (from 1) in ``order``, which must
    be total for a unique result.

    The rows are range-partitioned and sorted, numbered within their
    partition, and written by ``materialize_with``; the number of rows before
    a partition comes from a window over one row per partition, which is few
    enough to broadcast: the numbered rows are not shuffled again.  Without a
    writer (small reports, sessions without a shared folder) one window over
    all rows numbers them, in one task.
    """
    if materialize_with is None:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    # monotonically_increasing_id: partition number in the high bits, place in the low 33
    placed = materialize_with(df.repartitionByRange(*order).sortWithinPartitions(*order)
                              .withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    before = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(
                  Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("_part", "_before"))
    return (placed.join(F.broadcast(before), part == F.col("_part"))
            .withColumn(name, F.col("_before") + (F.col("_id") - F.shiftleft("_part", 33)) + 1)
            .drop("_id", "_part", "_before"))
