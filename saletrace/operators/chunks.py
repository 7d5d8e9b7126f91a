"""Ordered string aggregation in chunks.

``array_join(sort_array(collect_set(v)), sep)`` builds a group's whole string
in one row and one task.  :func:`joined_chunks` gives the same string as
numbered pieces of at most ``chunk_rows`` values, whatever a group's size:
the rows are numbered in the order (group, value) without a one-task sort
(``ordering.with_position``), and every run of ``chunk_rows`` positions is
joined by itself.  A group's pieces in chunk order, joined by the separator,
are its string.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saletrace.operators.ordering import with_position

CHUNK_ROWS = 10_000


def joined_chunks(df: DataFrame, group: Sequence[str], value: str, sep: str = ", ",
                  chunk_rows: int = CHUNK_ROWS,
                  materialize_with: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``group..., chunk, n_values, text``: ``df``'s values per group, sorted,
    joined by ``sep``, in pieces.  ``value`` is a string, or orders as its
    text should (numbers ascend as numbers).  Rows are taken as they are: make
    them distinct first for a set.  NULL values are left out.

    A piece ends where its group ends, or where the position of the row in
    the order of all rows passes a multiple of ``chunk_rows``.  ``chunk``
    numbers a group's pieces from 0; they are as many as its rows need, so
    the window that numbers them is small."""
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_value"))
    placed = with_position(rows, [F.col(g) for g in group] + [F.col("_value")], materialize_with,
                           name="_at")
    pieces = (placed.withColumn("_run", F.expr(f"(_at - 1) DIV {int(chunk_rows)}"))
              .groupBy(*group, "_run")
              .agg(F.count(F.lit(1)).alias("n_values"),
                   F.array_join(F.sort_array(F.collect_list("_value")).cast("array<string>"), sep)
                   .alias("text")))
    nth = F.row_number().over(Window.partitionBy(*group).orderBy("_run")) - 1
    return pieces.select(*group, nth.cast("bigint").alias("chunk"), "n_values", "text")
