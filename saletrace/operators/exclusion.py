"""``NOT IN (subquery)`` with SQL's NULL rules, without a NULL-aware join.

``x NOT IN (SELECT k FROM right)`` is TRUE when ``right`` is empty; else
NULL (row dropped) when ``x`` is NULL or ``right`` holds a NULL key; else
TRUE exactly when ``x`` is not among the keys.  Spark plans the literal form
as a broadcast NULL-aware anti join, which needs the whole right side on
every executor.  Here the membership test is an ordinary ``left_anti`` join
(sort-merge or broadcast, chosen by size) and the two NULL rules read one
scalar subquery over the right side (two counts, partially aggregated).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclude_not_in(left: DataFrame, right: DataFrame, left_key: str,
                   right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` for which ``left_key NOT IN (right_key of right)``
    is TRUE."""
    rk = right_key or left_key
    keys = right.select(F.col(rk).alias("_ex_key"))
    counts = keys.select(F.struct(F.count(F.lit(1)).alias("n"), F.count("_ex_key").alias("known"))
                         .alias("c")).scalar()
    n_right, n_null = counts["n"], counts["n"] - counts["known"]
    kept = left.join(keys.where(F.col("_ex_key").isNotNull()),
                     F.col(left_key) == F.col("_ex_key"), "left_anti")
    return kept.where((n_right == 0) | ((n_null == 0) & F.col(left_key).isNotNull()))
