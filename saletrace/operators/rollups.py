"""Account rollup (C10): sorted, comma-joined line-id sets per account and
short family name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saletrace.functions.logic import sorted_join


def short_family(df: DataFrame, family_short: DataFrame, family_col: str = "family") -> DataFrame:
    """Replace ``family_col`` by its short name where the lookup has one."""
    lk = family_short.select(F.col("family").alias("_fs_family"),
                             F.col("short_name").alias("_fs_short"))
    return (df.join(lk, F.col(family_col) == F.col("_fs_family"), "left")
            .withColumn(family_col, F.coalesce(F.col("_fs_short"), F.col(family_col)))
            .drop("_fs_family", "_fs_short"))


def account_rollup(matched: DataFrame, classes: DataFrame, family_short: DataFrame,
                   excluded_opp_type: str = "Renewal", sep: str = ", ",
                   as_strings: bool = True, own_tier: bool = False) -> DataFrame:
    """``(account_id, family, decom_rr_olis, provision_olis, close_dates)``.

    Matched rows (excluded opportunity type and NULL type dropped) joined to
    the line classes; per account and short family: the sorted distinct ids
    of decommissioned/reversed lines, of provisioned lines, and the sorted
    distinct close dates, each joined with ``sep`` (``''`` when empty).

    One aggregation: ``collect_set`` is partially aggregated on the map
    side (each task ships a de-duplicated set per group), and the final set
    of a group holds each id once however many asset pairs the line has.
    The output string of a group is as long as its id list by definition,
    so it is built in one task.  ``as_strings=False`` returns the same
    content in long form instead, ``(account_id, family, list, value)`` with
    ``list`` one of ``decom_rr_olis``, ``provision_olis``, ``close_dates``:
    distinct rows, no per-group collection, for accounts whose lists are too
    long to hold in one row.

    ``own_tier``: ``matched`` is ``matching.row_matches`` and ``classes``
    ``classify.classify_rows``; rows whose tier is not their line's are none of
    the match, and are left out by the join.
    """
    tier, best = (["_row_tier"], ["_best"]) if own_tier else ([], [])
    cl = classes.select(F.col("oli_id").alias("_c_oli"), "decom_rr", "provisioned", *best)
    rows = (matched.where(F.col("opp_type") != excluded_opp_type)
            .select("account_id", "family", "oli_id", "close_date", *tier)
            .join(cl, F.col("oli_id") == F.col("_c_oli")))
    if own_tier:
        # no tier is under its line's best; not written as an equality, by which
        # the classes would be shuffled again
        rows = rows.where(F.col("_row_tier") <= F.col("_best")).drop("_row_tier", "_best")
    rows = short_family(rows, family_short)
    if not as_strings:
        entries = F.array(
            F.when(F.col("decom_rr") == 1, F.struct(F.lit("decom_rr_olis").alias("list"),
                                                    F.col("oli_id").alias("value"))),
            F.when(F.col("provisioned") == 1, F.struct(F.lit("provision_olis").alias("list"),
                                                       F.col("oli_id").alias("value"))),
            F.when(F.col("close_date").isNotNull(),
                   F.struct(F.lit("close_dates").alias("list"),
                            F.col("close_date").cast("string").alias("value"))))
        return (rows.select("account_id", "family", F.explode(entries).alias("e"))
                .where(F.col("e").isNotNull())
                .select("account_id", "family", "e.list", "e.value")
                .distinct())
    return (rows.groupBy("account_id", "family")
            .agg(sorted_join(F.collect_set(F.when(F.col("decom_rr") == 1, F.col("oli_id"))), sep)
                 .alias("decom_rr_olis"),
                 sorted_join(F.collect_set(F.when(F.col("provisioned") == 1, F.col("oli_id"))),
                             sep).alias("provision_olis"),
                 sorted_join(F.collect_set(F.col("close_date").cast("string")), sep)
                 .alias("close_dates")))
