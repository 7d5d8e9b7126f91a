"""Snapshot comparison (C6): how the set of matched lines changed between
two runs, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saletrace.functions.logic import ordinal
from saletrace.params import OVERALL_LABEL, SEGMENT_ORDER
from saletrace.sources.io import constant_relation


def segments(old: DataFrame, new: DataFrame, key: str = "oli_id",
             group: str = "family") -> DataFrame:
    """Distinct (key, group) of each run, full outer joined on ``key``:
    ``segment`` is ``in_both`` / ``old_only`` / ``new_only``.

    As the original: pairs join on the key only (a key with two groups on
    one side is counted twice in ``in_both``), a NULL key never matches and
    is labelled ``new_only`` even when it comes from the old run, and
    ``in_both`` rows take the old run's group.

    Each run is dealt by its key once, for the DISTINCT and the join.
    """
    o = old.select(F.col(key).alias("_o_key"), F.col(group).alias("_o_grp")).repartition("_o_key").distinct()
    n = new.select(F.col(key).alias("_n_key"), F.col(group).alias("_n_grp")).repartition("_n_key").distinct()
    seg = (F.when(F.col("_o_key").isNotNull() & F.col("_n_key").isNotNull(), F.lit("in_both"))
           .when(F.col("_o_key").isNotNull(), F.lit("old_only"))
           .otherwise(F.lit("new_only")))
    return (o.join(n, F.col("_o_key") == F.col("_n_key"), "full_outer")
            .select(F.coalesce("_o_key", "_n_key").alias(key),
                    F.coalesce("_o_grp", "_n_grp").alias(group),
                    seg.alias("segment")))


def _emit(arr, segment: str, cond, overall: bool = False, weight=None):
    """``arr`` of ``struct<g>`` → ``struct<grp, seg, ov, n>`` rows (the group
    left out of overall rows), or none unless ``cond``; ``n`` is 1 unless a
    ``weight`` column is given."""
    n = F.lit(1) if weight is None else weight

    def row(x):
        grp = F.lit(None).cast("string") if overall else x["g"]
        return F.struct(grp.alias("grp"), F.lit(segment).alias("seg"), F.lit(overall).alias("ov"),
                        n.cast("int").alias("n"))

    rows = F.transform(arr, row)
    return F.filter(rows, lambda _: cond)


def compare_snapshots(old: DataFrame, new: DataFrame, key: str = "oli_id",
                      group: str = "family", count_col: str = "unique_oli_count") -> DataFrame:
    """Segment counts overall and per group (C6): ``(group, segment, count)``.

    The numbers of counting ``segments`` rows per (group, segment) and per
    segment, plus distinct-key totals per run (``total_old``/``total_new``)
    per group and overall; the overall rows carry the group ``'overall'``.
    Computed with two shuffles instead of one per summary level:

    1. both runs, tagged by side, are grouped by key, collecting each side's
       set of groups (partially aggregated: a key repeated in many matched
       rows is one set entry per map task);
    2. each key emits its contributions: the rows the full outer join on
       the key gives (every old group with every new group for a key in both
       runs, labelled with the old group; the groups of a key in one run
       only; NULL keys never match and count as ``new_only``), one row per
       group for the per-group totals, one mark per run for the overall
       totals, and an overall copy of each joined row;
    3. one partially aggregated count per (group, segment, overall).
    """
    g = F.struct(F.col(group).alias("g"))
    both = (old.select(F.col(key).alias("_k"), g.alias("_g"), F.lit(True).alias("_old"))
            .unionByName(new.select(F.col(key).alias("_k"), g.alias("_g"),
                                    F.lit(False).alias("_old"))))
    return _compare_tagged(both, group, count_col)


def compare_cuts(rows: DataFrame, in_old, in_new, key: str = "oli_id", group: str = "family",
                 count_col: str = "unique_oli_count", tier: str | None = None) -> DataFrame:
    """``compare_snapshots`` of two cuts of one table (``in_old``/``in_new``
    are boolean columns; a row may be in both), reading ``rows`` once: each
    row is tagged with its sides by an ``explode``, no second scan.

    ``tier``: a column of integers from 0; only the rows of a key with the
    least of them count (``matching.row_matches``).  A key collects the
    distinct groups with tier and sides, and keeps those of its least tier."""
    if tier is not None:
        sides = F.when(in_old, 1).otherwise(0) + F.when(in_new, 2).otherwise(0)
        # the tier, and in the low two bits the sides: the least one has the least tier
        row = F.struct((F.col(tier) * 4 + sides).alias("s"), F.when(sides > 0, F.col(group)).alias("g"))
        per_key = (rows.groupBy(F.col(key).alias("_k")).agg(F.collect_set(row).alias("_rows"))
                   .withColumn("_best", F.shiftright(F.array_min("_rows")["s"], 2)))

        def groups(side: int) -> Column:
            own = F.filter("_rows", lambda x: (F.shiftright(x["s"], 2) == F.col("_best"))
                           & (x["s"].bitwiseAND(F.lit(side)) > 0))
            return F.array_distinct(F.transform(own, lambda x: F.struct(x["g"].alias("g"))))
        per_key = per_key.select("_k", groups(1).alias("_go"), groups(2).alias("_gn"))
        return summed_report(counted(contributions(per_key)), group, count_col)
    g = F.struct(F.col(group).alias("g"))
    sides = F.filter(F.array(F.when(in_old, F.lit(True)), F.when(in_new, F.lit(False))),
                     lambda x: x.isNotNull())
    both = rows.select(F.col(key).alias("_k"), g.alias("_g"), F.explode(sides).alias("_old"))
    return _compare_tagged(both, group, count_col)


def _compare_tagged(both: DataFrame, group: str, count_col: str) -> DataFrame:
    """The comparison over rows ``(_k, _g: struct<g>, _old: boolean)``."""
    per_key = both.groupBy("_k").agg(
        F.collect_set(F.when(F.col("_old"), F.col("_g"))).alias("_go"),
        F.collect_set(F.when(~F.col("_old"), F.col("_g"))).alias("_gn"))
    return summed_report(counted(contributions(per_key)), group, count_col)


def grouped_sides(run: DataFrame, key: str, group: str) -> DataFrame:
    """``_k, _go``: the set of groups of each key of one run."""
    return (run.groupBy(F.col(key).alias("_k"))
            .agg(F.collect_set(F.struct(F.col(group).alias("g"))).alias("_go")))


def joined_sides(old: DataFrame, new: DataFrame) -> DataFrame:
    """``_k, _go, _gn`` of two runs from ``grouped_sides``, by a full outer
    join on the key (NULL keys stay apart)."""
    none = F.array().cast(old.schema["_go"].dataType)
    n = new.select(F.col("_k").alias("_nk"), F.col("_go").alias("_gn"))
    return (old.join(n, F.col("_k") == F.col("_nk"), "full_outer")
            .select(F.coalesce("_k", "_nk").alias("_k"), F.coalesce("_go", none).alias("_go"),
                    F.coalesce("_gn", none).alias("_gn")))


def contributions(per_key: DataFrame, *carry: str) -> DataFrame:
    """The rows ``c: struct<grp, seg, ov, n>`` each key of ``_k, _go, _gn``
    adds to the report, with the columns ``carry``."""
    go, gn = F.col("_go"), F.col("_gn")
    known = F.col("_k").isNotNull()
    has_o, has_n = F.size(go) > 0, F.size(gn) > 0
    joined = F.flatten(F.transform(go, lambda a: F.transform(
        gn, lambda b: F.struct(F.coalesce(a["g"], b["g"]).alias("g")))))
    mark = F.array(F.struct(F.lit(None).cast("string").alias("g")))
    parts = []
    for ov in (False, True):
        parts += [_emit(joined, "in_both", known, ov),
                  _emit(go, "old_only", known & ~has_n, ov),
                  _emit(go, "new_only", ~known, ov),
                  _emit(gn, "new_only", ~known | ~has_o, ov)]
    # per-group totals count distinct non-NULL keys, but a group whose keys
    # are all NULL still reports 0 (a grouped COUNT(DISTINCT) row)
    one_if_known = F.when(known, F.lit(1)).otherwise(F.lit(0))
    parts += [_emit(go, "total_old", F.lit(True), weight=one_if_known),
              _emit(gn, "total_new", F.lit(True), weight=one_if_known),
              _emit(mark, "total_old", known & has_o, True),
              _emit(mark, "total_new", known & has_n, True)]
    return per_key.select(*carry, F.explode(F.concat(*parts)).alias("c"))


def counted(contrib: DataFrame, *carry: str) -> DataFrame:
    return (contrib.groupBy(*carry, F.col("c.grp").alias("grp"), F.col("c.seg").alias("seg"),
                            F.col("c.ov").alias("ov"))
            .agg(F.sum("c.n").cast("bigint").alias("n")))


def summed_report(counts: DataFrame, group: str, count_col: str) -> DataFrame:
    """The report from partial counts ``grp, seg, ov, n``."""
    # an empty run still reports its overall total, 0, as a global count does
    zeros = constant_relation(counts.sparkSession,
                              [(None, "total_old", True, 0), (None, "total_new", True, 0)],
                              "grp string, seg string, ov boolean, n bigint")
    out = counts.unionByName(zeros).groupBy("grp", "seg", "ov").agg(F.sum("n").alias("n"))
    return out.select(
        F.when(F.col("ov"), F.lit(OVERALL_LABEL)).otherwise(F.col("grp")).alias(group),
        F.col("seg").alias("segment"), F.col("n").cast("bigint").alias(count_col))


def rank_segments(report: DataFrame, group: str = "family") -> DataFrame:
    """Report order of the comparison: by group, then segment in the order
    total_old, total_new, in_both, old_only, new_only; ``pos`` numbers the
    rows.  The report holds at most 5 rows per group, so numbering it in one
    ordered window is bounded by the number of groups, not by the data."""
    rank = ordinal(F.col("segment"), SEGMENT_ORDER)
    w = Window.orderBy(F.col(group).asc_nulls_first(), rank.asc_nulls_first())
    return report.withColumn("pos", F.row_number().over(w)).orderBy("pos")
