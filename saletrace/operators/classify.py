"""Line classification (C7): decommissioned/reversed, provisioned, or
neither; one row per line, lines that are neither are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saletrace.functions.logic import contains_any, flag01
from saletrace.operators.matching import is_live
from saletrace.params import REVERSAL_LABEL, ClassifyRules


#: what ``line_tests`` adds
LINE_TESTS = ("_counted", "_prov_by_line", "_decom_by_line")


def _counted(rules: ClassifyRules) -> Column:
    q = F.col("quantity")
    return ((F.col("opp_type") != rules.excluded_opp_type)
            & ((q > rules.excluded_quantity) | (q < rules.excluded_quantity)))


def _override(rules: ClassifyRules) -> Column:
    return (contains_any(F.col("family"), rules.always_provisioned)
            | (contains_any(F.col("family"), rules.provisioned_after)
               & (F.col("close_date") > F.lit(rules.provisioned_after_date).cast("date"))))


def _labels(rows: DataFrame, provisioned: Column, decommissioned: Column, rules: ClassifyRules,
            id_col: str) -> DataFrame:
    """One row per labelled line from row-level tests."""
    counted = rows.where(_counted(rules))
    override = _override(rules)
    # integer flags (set only where the id is not NULL) aggregate by hash
    scored = counted.select(
        F.col(id_col),
        F.when((override | provisioned) & F.col(id_col).isNotNull(), F.lit(1)).alias("_prov"),
        flag01((F.col("reversal_opp") == REVERSAL_LABEL) | decommissioned).alias("_decom"))
    per_line = scored.groupBy(id_col).agg(F.max("_decom").alias("_decom"),
                                          F.max("_prov").alias("_prov"))
    is_decom = F.col("_decom") == 1
    is_prov = ~is_decom & F.col("_prov").isNotNull()
    return (per_line.where(is_decom | is_prov)
            .select(id_col, F.when(is_decom, F.lit(1)).alias("decom_rr"),
                    F.when(is_prov, F.lit(1)).alias("provisioned")))


def classify_lines(matched: DataFrame, rules: ClassifyRules = ClassifyRules(),
                   id_col: str = "oli_id") -> DataFrame:
    """``(oli_id, decom_rr, provisioned)`` with 1 or NULL flags.

    Per matched row: provisioned when the asset is enabled, active and in a
    live use, or the match tier is a deployment-linked one; family overrides
    make a line provisioned regardless; decommissioned/reversed when the
    line is a reversal or its asset has a decommission key.  Rows of
    excluded opportunity type (NULL type rows drop too, as ``!=`` does) and
    of quantity exactly ``excluded_quantity`` are ignored.  Per line, any
    decommissioned row wins over any provisioned row.
    """
    return _labels(matched, is_live(rules) | F.col("match_type").contains(rules.linked_tier_marker),
                   F.col("decom_resource").isNotNull(), rules, id_col)


def classify_summary(summary: DataFrame, rules: ClassifyRules = ClassifyRules(),
                     id_col: str = "oli_id") -> DataFrame:
    """``classify_lines`` from ``match_summary``: the same lines and flags,
    without building a pair (a line's flags ask only whether any of its
    assets is live, and whether any is decommissioned)."""
    return _labels(summary, F.col("any_live") | F.col("match_type").contains(rules.linked_tier_marker),
                   F.col("any_decom"), rules, id_col)


def line_tests(facts: DataFrame, rules: ClassifyRules = ClassifyRules()) -> DataFrame:
    """``facts`` with the tests of ``classify_lines`` that need no asset, as
    three flags ``LINE_TESTS``: they travel through the match instead of the
    columns they are made of."""
    counted = F.coalesce(_counted(rules), F.lit(False))
    return facts.withColumns({
        "_counted": counted,
        "_prov_by_line": counted & F.coalesce(_override(rules), F.lit(False)),
        "_decom_by_line": counted & F.coalesce(F.col("reversal_opp") == REVERSAL_LABEL, F.lit(False))})


def classify_rows(rows: DataFrame, rules: ClassifyRules = ClassifyRules(),
                  id_col: str = "oli_id") -> DataFrame:
    """``classify_summary`` from ``matching.row_matches`` of ``line_tests``, in
    one aggregate by line, with the line's best tier ``_best``.  A flag holds
    if the least tier in which a row has it is the least tier of all rows: only
    rows of the line's best tier are in the match."""
    tier = F.col("_row_tier")
    linked = F.col("match_type").contains(rules.linked_tier_marker)
    prov = F.col("_prov_by_line") | (F.col("_counted") & (F.col("any_live") | linked))
    decom = F.col("_decom_by_line") | (F.col("_counted") & F.col("any_decom"))
    per_line = rows.groupBy(id_col).agg(
        F.min(tier).alias("_best"), F.min(F.when(decom, tier)).alias("_decom"),
        F.min(F.when(prov & F.col(id_col).isNotNull(), tier)).alias("_prov"))
    is_decom = F.coalesce(F.col("_decom") == F.col("_best"), F.lit(False))
    is_prov = ~is_decom & F.coalesce(F.col("_prov") == F.col("_best"), F.lit(False))
    return (per_line.where(is_decom | is_prov)
            .select(id_col, F.when(is_decom, F.lit(1)).alias("decom_rr"),
                    F.when(is_prov, F.lit(1)).alias("provisioned"), "_best"))
