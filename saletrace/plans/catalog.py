"""The query catalogue: one function ``(spark, sf_dir) -> DataFrame`` per
operator, each reading the driver tables under ``sf_dir`` whole and
deriving the canonical inputs from them (``saletrace.sources.fixtures``)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saletrace.functions.hosts import dotted_prefix, first_label
from saletrace.functions.logic import is_true, ordinal, sorted_join
from saletrace.operators.assets import enrich_assets, host_keys, unify_sources
from saletrace.operators.chunks import joined_chunks
from saletrace.operators.classify import LINE_TESTS, classify_rows, line_tests
from saletrace.operators.compare import compare_cuts, compare_snapshots, rank_segments, segments
from saletrace.operators.disjunctive import Alternative, disjunctive_join
from saletrace.operators.exclusion import exclude_not_in
from saletrace.operators.facts import FACT_COLUMNS, base_product_codes, line_facts, linked_ids
from saletrace.operators.matching import match_summary, row_matches, tiered_match
from saletrace.operators.ordering import with_position
from saletrace.operators.period import period_change, period_rejects
from saletrace.operators.profile import profile_columns
from saletrace.operators.rollups import account_rollup
from saletrace.operators.status import decom_rollup, line_status, merge_decoms, reversal_rollup
from saletrace.plans.materialize import materialize, new_folder, run_folder
from saletrace.plans.runs import compare_changed, compare_versions, write_run
from saletrace.session import checkpoint_dir
from saletrace.sources.fixtures import (
    FIXTURE_CLASSIFY_RULES, FIXTURE_FACT_RULES, FIXTURE_PERIOD_RULES,
    FIXTURE_STATUS_RULES, FIXTURE_TIERS, NEW_RUN_FROM, OLD_RUN_BEFORE, RUN_DOUBLED_AS, RUN_DOUBLED_UNDER,
    RUN_MOVED_OVER, RUN_MOVED_TO, Fixtures)
from saletrace.sources.io import read_snapshot, write_snapshot
from saletrace.sources.versions import read_version, write_version


# a match key with more rows than this on either side is sliced in the pair
# join (no effect below)
HOT_KEY_ROWS = 1_000_000
# values in a piece of a rollup list
ROLLUP_CHUNK = 1000
# buckets of a written run
RUN_BUCKETS = 32
# the fact columns that the classes and the rollup read
CLASS_FACTS = ("oli_id", *LINE_TESTS)
ROLLUP_FACTS = (*CLASS_FACTS, "opp_type", "account_id", "family", "close_date")
RUN_FACTS = ("oli_id", "family", "close_date")
RUN_CORRECTED_DAY = "1998-02-11"


class FixtureRun:
    """The chain of operators over one fixture folder.  Steps are lazy
    DataFrames; intermediates read more than once are written under the
    session's checkpoint folder, where it names one (``plans.materialize``)."""

    def __init__(self, spark: SparkSession, sf_dir: str, write: bool = True):
        self.fx = Fixtures(spark, sf_dir)
        self.keep = (lambda df, name: materialize(df, name)) if write else (lambda df, name: df)
        self.writes = write and bool(checkpoint_dir(spark))
        self._summary = {}

    def assets(self) -> DataFrame:
        return unify_sources(self.fx.asset_sources())

    def keys(self) -> DataFrame:
        return host_keys(self.fx.decom_host())

    def enriched(self) -> DataFrame:
        return enrich_assets(self.assets(), self.fx.master_account(), self.fx.deployment(),
                             self.keys())

    def facts(self) -> DataFrame:
        fx = self.fx
        return line_facts(fx.opportunity(), fx.line_item(dealt=True), fx.quote_line(dealt=True), fx.quote(),
                          fx.product(), fx.reversal(), FIXTURE_FACT_RULES)

    def matched(self, tiers=None) -> DataFrame:
        """The pairs: only for the match itself."""
        return tiered_match(self.facts(), self.enriched(), self.fx.class_family(),
                            materialize_with=(lambda df: self.keep(df, "match_step")) if self.writes else None,
                            hot_key_rows=HOT_KEY_ROWS, tiers=tiers)

    def summary_plan(self, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
        # each source is read once: the key lookups share one shuffled summary,
        # and the annotated facts are written before their minimum is joined
        return match_summary(self.facts(), self.enriched(), self.fx.class_family(),
                             rules=FIXTURE_CLASSIFY_RULES, columns=columns,
                             materialize_with=lambda df: self.keep(df, "match_step"),
                             materialize_lines_with=lambda df: self.keep(df, "mixed_lines"))

    def summary(self, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
        """The matched lines without their pairs, for all that reads it twice."""
        columns = tuple(columns)
        if columns not in self._summary:
            self._summary[columns] = self.keep(self.summary_plan(columns), "match_summary")
        return self._summary[columns]

    def row_matches(self, columns: Sequence[str]) -> DataFrame:
        """Every fact row with its own tier, for what aggregates by line."""
        return row_matches(line_tests(self.facts(), FIXTURE_CLASSIFY_RULES), self.enriched(),
                           self.fx.class_family(), rules=FIXTURE_CLASSIFY_RULES, columns=columns)

    def position(self, df: DataFrame, *order) -> DataFrame:
        """``df`` numbered in ``order`` (distributed where it can be written)."""
        return with_position(df, order, (lambda x: self.keep(x, "ordered")) if self.writes else None)

    def rollup(self, as_strings: bool = False) -> DataFrame:
        rows = self.keep(self.row_matches(ROLLUP_FACTS), "match_step")
        return account_rollup(rows, classify_rows(rows, FIXTURE_CLASSIFY_RULES),
                              self.fx.family_short(), as_strings=as_strings, own_tier=True)

    def status(self) -> DataFrame:
        fx = self.fx
        la = fx.line_asset_sources()
        return line_status(la, decom_rollup(fx.decom_event(), FIXTURE_STATUS_RULES),
                           reversal_rollup(la, fx.reverse_rebook(), fx.quote(),
                                           FIXTURE_STATUS_RULES),
                           FIXTURE_STATUS_RULES, columns=fx.line_asset_columns())


# ---- catalogue entries --------------------------------------------------------

def q_unify_sources(spark: SparkSession, sf: str) -> DataFrame:
    return FixtureRun(spark, sf).assets()


def q_host_keys(spark: SparkSession, sf: str) -> DataFrame:
    return FixtureRun(spark, sf).keys()


def q_enrich_assets(spark: SparkSession, sf: str) -> DataFrame:
    return FixtureRun(spark, sf).enriched()


def q_line_facts(spark: SparkSession, sf: str) -> DataFrame:
    return FixtureRun(spark, sf).facts()


def q_asset_links(spark: SparkSession, sf: str) -> DataFrame:
    """Assets with account and deployment link only (no decommission key)."""
    p = FixtureRun(spark, sf, write=False)
    return enrich_assets(p.assets(), p.fx.master_account(), p.fx.deployment())


def q_tiered_match(spark: SparkSession, sf: str) -> DataFrame:
    return FixtureRun(spark, sf).matched()


def q_tiered_match_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The match under other rules: five tiers with keys of one and two parts,
    predicates on either side, and the lookup."""
    return FixtureRun(spark, sf).matched(FIXTURE_TIERS)


def q_tier_summary(spark: SparkSession, sf: str) -> DataFrame:
    return (FixtureRun(spark, sf).summary_plan(["oli_id"]).groupBy("match_type")
            .agg(F.sum("n_rows").alias("n"), F.countDistinct("oli_id").alias("n_lines")))


def _cuts(p: FixtureRun) -> DataFrame:
    """Two cuts of one match run, compared in one pass over the match."""
    close = F.col("close_date")
    return compare_cuts(p.row_matches(RUN_FACTS), close < F.lit(OLD_RUN_BEFORE).cast("date"),
                        close >= F.lit(NEW_RUN_FROM).cast("date"), tier="_row_tier")


def q_snapshot_compare(spark: SparkSession, sf: str) -> DataFrame:
    return _cuts(FixtureRun(spark, sf))


def q_snapshot_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Row-level segments: distinct (line, family) of both runs, full outer
    joined on the line id."""
    m = FixtureRun(spark, sf).summary(RUN_FACTS)
    return segments(m.where(F.col("close_date") < F.lit(OLD_RUN_BEFORE).cast("date")),
                    m.where(F.col("close_date") >= F.lit(NEW_RUN_FROM).cast("date")))


def q_ranked_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rank_segments(_cuts(FixtureRun(spark, sf)))


def _two_runs(p: FixtureRun) -> tuple[DataFrame, DataFrame]:
    """Two runs ``oli_id, family``.  They differ in lines (cut by close date)
    and in families: the new run moves large lines to another family and lists
    small ones under a second one as well."""
    columns = (*RUN_FACTS, "quantity")
    m = p.keep(p.summary_plan(columns).select(*columns), "run_lines")
    old = m.where(F.col("close_date") < F.lit(OLD_RUN_BEFORE).cast("date"))
    new = m.where(F.col("close_date") >= F.lit(NEW_RUN_FROM).cast("date"))
    moved = new.withColumn("family", F.when(F.col("quantity") > RUN_MOVED_OVER, RUN_MOVED_TO)
                           .otherwise(F.col("family")))
    second = (new.where(F.col("quantity") < RUN_DOUBLED_UNDER)
              .withColumn("family", F.lit(RUN_DOUBLED_AS)))
    return old.select("oli_id", "family"), moved.unionByName(second).select("oli_id", "family")


def q_run_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs, written as snapshots and read back, compared."""
    folder = new_folder(spark, run_folder(spark), "runs")
    for run, df in zip(("old", "new"), _two_runs(FixtureRun(spark, sf))):
        write_snapshot(df, folder, run)
    return compare_snapshots(read_snapshot(spark, folder, "old"), read_snapshot(spark, folder, "new"))


def q_run_compare_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The same two runs as bucketed versions, joined bucket by bucket."""
    folder = new_folder(spark, run_folder(spark), "runs")
    for run, df in zip(("old", "new"), _two_runs(FixtureRun(spark, sf))):
        write_run(df, folder, run, buckets=RUN_BUCKETS)
    return compare_versions(spark, folder, "old", "new")


def q_run_compare_changed(spark: SparkSession, sf: str) -> DataFrame:
    """A run and its late correction (the lines closed on one day move to
    another family): only buckets that the correction touched are read."""
    p = FixtureRun(spark, sf)
    m = p.keep(p.summary_plan(RUN_FACTS).select(*RUN_FACTS), "run_lines")
    folder = new_folder(spark, run_folder(spark), "runs")
    late = F.col("close_date") == F.lit(RUN_CORRECTED_DAY).cast("date")
    fixed = m.withColumn("family", F.when(late, RUN_MOVED_TO).otherwise(F.col("family")))
    write_run(m, folder, "old", buckets=RUN_BUCKETS)
    write_run(fixed, folder, "new", buckets=RUN_BUCKETS)
    return compare_changed(spark, folder, "old", "new")


def q_classify_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The line classes in the order of their ids, numbered."""
    p = FixtureRun(spark, sf)
    classes = classify_rows(p.row_matches(CLASS_FACTS), FIXTURE_CLASSIFY_RULES)
    return p.position(classes.drop("_best"), F.col("oli_id"))


def q_decom_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return decom_rollup(Fixtures(spark, sf).decom_event(), FIXTURE_STATUS_RULES)


def q_decom_rollup_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The rollup kept as a version, and brought up to date by three batches of
    events; the stored table is neither shuffled nor aggregated again."""
    events = Fixtures(spark, sf).decom_event()
    folder = new_folder(spark, run_folder(spark), "decoms")
    part = F.pmod(F.coalesce(F.dayofyear("decommissioned_at"), F.lit(0)), F.lit(3))
    write_version(decom_rollup(events.where(part == 0), FIXTURE_STATUS_RULES), folder, "decoms",
                  "asset_id", RUN_BUCKETS)
    for n in (1, 2):
        merged = merge_decoms(read_version(spark, folder, "decoms"), events.where(part == n),
                              FIXTURE_STATUS_RULES)
        write_version(merged, folder, "decoms", "asset_id", RUN_BUCKETS)
    return read_version(spark, folder, "decoms")


def q_reversal_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Sums over all (line, incident) pairs of an ``OR`` with an ``EXISTS``: a
    line meets an incident of its opportunity, one through a quote of its
    opportunity, or one that is numbered after its opportunity."""
    fx = Fixtures(spark, sf)
    lines = fx.line_asset().select("oli_id", "opp_id", "quantity", F.concat(
        F.lit("INC"), F.expr("substring(opp_id, 2)")).alias("named"))
    quote = fx.quote().select(F.col("id").alias("quote_id"), "opportunity_id")
    pairs = disjunctive_join(lines, fx.reverse_rebook(), [
        Alternative([("opp_id", "linked_id")],
                    right="link_type = 'Opportunity' AND booking_type = 'Reversal'"),
        Alternative([("opp_id", "opportunity_id")], right="link_type = 'Quote'", through=quote,
                    to=[("quote_id", "linked_id")]),
        Alternative([("named", "incident_number")])])
    return pairs.groupBy("booking_type", "processed_as").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum("quantity").alias("quantity"))


def q_reversal_rollup(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    return reversal_rollup(fx.line_asset(), fx.reverse_rebook(), fx.quote(), FIXTURE_STATUS_RULES)


def q_line_status(spark: SparkSession, sf: str) -> DataFrame:
    return FixtureRun(spark, sf).status()


def q_status_summary(spark: SparkSession, sf: str) -> DataFrame:
    return FixtureRun(spark, sf).status().groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def q_account_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The long form: one row per account, family, list and value."""
    return FixtureRun(spark, sf).rollup()


def q_account_rollup_strings(spark: SparkSession, sf: str) -> DataFrame:
    """The original's form: one row per account and family, its lists as
    strings."""
    return FixtureRun(spark, sf).rollup(as_strings=True)


def q_rollup_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The same lists in numbered pieces of at most ``ROLLUP_CHUNK`` values:
    no list is built in one task."""
    p = FixtureRun(spark, sf)
    return joined_chunks(p.rollup(), ["account_id", "family", "list"], "value",
                         chunk_rows=ROLLUP_CHUNK,
                         materialize_with=(lambda x: p.keep(x, "ordered")) if p.writes else None)


def q_period_change_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The report with the account's id lists on every row, as the original
    prints it."""
    p = FixtureRun(spark, sf)
    return period_change(p.fx.arr_quarter(), p.rollup(as_strings=True),
                         replace(FIXTURE_PERIOD_RULES, sort=False, attach_lists=True))


def q_period_change(spark: SparkSession, sf: str) -> DataFrame:
    """The report's rows in report order, numbered; the id lists are the long
    rollup's, joined on (account_id, family) by who reads them."""
    p = FixtureRun(spark, sf)
    report = period_change(p.fx.arr_quarter(), None, replace(FIXTURE_PERIOD_RULES, sort=False))
    return p.position(report, F.col("arr_diff").asc_nulls_first(), F.col("oli_id"),
                      F.col("account_name"))


def q_period_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """How many amount texts are no number, per period."""
    return period_rejects(Fixtures(spark, sf).arr_quarter(), FIXTURE_PERIOD_RULES)


def q_membership_flag(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item with its base product code (product self-lookup)
    and its reversal flag (membership in distinct linked ids)."""
    fx = Fixtures(spark, sf)
    li = fx.line_item().select("id", "opportunity_id", "quote_line_id", "product_id")
    prod = fx.product().select(F.col("id").alias("_p_id"), "base_product_id")
    j = (li.join(prod, F.col("product_id") == F.col("_p_id"), "left")
         .join(base_product_codes(fx.product()),
               F.col("base_product_id") == F.col("base_id"), "left")
         .join(linked_ids(fx.reversal(), "Quote", "rq"),
               F.col("quote_line_id") == F.col("_rq_id"), "left")
         .join(linked_ids(fx.reversal(), "Opportunity", "ro"),
               F.col("opportunity_id") == F.col("_ro_id"), "left"))
    return j.select(F.col("id").alias("oli_id"), "base_product_code",
                    (F.col("_rq").isNotNull() | F.col("_ro").isNotNull()).alias("is_reversed"))


def q_null_safe_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    """``order key NOT IN (customer keys of a segment)`` three ways, with
    some order keys NULL: a right side holding a NULL (nothing passes), one
    without (NULL left keys drop), and an empty one (everything passes)."""
    t = Fixtures(spark, sf).t
    lhs = t["orders"].select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("o_custkey")).alias("k"))
    cust = t["customer"]
    with_null = cust.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("c_custkey")).alias("c"))
    plain = cust.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("c"))
    empty = cust.where(F.col("c_mktsegment") == "NONE").select(F.col("c_custkey").alias("c"))
    parts = [exclude_not_in(lhs, right, "k", "c").select("o_orderkey", F.lit(seg).alias("segment"))
             for seg, right in (("MACHINERY", with_null), ("BUILDING", plain), ("NONE", empty))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_scalar_probe(spark: SparkSession, sf: str) -> DataFrame:
    """One column per scalar function the pipeline uses, over every event."""
    t = Fixtures(spark, sf).t
    e = t["events"]
    eid = F.col("event_id")
    host = F.concat(F.lit("h"), (eid % 500).cast("string"),
                    F.when(eid % 17 == 0, F.lit("")).when(eid % 19 == 0, F.lit(".lead"))
                    .otherwise(F.lit(".example.com")))
    host = F.when(eid % 23 == 0, F.concat(F.lit("."), host)).otherwise(host)
    link = F.concat(F.lit("https://crm.example.com/x/A"), F.col("user_id").cast("string"),
                    F.when(eid % 11 == 0, F.lit("/")).otherwise(F.lit("")))
    amount = F.when(eid % 10 == 0, F.lit("n/a")).otherwise(
        F.concat(eid.cast("string"), F.lit(".5")))
    label = F.concat(F.lit("2001 | Q"), (eid % 5).cast("string"))
    enabled = F.when(eid % 13 == 0, F.lit(None).cast("boolean")).otherwise(eid % 2 == 0)
    d = F.col("ts").cast("date")
    return e.select(
        "event_id",
        is_true(enabled).alias("enabled_or_false"),
        first_label(host).alias("first_label"),
        F.instr(host, ".").alias("dot_pos"),
        dotted_prefix(host).alias("dotted_prefix"),
        F.lower(F.col("event_type")).alias("lower_type"),
        F.regexp_extract(link, r"[^/]+$", 0).alias("link_tail"),
        amount.try_cast("double").alias("amount"),
        d.alias("ts_date"),
        d.cast("string").alias("ts_text"),
        F.year("ts").cast("int").alias("ts_year"),
        F.datediff(F.lit("2024-03-01").cast("date"), d).alias("age_days"),
        sorted_join(F.array(F.col("event_type"), F.lit("b"), F.lit("a"))).alias("joined"),
        (F.lit(-1) * F.col("value")).alias("neg_value"),
        ordinal(label, ("2001 | Q1", "2001 | Q2")).alias("period_ord"),
    )


def q_profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profile_columns(Fixtures(spark, sf).t.all(), sort=True, catalog="files", schema="driver")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "unify_sources": q_unify_sources,
    "host_keys": q_host_keys,
    "enrich_assets": q_enrich_assets,
    "asset_links": q_asset_links,
    "line_facts": q_line_facts,
    "tiered_match": q_tiered_match,
    "tiered_match_rules": q_tiered_match_rules,
    "tier_summary": q_tier_summary,
    "snapshot_compare": q_snapshot_compare,
    "snapshot_segments": q_snapshot_segments,
    "ranked_segments": q_ranked_segments,
    "run_compare": q_run_compare,
    "run_compare_versions": q_run_compare_versions,
    "run_compare_changed": q_run_compare_changed,
    "classify_lines": q_classify_lines,
    "decom_rollup": q_decom_rollup,
    "decom_rollup_merged": q_decom_rollup_merged,
    "reversal_pairs": q_reversal_pairs,
    "reversal_rollup": q_reversal_rollup,
    "line_status": q_line_status,
    "status_summary": q_status_summary,
    "account_rollup": q_account_rollup,
    "account_rollup_strings": q_account_rollup_strings,
    "rollup_chunks": q_rollup_chunks,
    "period_change": q_period_change,
    "period_change_lists": q_period_change_lists,
    "period_rejects": q_period_rejects,
    "membership_flag": q_membership_flag,
    "null_safe_exclusion": q_null_safe_exclusion,
    "scalar_probe": q_scalar_probe,
    "profile_columns": q_profile_columns,
}
