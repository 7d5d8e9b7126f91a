"""Plan checks of §5: no nested-loop or cartesian join, no Python UDF node,
column pruning at the scans, no repeated upstream plans in the match."""

import contextlib

import pytest

import __spark_entry__ as entry
from saletrace.plans.catalog import FixtureRun
from saletrace.plans.checks import count_nodes, physical_plan, plan_problems, read_schemas

COMPOSITES = ["line_facts", "tiered_match", "snapshot_compare", "classify_lines",
              "line_status", "decom_rollup", "reversal_rollup", "account_rollup",
              "period_change", "enrich_assets", "unify_sources", "null_safe_exclusion"]


@pytest.mark.parametrize("name", COMPOSITES)
def test_no_forbidden_nodes(spark, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    assert plan_problems(df) == []


def test_lineitem_scan_is_pruned(spark, sf_small):
    df = entry.queries()["line_facts"](spark, sf_small)
    schemas = [s for s in read_schemas(df) if "l_orderkey" in s]
    assert schemas
    for s in schemas:
        for unused in ("l_tax", "l_discount", "l_shipdate", "l_linestatus"):
            assert unused not in s


NO_PAIRS = ["tier_summary", "snapshot_compare", "snapshot_segments", "ranked_segments",
            "run_compare", "classify_lines", "account_rollup", "period_change"]


@contextlib.contextmanager
def large_inputs(spark):
    """Plans as for inputs too big to broadcast, before any runtime change."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@contextlib.contextmanager
def jobs_of(spark):
    """The number of jobs that run inside."""
    tracker, seen = spark.sparkContext.statusTracker(), []
    spark.sparkContext.setJobGroup("plan-test", "plan test")
    before = set(tracker.getJobIdsForGroup("plan-test"))
    try:
        yield seen
        seen += set(tracker.getJobIdsForGroup("plan-test")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("build", ["facts", "enriched", "matched", "summary", "rollup", "status"])
def test_building_runs_no_job(spark, sf_small, build):
    run = FixtureRun(spark, sf_small, write=False)
    for df in run.fx.t.all().values():  # footers are read before
        df.schema
    with jobs_of(spark) as jobs:
        getattr(run, build)()
    assert jobs == []


def test_match_plan_at_scale(spark, sf_small):
    """Nothing written in between: the key summaries, the best tiers and the
    sliced pair join are all in the plan, without a one-task step."""
    with large_inputs(spark):
        df = FixtureRun(spark, sf_small, write=False).matched()
        text = physical_plan(df)
        assert plan_problems(df) == []
    assert "SinglePartition" not in text
    # what is broadcast is the constant class-to-family lookup
    for below in text.split("BroadcastExchange ")[1:]:
        assert "_lk_class" in "".join(below.splitlines()[1:3])
    assert "partial_count(CASE WHEN _for" in text      # key summaries, combined before the shuffle
    assert "partial_min(_row_tier" in text                # best tier of a line
    assert "Window" not in text and "_k_salt" in text


@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_pair_join(spark, sf_small, name, monkeypatch):
    """Queries that need no pairs never build them."""
    from saletrace.plans import catalog

    def pairs(*args, **kwargs):
        raise AssertionError("pairs built")
    monkeypatch.setattr(catalog, "tiered_match", pairs)
    catalog.QUERIES[name](spark, sf_small)


def test_summary_joins_are_on_distinct_keys(spark, sf_small):
    run = FixtureRun(spark, sf_small, write=False)
    assert run.summary().count() <= run.facts().count()


@contextlib.contextmanager
def static_plans(spark):
    """Shuffles that are read twice show in the plan only without adaptive
    execution, which finds them as it runs."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_scans_each_table_once(spark, sf_small):
    """All values of all tables meet in one shuffle, already counted; the
    other is a row per column and task."""
    with large_inputs(spark), static_plans(spark):
        text = planned(entry.queries()["profile_columns"](spark, sf_small))
    assert text.count("FileScan parquet") == 14
    assert text.count("Exchange hashpartitioning(t#") == 2 and "h1#" in text


def test_summary_reads_each_source_once(spark, sf_small):
    """Seven asset sources, deployments, decommission hosts and accounts once
    each; line items, quote lines, quotes, opportunities and the two halves of
    the reversals once each; products twice (themselves and their base
    products).  More tiers read no more."""
    from saletrace.operators.matching import match_summary
    from saletrace.sources.fixtures import FIXTURE_TIERS

    def scans(tiers):
        run = FixtureRun(spark, sf_small, write=False)
        steps = []

        def keep(df):  # the plan that a written step would run
            steps.append(df)
            return df
        match_summary(run.facts(), run.enriched(), run.fx.class_family(), tiers=tiers,
                      materialize_with=keep)
        (step,) = steps
        with large_inputs(spark), static_plans(spark):
            plan = planned(step)
        return plan.count("FileScan parquet"), plan.count("ReusedExchange")
    alone, reused = scans(None)
    wider, _ = scans(FIXTURE_TIERS)
    assert (alone, wider) == (18, 18) and reused >= 2


def test_filters_reach_the_scan(spark, sf_small):
    """The family list and the close-date cut of the line facts reach the
    parquet scans of part and orders."""
    text = physical_plan(entry.queries()["line_facts"](spark, sf_small))
    assert "PushedFilters: [In(p_type," in text
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in text


def test_facts_shuffle_flags_and_numbers(spark, sf_small):
    """Lines are dealt by opportunity as numbers, and the reversal lookups
    become flags before the next shuffle."""
    with large_inputs(spark), static_plans(spark):
        df = FixtureRun(spark, sf_small, write=False).facts()
        text = planned(df)
    dealt = [x for x in text.splitlines() if "REPARTITION_BY_COL" in x]
    assert len(dealt) == 2 and all("l_orderkey" in x for x in dealt)
    lines = text.splitlines()
    moved = [lines[i + 1] for i, x in enumerate(lines) if "Exchange hashpartitioning(_li_prod" in x]
    assert moved and all("AS _reversed" in x for x in moved)


@pytest.mark.parametrize("name, written", [
    ("account_rollup_strings", ["match_step"]), ("account_rollup", ["match_step"]),
    ("ranked_segments", []), ("snapshot_compare", []), ("classify_lines", ["ordered"])])
def test_lines_take_their_tier_as_they_aggregate(spark, sf_small, name, written, monkeypatch):
    """The best tier of a line is found in the aggregate by line that the query
    needs anyway: no minimum, no written lines and no join of its own."""
    from saletrace.plans import catalog

    names, steps = [], []

    def keep(df, step):
        names.append(step)
        steps.append(df)
        return df
    monkeypatch.setattr(catalog, "materialize", keep)
    df = catalog.QUERIES[name](spark, sf_small)
    assert names == written
    assert "_b_id" not in physical_plan(df)
    if name != "account_rollup_strings" and name != "account_rollup":
        with large_inputs(spark), static_plans(spark):
            text = planned(steps[0] if steps else df)
        by_line = [x for x in text.splitlines() if "Exchange hashpartitioning(oli_id" in x
                   or "Exchange hashpartitioning(_k#" in x]
        assert len(by_line) == 1
