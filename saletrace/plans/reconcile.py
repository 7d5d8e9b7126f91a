"""The reconciliation run end to end, with its tables written as snapshots.

The original runs five SQL steps that hand tables to each other: the match
table, a comparison of two match runs, the line classes, the status
dataset, and the period report.  ``run_reconciliation`` does the same over
canonical input DataFrames: each output is written once per run id under
``out_dir/<table>/run_id=<id>`` (never overwriting what a step reads), and
later steps read the written tables, so every step boundary is a durable
checkpoint on shared storage.  ``compare_runs`` compares the match tables
of two runs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from saletrace.operators.assets import AssetSource, enrich_assets, host_keys, unify_sources
from saletrace.operators.classify import classify_lines
from saletrace.operators.compare import compare_snapshots
from saletrace.operators.facts import line_facts
from saletrace.operators.matching import Tier, default_tiers, tiered_match
from saletrace.operators.period import period_change
from saletrace.operators.rollups import account_rollup
from saletrace.operators.status import decom_rollup, line_status, reversal_rollup
from saletrace.params import ClassifyRules, FactRules, Lookups, PeriodRules, StatusRules
from saletrace.plans.materialize import materialize
from saletrace.sources.io import lookup, read_snapshot, write_snapshot


@dataclass
class Inputs:

    opportunity: DataFrame
    line_item: DataFrame
    quote_line: DataFrame
    quote: DataFrame
    product: DataFrame
    reversal: DataFrame
    asset_sources: list[AssetSource]
    master_account: DataFrame
    deployment: DataFrame
    decom_host: DataFrame
    # inputs of the status dataset and the period report (optional)
    line_asset: DataFrame | None = None
    decom_event: DataFrame | None = None
    reverse_rebook: DataFrame | None = None
    arr: DataFrame | None = None


@dataclass
class Rules:
    facts: FactRules
    lookups: Lookups
    classify: ClassifyRules = ClassifyRules()
    status: StatusRules = StatusRules()
    period: PeriodRules = PeriodRules()
    tiers: tuple[Tier, ...] = field(default_factory=default_tiers)


def run_reconciliation(spark: SparkSession, inputs: Inputs, rules: Rules, out_dir: str,
                       run_id: str, hot_key_rows: int | None = 1_000_000) -> dict[str, str]:
    """Run the match, classification, status dataset and period report;
    write each as a snapshot of ``run_id``; return ``{table: folder}``.
    ``hot_key_rows``: match keys with more rows are sliced (see
    ``tiered_match``); None leaves skew to AQE alone."""
    out = out_dir.rstrip("/")
    written: dict[str, str] = {}
    class_family = lookup(spark, rules.lookups.class_family, "class_name string, family string")
    family_short = lookup(spark, rules.lookups.family_short, "family string, short_name string")

    assets = materialize(enrich_assets(unify_sources(inputs.asset_sources), inputs.master_account,
                                       inputs.deployment, host_keys(inputs.decom_host)),
                         "enriched_assets")
    facts = line_facts(inputs.opportunity, inputs.line_item, inputs.quote_line, inputs.quote,
                       inputs.product, inputs.reversal, rules.facts)
    matched = tiered_match(facts, assets, class_family,
                           materialize_with=lambda df: materialize(df, "match_step"),
                           hot_key_rows=hot_key_rows, tiers=rules.tiers)
    written["matched"] = write_snapshot(matched, f"{out}/matched", run_id)
    matched = read_snapshot(spark, f"{out}/matched", run_id)

    classes = classify_lines(matched, rules.classify)
    written["line_classes"] = write_snapshot(classes, f"{out}/line_classes", run_id,
                                             sort_within=["oli_id"])
    classes = read_snapshot(spark, f"{out}/line_classes", run_id)

    if inputs.line_asset is not None and inputs.decom_event is not None \
            and inputs.reverse_rebook is not None:
        status = line_status(inputs.line_asset, decom_rollup(inputs.decom_event, rules.status),
                             reversal_rollup(inputs.line_asset, inputs.reverse_rebook,
                                             inputs.quote, rules.status), rules.status)
        written["line_status"] = write_snapshot(status, f"{out}/line_status", run_id)

    if inputs.arr is not None:
        rollup = account_rollup(matched, classes, family_short, rules.period.excluded_opp_type,
                                as_strings=rules.period.attach_lists)
        written["account_rollup"] = write_snapshot(rollup, f"{out}/account_rollup", run_id)
        if rules.period.attach_lists:
            rollup = read_snapshot(spark, f"{out}/account_rollup", run_id)
        report = period_change(inputs.arr, rollup, rules.period)
        written["period_change"] = write_snapshot(report, f"{out}/period_change", run_id)
    return written


def compare_runs(spark: SparkSession, out_dir: str, old_run: str, new_run: str) -> DataFrame:
    """Segment counts between the match tables of two runs."""
    old = read_snapshot(spark, f"{out_dir.rstrip('/')}/matched", old_run)
    new = read_snapshot(spark, f"{out_dir.rstrip('/')}/matched", new_run)
    return compare_snapshots(old, new)


def fixture_inputs(spark: SparkSession, sf_dir: str) -> tuple[Inputs, Rules]:
    """Inputs and rules of the test fixtures (``sources.fixtures``)."""
    from saletrace.sources import fixtures as fx_mod

    fx = fx_mod.Fixtures(spark, sf_dir)
    inputs = Inputs(
        opportunity=fx.opportunity(), line_item=fx.line_item(), quote_line=fx.quote_line(),
        quote=fx.quote(), product=fx.product(), reversal=fx.reversal(),
        asset_sources=fx.asset_sources(), master_account=fx.master_account(),
        deployment=fx.deployment(), decom_host=fx.decom_host(), line_asset=fx.line_asset(),
        decom_event=fx.decom_event(), reverse_rebook=fx.reverse_rebook(), arr=fx.arr_quarter())
    rules = Rules(facts=fx_mod.FIXTURE_FACT_RULES, lookups=fx_mod.FIXTURE_LOOKUPS,
                  classify=fx_mod.FIXTURE_CLASSIFY_RULES, status=fx_mod.FIXTURE_STATUS_RULES,
                  period=fx_mod.FIXTURE_PERIOD_RULES)
    return inputs, rules
