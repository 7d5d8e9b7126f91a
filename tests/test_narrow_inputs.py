"""Shuffles that the period report and the asset enrichment do without."""

from dataclasses import replace

from helpers import assets_df
from saletrace.operators.assets import enrich_assets
from saletrace.operators.period import period_change
from saletrace.plans.catalog import FixtureRun
from saletrace.plans.checks import read_schemas
from saletrace.sources.fixtures import FIXTURE_PERIOD_RULES
from test_plans import large_inputs, planned, static_plans


def test_report_is_summed_where_its_lines_are(spark, sf_small):
    """Lines come dealt by opportunity, one of the keys they are summed by: only
    the sums are shuffled again, for the lists, and without the year."""
    run = FixtureRun(spark, sf_small, write=False)
    lists = spark.createDataFrame([], "account_id string, family string, decom_rr_olis string, provision_olis string")
    with large_inputs(spark), static_plans(spark):
        text = planned(period_change(run.fx.arr_quarter(), lists, replace(
            FIXTURE_PERIOD_RULES, sort=False, attach_lists=True)))
    lines = text.splitlines()
    assert "Exchange hashpartitioning(account_name" not in text
    dealt = [x for x in lines if "REPARTITION_BY_COL" in x]
    assert len(dealt) == 1 and "l_orderkey" in dealt[0]
    (moved,) = [lines[i + 1] for i, x in enumerate(lines) if "Exchange hashpartitioning(account_id" in x
                and "oli_id" in lines[i + 1]]
    assert "close_date" in moved and "close_year" not in moved


def test_year_is_of_the_date(spark):
    arr = spark.sql("""SELECT 'n' AS account_name, 'x/A1' AS account_link, 'O1' AS opp_id, 'L1' AS oli_id,
        'F' AS family_short, CAST(d AS date) AS close_date, '1.5' AS arr_text, '2001 | Q2' AS year_quarter
        FROM VALUES ('2001-12-31'), ('2002-01-01'), ('2002-01-01'), (NULL) AS t(d)""")
    for lists in (False, True):
        rollup = spark.createDataFrame([("A1", "F", "L1", "")], (
            "account_id string, family string, decom_rr_olis string, provision_olis string"))
        got = period_change(arr, rollup, replace(FIXTURE_PERIOD_RULES, sort=False, attach_lists=lists))
        assert sorted((r.close_year or 0, r.arr_diff) for r in got.collect()) == [(0, 1.5), (2001, 1.5), (2002, 3.0)]


def test_enrichment_reads_what_is_wanted(spark, sf_small):
    """Assets without a key were spread by a hash of all their columns, which
    were read and shuffled for it."""
    run = FixtureRun(spark, sf_small, write=False)
    schemas = [s for s in read_schemas(run.row_matches(["oli_id"])) if "event_type" in s]
    assert schemas and not any("ts:" in s for s in schemas)


def test_assets_without_keys_are_kept(spark):
    assets = assets_df(spark, [{"asset_id": "V1"}, {"asset_id": "V1"}, {"asset_id": "V2", "resource_key": "k"},
                               {"asset_id": None}]).withColumnRenamed("account_id", "_unused")
    got = enrich_assets(assets.drop("_unused", "deployment_asset_id", "deployment_id", "deployment_code",
                                    "decom_resource"),
                        spark.createDataFrame([(None, "A")], "source_account_id string, account_id string"),
                        spark.createDataFrame([("D", None, "c")], "id string, asset_id string, product_code string"),
                        spark.createDataFrame([("k",), (None,)], "resource_key string"))
    assert sorted((r.asset_id or "", r.account_id, r.decom_resource or "") for r in got.collect()) == [
        ("", None, ""), ("V1", None, ""), ("V1", None, ""), ("V2", None, "k")]
