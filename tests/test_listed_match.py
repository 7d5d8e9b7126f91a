"""The match by lists: facts and assets meet once, by the first key of all kinds."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings

from helpers import assets_df, d, facts_df
from saletrace.operators.matching import LOOKED_UP, Tier, tiered_match
from saletrace.sources.fixtures import FIXTURE_TIERS
from test_matching import LOOKUP, asset_rows, brute_cascade, fact_rows
from test_plans import large_inputs, planned, static_plans


def rows(df):
    return Counter(map(tuple, df.collect()))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_rows, asset_rows)
def test_lists_equal_cascade(spark, facts, assets):
    """Accounts of over two asset rows take the join, the others the lists."""
    facts = [dict(f, opp_id=f"O{i}") for i, f in enumerate(facts)]
    assets = [dict(a, asset_id=f"V{i}", deployment_asset_id=f"V{i}" if a.pop("has_dep") else None)
              for i, a in enumerate(assets)]
    res = tiered_match(facts_df(spark, facts), assets_df(spark, assets),
                       spark.createDataFrame(LOOKUP, "class_name string, family string"),
                       materialize_with=lambda df: df.localCheckpoint(), list_rows=2)
    assert Counter((r["opp_id"], r["oli_id"], r["asset_id"], r["match_type"])
                   for r in res.collect()) == brute_cascade(facts, assets)


def case(spark):
    """Repeated facts, assets and lookup rows, NULL ids and keys, a line of two
    accounts, and keys of two kinds with one value."""
    facts = [{"opp_id": f"O{i}", "oli_id": o, "account_id": a, "base_product_code": b, "family": f, "quantity": q,
              "enabled_ol": i % 2 == 0, "close_date": d("2024-01-02")}
             for i, (o, a, b, f, q) in enumerate([
                 ("L1", "A1", "B1", "F1", 1.0), ("L1", "A2", "B9", "F2", 1.0), ("L2", "A2", "F2", "F1", 1.0),
                 ("L3", "A2", "B1", "F3", -1.0), ("L4", None, "B1", "F1", 1.0), ("L5", "A3", None, "F2", 1.0),
                 (None, "A1", "B2", "F2", 1.0), (None, None, None, None, None), ("L6", "A4", "B1", "F1", 2.0)])]
    assets = [{"asset_id": f"V{i}", "account_id": a, "class_name": c, "deployment_code": b, "enabled": i % 3 > 0,
               "deployment_asset_id": f"V{i}" if b else None, "install_status": "1" if i % 2 else None}
              for i, (a, c, b) in enumerate([
                  ("A1", "c1", "B1"), ("A1", "c2", "B2"), ("A1", "c1", None), ("A2", "c1", "F2"), ("A2", "error", None),
                  ("A2", "c2", "B1"), ("A3", "c2", None), (None, "c1", "B1"), ("A3", "error", "B1")])]
    return (facts_df(spark, facts + facts[1:4]), assets_df(spark, assets + assets[2:7]),
            spark.createDataFrame([*LOOKUP, LOOKUP[1]], "class_name string, family string"))


@pytest.mark.parametrize("tiers", [None, FIXTURE_TIERS, (
    Tier("code", ("account_id", "base_product_code"), ("asset_account_id", "deployment_code")),
    Tier("other", ("family", "account_id"), (LOOKED_UP, "asset_account_id")))])
def test_every_way_gives_the_same(spark, tiers):
    """Keys of one and two parts, predicates on both sides; rules whose keys do
    not begin with the same one are joined."""
    inputs = case(spark)
    plain = rows(tiered_match(*inputs, tiers=tiers))
    for n in (0, 3, 128):
        steps = []

        def keep(df):
            steps.append(df)
            return df.localCheckpoint()
        assert rows(tiered_match(*inputs, tiers=tiers, materialize_with=keep, list_rows=n,
                                 hot_key_rows=1)) == plain
        same_first = tiers is None or tiers[-1].line[0] == "account_id"
        assert len(steps) == (5 if same_first else 3)


@pytest.mark.parametrize("tiers", [None, FIXTURE_TIERS])
def test_facts_and_assets_are_shuffled_once_for_all_kinds(spark, tiers, tmp_path):
    """By lookups the facts were shuffled once for each kind and again for the
    pairs, for which the assets were shuffled too."""
    steps = []

    def keep(df):
        with large_inputs(spark), static_plans(spark):
            steps.append(planned(df))
        path = f"{tmp_path}/{len(steps)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    out = tiered_match(*case(spark), tiers=tiers, materialize_with=keep)
    (met,) = [x for x in steps if "_hits" in x]
    dealt = [x for x in met.splitlines() if "Exchange hashpartitioning(" in x]
    assert len([x for x in dealt if "_slice" in x]) == 1 and "SinglePartition" not in met
    assert len([x for x in dealt if "_copy" in x]) == 1
    assert not any("_slice" in x for x in steps[:steps.index(met)])
    assert rows(out) == rows(tiered_match(*case(spark), tiers=tiers))
