"""Tiered match: the single-pass plan against a brute-force cascade."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import d, assets_df, facts_df
from saletrace.params import TIER_LABELS
from saletrace.operators.matching import tiered_match

LOOKUP = [("c1", "F1"), ("c1", "F2"), ("c2", "F2")]  # c3 and F3 unmapped


def eq(a, b):
    return a is not None and b is not None and a == b


def brute_cascade(facts, assets):
    """The literal four-tier cascade with NOT IN on line ids, row by row."""
    t1 = [(f, a) for f in facts for a in assets
          if a.get("deployment_asset_id") is not None and eq(a.get("account_id"), f.get("account_id"))
          and eq(a.get("deployment_code"), f.get("base_product_code"))]
    ids1 = {f.get("oli_id") for f, _ in t1}
    t2 = [(f, a) for f in facts if f.get("oli_id") not in ids1 for a in assets
          for c, fam in LOOKUP
          if a.get("deployment_asset_id") is not None and eq(a.get("account_id"), f.get("account_id"))
          and eq(c, a.get("class_name")) and eq(fam, f.get("family"))]
    ids2 = {f.get("oli_id") for f, _ in t2}
    t3 = [(f, a) for f in facts if f.get("oli_id") not in ids1 | ids2 for a in assets
          for c, fam in LOOKUP
          if eq(a.get("account_id"), f.get("account_id")) and eq(c, a.get("class_name"))
          and eq(fam, f.get("family"))]
    ids3 = {f.get("oli_id") for f, _ in t3}
    out = Counter()
    for tier, pairs in zip(TIER_LABELS, (t1, t2, t3)):
        for f, a in pairs:
            out[(f.get("opp_id"), f.get("oli_id"), a.get("asset_id"), tier)] += 1
    for f in facts:
        if f.get("oli_id") not in ids1 | ids2 | ids3:
            out[(f.get("opp_id"), f.get("oli_id"), None, TIER_LABELS[3])] += 1
    return out


def run(spark, facts, assets):
    lk = spark.createDataFrame(LOOKUP, "class_name string, family string")
    res = tiered_match(facts_df(spark, facts), assets_df(spark, assets), lk)
    return Counter((r["opp_id"], r["oli_id"], r["asset_id"], r["match_type"])
                   for r in res.collect())


fact_rows = st.lists(st.fixed_dictionaries({
    "oli_id": st.sampled_from(["L1", "L2", "L3", "L4"]),
    "account_id": st.sampled_from(["A1", "A2", None]),
    "base_product_code": st.sampled_from(["B1", "B2", None]),
    "family": st.sampled_from(["F1", "F2", "F3", None]),
}), max_size=8)
asset_rows = st.lists(st.fixed_dictionaries({
    "account_id": st.sampled_from(["A1", "A2", None]),
    "has_dep": st.booleans(),
    "deployment_code": st.sampled_from(["B1", "B2", None]),
    "class_name": st.sampled_from(["c1", "c2", "c3", None]),
}), max_size=8)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_rows, asset_rows)
def test_single_pass_equals_cascade(spark, facts, assets):
    facts = [dict(f, opp_id=f"O{i}") for i, f in enumerate(facts)]
    assets = [dict(a, asset_id=f"V{i}", deployment_asset_id=f"V{i}" if a.pop("has_dep") else None)
              for i, a in enumerate(assets)]
    assert run(spark, facts, assets) == brute_cascade(facts, assets)


def test_exclusion_is_per_line_not_per_row(spark):
    # line L1 has two rows: one reaches tier 1, the other only tier 3 ->
    # only the tier-1 pairs of the first row survive
    facts = [{"opp_id": "O1", "oli_id": "L1", "account_id": "A1", "base_product_code": "B1",
              "family": "F1"},
             {"opp_id": "O2", "oli_id": "L1", "account_id": "A2", "base_product_code": "B9",
              "family": "F1"}]
    assets = [{"asset_id": "V1", "account_id": "A1", "deployment_asset_id": "V1",
               "deployment_code": "B1", "class_name": "c3"},
              {"asset_id": "V2", "account_id": "A2", "class_name": "c1"}]
    got = run(spark, facts, assets)
    assert got == Counter({("O1", "L1", "V1", TIER_LABELS[0]): 1})
    assert got == brute_cascade(facts, assets)


def test_hot_account_keeps_all_pairs(spark):
    facts = [{"opp_id": f"O{i}", "oli_id": f"L{i}", "account_id": "HOT", "family": "F2"}
             for i in range(30)]
    assets = [{"asset_id": f"V{j}", "account_id": "HOT", "class_name": "c2"} for j in range(40)]
    got = run(spark, facts, assets)
    assert sum(got.values()) == 30 * 40
    assert set(k[3] for k in got) == {TIER_LABELS[2]}


def test_empty_assets_gives_no_match_rows(spark):
    facts = [{"opp_id": "O1", "oli_id": "L1", "account_id": "A1", "family": "F1"},
             {"opp_id": "O2", "oli_id": "L1", "account_id": "A1", "family": "F1"}]
    got = run(spark, facts, [])
    assert got == Counter({("O1", "L1", None, "no_match"): 1, ("O2", "L1", None, "no_match"): 1})


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_rows, asset_rows)
def test_every_line_in_exactly_one_tier(spark, facts, assets):
    facts = [dict(f, opp_id=f"O{i}") for i, f in enumerate(facts)]
    assets = [dict(a, asset_id=f"V{i}", deployment_asset_id=f"V{i}" if a.pop("has_dep") else None)
              for i, a in enumerate(assets)]
    got = run(spark, facts, assets)
    tiers_per_line = {}
    for (_, oli, _, tier), n in got.items():
        tiers_per_line.setdefault(oli, set()).add(tier)
    assert set(tiers_per_line) == {f["oli_id"] for f in facts}
    assert all(len(t) == 1 for t in tiers_per_line.values())


def run_salted(spark, facts, assets, hot=1):
    lk = spark.createDataFrame(LOOKUP, "class_name string, family string")
    res = tiered_match(facts_df(spark, facts), assets_df(spark, assets), lk,
                       hot_key_rows=hot)
    return Counter((r["opp_id"], r["oli_id"], r["asset_id"], r["match_type"])
                   for r in res.collect())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_rows, asset_rows)
def test_salted_pair_join_equals_cascade(spark, facts, assets):
    facts = [dict(f, opp_id=f"O{i}") for i, f in enumerate(facts)]
    assets = [dict(a, asset_id=f"V{i}", deployment_asset_id=f"V{i}" if a.pop("has_dep") else None)
              for i, a in enumerate(assets)]
    assert run_salted(spark, facts, assets) == brute_cascade(facts, assets)


def test_salted_hot_account_keeps_all_pairs(spark):
    facts = [{"opp_id": f"O{i}", "oli_id": f"L{i}", "account_id": "HOT", "family": "F2"}
             for i in range(20)]
    assets = [{"asset_id": f"V{j}", "account_id": "HOT", "class_name": "c2"} for j in range(30)]
    got = run_salted(spark, facts, assets, hot=10)
    assert got == brute_cascade(facts, assets) and sum(got.values()) == 600


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_rows, asset_rows)
def test_summary_says_what_the_pairs_say(spark, facts, assets):
    """Rows, tiers and line classes from the summary equal those of the pairs."""
    from pyspark.sql import functions as F

    from saletrace.operators.classify import classify_lines, classify_summary
    from saletrace.operators.matching import match_summary

    facts = [dict(f, opp_id=f"O{i}", opp_type="New", quantity=1.0) for i, f in enumerate(facts)]
    assets = [dict(a, asset_id=f"V{i}", deployment_asset_id=f"V{i}" if a.pop("has_dep") else None,
                   enabled=i % 3 > 0, install_status="1" if i % 2 else "4", used_for="Production",
                   decom_resource="k" if i % 4 == 3 else None)
              for i, a in enumerate(assets)]
    lk = spark.createDataFrame(LOOKUP, "class_name string, family string")
    f, a = facts_df(spark, facts), assets_df(spark, assets)
    pairs, summary = tiered_match(f, a, lk), match_summary(f, a, lk)
    keys = ("opp_id", "oli_id", "family", "match_type")
    assert sorted(map(tuple, pairs.groupBy(*keys).count().collect()), key=str) == sorted(
        map(tuple, summary.select(*keys, F.col("n_rows")).collect()), key=str)
    assert sorted(map(tuple, classify_lines(pairs).collect()), key=str) == sorted(
        map(tuple, classify_summary(summary).collect()), key=str)


def test_hot_probe_side_is_dealt(spark):
    facts = [{"opp_id": f"O{i}", "oli_id": f"L{i}", "account_id": "HOT", "family": "F2"}
             for i in range(40)]
    assets = [{"asset_id": f"V{j}", "account_id": "HOT", "class_name": "c2"} for j in range(3)]
    assert run_salted(spark, facts, assets, hot=10) == brute_cascade(facts, assets)


def test_callers_tiers(spark):
    """Rules of one and three keys, with predicates on both sides; ranks follow
    the order given, and wrong rules are refused."""
    import pytest

    from saletrace.operators.matching import LOOKED_UP, Tier, match_summary
    f = facts_df(spark, [
        {"opp_id": "O1", "oli_id": "L1", "account_id": "A", "family": "F", "quantity": 5.0,
         "close_date": d("2024-01-02")},
        {"opp_id": "O1", "oli_id": "L2", "account_id": "A", "family": "F", "quantity": -5.0},
        {"opp_id": "O1", "oli_id": "L3", "account_id": "B", "family": "G", "quantity": 1.0},
        {"opp_id": "O1", "oli_id": "L4", "account_id": None, "family": "F", "quantity": -1.0}])
    a = assets_df(spark, [
        {"asset_id": "V1", "account_id": "A", "class_name": "c", "start_date": d("2024-05-01")},
        {"asset_id": "V2", "account_id": "A", "class_name": "c", "start_date": d("2020-05-01")},
        {"asset_id": "V3", "account_id": "B", "class_name": "x"}])
    lk = spark.createDataFrame([("c", "F"), ("c", "H")], "class_name string, family string")
    tiers = (Tier("same_year", ("account_id", "family", "year(close_date)"),
                  ("asset_account_id", LOOKED_UP, "year(start_date)"), line_where="quantity > 0"),
             Tier("anything", ("account_id",), ("asset_account_id",), asset_where="class_name = 'c'"))
    got = sorted((r.oli_id, r.asset_id, r.match_type)
                 for r in tiered_match(f, a, lk, tiers=tiers, no_match="none").collect())
    assert got == sorted([("L1", "V1", "same_year"), ("L2", "V1", "anything"),
                          ("L2", "V2", "anything"), ("L3", None, "none"), ("L4", None, "none")],
                         key=lambda x: (x[0], x[1] or ""))
    summary = {r.oli_id: (r.match_type, r.n_rows)
               for r in match_summary(f, a, lk, tiers=tiers, no_match="none").collect()}
    assert summary == {"L1": ("same_year", 1), "L2": ("anything", 2), "L3": ("none", 1),
                       "L4": ("none", 1)}
    for bad in ((), (Tier("t", ("a",), ("b", "c")),), (Tier("t", ("a",), ("b",)),) * 2,
                (Tier("t", ("a", "b"), (LOOKED_UP, LOOKED_UP)),)):
        with pytest.raises(ValueError):
            tiered_match(f, a, lk, tiers=bad or [Tier("t", (), ())])


def mixed_case(spark):
    facts = facts_df(spark, [
        {"opp_id": "O1", "oli_id": "L1", "account_id": "A1", "base_product_code": "B1", "family": "F1"},
        {"opp_id": "O2", "oli_id": "L1", "account_id": "A2", "base_product_code": "B9", "family": "F1"},
        {"opp_id": "O3", "oli_id": "L2", "account_id": "A2", "family": "F1"},
        {"opp_id": "O4", "oli_id": "L2", "account_id": "A2", "family": "F2"},
        {"opp_id": "O5", "oli_id": None, "account_id": "A2", "family": "F1"},
        {"opp_id": "O6", "oli_id": None, "account_id": None, "family": "F1"},
        {"opp_id": "O7", "oli_id": "", "account_id": None, "family": "F1"}])
    assets = assets_df(spark, [
        {"asset_id": "V1", "account_id": "A1", "deployment_asset_id": "V1", "deployment_code": "B1",
         "class_name": "c3"},
        {"asset_id": "V2", "account_id": "A2", "class_name": "c1"}])
    return facts, assets, spark.createDataFrame(LOOKUP, "class_name string, family string")


def test_only_mixed_lines_meet_their_rows(spark, tmp_path):
    """Lines whose rows have several tiers are found, NULL ids as one line; once
    they are written, the rows are not shuffled by line."""
    from saletrace.operators.matching import best_tiers, key_summaries, keyed_assets, mixed_lines, row_tiers
    from test_plans import planned, static_plans

    facts, assets, lk = mixed_case(spark)
    keys = key_summaries(keyed_assets(assets, lk))
    found = mixed_lines(row_tiers(facts, keys, ["oli_id"])).collect()
    assert sorted((r._b_id, r._b_null, r._best) for r in found) == [("", True, 3), ("L1", False, 1)]
    written = []

    def keep(df):
        written.append(f"{tmp_path}/{len(written)}")
        df.write.parquet(written[-1])
        return spark.read.parquet(written[-1])
    best = best_tiers(facts, keys, materialize_with=keep, materialize_lines_with=keep)
    with static_plans(spark):
        text = planned(best)
    assert len(written) == 2 and "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert sorted((r.opp_id, r._row_tier, r._best) for r in best.collect()) == [
        ("O1", 1, 1), ("O2", 3, 1), ("O3", 3, 3), ("O4", 3, 3), ("O5", 3, 3), ("O6", 4, 3), ("O7", 4, 4)]
    got = Counter((r.opp_id, r.oli_id, r.asset_id) for r in tiered_match(facts, assets, lk).collect())
    assert got == Counter([("O1", "L1", "V1"), ("O3", "L2", "V2"), ("O4", "L2", "V2"), ("O5", None, "V2"),
                           ("O7", "", None)])


def test_lookups_shuffle_a_row_once_each(spark):
    """A lookup shuffles the rows and nothing else a second time: the summaries
    arrive dealt by its key, and keys that are wanted columns travel once."""
    from saletrace.operators.matching import key_summaries, keyed_assets, row_tiers
    from test_plans import large_inputs, planned, static_plans

    facts, assets, lk = mixed_case(spark)
    columns = ["oli_id", "account_id", "family", "base_product_code"]
    with large_inputs(spark), static_plans(spark):
        text = planned(row_tiers(facts, key_summaries(keyed_assets(assets, lk)), columns))
    by_key = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len([x for x in by_key if "_slice" in x]) == 2
    assert len([x for x in by_key if "_k0" in x]) == 2 and len(by_key) == 5  # and the class lookup
    assert "_q0" not in text


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_rows, asset_rows)
def test_rows_with_their_own_tier_give_the_same(spark, facts, assets):
    """Classes, rollups and comparisons that take a line's least tier as they
    aggregate equal those of the summary, whose lines are joined to their best
    tier; NULL ids and dates, rows that are not counted and reversals too."""
    from pyspark.sql import functions as F

    from saletrace.operators.classify import LINE_TESTS, classify_rows, classify_summary, line_tests
    from saletrace.operators.compare import compare_cuts
    from saletrace.operators.matching import match_summary, row_matches
    from saletrace.operators.rollups import account_rollup

    facts = [dict(f, opp_id=f"O{i}", opp_type=("New", "New", "Renewal", None)[i % 4], quantity=float(i % 5),
                  oli_id=None if i % 7 == 6 else f["oli_id"], close_date=None if i % 6 == 5 else d(f"2024-01-0{i % 3 + 1}"),
                  reversal_opp="reversal" if i % 8 == 7 else None)
             for i, f in enumerate(facts)]
    assets = [dict(a, asset_id=f"V{i}", deployment_asset_id=f"V{i}" if a.pop("has_dep") else None,
                   enabled=i % 3 > 0, install_status="1" if i % 2 else "4", used_for="Production",
                   decom_resource="k" if i % 4 == 3 else None)
              for i, a in enumerate(assets)]
    lk = spark.createDataFrame(LOOKUP, "class_name string, family string")
    short = spark.createDataFrame([("F1", "X"), ("F2", "X")], "family string, short_name string")
    f, a = facts_df(spark, facts), assets_df(spark, assets)
    summary = match_summary(f, a, lk)
    own = row_matches(line_tests(f), a, lk, columns=(
        "oli_id", *LINE_TESTS, "opp_type", "account_id", "family", "close_date"))

    def same(x, y):
        assert sorted(map(tuple, x.collect()), key=str) == sorted(map(tuple, y.collect()), key=str)
    old, new = classify_summary(summary), classify_rows(own)
    same(old, new.drop("_best"))
    for strings in (True, False):
        same(account_rollup(summary, old, short, as_strings=strings),
             account_rollup(own, new, short, as_strings=strings, own_tier=True))
    day = F.col("close_date")
    cuts = (day < F.lit("2024-01-03").cast("date"), day >= F.lit("2024-01-02").cast("date"))
    same(compare_cuts(summary, *cuts), compare_cuts(own, *cuts, tier="_row_tier"))


def test_only_rows_of_the_least_tier_count(spark):
    """A flag, a list entry and a group that a row of a worse tier has are not
    the line's."""
    from pyspark.sql import functions as F

    from saletrace.operators.classify import classify_rows
    from saletrace.operators.compare import compare_cuts

    rows = spark.createDataFrame([
        ("L1", 1, "F1", False, True, 0), ("L1", 2, "F2", True, True, 0), ("L2", 3, "F1", True, False, 0),
        ("L3", 2, "F1", False, False, 9), ("L3", 3, "F2", True, False, 0)],
        "oli_id string, _row_tier int, family string, _decom_by_line boolean, _prov_by_line boolean, day int")
    rows = rows.withColumns({"_counted": F.lit(True), "any_live": F.lit(False), "any_decom": F.lit(False),
                             "match_type": F.lit("account_family")})
    got = sorted((r.oli_id, r.decom_rr, r.provisioned, r._best) for r in classify_rows(rows).collect())
    assert got == [("L1", None, 1, 1), ("L2", 1, None, 3)]
    report = compare_cuts(rows, F.col("day") < 5, F.col("day") < 0, tier="_row_tier").collect()
    # L3's only row in the old cut is of a worse tier than its row outside
    assert {(r.family, r.segment): r.unique_oli_count for r in report} == {
        ("F1", "old_only"): 2, ("F1", "total_old"): 2, ("overall", "old_only"): 2,
        ("overall", "total_old"): 2, ("overall", "total_new"): 0}
