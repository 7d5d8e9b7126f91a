"""Snapshot comparison against a brute-force version of the literal SQL
(DISTINCT per run, full outer join on the key, six summary levels)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from saletrace.operators.compare import compare_snapshots

pairs = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                           st.sampled_from(["F1", "F2", None])), max_size=7)


def brute(old, new):
    o, n = set(old), set(new)
    rows, used = [], set()
    for ok, og in o:
        partners = [(nk, ng) for nk, ng in n if ok is not None and nk == ok]
        for p in partners:
            rows.append((og if og is not None else p[1], "in_both"))
            used.add(p)
        if not partners:
            rows.append((og, "new_only" if ok is None else "old_only"))
    rows += [(ng, "new_only") for nk, ng in n if (nk, ng) not in used]
    out = Counter()
    for g, seg in rows:
        out[("overall", seg)] += 1
        out[(g, seg)] += 1
    for side, label in ((o, "total_old"), (n, "total_new")):
        out[("overall", label)] = len({k for k, _ in side if k is not None})
        for g in {g for _, g in side}:
            out[(g, label)] = len({k for k, gg in side if gg == g and k is not None})
    return out


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs, pairs)
def test_compare_equals_literal_sql(spark, old, new):
    schema = "oli_id string, family string"
    got = compare_snapshots(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema))
    rows = [(r["family"], r["segment"], r["unique_oli_count"]) for r in got.collect()]
    assert len(rows) == len({(f, s) for f, s, _ in rows})
    assert Counter({(f, s): c for f, s, c in rows}) == brute(old, new)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["F1", None]),
                          st.integers(0, 3)), max_size=8))
def test_one_pass_cuts_equal_two_snapshots(spark, rows):
    from pyspark.sql import functions as F

    from saletrace.operators.compare import compare_cuts

    df = spark.createDataFrame(rows, "oli_id string, family string, d int")
    old, new = df.where(F.col("d") < 2), df.where(F.col("d") >= 1)
    a = sorted(map(tuple, compare_snapshots(old, new).collect()), key=str)
    b = sorted(map(tuple, compare_cuts(df, F.col("d") < 2, F.col("d") >= 1).collect()), key=str)
    assert a == b


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from("abcdef"), st.sampled_from(["F1", "F2"])),
       st.dictionaries(st.sampled_from("abcdef"), st.sampled_from(["F1", "F2"])))
def test_identities_with_unique_ids(spark, old, new):
    schema = "oli_id string, family string"
    got = {(r["family"], r["segment"]): r["unique_oli_count"] for r in compare_snapshots(
        spark.createDataFrame(list(old.items()), schema),
        spark.createDataFrame(list(new.items()), schema)).collect()}
    o = lambda seg: got.get(("overall", seg), 0)
    assert o("old_only") + o("in_both") == o("total_old")
    assert o("new_only") + o("in_both") == o("total_new")
    assert o("in_both") <= min(o("total_old"), o("total_new"))


def test_segments_deal_each_run_once(spark):
    """The DISTINCT of a run and the join by its key share one shuffle."""
    from saletrace.operators.compare import segments
    from test_plans import large_inputs, planned, static_plans

    old = spark.createDataFrame([("a", "F1"), ("a", "F1"), ("b", "F2"), (None, "F1"), (None, "F1")],
                                "oli_id string, family string")
    new = spark.createDataFrame([("a", "F2"), ("a", "F1"), ("c", None), (None, "F1")],
                                "oli_id string, family string")
    with large_inputs(spark), static_plans(spark):
        df = segments(old, new)
        assert planned(df).count("Exchange hashpartitioning") == 2
    assert Counter(map(tuple, df.collect())) == Counter([
        ("a", "F1", "in_both"), ("a", "F1", "in_both"), ("b", "F2", "old_only"),
        ("c", None, "new_only"), (None, "F1", "new_only"), (None, "F1", "new_only")])
