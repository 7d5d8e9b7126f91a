"""Bucketed versions: atomic publishing, comparison without a shuffle, by
changed buckets only, and rollups merged batch by batch."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from saletrace.operators.compare import compare_snapshots
from saletrace.operators.status import decom_rollup, merge_decoms
from saletrace.plans.runs import changed_buckets, compare_changed, compare_versions, write_run
from saletrace.sources.versions import current_version, read_version, write_version
from test_skew import conf

SCHEMA = "oli_id string, family string"


def rows(seed, n=300):
    r = random.Random(seed)
    out = [(f"L{r.randrange(n)}", r.choice(["F1", "F2", None, "overall"])) for _ in range(n)]
    return out + [(None, "F1"), (None, None)]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def root(tmp_path):
    return f"file://{tmp_path}/runs"


def test_bucketed_and_changed_equal_snapshots(spark, root):
    old, base = rows(1), rows(1)
    new = base[:-40] + [("L7", "F9"), ("X1", "F1"), (None, "F3")]
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (old, new))
    write_run(a, root, "old", buckets=16)
    write_run(b, root, "new", buckets=16)
    write_run(a.limit(0), root, "none", buckets=16)
    for x, y, dx, dy in (("old", "new", a, b), ("new", "old", b, a), ("old", "old", a, a),
                         ("none", "new", a.limit(0), b), ("old", "none", a, a.limit(0)),
                         ("none", "none", a.limit(0), a.limit(0))):
        want = got(compare_snapshots(dx, dy))
        assert got(compare_versions(spark, root, x, y)) == want
        assert got(compare_changed(spark, root, x, y)) == want


def test_no_exchange_below_the_compare(spark, root):
    for run in ("old", "new"):
        write_run(spark.createDataFrame(rows(3), SCHEMA), root, run, buckets=8)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.enabled": "false"}):
        plan = compare_versions(spark, root, "old", "new")._jdf.queryExecution().executedPlan()
        text = plan.toString()
    below = text[text.index("SortMergeJoin"):]
    assert "Exchange" not in below
    assert len(re.findall("Bucketed: true", text)) == 2


def test_unchanged_buckets_are_not_read(spark, root):
    base = [(f"L{i}", "F1") for i in range(400)]
    moved = [(k, "F2" if k == "L11" else f) for k, f in base]
    a = write_run(spark.createDataFrame(base, SCHEMA), root, "old", buckets=32)
    b = write_run(spark.createDataFrame(moved, SCHEMA), root, "new", buckets=32)
    fa, fb = changed_buckets(spark, a, b)
    assert len(fa) == len(fb) == 1
    read = [f for f in compare_changed(spark, root, "old", "new").inputFiles()
            if "-digests" not in f and "-self" not in f]
    assert len(read) == 2
    assert got(compare_changed(spark, root, "old", "new")) == got(compare_snapshots(
        spark.createDataFrame(base, SCHEMA), spark.createDataFrame(moved, SCHEMA)))


def test_a_null_is_not_its_neighbour(spark, root):
    """(a, null) and (null, a) differ; equal rows in another order do not."""
    x = write_run(spark.createDataFrame([("a", None), ("b", "c")], SCHEMA), root, "x", buckets=1)
    y = write_run(spark.createDataFrame([(None, "a"), ("b", "c")], SCHEMA), root, "y", buckets=1)
    z = write_run(spark.createDataFrame([("b", "c"), ("a", None)], SCHEMA), root, "z", buckets=1)
    assert changed_buckets(spark, x, y)[0] and changed_buckets(spark, x, z) == ([], [])


def test_a_failed_write_leaves_the_old_version(spark, root):
    first = spark.createDataFrame([("L1", "F1")], SCHEMA)
    before = write_version(first, root, "t", "oli_id", 4)
    bad = first.withColumn("family", F.expr("raise_error('lost')").cast("string"))
    with pytest.raises(Exception):
        write_version(bad, root, "t", "oli_id", 4)
    assert current_version(spark, root, "t") == before
    assert got(read_version(spark, root, "t")) == [("L1", "F1")]
    held = read_version(spark, root, "t")  # a reader of the old version
    write_version(spark.createDataFrame([("L2", "F2")], SCHEMA), root, "t", "oli_id", 4)
    assert got(held) == [("L1", "F1")]
    assert got(read_version(spark, root, "t")) == [("L2", "F2")]


def test_runs_of_other_buckets_are_refused(spark, root):
    df = spark.createDataFrame([("L1", "F1")], SCHEMA)
    write_run(df, root, "a", buckets=2)
    write_run(df, root, "b", buckets=4)
    with pytest.raises(ValueError):
        compare_versions(spark, root, "a", "b")


def test_decoms_merged_in_batches(spark, root):
    r = random.Random(4)
    events = [(r.choice(["a", "b", "c", "d", None]),
               dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(900)) if r.random() > .1
               else None, r.randrange(2)) for _ in range(120)]
    schema = "asset_id string, decommissioned_at timestamp, acct_product_match int"
    whole = decom_rollup(spark.createDataFrame(events, schema))
    state = decom_rollup(spark.createDataFrame([], schema))
    write_version(state, root, "decoms", "asset_id", 4)
    for at in (0, 40, 80):
        batch = spark.createDataFrame(events[at:at + 40], schema)
        merged = merge_decoms(read_version(spark, root, "decoms"), batch)
        write_version(merged, root, "decoms", "asset_id", 4)
    assert got(read_version(spark, root, "decoms")) == got(whole)


def test_run_is_dealt_once(spark, root, monkeypatch):
    """The DISTINCT of a run and its buckets share one shuffle."""
    from saletrace.plans import runs
    from test_plans import planned, static_plans
    staged = []

    def stage(df, root, name, key, buckets):
        with static_plans(spark):  # as stage_version deals the rows
            staged.append(planned(df.repartition(buckets, key)))
        return stage_version(df, root, name, key, buckets)
    stage_version = runs.stage_version
    monkeypatch.setattr(runs, "stage_version", stage)
    write_run(spark.createDataFrame([("a", "F1"), ("a", "F1"), (None, "F2")] * 3, SCHEMA), root, "one",
              buckets=8)
    assert staged[0].count("Exchange hashpartitioning") == 1
    assert got(read_version(spark, root, "one").select("oli_id", "family")) == [("a", "F1"), (None, "F2")]
